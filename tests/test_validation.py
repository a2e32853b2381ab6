import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import drift, quality, record, report, verdict
from sluice.sources.registry import Registry, load_registry
from sluice.spec import EVENT_FIELDS, PipelineConfig

CFG = PipelineConfig()
BANK = "banking_transaction_v1"
GOOD = {"transaction_id": "T1", "transaction_date": "2024-01-05", "amount": 10.5,
        "transaction_status": "Success"}


def events(spark, *payloads, schema_id=BANK):
    rows = [(f"e{i}", "G", f"{i}", f"k{i}", "banking_transaction", "2024-01-01T00:00:00Z",
             schema_id, "cloud", "1.0.0", p if p is None or isinstance(p, str) else json.dumps(p), i)
            for i, p in enumerate(payloads)]
    schema = ", ".join(f"{c} string" for c in EVENT_FIELDS) + ", arrival bigint"
    return spark.createDataFrame(rows, schema)


def validate(spark, registry, *payloads, schema_id=BANK):
    got = verdict.validate(events(spark, *payloads, schema_id=schema_id), registry,
                           "2024-01-05T07:08:09.123Z", CFG)
    return [r for r in got.orderBy("arrival").collect()]


def kinds(row):
    return [(v.field, v.expected_type, v.actual_type, v.violation_type) for v in row.violations]


def test_clean_payload(spark, registry):
    row, = validate(spark, registry, GOOD)
    assert (row.drift_detected, row.schema_valid, row.compatibility, row.recommended_action,
            row.drift_type, row.schema_version) == (False, True, "FULL", "AUTO_EVOLVE", None, "1.0")
    assert (row.validation_status, row.quality_score) == ("PASSED", 1.0)


def test_violations_in_registry_then_payload_order(spark, registry):
    row, = validate(spark, registry, {
        "zeta": None, "transaction_id": 5, "amount": None, "alpha": [1], "channel": {"a": 1},
        "balance": True})
    assert kinds(row) == [
        ("transaction_id", "string", "number", "TYPE_CHANGE"),
        ("transaction_date", "string", "null", "MISSING_FIELD"),
        ("amount", "number", "null", "MISSING_FIELD"),
        ("balance", "number", "boolean", "TYPE_CHANGE"),
        ("channel", "string", "unknown", "TYPE_CHANGE"),
        ("zeta", "undefined", "unknown", "NEW_FIELD"),
        ("alpha", "undefined", "unknown", "NEW_FIELD")]
    assert (row.drift_type, row.compatibility, row.recommended_action) == (
        "TYPE_CHANGE", "NONE", "REJECT")
    assert (row.validation_status, row.quality_score, row.quality_threshold, row.rule_results,
            row.rejection_reason) == ("REJECTED", 0.0, 0.0, [], "SCHEMA_BREAKING_CHANGE:TYPE_CHANGE")


def test_new_field_is_not_breaking(spark, registry):
    row, = validate(spark, registry, {**GOOD, "account_number": "1"})
    assert (row.drift_detected, row.breaking_change, row.compatibility, row.drift_type,
            row.validation_status) == (True, False, "BACKWARD", "NEW_FIELD", "PASSED")


@pytest.mark.parametrize("number", ["1", "1.5", "100.0", "1e3", "123456789012345678901234567890"])
def test_every_number_is_a_number(spark, registry, number):
    row, = validate(spark, registry, json.dumps({**GOOD, "amount": 0}).replace(
        '"amount": 0', f'"amount": {number}'))
    assert row.violations == []


def test_absent_optional_fields_are_no_drift(spark, registry):
    row, = validate(spark, registry, {**GOOD, "balance": None})
    assert row.violations == []


def test_absent_payload_and_unknown_schema(spark, registry):
    row, = validate(spark, registry, None)
    assert [v.violation_type for v in row.violations] == ["MISSING_FIELD"] * 3
    row, = validate(spark, registry, GOOD, schema_id="nobody")
    assert kinds(row) == [("schema_id", "registered schema", "unknown", "MISSING_FIELD")]
    assert (row.schema_version, row.rejection_reason) == (
        "unknown", "SCHEMA_BREAKING_CHANGE:MISSING_FIELD")


@pytest.mark.parametrize("change,score,status", [
    ({}, 23 / 23, "PASSED"),
    ({"amount": 0}, 20 / 23, "PASSED"),
    ({"amount": 0, "transaction_date": "5.1.24"}, 17 / 23, "PASSED"),
    ({"transaction_date": "x", "transaction_status": "x", "balance": -1}, 16 / 23, "QUARANTINED"),
    ({"amount": -1, "transaction_date": "x", "transaction_status": None, "balance": -1,
      "credit_score": 5}, 12 / 23, "QUARANTINED"),
    ({"transaction_id": "  "}, 0.0, "REJECTED"),
    ({"transaction_date": " "}, 0.0, "REJECTED"),
])
def test_score_space(spark, registry, change, score, status):
    row, = validate(spark, registry, {**GOOD, **change})
    assert row.quality_score == pytest.approx(score) and row.validation_status == status
    assert row.quality_passed == (score >= 0.7)
    assert row.rejection_reason == (
        "QUALITY_REJECTED:score=0.00" if status == "REJECTED" else None)


def test_orders_and_lineitem_scores(spark, registry):
    order = {"o_orderkey": 1, "o_custkey": 2, "o_totalprice": 0}
    row, = validate(spark, registry, order, schema_id="tpch_orders_v1")
    assert row.quality_score == pytest.approx(8 / 11) and row.validation_status == "PASSED"
    line = {"line_item_id": " ", "l_orderkey": 1, "l_linenumber": 1, "l_quantity": 1}
    row, = validate(spark, registry, line, schema_id="tpch_lineitem_v1")
    assert (row.quality_score, row.validation_status) == (0.0, "REJECTED")


def rule(row, rule_id):
    r, = [x for x in row.rule_results if x.rule_id == rule_id]
    return r.passed, r.actual_value, r.message


@pytest.mark.parametrize("payload,rule_id,want", [
    ({"amount": 100}, "amount.not_null", (True, "100", None)),
    ({"amount": 100.0}, "amount.not_null", (True, "100.0", None)),
    ({"amount": 100}, "amount.positive", (True, "100.0", None)),
    ({"amount": -2.5}, "amount.positive", (False, "-2.5", "amount must be > 0, got: -2.5")),
    ({}, "transaction_status.valid_value", (True, "Success", None)),
    ({"transaction_date": "2024-02-30"}, "transaction_date.iso_format",
     (False, "2024-02-30", "transaction_date must be yyyy-MM-dd, got: 2024-02-30")),
    ({"transaction_date": "2024-1-5"}, "transaction_date.iso_format",
     (False, "2024-1-5", "transaction_date must be yyyy-MM-dd, got: 2024-1-5")),
    ({"transaction_date": "2024-01-05\n"}, "transaction_date.iso_format",
     (False, "2024-01-05\n", "transaction_date must be yyyy-MM-dd, got: 2024-01-05\n")),
    ({}, "balance.non_negative", (True, "null", "balance absent — skipped")),
    ({"balance": 0}, "balance.non_negative", (True, "0.0", None)),
    ({"balance": -1}, "balance.non_negative", (False, "-1.0", "balance must be >= 0, got: -1.0")),
    ({}, "credit_score.in_range", (True, "null", "credit_score absent — skipped")),
    ({"credit_score": 900.9}, "credit_score.in_range", (True, "900", None)),
    ({"credit_score": 901}, "credit_score.in_range",
     (False, "901", "credit_score must be 300–900, got: 901")),
    ({"credit_score": 299.9}, "credit_score.in_range",
     (False, "299", "credit_score must be 300–900, got: 299")),
])
def test_rule_edges(spark, registry, payload, rule_id, want):
    row, = validate(spark, registry, {**GOOD, **payload})
    assert rule(row, rule_id) == want


def test_rules_on_values_of_other_types(spark, registry):
    """Types the drift check would stop; the rules cope with them on their own."""
    checked = drift.check_drift(events(spark, {
        "amount": "5", "balance": "x", "credit_score": True}), registry).drop("breaking_change")
    row = quality.check_quality(checked).first()
    assert rule(row, "amount.positive") == (False, "5", "amount is not a number: 5")
    assert rule(row, "balance.non_negative") == (False, "x", "balance is not a number: x")
    assert rule(row, "credit_score.in_range") == (
        False, "true", "credit_score is not a number: true")
    assert rule(row, "transaction_id.not_null") == (
        False, "null", "transaction_id must not be null or blank")


def test_own_rules_and_threshold(spark, registry):
    rules = {BANK: [quality.one_of("channel", ["web"], "LOW", BANK),
                    quality.not_null("amount", "HIGH", BANK)]}
    checked = drift.check_drift(events(spark, {**GOOD, "channel": "post"}), registry)
    row = quality.check_quality(checked, threshold=0.8, rules=rules).first()
    assert row.quality_score == 0.75 and not row.quality_passed and row.quality_threshold == 0.8
    none = quality.check_quality(checked, rules={}).first()
    assert none.quality_score == 1.0 and none.rule_results == []


def test_registry_from_files_last_one_wins(spark, tmp_path, registry):
    for name, version in (("a.json", "1.0"), ("b.json", "2.0")):
        (tmp_path / name).write_text(json.dumps({
            "schema_id": "s", "version": version,
            "fields": [{"name": "x", "type": "number", "required": True}]}, indent=2))
    (tmp_path / "note.txt").write_text("not a schema")
    got = load_registry(spark, str(tmp_path))
    assert got.rows == 1
    assert [(r.version, r.name, r.type, r.required) for r in got.fields().collect()] == [
        ("2.0", "x", "number", True)]
    assert {r.schema_id: r.n for r in registry.fields().groupBy("schema_id").agg(
        F.count("*").alias("n")).collect()} == {
        BANK: 20, "tpch_orders_v1": 9, "tpch_lineitem_v1": 17}


def test_registry_beyond_the_broadcast_bound_is_shuffled(spark, registry):
    large = Registry(registry.table, 10_000_000)
    checked = drift.check_drift(events(spark, GOOD, {"amount": 1}), large)
    assert sorted(r.breaking_change for r in checked.collect()) == [False, True]


def test_stored_record_and_dead_letter(spark, registry):
    got = verdict.validate(events(spark, {**GOOD, "x": None}, {"amount": "1"}), registry,
                           "2024-01-05T07:08:09.123Z", CFG)
    stored = record.partition_columns(record.stored_record(got)).orderBy("event_id").collect()
    assert len(stored[0].asDict()) == 24 + 4
    assert (stored[0].year, stored[0].month, stored[0].day, stored[0].hour) == ("2024", "01", "05", "07")
    assert json.loads(stored[0].payload_json) == {**GOOD, "x": None}
    assert json.loads(stored[0].schema_violations_json) == [{
        "field": "x", "expectedType": "undefined", "actualType": "unknown", "violationType": "NEW_FIELD"}]
    first = json.loads(stored[0].quality_rule_results_json)[0]
    assert first == {"ruleId": "transaction_id.not_null", "field": "transaction_id",
                     "severity": "CRITICAL", "passed": True, "actualValue": "T1", "message": None}
    letter, = verdict.rejected_records(got, CFG).collect()
    assert letter.key == "e1" and letter.headers == {
        "failure_reason": "SCHEMA_BREAKING_CHANGE:MISSING_FIELD",
        "original_topic": "banking-transactions", "source": "intelligence-layer"}
    assert json.loads(letter.value) == {
        "eventId": "e1", "tradeGroupId": "G", "tradeId": "1", "idempotencyKey": "k1",
        "eventType": "banking_transaction", "timestamp": "2024-01-01T00:00:00Z", "schemaId": BANK,
        "source": "cloud", "pipelineVersion": "1.0.0", "payload": {"amount": "1"}}


def test_reports(spark, registry):
    got = verdict.validate(events(
        spark, GOOD, {**GOOD, "x": 1}, {**GOOD, "transaction_id": " "}), registry, "t", CFG)
    r = report.batch_report(got).first()
    assert (r.total, r.passed, r.passed_pct, r.rejected, r.schema_drift) == (3, 2, 66.7, 1, 1)
    empty = report.batch_report(got.where("false")).first()
    assert (empty.total, empty.passed_pct, empty.avg_quality_score) == (0, 0.0, 0.0)
    assert [r.failed_rules for r in report.quality_deviations(got).collect()] == [
        ["transaction_id.not_null[CRITICAL]"]]
