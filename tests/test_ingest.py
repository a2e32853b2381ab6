import json
from pathlib import Path

from sluice.operators import publish, report
from sluice.plans.ingest import ingest
from sluice.session import run_dir
from sluice.sources.lake import scan_lake
from sluice.sources.records import read_records
from sluice.sources.tables import read_numbered
from sluice.spec import BANKING, PipelineConfig
from tests.conftest import control_json, event_json, records
from tests.test_validation import GOOD

CFG = PipelineConfig()
AT = "2024-01-05T07:08:09.000Z"


def test_all_outputs(spark, registry, tmp_path):
    weak = {**GOOD, "transaction_date": "x", "transaction_status": "x", "balance": -1}
    events = [event_json("A", "1", payload=GOOD), event_json("A", "2", payload=weak),
              event_json("A", "3", payload={"amount": "1"}), event_json("B", "1", payload=GOOD),
              event_json("X", "1"), event_json("X", "2"), "{bad", event_json("A", "1")]
    recs = records(spark, events, headers={5: {"attempt_count": "3"}})
    control = records(spark, [control_json("A", ["1", "2", "3"]), control_json("B", ["1", "2"])])
    root = str(tmp_path / "lake")
    result = ingest(recs, control, root, registry, AT, 1000, CFG)

    assert [r.trade_id for r in scan_lake(spark, root).collect()] == ["1"]
    assert [r.trade_id for r in scan_lake(spark, root, "quarantine").collect()] == ["2"]
    letters = spark.read.parquet(f"{root}/dlq").collect()
    assert sorted(r.headers["failure_reason"] for r in letters) == [
        "BATCH_TIMEOUT", "FATAL_PARSE_ERROR", "NO_CONTROL_DOC", "SCHEMA_BREAKING_CHANGE:MISSING_FIELD"]
    waiting, = spark.read.parquet(f"{root}/retry").collect()
    assert json.loads(waiting.value)["trade_id"] == "1"
    assert waiting.headers == {"attempt_count": "1", "retry_after": "3000"}

    counters = report.run_counters(result.settled.decisions, elapsed_seconds=2.0).first()
    assert (counters.total, counters.processed_normally, counters.duplicates,
            counters.retry_routed_control_doc, counters.quarantined_control_doc,
            counters.quarantined_other, counters.events_per_sec) == (8, 4, 1, 1, 1, 1, 4.0)
    assert report.batch_report(result.validated).first().total == 3


def test_table_to_lake(spark, registry, tmp_path):
    rows = [(f"T{i}", "2024-01-05", 1.0 + i, "Success") for i in range(1200)]
    spark.createDataFrame(
        rows, "transaction_id string, transaction_date string, amount double, transaction_status string"
    ).coalesce(1).write.parquet(str(tmp_path / "in"))
    sent = publish.publish(read_numbered(spark, str(tmp_path / "in")), BANKING, AT)
    publish.write_records(sent, str(tmp_path / "control"), str(tmp_path / "events"))
    root = str(tmp_path / "lake")
    result = ingest(read_records(spark, str(tmp_path / "events")),
                    read_records(spark, str(tmp_path / "control")), root, registry, AT, 0, CFG)
    assert [r.expected_count for r in result.settled.status.orderBy("trade_group_id").collect()] == [
        500, 500, 200]
    stored = scan_lake(spark, root)
    assert stored.count() == 1200 and stored.select("event_id").distinct().count() == 1200
    staged = Path(run_dir(spark, result.run))
    assert staged.exists()
    result.discard()
    assert not staged.exists() and stored.count() == 1200
