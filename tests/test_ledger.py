import json

import pytest
from tests.conftest import control_json, event_json, records

from sluice.operators import intake, ledger
from sluice.plans import ingest
from sluice.spec import PipelineConfig

CFG = PipelineConfig()


def settle(spark, events, control):
    recs = records(spark, events)
    parsed = intake.parse_events(recs)
    s = ingest.settle(intake.event_keys(parsed, CFG),
                      ingest.control_table(records(spark, control)), CFG)
    status = {r.trade_group_id: (r.status, r.expected_count, r.actual_count, r.missing_count)
              for r in s.status.collect()}
    ready = ledger.ready_events(intake.taken_in(parsed), s.slots, s.status)
    return status, sorted(r.arrival for r in ready.collect()), s, parsed


SCENARIOS = {
    "whole group": (["1", "2", "3"], None, ["1", "2", "3"], ("SUCCESS", 3, 3, 0), [0, 1, 2]),
    "partial": (["1", "2", "3"], None, ["1", "2"], ("FAIL", 3, 2, 1), []),
    "nothing came": (["1", "2"], None, [], ("FAIL", 2, 0, 2), []),
    "stray before the last": (["1", "2"], None, ["1", "9", "2"], ("FAIL", 2, 3, 0), []),
    "stray after the last": (["1", "2"], None, ["1", "2", "9"], ("SUCCESS", 2, 2, 0), [0, 1]),
    "ids repeat in the document": (["1", "1"], None, ["1"], ("FAIL", 2, 1, 0), []),
    "count too high": (["1", "2"], 3, ["1", "2"], ("FAIL", 3, 2, 0), []),
    "count too low": (["1", "2"], 1, ["1", "2"], ("FAIL", 1, 2, 0), []),
    "empty group": ([], 0, [], ("FAIL", 0, 0, 0), []),
}


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenario(spark, name):
    ids, count, sent, want, want_ready = SCENARIOS[name]
    events = [event_json("G", i) for i in sent] or [event_json("other", "1")]
    status, ready, _, _ = settle(spark, events, [control_json("G", ids, count)])
    assert status == {"G": want} and ready == want_ready


def test_duplicates_are_not_counted(spark):
    sent = ["1", "2", "2", "3", "1", "4", "5"]
    status, ready, _, _ = settle(
        spark, [event_json("G", i) for i in sent], [control_json("G", ["1", "2", "3", "4", "5"])])
    assert status["G"] == ("SUCCESS", 5, 5, 0) and ready == [0, 1, 3, 5, 6]


def test_same_id_under_another_key_counts_once(spark):
    events = [event_json("G", "1"), event_json("G", "1", key="other"), event_json("G", "2")]
    status, ready, _, _ = settle(spark, events, [control_json("G", ["1", "2"])])
    assert status["G"] == ("SUCCESS", 2, 2, 0) and ready == [0, 2]


def test_no_control_document_no_ready_event(spark):
    status, ready, s, _ = settle(spark, [event_json("G", "1")], [control_json("H", ["1"])])
    assert ready == [] and status == {"H": ("FAIL", 1, 0, 1)}
    assert [r.outcome for r in s.decisions.collect()] == ["RETRY_ROUTED"]


def test_later_control_document_is_ignored(spark):
    control = [control_json("G", ["1"]), control_json("G", ["1", "2"])]
    status, ready, _, _ = settle(spark, [event_json("G", "1")], control)
    assert status["G"] == ("SUCCESS", 1, 1, 0) and ready == [0]


def test_event_after_completion_finds_no_control_document(spark):
    events = [event_json("G", "1"), event_json("G", "9"), event_json("G", "1")]
    _, _, s, _ = settle(spark, events, [control_json("G", ["1"])])
    assert {r.arrival: r.outcome for r in s.decisions.collect()} == {
        0: "SUCCESS", 1: "RETRY_ROUTED", 2: "DUPLICATE"}


def test_failed_group_record_missing_ids_and_incomplete_events(spark):
    _, _, s, parsed = settle(spark, [event_json("G", "1")], [control_json("G", ["1", "2", "3"])])
    letter, = ledger.failed_group_records(s.status).collect()
    assert letter.key == "G" and letter.headers == {"failure_reason": "BATCH_TIMEOUT"}
    assert json.loads(letter.value) == {
        "trade_group_id": "G", "failure_reason": "BATCH_TIMEOUT", "expected_count": 3,
        "actual_count": 1, "missing_count": 2}
    assert {r.trade_id for r in ledger.missing_ids(s.slots).collect()} == {"2", "3"}
    held = ledger.incomplete_events(intake.taken_in(parsed), s.slots, s.status, CFG)
    assert [r.trade_id for r in held.collect()] == ["1"]


def test_hot_group_of_strays_leaves_the_others_alone(spark):
    events = [event_json("hot", f"s{i}") for i in range(300)]
    events += [event_json(f"G{g}", str(i)) for g in range(20) for i in range(30)]
    control = [control_json("hot", ["a", "b"])]
    control += [control_json(f"G{g}", [str(i) for i in range(30)]) for g in range(20)]
    status, ready, _, _ = settle(spark, events, control)
    assert status.pop("hot") == ("FAIL", 2, 300, 2)
    assert set(status.values()) == {("SUCCESS", 30, 30, 0)} and len(ready) == 600


def test_registered_plan_has_no_window(spark):
    recs = records(spark, [event_json("G", "1")])
    docs = ingest.control_table(records(spark, [control_json("G", ["1"])]))
    decided = intake.decide(intake.event_keys(intake.parse_events(recs), CFG), docs, CFG)
    plan = decided._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "CartesianProduct" not in plan
