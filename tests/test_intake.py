import json

from tests.conftest import control_json, event_json, records
from pyspark.sql import functions as F

from sluice.functions.headers import from_kafka_headers, to_kafka_headers
from sluice.operators import intake, retry
from sluice.plans.ingest import control_table
from sluice.spec import PipelineConfig

CFG = PipelineConfig()


def decide(spark, events, control, headers=None, cfg=CFG, seen=None):
    recs = records(spark, events, headers=headers)
    docs = control_table(records(spark, control, topic="banking-control"))
    out = intake.decide(intake.event_keys(intake.parse_events(recs), cfg), docs, cfg, seen)
    return {r.arrival: (r.outcome, r.failure_reason) for r in out.collect()}


def test_strict_parsing(spark):
    values = [
        event_json("G", "1"),
        "{bad", "", "null", "[1]", None,
        event_json("G", "1", surplus=1),
        event_json("G", "1", event_id={"x": 1}),
        event_json("G", "1", event_id=5),
        event_json("G", "1", event_id="{curly"),
        '{"trade_group_id":"G","payload":"text"}',
        '{"trade_group_id":"G","payload":[1]}',
        '{"trade_group_id":"G","payload":null}',
        event_json("G", "1")[:-1],
    ]
    got = intake.parse_events(records(spark, values)).orderBy("arrival").select(
        F.col("env").isNotNull().alias("ok")).collect()
    assert [r.ok for r in got] == [True, False, False, False, False, False, False, False, True,
                                   True, False, False, True, False]


def test_payload_text_keeps_order_and_nulls(spark):
    e = intake.taken_in(intake.parse_events(records(spark, [
        event_json("G", "1", payload={"z": 1, "a": None, "m": {"y": 1, "b": 2}})]))).first()
    assert e.payload == '{"z":1,"a":null,"m":{"y":1,"b":2}}'


def test_control_documents(spark):
    docs = [control_json("A", ["1"]), control_json("B", ["1"], surplus=1), "{bad",
            '{"trade_group_id":"C"}', '{"trade_group_id":"D","trade_ids":["1"]}',
            '{"trade_group_id":"E","trade_ids":["1"],"expected_count":"x"}',
            control_json("A", ["9"])]
    got = {r.trade_group_id: (r.expected_count, r.trade_ids)
           for r in control_table(records(spark, docs)).collect()}
    assert got == {"A": (1, ["1"]), "D": (0, ["1"])}


def test_outcomes(spark):
    events = [
        event_json("G", "1"),                                   # taken in
        event_json("G", "2", key="G-1"),                        # same key: duplicate
        event_json(None, "3", key="K3"),                        # no group
        event_json("G", None, key="K4"),                        # no id
        event_json("X", "5"),                                   # no control document
        "{bad",
        event_json(None, "6", key="G-1"),                       # key was marked before
        '{"trade_group_id":"G","trade_id":"7","payload":{}}',   # no key
        event_json("G", " ", key="K8"),                         # blank id passes
        event_json("X", "9"),                                   # third attempt is over
    ]
    got = decide(spark, events, [control_json("G", ["1", "2"])],
                 headers={9: {"attempt_count": "3"}, 4: {"attempt_count": "many"}})
    assert got == {
        0: ("SUCCESS", None), 1: ("DUPLICATE", None), 2: ("DLQ_ROUTED", "FATAL_MISSING_FIELDS"),
        3: ("DLQ_ROUTED", "FATAL_MISSING_FIELDS"), 4: ("RETRY_ROUTED", None),
        5: ("DLQ_ROUTED", "FATAL_PARSE_ERROR"), 6: ("DUPLICATE", None),
        7: ("DLQ_ROUTED", "FATAL_MISSING_FIELDS"), 8: ("SUCCESS", None),
        9: ("DLQ_ROUTED", "NO_CONTROL_DOC")}


def test_a_lost_event_does_not_mark_its_key(spark):
    events = [event_json(None, "1", key="K"), event_json("X", "1", key="K"),
              event_json("G", "1", key="K"), event_json("G", "1", key="K")]
    got = decide(spark, events, [control_json("G", ["1"])])
    assert [got[i][0] for i in range(4)] == ["DLQ_ROUTED", "RETRY_ROUTED", "SUCCESS", "DUPLICATE"]


def test_keys_of_earlier_runs_are_duplicates(spark):
    seen = spark.createDataFrame([("G-1",)], "idempotency_key string")
    got = decide(spark, [event_json("G", "1"), event_json("G", "2"), event_json("X", "1", key="G-1")],
                 [control_json("G", ["1", "2"])], seen=seen)
    assert [got[i][0] for i in range(3)] == ["DUPLICATE", "SUCCESS", "DUPLICATE"]


def test_keys_apart_by_schema_if_asked(spark):
    events = [event_json("G", "1", key="K"), event_json("G", "2", key="K", schema_id="other")]
    control = [control_json("G", ["1", "2"])]
    assert decide(spark, events, control)[1][0] == "DUPLICATE"
    apart = PipelineConfig(dedup_by_schema=True)
    assert decide(spark, events, control, cfg=apart)[1][0] == "SUCCESS"


def test_one_key_holding_a_third_of_all_rows(spark):
    """The hot key, the hot group and the hot lost key come out as a plain loop says."""
    events = []
    for i in range(900):
        if i % 3 == 0:
            events.append(event_json("G", f"{i}", key="hot"))
        elif i % 3 == 1:
            events.append(event_json("G", f"{i}"))
        else:
            events.append(event_json("X", f"{i}", key="hot" if i % 2 else f"x{i}"))
    got = decide(spark, events, [control_json("G", ["1"])])
    marked, want = set(), {}
    for i, text in enumerate(events):
        e = json.loads(text)
        if e["idempotency_key"] in marked:
            want[i] = "DUPLICATE"
        elif e["trade_group_id"] != "G":
            want[i] = "RETRY_ROUTED"
        else:
            marked.add(e["idempotency_key"])
            want[i] = "SUCCESS"
    assert {i: o for i, (o, _) in got.items()} == want


def test_dead_letters_carry_reason_topic_and_attempts(spark):
    recs = records(spark, ["{bad", event_json("G", "1")], headers={0: {"attempt_count": "2"}})
    docs = control_table(records(spark, [control_json("G", ["1"])]))
    decisions = intake.decide(intake.event_keys(intake.parse_events(recs), CFG), docs, CFG)
    letter, = intake.dead_letters(recs, decisions).collect()
    assert (letter.key, letter.value) == ("k0", "{bad")
    assert letter.headers == {"failure_reason": "FATAL_PARSE_ERROR",
                              "original_topic": "banking-transactions", "attempt_count": "2"}


def test_retry_records_and_replay(spark):
    recs = records(spark, [event_json("X", "1"), event_json("X", "2")],
                   headers={1: {"attempt_count": "2"}})
    none = control_table(records(spark, [control_json("G", ["1"])]))
    decisions = intake.decide(intake.event_keys(intake.parse_events(recs), CFG), none, CFG)
    waiting = retry.retry_records(recs, decisions, 1000, CFG)
    assert {r.headers["attempt_count"]: r.headers["retry_after"] for r in waiting.collect()} == {
        "1": "3000", "3": "9000"}
    late = control_table(records(spark, [control_json("X", ["1", "2"])]))
    step = retry.retry_step(waiting, late, 3000, CFG)
    assert [(r.outcome, r.attempt_count) for r in step.decisions.collect()] == [("SUCCESS", 1)]
    assert [r.headers["retry_after"] for r in step.waiting.collect()] == ["9000"]
    over = retry.retry_step(waiting, none, 9000, CFG)
    assert {r.outcome for r in over.decisions.collect()} == {"RETRY_ROUTED", "DLQ_ROUTED"}


def test_error_routes(spark):
    df = spark.createDataFrame(
        [("IOException", 0), ("IOException", 3), ("ClassCastException", 0), ("Odd", 1)],
        "error string, attempt_count int")
    got = [(r.outcome, r.failure_reason) for r in retry.route_errors(df, CFG).collect()]
    assert got == [("RETRY_ROUTED", None), ("DLQ_ROUTED", "RETRY_EXHAUSTED"),
                   ("DLQ_ROUTED", "FATAL:ClassCastException"), ("DLQ_ROUTED", "FATAL:Odd")]


def test_kafka_headers_there_and_back(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},)], "headers map<string,string>")
    back = df.select(from_kafka_headers(to_kafka_headers(F.col("headers"))).alias("h")).first().h
    assert back == {"a": "1", "b": "2"}
    none = spark.createDataFrame([(None,)], "h array<struct<key:string,value:binary>>")
    assert none.select(from_kafka_headers(F.col("h")).alias("h")).first().h == {}
