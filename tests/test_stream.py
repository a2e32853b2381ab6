import json
import time

import pytest
from pyspark.sql import functions as F

from sluice.plans import ingest
from sluice.operators import intake
from sluice.sources.lake import scan_lake
from sluice.sources.records import stream_records
from sluice.spec import PipelineConfig
from sluice.streaming import run
from tests.conftest import control_json, event_json, records
from tests.test_validation import GOOD

CFG = PipelineConfig()
HOURS = 3 * 3600


@pytest.fixture()
def streams(spark, tmp_path):
    def make(events, control):
        """Record tables; a last record on both sides moves the clock past all deadlines."""
        for name, values, tick in (
                ("events", events, event_json("clock", "tick")),
                ("control", control, control_json("clock", []))):
            all_values = values + [tick]
            times = [0] * len(values) + [HOURS]
            records(spark, all_values, times=times).drop("arrival").write.parquet(str(tmp_path / name))
        return (stream_records(spark, str(tmp_path / "events")),
                stream_records(spark, str(tmp_path / "control")))

    return make


def decisions(spark, streams, tmp_path, events, control):
    ev, ctl = streams(events, control)
    out = run.decide_stream(ev, run.control_stream(ctl), CFG, event_time=True)
    job = (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
           .option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start())
    job.awaitTermination()
    return [r for r in spark.read.parquet(str(tmp_path / "out")).collect()
            if r.trade_group_id != "clock"]


def test_groups_as_in_batch(spark, streams, tmp_path):
    events = [event_json("A", i) for i in ("1", "2", "2", "3", "1", "4", "5")]
    events += [event_json("B", "1"), event_json("C", "1"), event_json("C", "9"), event_json("C", "2")]
    events += [event_json("X", "1"), event_json(None, "1", key="n"), "{bad"]
    events += [event_json("E", "1"), event_json("E", "9")]
    control = [control_json("A", ["1", "2", "3", "4", "5"]), control_json("A", ["1"]),
               control_json("B", ["1", "2", "3"]), control_json("C", ["1", "2"]),
               control_json("D", ["1"]), control_json("E", ["1"])]
    got = decisions(spark, streams, tmp_path, events, control)
    groups = {r.trade_group_id: (r.status, r.expected_count, r.actual_count, r.missing_count)
              for r in got if r.kind == "group"}
    settled = ingest.settle(
        intake.event_keys(intake.parse_events(records(spark, events)), CFG),
        ingest.control_table(records(spark, control)), CFG)
    batch = {r.trade_group_id: (r.status, r.expected_count, r.actual_count, r.missing_count)
             for r in settled.status.collect()}
    assert groups == batch
    assert groups["A"] == ("SUCCESS", 5, 5, 0) and groups["B"] == ("FAIL", 3, 1, 2)
    taken = {(r.trade_group_id, r.trade_id) for r in got if r.outcome == "SUCCESS"}
    assert taken == {("A", i) for i in "12345"} | {("E", "1")}
    lost = sorted((r.trade_group_id or "-", r.failure_reason) for r in got
                  if r.kind == "event" and r.outcome == "DLQ_ROUTED")
    assert lost == [("-", "FATAL_MISSING_FIELDS"), ("-", "FATAL_PARSE_ERROR"),
                    ("E", "NO_CONTROL_DOC"), ("X", "NO_CONTROL_DOC")]
    held = {(r.trade_group_id, r.trade_id) for r in got if r.kind == "incomplete"}
    assert held == {("B", "1"), ("C", "1"), ("C", "2")}


def test_whole_job_writes_lake_and_dead_letters(spark, registry, streams, tmp_path):
    bad = {**GOOD, "transaction_id": " "}
    events = [event_json("A", "1", payload=GOOD), event_json("A", "2", payload=bad),
              event_json("B", "1", payload=GOOD), "{bad"]
    control = [control_json("A", ["1", "2"]), control_json("B", ["1", "2"])]
    ev, ctl = streams(events, control)
    job = run.run_stream(ev, ctl, str(tmp_path / "lake"), str(tmp_path / "chk"), registry, CFG,
                         available_now=True, event_time=True,
                         ingestion_time="2024-01-05T07:08:09.000Z")
    job.awaitTermination()
    stored = scan_lake(spark, str(tmp_path / "lake")).collect()
    assert [(r.trade_id, r.hour) for r in stored] == [("1", 7)]
    letters = spark.read.parquet(str(tmp_path / "lake" / "dlq")).where("key <> 'clock'")
    assert sorted(r.headers["failure_reason"] for r in letters.collect()
                  if json.loads(r.value if r.value != "{bad" else "{}").get("trade_group_id") != "clock") == [
        "BATCH_TIMEOUT", "FATAL_PARSE_ERROR", "QUALITY_REJECTED:score=0.00"]


def test_control_document_comes_after_its_events(spark, tmp_path):
    """Events wait in state over micro-batches until their control document arrives."""
    def put(name, place, value, seconds):
        (records(spark, [value], times=[seconds]).drop("arrival").withColumn(
            "offset", F.lit(place).cast("bigint")).coalesce(1)
         .write.mode("append").parquet(str(tmp_path / name)))

    for place, (event, control, seconds) in enumerate([
            (event_json("A", "1"), control_json("B", ["1"]), 0),
            (event_json("A", "2"), control_json("C", ["1"]), 1),
            (event_json("X", "1"), control_json("A", ["1", "2"]), 2),
            (event_json("clock", "tick"), control_json("clock", []), HOURS)]):
        put("events", place, event, seconds)
        put("control", place, control, seconds)
    ev = stream_records(spark, str(tmp_path / "events"), max_files=1)
    ctl = stream_records(spark, str(tmp_path / "control"), max_files=1)
    out = run.decide_stream(ev, run.control_stream(ctl), CFG, event_time=True)
    job = (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
           .option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start())
    job.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    groups = {r.trade_group_id: r.status for r in got if r.kind == "group"}
    assert (groups["A"], groups["B"], groups["C"]) == ("SUCCESS", "FAIL", "FAIL")
    assert {r.trade_id for r in got if r.outcome == "SUCCESS"} == {"1", "2"}
    assert [r.failure_reason for r in got if r.trade_group_id == "X"] == ["NO_CONTROL_DOC"]


def test_by_the_clock_every_record_gets_a_decision(spark, tmp_path):
    """Late events and copies included; nothing falls behind a watermark."""
    for place, (values, seconds) in enumerate([
            ([event_json("A", "1"), event_json("A", "1")], 10 * 3600),
            ([event_json("A", "2"), event_json("A", "1"), "{bad", event_json(None, "1", key="n")], 0)]):
        (records(spark, values, times=[seconds] * len(values)).drop("arrival").withColumn(
            "offset", F.col("offset") + 10 * place).coalesce(1)
         .write.mode("append").parquet(str(tmp_path / "events")))
    records(spark, [control_json("A", ["1", "2"])]).drop("arrival").write.parquet(str(tmp_path / "control"))
    out = run.decide_stream(
        stream_records(spark, str(tmp_path / "events"), max_files=1),
        run.control_stream(stream_records(spark, str(tmp_path / "control"))), CFG)
    job = (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
           .option("checkpointLocation", str(tmp_path / "chk")).start())
    try:
        for _ in range(120):
            time.sleep(1)
            assert job.isActive, job.exception()
            if (tmp_path / "out" / "_spark_metadata").exists():
                got = spark.read.schema(out.schema).parquet(str(tmp_path / "out")).collect()
                if len(got) >= 7:
                    break
    finally:
        job.stop()
    assert sorted((r.kind, r.outcome or r.status, r.failure_reason or "") for r in got) == [
        ("event", "DLQ_ROUTED", "FATAL_MISSING_FIELDS"), ("event", "DLQ_ROUTED", "FATAL_PARSE_ERROR"),
        ("event", "DUPLICATE", ""), ("event", "DUPLICATE", ""),
        ("event", "SUCCESS", ""), ("event", "SUCCESS", ""), ("group", "SUCCESS", "")]


def test_clock_timers_and_available_now_exclude_each_other(spark, registry, streams, tmp_path):
    ev, ctl = streams([], [])
    with pytest.raises(ValueError):
        run.run_stream(ev, ctl, str(tmp_path / "lake"), str(tmp_path / "chk"), registry, CFG,
                       available_now=True)
