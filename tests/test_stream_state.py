"""Stream state: large groups, late records, one decision per record, and what is left of it."""
import time

from pyspark.sql import functions as F

from sluice.sources.lake import scan_lake
from sluice.sources.records import claimed_range, read_claimed, stream_records, with_arrival
from sluice.spec import PipelineConfig
from sluice.streaming import run
from tests.conftest import control_json, event_json, records
from tests.test_validation import GOOD

CFG = PipelineConfig()
HOURS = 3 * 3600


def put(spark, path, values, place, seconds=0):
    (records(spark, values, times=[seconds] * len(values)).drop("arrival").withColumn(
        "offset", F.col("offset") + place).coalesce(1).write.mode("append").parquet(path))
    time.sleep(0.02)


def decide(spark, tmp_path, batches, control):
    """Decisions over micro-batches given as (values, seconds), and the query's last progress."""
    for n, (values, seconds) in enumerate(batches):
        put(spark, str(tmp_path / "events"), values, 1000 * n, seconds)
    put(spark, str(tmp_path / "control"), control, 0)
    put(spark, str(tmp_path / "control"), [control_json("clock", [])], 500, HOURS)
    out = run.decide_stream(
        stream_records(spark, str(tmp_path / "events"), max_files=1),
        run.control_stream(stream_records(spark, str(tmp_path / "control"))), CFG, event_time=True)
    job = (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
           .option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start())
    job.awaitTermination()
    rows = spark.read.schema(out.schema).parquet(str(tmp_path / "out")).where("trade_group_id <> 'clock'")
    return rows.collect(), job.recentProgress


def test_every_record_has_one_decision(spark, tmp_path):
    ids = [str(i) for i in range(40)]
    batches = [([event_json("A", i, key=f"A{i}") for i in ids[:20]], 0),
               ([event_json("A", i, key=f"again{i}") for i in ids[:20]]  # announced ids under new keys
                + [event_json("A", "0", key="A0"), event_json("B", "1"), event_json("B", "x"), event_json("X", "1")], 1),
               ([event_json("A", i, key=f"A{i}") for i in ids[20:]], 2),
               (["{bad"], HOURS), ([event_json("A", "7", key="late"), event_json("B", "2")], 3)]
    got, progress = decide(spark, tmp_path, batches, [control_json("A", ids), control_json("B", ["1", "2"])])
    events = [r for r in got if r.kind != "group"]
    assert len({r.arrival for r in events}) == len(events) == sum(len(v) for v, _ in batches) - 1
    outcome = {}
    for r in events:
        outcome.setdefault((r.trade_group_id, r.kind, r.outcome, r.failure_reason), []).append(r.trade_id)
    assert sorted(outcome["A", "event", "SUCCESS", None]) == sorted(ids)
    assert sorted(outcome["A", "event", "DUPLICATE", None]) == sorted(ids[:20] + ["0"])
    assert outcome["B", "incomplete", None, None] == ["1"] or "2" in outcome["B", "incomplete", None, None]
    assert outcome["B", "unannounced", None, None] == ["x"]
    assert ["1"] == outcome["X", "event", "DLQ_ROUTED", "NO_CONTROL_DOC"]
    assert {(r.trade_group_id, r.status) for r in got if r.kind == "group"} == {("A", "SUCCESS"), ("B", "FAIL")}


def test_state_is_empty_after_a_group_of_many_micro_batches(spark, tmp_path):
    ids = [str(i) for i in range(600)]
    batches = [([event_json("A", i) for i in ids[n::12]], 0) for n in range(12)] + [(["{bad"], HOURS), (["{bad"], HOURS)]
    got, progress = decide(spark, tmp_path, batches, [control_json("A", ids)])
    assert sorted(r.trade_id for r in got if r.outcome == "SUCCESS") == sorted(ids)
    left = {s["operatorName"]: 0 for p in progress for s in p["stateOperators"]}
    rows = [sum(s["numRowsTotal"] for s in p["stateOperators"]) for p in progress]
    assert left and max(rows) >= 600 and rows[-1] <= 6  # what is left belongs to the clock's own group


def test_claims_fetch_the_records(spark, tmp_path):
    put(spark, str(tmp_path / "t"), ["a", "b", "c"], 5)
    table = spark.read.parquet(str(tmp_path / "t"))
    decided = with_arrival(table.withColumn("claim", F.col("_metadata.file_path"))).where("value <> 'b'").select(
        "arrival", "claim", F.lit("g").alias("trade_group_id"))
    assert sorted(r.value for r in read_claimed(decided).collect()) == ["a", "c"]
    assert read_claimed(decided.limit(0)).collect() == []
    assert claimed_range(decided, "t") == {
        "startingOffsets": '{"t": {"0": 5}}', "endingOffsets": '{"t": {"0": 8}}'}


def test_job_fills_files_and_counts(spark, registry, tmp_path):
    for n in range(4):
        put(spark, str(tmp_path / "events"), [event_json("A", str(n), payload=GOOD)], 1000 * n)
    put(spark, str(tmp_path / "events"), ["{bad"], 9000, HOURS)
    put(spark, str(tmp_path / "control"), [control_json("A", ["0", "1", "2", "3"])], 0)
    put(spark, str(tmp_path / "control"), [control_json("clock", [])], 500, HOURS)
    root = str(tmp_path / "lake")
    run.run_stream(stream_records(spark, str(tmp_path / "events"), max_files=2),
                   stream_records(spark, str(tmp_path / "control")), root, str(tmp_path / "chk"), registry, CFG,
                   available_now=True, event_time=True, ingestion_time="2024-01-05T07:08:09.000Z",
                   fill_files=True).awaitTermination()
    run.flush(spark, root, CFG, everything=True)
    assert sorted(r.trade_id for r in scan_lake(spark, root).collect()) == ["0", "1", "2", "3"]
    counted = run.stream_counters(spark, root).first()
    assert (counted.total, counted.processed_normally, counted.quarantined_other, counted.whole_groups) == (5, 4, 1, 1)
