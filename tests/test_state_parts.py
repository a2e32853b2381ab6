"""What a micro-batch writes of stream state follows what came with it, not what is held."""
from sluice.sources.records import stream_records
from sluice.session import state_parts
from sluice.spec import PipelineConfig
from sluice.streaming import run
from sluice.streaming.groups import KeyMarks
from tests.conftest import control_json, event_json, records
from tests.test_state_calls import COPY, event, started

CFG = PipelineConfig()


def test_marks_are_added_without_writing_the_older_ones():
    marks, _ = started(KeyMarks(CFG, event_time=True))
    list(marks.handleInputRows((0,), iter([event(f"k{n}", n) for n in range(2000)]), None))
    for n in range(40):  # more micro-batches than parts of a moment
        before = dict(marks.marks.held)
        got = list(marks.handleInputRows((0,), iter([event(f"late{n}", 5000 + n), event("k3", 9000)]), None))
        assert [r.kind for r in got] == [COPY, "event"]
        written = [v for k, v in marks.marks.held.items() if before.get(k) != v]
        assert n >= 15 or sum(len(str(v)) for v in written) < 200
    assert len(marks._held()) == 2040 and len(marks.marks.held) <= 16


def test_state_lies_in_a_part_per_core(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        records(spark, [event_json("A", "1")]).drop("arrival").write.parquet(str(tmp_path / "events"))
        records(spark, [control_json("A", ["1"])]).drop("arrival").write.parquet(str(tmp_path / "control"))
        out = run.decide_stream(
            stream_records(spark, str(tmp_path / "events")),
            run.control_stream(stream_records(spark, str(tmp_path / "control"))), CFG, event_time=True)
        with state_parts(spark):
            job = (out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
                   .option("checkpointLocation", str(tmp_path / "chk")).trigger(availableNow=True).start())
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
        job.awaitTermination()
        parts = {s["numShufflePartitions"] for p in job.recentProgress for s in p["stateOperators"]}
        assert parts == {spark.sparkContext.defaultParallelism}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
