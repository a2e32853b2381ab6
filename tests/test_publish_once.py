"""Sinks of a run that fails anywhere and is done again, and files filled from the buffer."""
import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import report, verdict
from sluice.plans.ingest import write_verdicts
from sluice.session import stage
from sluice.sources import buffer, lake
from sluice.sources.lake import Sink, once_per_run, remember_previous, run_path, scan_lake
from sluice.spec import EVENT_FIELDS, PipelineConfig
from tests.test_validation import GOOD

CFG = PipelineConfig()
AT = "2024-01-05T07:08:09.000Z"


def validated(spark, registry, first, n, source="cloud"):
    made = {"event_id": F.sha2(F.col("id").cast("string"), 256), "schema_id": F.lit("banking_transaction_v1"),
            "source": F.lit(source), "payload": F.lit(json.dumps(GOOD))}
    events = spark.range(first, first + n).select(
        *[made.get(c, F.col("id").cast("string")).alias(c) for c in EVENT_FIELDS], F.col("id").alias("arrival"))
    return stage(verdict.validate(events, registry, AT, CFG), "validated", by=["validation_status"])


@pytest.mark.parametrize("where", ["before_record", "before_moves", "between_moves", "before_mark"])
def test_a_failure_anywhere_neither_doubles_nor_loses_rows(spark, registry, tmp_path, monkeypatch, where):
    root = str(tmp_path / "lake")
    rows = validated(spark, registry, 0, 400, "a").unionByName(validated(spark, registry, 400, 400, "b"))
    sink = Sink("data", lambda to: lake.write_lake(rows, root, "data", CFG, 200.0, 1, to))
    real = {"text": lake.write_text, "below": lake._below}
    calls = {"n": 0}

    def fail(*a, **k):
        raise OSError("gone")

    def write_text(spark, path, text):
        if where == "before_record":
            fail()
        real["text"](spark, path, text)
        if where == "before_moves":
            fail()

    def below(*a):
        calls["n"] += 1
        if where == "between_moves" and calls["n"] > 2:
            fail()
        return real["below"](*a)

    monkeypatch.setattr(lake, "write_text", write_text)
    monkeypatch.setattr(lake, "_below", below)
    if where == "before_mark":
        publish = lake._publish
        monkeypatch.setattr(lake, "_publish", lambda *a: (publish(*a), fail()))
    with pytest.raises(OSError):
        once_per_run(spark, root, "r", "passed", sink)
    monkeypatch.undo()
    assert once_per_run(spark, root, "r", "passed", sink)
    assert not once_per_run(spark, root, "r", "passed", sink)
    stored = scan_lake(spark, root)
    assert stored.count() == 800 and stored.select("event_id").distinct().count() == 800


def test_runs_nobody_follows_are_forgotten(spark, tmp_path):
    root = str(tmp_path)
    for n in range(4):
        for _ in range(2):
            once_per_run(spark, root, f"r{n}", "x", lambda: None)
            remember_previous(spark, root, f"r{n}", f"r{n - 1}" if n else None)
    left = {p.name for p in (tmp_path / "_runs").iterdir()}
    assert left == {"r2", "r3"} and run_path(root, "r3").endswith("r3")


def test_many_small_batches_fill_few_files(spark, registry, tmp_path):
    root = str(tmp_path / "lake")
    for n in range(10):
        write_verdicts(validated(spark, registry, 100 * n, 100), root, CFG, place=buffer.buffer_prefix)
        assert buffer.release(spark, root, "data", CFG, 0, 10**15) == 0
    assert len(buffer.waiting_files(spark, root, "data")) == 10
    assert buffer.release(spark, root, "data", CFG, 10**15, 1000) == 10  # nothing new for long
    stored = scan_lake(spark, root)
    assert stored.count() == stored.select("event_id").distinct().count() == 1000
    assert report.files(stored).count() == 1
    row = stored.first()
    assert (row["year"], row["month"], row["hour"], row["source"]) == (2024, 1, 7, "cloud")
    assert (tmp_path / "lake/data/year=2024/month=01/day=05/hour=07/source=cloud").is_dir()
    assert buffer.waiting_files(spark, root, "data") == []


def test_full_folders_are_released_alone():
    waiting = [("h=1/a", 20 << 20, 5), ("h=1/b", 20 << 20, 9), ("h=2/a", 1 << 20, 9)]
    assert buffer.due_files(waiting, CFG, 10, 100, False) == ["h=1/a", "h=1/b"]
    assert buffer.due_files(waiting, CFG, 200, 100, False) == ["h=1/a", "h=1/b", "h=2/a"]
    assert buffer.due_files([], CFG, 200, 100, True) == []


def test_a_release_cut_short_is_finished(spark, registry, tmp_path, monkeypatch):
    root = str(tmp_path / "lake")
    write_verdicts(validated(spark, registry, 0, 50), root, CFG, place=buffer.buffer_prefix)

    def fail(*a):
        raise OSError("gone")

    monkeypatch.setattr(buffer, "forget_run", fail)
    with pytest.raises(OSError):
        buffer.release(spark, root, "data", CFG, 0, 0, True)
    monkeypatch.undo()
    monkeypatch.setattr(buffer, "_merged", fail)  # published already, so not written again
    write_verdicts(validated(spark, registry, 50, 50), root, CFG, place=buffer.buffer_prefix)
    monkeypatch.undo()
    buffer.release(spark, root, "data", CFG, 0, 0, True)
    buffer.release(spark, root, "data", CFG, 0, 0, True)
    assert scan_lake(spark, root).select("event_id").distinct().count() == scan_lake(spark, root).count() == 100
