import pytest

from sluice.operators import columns
from sluice.plans.ingest import decide_and_validate, control_table, write_result
from sluice.plans.runs import ingest_run, left_open
from sluice.sources.lake import forget_run, once_per_run, run_path, scan_lake
from sluice.sources.tables import read_csv_numbered
from sluice.spec import PipelineConfig
from tests.conftest import control_json, event_json, records
from tests.test_validation import GOOD

CFG = PipelineConfig()
AT = "2024-01-05T07:08:09.000Z"
SENT = 1_704_067_200_000  # 2024-01-01, the time of the records


def event(group, trade_id, **more):
    return event_json(group, trade_id, payload=GOOD, **more)


def sent(spark, values, first=0, headers=None):
    """Records with offsets from ``first`` on."""
    made = records(spark, [event("skip", str(i)) for i in range(first)] + values, headers=headers)
    return made.where(f"offset >= {first}")


def run(spark, registry, root, values, documents, after_ms, name, previous=None, first=0):
    return ingest_run(sent(spark, values, first), records(spark, documents), root, registry, AT,
                      SENT + after_ms, CFG, name, previous)


def stored(spark, root):
    return sorted((r.trade_group_id, r.trade_id) for r in scan_lake(spark, root).collect())


def outcomes(result):
    return [r.outcome for r in result.settled.decisions.orderBy("arrival").collect()]


def test_group_waits_for_its_rest(spark, registry, tmp_path):
    root = str(tmp_path)
    one = run(spark, registry, root, [event("A", "1"), event("A", "1")],
              [control_json("A", ["1", "2"])], 1000, "r1")
    assert [r.status for r in one.settled.status.collect()] == ["PENDING"]
    assert outcomes(one) == ["SUCCESS", "DUPLICATE"]
    assert left_open(spark, root, "r1").events.count() == 1
    # The rest brings a copy of the kept event, which stays the first.
    two = run(spark, registry, root, [event("A", "1"), event("A", "2")], [], 2000, "r2", "r1", 2)
    assert outcomes(two) == ["DUPLICATE", "SUCCESS"]
    assert stored(spark, root) == [("A", "1"), ("A", "2")]
    left = left_open(spark, root, "r2")
    assert left.events.count() == left.control.count() == 0
    # Keys stay marked, for an hour and no longer.
    three = run(spark, registry, root, [event("A", "1")], [], 3000, "r3", "r2", 4)
    assert outcomes(three) == ["DUPLICATE"]
    late = run(spark, registry, root, [event("A", "1")], [], 2000 + 3_600_000, "r4", "r3", 4)
    assert outcomes(late) == ["RETRY_ROUTED"]


def test_group_fails_at_its_deadline(spark, registry, tmp_path):
    root = str(tmp_path)
    run(spark, registry, root, [event("A", "1")], [control_json("A", ["1", "2"])], 1000, "r1")
    still = run(spark, registry, root, [], [], CFG.group_timeout_ms - 1, "r2", "r1", 1)
    assert [r.status for r in still.settled.status.collect()] == ["PENDING"]
    over = run(spark, registry, root, [], [], CFG.group_timeout_ms, "r3", "r2", 1)
    assert [r.status for r in over.settled.status.collect()] == ["FAIL"]
    letter, = spark.read.parquet(f"{root}/dlq").collect()
    assert letter.headers["failure_reason"] == "BATCH_TIMEOUT"
    assert left_open(spark, root, "r3").events.count() == 0


def test_retries_are_replayed_when_due(spark, registry, tmp_path):
    root = str(tmp_path)
    one = run(spark, registry, root, [event("A", "1")], [], 0, "r1")
    assert outcomes(one) == ["RETRY_ROUTED"]
    early = run(spark, registry, root, [], [control_json("A", ["1"])], 1999, "r2", "r1", 1)
    assert outcomes(early) == [] and left_open(spark, root, "r2").retries.count() == 1
    due = run(spark, registry, root, [], [], 2000, "r3", "r2", 1)
    assert outcomes(due) == ["SUCCESS"] and stored(spark, root) == [("A", "1")]
    assert left_open(spark, root, "r3").retries.count() == 0


def test_a_run_done_again_writes_nothing_twice(spark, registry, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        run(spark, registry, root, [event("A", "1"), "{bad"], [control_json("A", ["1"])], 0, "r1")
    assert stored(spark, root) == [("A", "1")]
    assert spark.read.parquet(f"{root}/dlq").count() == 1


def test_a_sink_that_failed_is_done_again(spark, registry, tmp_path):
    root = str(tmp_path)
    recs = records(spark, [event("A", "1"), "{bad"])
    result = decide_and_validate(
        recs, control_table(records(spark, [control_json("A", ["1"])])), registry, AT, CFG)

    def broken(sink, write):
        if sink == "dead_letters":
            raise OSError("gone")
        once_per_run(spark, root, "r1", sink, write)

    with pytest.raises(OSError):
        write_result(recs, result, root, CFG, broken)
    write_result(recs, result, root, CFG,
                 lambda sink, write: once_per_run(spark, root, "r1", sink, write))
    assert stored(spark, root) == [("A", "1")]
    assert spark.read.parquet(f"{root}/dlq").count() == 1
    forget_run(spark, root, "r1")
    assert once_per_run(spark, root, "r1", "x", lambda: None)
    assert not once_per_run(spark, root, "r1", "x", lambda: None)
    assert run_path(root, "r1").endswith("_runs/r1")


def test_csv_rows_are_numbered_in_file_order(spark, tmp_path):
    """Blocks far smaller than a file, packed in any way, leave the numbers as they are."""
    for name, size in (("a", 3000), ("b", 1), ("c", 0)):
        (tmp_path / "in" / name).mkdir(parents=True)
        (tmp_path / "in" / name / "part.csv").write_text(
            "Txn ID,Amount\n" + "".join(f"{name}{i},{i}.5\n" for i in range(size)))
    seen = []
    for block in ("4096", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        try:
            rows = read_csv_numbered(spark, str(tmp_path / "in" / "*"), "`Txn ID` string, Amount double")
            named = columns.canonical_names(columns.clean_names(rows))
            seen.append(sorted(
                (r.transaction_id, r._row_file[-6:], r._row_index, r.arrival) for r in named.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(seen[0]) == 3001
    assert [(i, f, n) for i, f, n, _ in seen[0]] == sorted(
        [(f"a{i}", "a/part", i) for i in range(3000)] + [("b0", "b/part", 0)])
    assert len({a for *_, a in seen[0]}) == 3001
    assert seen[0] == seen[1]
