"""Staged tables and who removes them."""
from pathlib import Path

from sluice.session import run_dir, scratch, stage


def test_scratch_tables_go_and_others_stay(spark):
    with scratch(spark) as name:
        inner = stage(spark.range(5), "inner")
        outer = stage(inner, "outer", run="kept")
        assert inner.count() == 5 and Path(run_dir(spark, name)).exists()
    assert not Path(run_dir(spark, name)).exists()
    assert outer.count() == 5
    assert "shared" in stage(spark.range(1), "later").inputFiles()[0]


def test_shuffle_files_go_with_their_action(spark):
    """They do not wait for the driver to collect its garbage; a frame may still be used twice."""
    import time

    def files():
        return spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")

    before = set(files())
    rows = spark.range(1000).repartition(3, "id").groupBy("id").count()
    staged = stage(rows, "shuffled")
    for _ in range(50):
        left = [f for f in set(files()) - before if "/shuffle_" in f]
        if not left:
            break
        time.sleep(0.2)
    assert not left
    again = spark.range(1000).repartition(3, "id").groupBy("id").count()
    assert len(again.collect()) == len(again.collect()) == staged.count() == 1000
