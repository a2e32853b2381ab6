"""Work is spread over more tasks as tables grow."""
from pyspark.sql import functions as F

from catalog.queries import QUERIES
from sluice.sources import tables


def test_tasks_of_a_numbered_scan_follow_its_bytes(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t.parquet")
    spark.range(50_000).withColumn("x", F.rand(1)).coalesce(1).write.parquet(path)
    assert tables.read_numbered(spark, path, min_tasks=2).rdd.getNumPartitions() == 2
    monkeypatch.setattr(tables, "TASK_BYTES", 32 * 1024)
    rows = tables.read_numbered(spark, path, min_tasks=2)
    assert rows.rdd.getNumPartitions() >= 10
    assert rows.select(F.count("*"), F.min("_row_index"), F.max("_row_index"), F.countDistinct("arrival")).first()[:] == (
        50_000, 0, 49_999, 50_000)


def test_files_of_400_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "orders.parquet")
    spark.range(30_050).select(
        F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit(2.5).alias("o_totalprice"), F.lit("2024-01-01").cast("timestamp").alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).repartition(3).write.parquet(path)
    tasks = []
    write = QUERIES["file_records"].__closure__[0].cell_contents.__globals__["write_lake"]

    def seen(rows, *more):
        tasks.append(rows.groupBy(F.spark_partition_id()).count().count())
        write(rows, *more)
    monkeypatch.setitem(QUERIES["file_records"].__closure__[0].cell_contents.__globals__, "write_lake", seen)
    got = QUERIES["file_records"](spark, str(tmp_path)).first()
    assert (got.files, got.records, got.records_median) == (76, 30_050, 400.0)
    assert tasks[0] > 1


def test_a_task_gets_a_megabyte_of_the_files(spark, tmp_path):
    """Rows are written and read as JSON of a hundred times that size, so tasks must be small."""
    spark.range(600_000).select(F.rand(7).alias("x")).coalesce(1).write.parquet(str(tmp_path / "t"))
    size = sum(p.stat().st_size for p in (tmp_path / "t").glob("*.parquet"))
    assert size < 6 << 20
    assert tables.read_numbered(spark, str(tmp_path / "t"), min_tasks=2).rdd.getNumPartitions() >= size >> 20
