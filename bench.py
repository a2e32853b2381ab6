"""Headline timings: ``python bench.py`` prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each ingest goes all
the way: table rows are published as JSON records, taken in, checked for whole groups,
validated and written to a partitioned lake; the queries then read that lake.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from catalog import fixtures as fx
from sluice.functions.text import composite_key
from sluice.operators import publish
from sluice.plans.ingest import ingest
from sluice.plans.query import QueryFilter, count_rows, run_query
from sluice.session import configure
from sluice.sources.lake import scan_lake
from sluice.sources.records import read_records
from sluice.sources.registry import load_registry
from sluice.sources.tables import ROW_INDEX
from sluice.spec import LINEITEM, ORDERS, PipelineConfig

CFG = PipelineConfig()


def session(cpus: str, work: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.checkpoint.dir", f"{work}/shared")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def lineitem_rows(spark, sf_dir):
    """Line items with an id of their own: the table's keys repeat, so the row joins in."""
    rows = fx.lineitem_rows(spark, sf_dir)
    return rows.withColumn("line_item_id", composite_key(F.col("line_item_id"), F.col(ROW_INDEX)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="sluice-bench-")
    spark = session(cpus, work)
    registry = load_registry(spark)
    timings: dict[str, float] = {}

    def timed(name, action):
        started = time.monotonic()
        result = action()
        timings[name] = round(time.monotonic() - started, 3)
        return result

    events = 0
    for name, rows, spec in (("orders", fx.orders_rows, ORDERS),
                             ("lineitem", lineitem_rows, LINEITEM)):
        root = f"{work}/{name}"
        sent = publish.publish(rows(spark, sf_dir), spec, fx.PUBLISHED_AT)
        timed(f"publish_{name}", lambda: publish.write_records(
            sent, f"{root}/control", f"{root}/events"))
        records = read_records(spark, f"{root}/events")
        control = read_records(spark, f"{root}/control")
        result = timed(f"ingest_{name}", lambda: ingest(
            records, control, f"{root}/lake", registry, fx.INGESTED_AT, fx.NOW_MS, CFG))
        stored = scan_lake(spark, f"{root}/lake").count()
        received = records.count()
        assert stored == received, f"{name}: {stored} stored of {received}"
        assert result.settled.status.where("status <> 'SUCCESS'").count() == 0
        events += received

    root = f"{work}/lineitem/lake"
    lake = scan_lake(spark, root)
    timed("count_all", lambda: count_rows(lake, QueryFilter()).first())
    timed("count_pruned", lambda: count_rows(
        lake, QueryFilter(year=2024, month=6, day=1, hour=5, source="cloud")).first())
    timed("count_where", lambda: count_rows(
        lake, QueryFilter(additional_where="quality_score >= 0.9 AND schema_valid")).first())
    timed("first_page", lambda: run_query(spark, root, QueryFilter(year=2024, month=6)))
    timed("deep_page", lambda: run_query(spark, root, QueryFilter(page=2000)))

    ingest_seconds = sum(timings[k] for k in timings if k.startswith(("publish_", "ingest_")))
    files = scan_lake(spark, root).select("_metadata.file_path").distinct().count()
    print(json.dumps({
        "metric": "publish, ingest and query orders and lineitem",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "events": events,
        "events_per_sec": round(events / ingest_seconds, 1),
        "lineitem_files": files,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
