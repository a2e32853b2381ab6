"""Compare the registered queries with their SQL: ``python -m catalog.check SF_DIR [name …]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from catalog.oracles import ORACLES
from catalog.queries import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return value


def _normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda row: tuple((v is None, str(v)) for v in row))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def compare(spark: SparkSession, con, sf_dir: str, name: str) -> str | None:
    """None when query and SQL agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = _normal(df.columns, df.collect())
    if name not in ORACLES:
        return None if got else "no rows"
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    want = _normal(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if not want:
        return "the SQL gives no rows"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark = (SparkSession.builder.master("local[8]").appName("check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "16g").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in chosen or QUERIES:
        started = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:26} {time.time() - started:6.1f}s {'ok' if problem is None else problem}", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
