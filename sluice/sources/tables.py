"""File scans that feed the publisher."""

from __future__ import annotations

import re
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.joins import BROADCAST_ROWS
from sluice.session import file_bytes, stage

ROW_FILE = "_row_file"
ROW_INDEX = "_row_index"
ARRIVAL = "arrival"
ROW_COLUMNS = [ROW_FILE, ROW_INDEX, ARRIVAL]

INDEX_BITS = 33  # rows below 2^33 per file
TASK_BYTES = 1024 * 1024  # of a table's files per task that makes JSON of its rows
TASK_ROWS = 500  # neighbours dealt out together: a group of the usual size stays in one task


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header row; types by ``schema``, or inferred when none is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def file_names(files: list[str], path: str) -> list[tuple[str, str, int]]:
    """Files in order of their paths: URI, path below ``path`` without ending, number.

    Equal file names in different folders so stay apart. A file that does not lie below
    ``path`` (which may be a pattern) goes by its whole path, a single one by its name.
    """
    root = (urlparse(path).path or path).rstrip("/") + "/"
    out = []
    for number, uri in enumerate(sorted(files)):
        whole = unquote(urlparse(uri).path)
        at = whole.find(root)
        below = whole[at + len(root):] if at >= 0 else whole
        if len(files) == 1:
            below = whole.rsplit("/", 1)[-1]
        out.append((uri, re.sub(r"\.[^./]*$", "", below), number))
    return out


def read_numbered(spark: SparkSession, path: str, min_tasks: int | None = None) -> DataFrame:
    """Parquet scan with each row's file, its index in the file and its arrival number.

    The index comes from the file itself, so no row has to move to be numbered, and a
    row has the same numbers in every scan: ``arrival`` is the pair (number of the file
    in path order, index) as one ascending number. When the scan has fewer tasks than
    ``min_tasks`` (one row group is one task), or tasks of more than ``TASK_BYTES`` of the
    files, the numbered rows are dealt out to so many, since making and reading JSON is
    costlier than they are.
    """
    scan = spark.read.parquet(path)
    files = scan.inputFiles()
    if len(files) > 1:  # as the scan spells them; a row per file, read from footers
        files = [r[0] for r in scan.select("_metadata.file_path").distinct().collect()]
    names = file_names(files, path)
    rows = scan.select("*", F.col("_metadata.file_path").alias("_uri"),
                       F.col("_metadata.row_index").alias(ROW_INDEX))
    if len(names) <= 1:
        name = names[0][1] if names else ""
        rows = rows.withColumn(ROW_FILE, F.lit(name)).withColumn("_number", F.lit(0))
    else:
        table = spark.createDataFrame(names, f"_uri string, {ROW_FILE} string, _number int")
        rows = rows.join(F.broadcast(table) if len(names) <= BROADCAST_ROWS else table, "_uri")
    arrival = F.shiftleft(F.col("_number").cast("bigint"), INDEX_BITS) + F.col(ROW_INDEX)
    rows = rows.select(*scan.columns, ROW_FILE, ROW_INDEX, arrival.alias(ARRIVAL))
    return rows if min_tasks is None else deal_out(rows, file_bytes(scan), min_tasks)


def deal_out(rows: DataFrame, size: int, min_tasks: int) -> DataFrame:
    """Numbered rows in a task per ``TASK_BYTES`` of the files they fill, ``min_tasks`` at least."""
    wanted = max(min_tasks, -(-size // TASK_BYTES))
    if rows.rdd.getNumPartitions() < wanted:
        rows = rows.repartition(wanted, F.col(ROW_FILE), F.expr(f"{ROW_INDEX} div {TASK_ROWS}"))
    return rows


def read_csv_numbered(spark: SparkSession, path: str,
                      schema: T.StructType | str | None = None) -> DataFrame:
    """CSV scan with the numbers of ``read_numbered``, rows in the order of their file.

    CSV files know no row index. Rows are staged once with the block they came from and
    their rank in its task, so that the numbers do not depend on how blocks were packed
    into tasks; a row's index is its rank in the block after the rows of earlier blocks.
    Only the table of blocks, one row per block, is sorted, each file on its own.
    """
    scan = read_csv(spark, path, schema)
    columns = scan.columns
    staged = stage(scan.select(
        "*", F.col("_metadata.file_path").alias("_uri"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_rank")), "csv")
    blocks = staged.groupBy("_uri", "_block").agg(
        F.min("_rank").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_uri").orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1)
    before = blocks.select("_uri", "_block", "_first", F.coalesce(
        F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    files = [r[0] for r in blocks.select("_uri").distinct().collect()]  # a row per file
    names = spark.createDataFrame(
        file_names(files, path), f"_uri string, {ROW_FILE} string, _number int")
    index = F.col("_before") + F.col("_rank") - F.col("_first")
    return staged.join(before.join(names, "_uri"), ["_uri", "_block"]).select(
        *columns, ROW_FILE, index.alias(ROW_INDEX),
        (F.shiftleft(F.col("_number").cast("bigint"), INDEX_BITS) + index).alias(ARRIVAL))


def number_by(df: DataFrame, order: list[str], name: str, buckets: int = 64) -> DataFrame:
    """Number the rows of any frame by a unique sort key (for sources without row index).

    The key range is cut at sampled quantiles of its first column, rows are counted
    per bucket, and each bucket is numbered on its own from its offset. Buckets hold
    about equal shares of the rows, provided the first sort column is numeric and no
    value of it holds a large share.
    """
    lead = order[0]
    # At most `buckets` numbers reach the driver, whatever the size of the input.
    bounds = df.select(
        F.percentile_approx(lead, [i / buckets for i in range(1, buckets)], 10_000)
    ).first()[0] or []
    cuts = sorted(set(bounds))
    bucket = F.lit(0)
    for cut in cuts:
        bucket = bucket + F.when(F.col(lead) > F.lit(cut), 1).otherwise(0)
    placed = df.withColumn("_bucket", bucket)
    sizes = placed.groupBy("_bucket").agg(F.count("*").alias("_n"))
    offsets = sizes.select(
        "_bucket",
        (F.coalesce(F.sum("_n").over(
            Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0))).alias("_before"),
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    return (
        placed.withColumn("_within", within)
        .join(F.broadcast(offsets), "_bucket")  # at most `buckets` rows
        .select(
            *df.columns,
            F.lit(name).alias(ROW_FILE),
            (F.col("_before") + F.col("_within") - 1).alias(ROW_INDEX),
            (F.col("_before") + F.col("_within") - 1).alias(ARRIVAL),
        )
    )
