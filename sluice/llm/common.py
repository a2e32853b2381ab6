"""Helpers the corpus operators share: tables, the learning split, batches, labels."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_CHARS = 2_000_000  # texts are handed to numpy in slices of about this size


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """True for the documents no model may learn from; false for a null id."""
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def doc_texts(docs: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, so that further columns cannot clash; null is empty."""
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))


def packed_rows(docs: DataFrame) -> DataFrame:
    """Rows as one struct ``_row`` beside ``_id`` and ``_th``, the hash of the text (null: empty).

    No column of ``docs`` can clash with those of a join; ``select("_row.*")`` gives them back.
    """
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_th"))


def slices(sizes: list[int], limit: int = SLICE_CHARS) -> Iterator[slice]:
    """Cut a batch into runs of rows of at most about ``limit`` characters, one row at least."""
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def text_slices(batch: pa.RecordBatch, name: str = "text",
                limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of an Arrow batch with their texts, small enough for one numpy pass."""
    column = batch.column(name)
    sizes = [v or 0 for v in pc.binary_length(column).to_pylist()]
    for s in slices(sizes, limit):
        yield batch.slice(s.start, s.stop - s.start), column[s.start:s.stop].to_pylist()


def label_sample(labels: DataFrame, name: str, bound: int) -> DataFrame:
    """At most ``bound`` labelled documents to learn from, the same ones on every run.

    Rows without id or label and held-out documents are left out; of several labels of
    one document the largest counts. The rows taken are those of smallest id hash.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(name).isin(0, 1) & ~held_out())
    one_each = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col(name).cast("int")).alias("label"))
    return one_each.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


