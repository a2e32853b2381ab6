"""Removal of repeated multi-line passages, cut into chunks where the content says so.

A chunk ends after a line if a rolling hash over that line and the one before it falls
on a fixed remainder. An inserted or deleted line therefore moves no boundary beyond the
next line, and a passage shared by two documents is cut alike inside both. Chunks whose
hash occurs more than once are compared byte for byte; all but the first occurrence go.
Only built-in column functions are used.

Short passages mostly escape these chunks, which the query's SQL fixes. ``dedup_passages``
therefore looks at every two non-blank lines in a row instead, without any boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import stage

DIVISOR = 3  # a boundary after one line in three on average
MIN_LINES = 2
BROADCAST_HASHES = 1_000_000  # repeated hashes, 8 bytes each, sent to every task at most


def line_hash(line: Column) -> Column:
    """28 bits of a line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def _rows(docs: DataFrame) -> DataFrame:
    """Each row as a whole, its id and text, and a hash that tells texts of one id apart.

    The row goes into one struct, so that no column of ``docs`` can clash with ours.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.struct("*").alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                       F.xxhash64(text).alias("_th"), text.alias("_text"))


def _chunk_lists(rows: DataFrame, lines: Column) -> DataFrame:
    """``rows`` with ``_parts``, the chunks of ``lines`` in order, each a list of lines.

    Every costly array stands behind an ``explode`` of one element, which keeps the
    optimizer from copying it into each use.
    """
    split = rows.withColumn("_lines", F.explode(F.array(lines)))
    hashed = split.withColumn("_h", F.explode(F.array(F.transform("_lines", line_hash))))
    # beside each line's hash that of the line before; the first line follows a zero
    before = F.concat(F.array(F.lit(0).cast("long")), F.slice("_h", 1, F.size("_h") - 1))
    last = F.zip_with("_h", before, lambda h, b: (h + b * 31) % DIVISOR == 0)
    ends = F.filter(F.transform(last, lambda x, i: F.when(x, i + 1)), F.isnotnull)
    ends = F.array_distinct(F.concat(ends, F.array(F.size("_h"))))
    cut = hashed.withColumn("_ends", F.explode(F.array(ends))).drop("_h")
    starts = F.concat(F.array(F.lit(0)), F.slice("_ends", 1, F.size("_ends") - 1))
    spans = F.arrays_zip(starts.alias("a"), F.col("_ends").alias("b"))
    parts = F.transform(spans, lambda s: F.slice(F.col("_lines"), s["a"] + 1, s["b"] - s["a"]))
    return cut.withColumn("_parts", F.explode(F.array(parts))).drop("_ends", "_lines")


def _all_lines() -> Column:
    return F.split(F.col("_text"), "\n", -1)


def chunks(docs: DataFrame) -> DataFrame:
    """``_id, _th, _at, _chunk, _hash`` of every chunk of two lines at least, blank ones aside."""
    rows = _rows(docs).select("_id", "_th", "_text")
    return _chunk_lists(rows, _all_lines()).select(
        "_id", "_th", F.posexplode("_parts").alias("_at", "_part")).where(
        F.size("_part") >= MIN_LINES).select(
        "_id", "_th", "_at", F.concat_ws("\n", "_part").alias("_chunk")).where(
        F.col("_chunk").rlike(r"\S")).withColumn("_hash", F.xxhash64("_chunk"))


def repeated(docs: DataFrame) -> DataFrame:
    """``_id, _th, _at`` of every chunk that is not the first of its bytes.

    The first is the one of smallest (id, text hash, place), a null id before all others.
    """
    found = chunks(docs)
    where = F.struct("_id", "_th", "_at")
    hashes = stage(found.groupBy("_hash").agg(F.count(F.lit(1)).alias("_times"))
                   .where("_times > 1").select("_hash"), "hashes")
    # 8 bytes a row: sent to the tasks up to a bound, else joined by a shuffle
    few = hashes.count() <= BROADCAST_HASHES
    again = stage(found.join(F.broadcast(hashes) if few else hashes, "_hash", "left_semi"), "again")
    first = stage(again.groupBy("_hash", "_chunk").agg(
        F.min(where).alias("_first"), F.count(F.lit(1)).alias("_times"))
        .where("_times > 1").select("_hash", F.col("_chunk").alias("_bytes"), "_first"), "first")
    return again.join(first, "_hash").where(
        (F.col("_chunk") == F.col("_bytes")) & (where > F.col("_first"))).select(
        "_id", "_th", "_at")


def _cut(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` with its text left, its number of lines, and of lines removed."""
    gone = stage(repeated(docs).groupBy("_id", "_th").agg(
        F.sort_array(F.collect_set("_at")).alias("_gone")), "gone").select(
        F.col("_id").alias("_gone_id"), F.col("_th").alias("_gone_th"), "_gone")
    rows = _rows(docs).withColumn(
        "_n", F.when(F.col("_row.text").isNull(), 0).otherwise(F.size(_all_lines())))
    # by a shuffle at every size: what is gone grows with the documents
    joined = rows.join(gone.hint("merge"), F.col("_id").eqNullSafe(F.col("_gone_id"))
                       & (F.col("_th") == F.col("_gone_th")), "left")
    # texts that lose nothing are not cut again
    lists = _chunk_lists(joined, F.when(F.isnotnull("_gone"), _all_lines()).otherwise(F.array("_text")))
    kept = F.filter("_parts", lambda p, i: F.isnull("_gone") | ~F.array_contains("_gone", i))
    left = lists.withColumn("_kept", F.explode(F.array(F.flatten(kept))))
    return left.select(
        "_row", "_id", "_n",
        F.when(F.isnull("_gone"), F.col("_row.text")).otherwise(F.concat_ws("\n", "_kept")).alias("_left"),
        F.when(F.isnull("_gone"), 0).otherwise(F.col("_n") - F.size("_kept")).alias("_removed"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated chunks cut from ``text``; rows and columns stay.

    A text whose chunks all go becomes empty; a null text stays null. Rows that agree in
    id and text count as one document, so none of them loses text to the other. A chunk
    of one line, or of blank lines only, is never removed.
    """
    row = _cut(docs).select(F.col("_row").withField("text", F.col("_left")).alias("_row"))
    return row.select("_row.*")


def removed_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept_sha256`` per row; a null text has no lines."""
    return _cut(docs).select(
        F.col("_id").alias("doc_id"), F.col("_n").cast("long").alias("n_lines"),
        F.col("_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("_left", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def line_pairs(docs: DataFrame) -> DataFrame:
    """``_id, _th, _at, _to, _chunk, _hash`` of every non-blank line with the next such line.

    ``_chunk`` holds the lines from ``_at`` to ``_to``, blank ones between them included.
    """
    rows = _rows(docs).select("_id", "_th", F.explode(F.array(_all_lines())).alias("_lines"))
    filled = F.filter(F.transform("_lines", lambda x, i: F.when(x.rlike(r"\S"), i)), F.isnotnull)
    marked = rows.withColumn("_filled", F.explode(F.array(filled))).where(F.size("_filled") > 1)
    spans = F.zip_with(F.slice("_filled", 1, F.size("_filled") - 1),
                       F.slice("_filled", 2, F.size("_filled") - 1),
                       lambda a, b: F.struct(a.alias("_at"), b.alias("_to"), F.array_join(
                           F.slice("_lines", a + 1, b - a + 1), "\n").alias("_chunk")))
    return marked.select("_id", "_th", F.explode(spans).alias("_pair")).select(
        "_id", "_th", "_pair.*").withColumn("_hash", F.xxhash64("_chunk"))


def repeated_pairs(docs: DataFrame) -> DataFrame:
    """``_id, _th, _at, _to`` of every pair of lines whose bytes occurred before.

    First is the one of smallest (id, text hash, place), a null id before all others. A
    pair that shares a line with its own first occurrence is none: of a line many times in
    a row two stay.
    """
    found = line_pairs(docs)
    where = F.struct("_id", "_th", "_at", "_to")
    hashes = stage(found.groupBy("_hash").agg(F.count(F.lit(1)).alias("_times"))
                   .where("_times > 1").select("_hash"), "hashes")
    few = hashes.count() <= BROADCAST_HASHES
    again = stage(found.join(F.broadcast(hashes) if few else hashes, "_hash", "left_semi"), "again")
    first = stage(again.groupBy("_hash", "_chunk").agg(
        F.min(where).alias("_first"), F.count(F.lit(1)).alias("_times"))
        .where("_times > 1").select("_hash", F.col("_chunk").alias("_bytes"), "_first"), "first")
    apart = ~(F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_th") == F.col("_first._th"))) \
        | (F.col("_at") > F.col("_first._to"))
    return again.join(first, "_hash").where((F.col("_chunk") == F.col("_bytes")) & apart).select(
        "_id", "_th", "_at", "_to")


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without any two or more lines in a row that occurred before; rows and columns stay.

    Each line of a repeated pair goes, with blank lines inside the pair. A line's very
    first occurrence is in no repeated pair, so no line vanishes from the corpus. A line
    repeated between other neighbours stays. Nulls, empty texts and rows that agree in
    id and text are treated as in ``dedup_lines``.
    """
    gone = stage(repeated_pairs(docs).groupBy("_id", "_th").agg(
        F.array_distinct(F.flatten(F.collect_set(F.sequence("_at", "_to")))).alias("_gone")), "gone").select(
        F.col("_id").alias("_gone_id"), F.col("_th").alias("_gone_th"), "_gone")
    joined = _rows(docs).join(gone.hint("merge"), F.col("_id").eqNullSafe(F.col("_gone_id"))
                              & (F.col("_th") == F.col("_gone_th")), "left")
    # texts that lose nothing are not cut again
    lists = joined.withColumn("_lines", F.explode(F.array(
        F.when(F.isnotnull("_gone"), _all_lines()).otherwise(F.array(F.lit(""))))))
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.coalesce("_gone", F.array()))
    kept = F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")
    text = F.when(F.isnull("_gone"), F.col("_row.text")).otherwise(kept)
    return lists.select(F.col("_row").withField("text", text).alias("_row")).select("_row.*")


REMOVED_LINES_SQL = f"""
WITH lined AS (
  SELECT doc_id, text IS NULL AS no_text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
hashed AS (
  SELECT *, list_transform(l, lambda x: ('0x' || substr(md5(x), 1, 7))::BIGINT) AS h FROM lined),
lines AS (
  SELECT doc_id, i, l[i] AS line,
         (h[i] + 31 * CASE WHEN i > 1 THEN h[i - 1] ELSE 0 END) % {DIVISOR} = 0 AS last
  FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM hashed)),
placed AS (
  SELECT *, coalesce(sum(last::INT) OVER (
    PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM lines),
parts AS (
  SELECT doc_id, place, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n
  FROM placed GROUP BY doc_id, place),
marked AS (
  SELECT *, n >= {MIN_LINES} AND regexp_matches(chunk, '[^ \\t\\n\\f\\r\\v]') AND row_number() OVER (
    PARTITION BY chunk ORDER BY doc_id, place) > 1 AS gone FROM parts)
SELECT d.doc_id, CASE WHEN d.no_text THEN 0 ELSE len(d.l) END AS n_lines,
       coalesce(m.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(m.kept, '')) AS kept_sha256
FROM lined d LEFT JOIN (
  SELECT doc_id, sum(n) FILTER (gone) AS n_removed,
         string_agg(chunk, chr(10) ORDER BY place) FILTER (NOT gone) AS kept
  FROM marked GROUP BY doc_id) m USING (doc_id)
"""
