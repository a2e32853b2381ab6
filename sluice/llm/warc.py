r"""WARC records and a Merkle audit of their replicas.

A record's leaf is the hash of its bytes. Leaves in one range of offsets of an archive
make a node, ranges of sixteen times that length the next level, and so on to the root of
the archive. Two replicas are compared by their roots; below a root that differs only the
children of differing nodes are looked at, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import stage

RANGE = 1 << 18  # bytes of an archive under one lowest node
FANOUT = 16
ARCHIVE_PAGES = 500  # pages written to one archive


def record_bytes(url: Column, body: Column) -> Column:
    """A WARC response record: header lines, a blank line, the body, two line ends."""
    body = F.coalesce(body, F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def page_records(pages: DataFrame) -> DataFrame:
    """One record per page: ``archive, page_id, record``.

    An archive takes the pages of 500 consecutive ids; pages without id go to archives of
    their own, numbered below zero by hash.
    """
    made = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        record_bytes(F.col("url"), F.col("html")).alias("record"))
    archive = F.coalesce(F.floor(F.col("page_id") / ARCHIVE_PAGES),
                         -1 - F.pmod(F.xxhash64("record"), F.lit(1 << 20))).cast("long")
    return made.select(archive.alias("archive"), "page_id", "record")


def manifest(records: DataFrame, *more: str) -> DataFrame:
    """Where each record lies: ``archive, page_id, digest, length, offset`` and columns ``more``.

    Records of an archive follow each other by id, then by digest; equal ones are stored
    once. Offsets are running sums of lengths, so no record's bytes move for them.
    """
    sized = records.select(
        "archive", "page_id", F.sha2(F.col("record").cast("binary"), 256).alias("digest"),
        F.octet_length("record").cast("long").alias("length"), *more).distinct()
    before = Window.partitionBy("archive").orderBy("page_id", "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    return sized.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def _next_level(nodes: DataFrame) -> DataFrame:
    """Nodes of the next level: at most ``FANOUT`` children each, in order."""
    listed = F.array_sort(F.collect_list(F.struct("node", "digest")))
    return nodes.groupBy("archive", F.floor(F.col("node") / FANOUT).cast("long").alias("parent")).agg(
        F.sha2(F.to_json(listed), 256).alias("digest")).withColumnRenamed("parent", "node")


def tree(replica: DataFrame, levels: int) -> list[DataFrame]:
    """Levels of the tree from the lowest nodes to the roots (node 0 of each archive).

    A lowest node hashes the records that begin in its range of offsets, in order.
    """
    listed = F.array_sort(F.collect_list(F.struct("offset", "length", "digest")))
    low = replica.groupBy("archive", F.floor(F.col("offset") / RANGE).cast("long").alias("node")).agg(
        F.sha2(F.to_json(listed), 256).alias("digest"))
    out = [stage(low, "level0")]
    for k in range(1, levels):
        out.append(stage(_next_level(out[-1]), f"level{k}"))
    return out


def level_count(*replicas: DataFrame) -> int:
    """Levels until one node holds the furthest offset of any replica."""
    furthest = max(r.agg(F.max("offset")).first()[0] or 0 for r in replicas)
    count, span = 1, RANGE
    while span <= furthest:
        count, span = count + 1, span * FANOUT
    return count


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nodes of one level that are missing on a side or differ."""
    left = a.select("archive", "node", F.col("digest").alias("a"))
    right = b.select("archive", "node", F.col("digest").alias("b"))
    return left.join(right, ["archive", "node"], "full").where(
        ~F.col("a").eqNullSafe(F.col("b"))).select("archive", "node")


def audit(original: DataFrame, replica: DataFrame) -> DataFrame:
    """Records that differ: ``archive, offset, status, length_a, digest_a, length_b, digest_b``.

    Both sides are ``archive, offset, length, digest``, one row per record; ``status`` is
    ``missing`` (not in the replica), ``extra`` or ``altered``. Archives whose roots agree
    are never read again; of the others, each level reads only the children of nodes that
    differ. Several records of one offset are compared by their sorted list.
    """
    def whole(side):
        listed = F.array_sort(F.collect_list(F.struct("length", "digest")))
        one = side.groupBy("archive", "offset").agg(listed.alias("all"))
        return one.select("archive", "offset", F.col("all")[0]["length"].alias("length"), F.when(
            F.size("all") == 1, F.col("all")[0]["digest"]).otherwise(
            F.sha2(F.to_json("all"), 256)).alias("digest"))

    a, b = (stage(side.select("archive", "offset", "length", "digest"), "leaves")
            for side in (original, replica))
    levels = level_count(a, b)
    trees = tree(a, levels), tree(b, levels)
    suspects = stage(_differing(trees[0][-1], trees[1][-1]), "suspects")
    for k in range(levels - 2, -1, -1):
        parents = suspects.withColumnRenamed("node", "parent")

        def below(nodes, parents=parents):
            keyed = nodes.withColumn("parent", F.floor(F.col("node") / FANOUT).cast("long"))
            return keyed.join(parents, ["archive", "parent"], "left_semi")
        suspects = stage(_differing(below(trees[0][k]), below(trees[1][k])), "suspects")

    def within(side):
        keyed = side.withColumn("node", F.floor(F.col("offset") / RANGE).cast("long"))
        return whole(keyed.join(suspects, ["archive", "node"], "left_semi"))
    left = within(a).select("archive", "offset", F.col("length").alias("length_a"), F.col("digest").alias("digest_a"))
    right = within(b).select("archive", "offset", F.col("length").alias("length_b"), F.col("digest").alias("digest_b"))
    joined = left.join(right, ["archive", "offset"], "full")
    differs = ~(F.col("digest_a").eqNullSafe(F.col("digest_b")) & F.col("length_a").eqNullSafe(F.col("length_b")))
    status = F.when(F.isnull("digest_b"), "missing").when(F.isnull("digest_a"), "extra").otherwise("altered")
    return joined.where(differs).select("archive", "offset", status.alias("status"), "length_a",
                                        "digest_a", "length_b", "digest_b")


# The audit of a replica in which every 50th page is lost and the one after it changed.
AUDIT_SQL = f"""
WITH r AS (
  SELECT page_id // {ARCHIVE_PAGES} AS archive, page_id,
    'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
    || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
    || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM (SELECT DISTINCT page_id, url, html FROM pages)),
m AS (
  SELECT archive, page_id, record, sha256(record) AS digest, strlen(record) AS length FROM r),
o AS (
  SELECT *, coalesce(sum(length) OVER (PARTITION BY archive ORDER BY page_id, digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset" FROM m)
SELECT archive, CAST("offset" AS BIGINT) AS "offset",
  CASE page_id % 50 WHEN 0 THEN 'missing' ELSE 'altered' END AS status,
  length AS length_a, digest AS digest_a,
  CASE page_id % 50 WHEN 1 THEN length END AS length_b,
  CASE page_id % 50 WHEN 1 THEN sha256('X' || substr(record, 2)) END AS digest_b
FROM o WHERE page_id % 50 IN (0, 1)
"""
