"""Connected components of a graph given as edges, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import stage


def _checksum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], int(row["h"] or 0)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return stage(both, "star").join(stage(smallest, "least"), "u").where("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    smallest = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = stage(down, "star").join(stage(smallest, "least"), "u").select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.union(smallest.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """One row ``(node, root)`` per node of an edge; the root is the smallest node reached.

    Takes columns ``u`` and ``v``; loops and repeated edges are harmless. Every round is
    a few shuffles of the edges, written to the shared folder, and the number of rounds
    grows with the logarithm of the number of nodes. No node's neighbours meet in one
    task except as partial minima.
    """
    now = stage(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, mark = None, _checksum(now)
    while mark != before and mark[0]:
        before = mark
        large = stage(_large_star(now).distinct(), "large")
        now = stage(_small_star(large).distinct(), "small")
        mark = _checksum(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
