"""Exact top-k by inner product, reading sorted lists without random access.

Candidates are dealt into blocks. Per block and dimension the components are one sorted
list; a query reads every list from its good end, all to the same depth. What was read of
a candidate bounds its score: unread components count as the list's last value read from
above, and as its far end from below. Reading stops once no candidate outside the best k
can reach the k-th lower bound; those still within reach get their final scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import stage

SCALE = 256
K = 5
BLOCK = 2048  # candidates sorted together in one task
QUERIES = 1024  # queries that meet a block in one task
FIRST_DEPTH = 64  # rows read of each list before the bounds are first compared
RESOLVED = 32  # reading stops when one candidate in so many is left; these get final scores


def scaled(vector: Column) -> Column:
    """``floor(256 * x)`` of each component as long; null for vectors that take no part."""
    # array functions see null components as null, so any of them makes the test fail
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return F.when(vector.isNotNull() & usable, whole)


class Lists:
    """A block of candidates as sorted lists, two per dimension: ascending and descending.

    Bounds are kept in floating point, with a margin for its rounding; final scores are
    integers.
    """

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        order = np.argsort(rows, axis=0, kind="stable")
        values = np.take_along_axis(rows, order, axis=0).astype(float)
        self.order = np.concatenate([order.T, order.T[:, ::-1]])  # (2d, n): places in order
        self.values = np.concatenate([values.T, values.T[:, ::-1]])
        self.rank = np.argsort(order, axis=0, kind="stable").T.astype(
            np.uint16 if len(rows) <= 1 << 16 else np.int32)

    def best(self, query: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best ``k`` rows, ties to the smaller id.

        ``own`` marks the rows that are no candidates.
        """
        n, d = self.rows.shape
        used = np.nonzero(query)[0]
        weight = query[used].astype(float)[:, None]
        down = weight[:, 0] > 0  # such lists are read from their large end
        lists = used + d * down
        worst = self.values[lists, -1:] * weight
        margin = 1 + 1e-9 * np.maximum(np.abs(worst), np.abs(self.values[lists, :1] * weight)).sum()
        lower = np.full(n, worst.sum())
        lower[own] = -np.inf
        alive = np.nonzero(~own)[0]
        depth = 0
        while len(used) and depth < n and len(alive) > max(k, n // RESOLVED):
            # four times as deep up to half way, then half of what is left
            before, depth = depth, min(n, max(FIRST_DEPTH, min(4 * depth, (n + depth + 1) // 2)))
            read = slice(before, depth)
            gain = self.values[lists, read] * weight - worst
            lower += np.bincount(self.order[lists, read].ravel(), gain.ravel(), n)
            edge = self.values[lists, depth - 1][:, None] * weight
            kth = np.partition(lower[alive], len(alive) - k)[len(alive) - k] - margin
            if edge.sum() > kth:
                continue  # a row not read anywhere might still qualify
            most = 2 * len(alive) > n  # then it is quicker to look at all rows
            rank = (self.rank if most else self.rank.take(alive, axis=1))[used]
            unread = np.where(down[:, None], rank < n - depth, rank >= depth)
            more = (edge - worst)[:, 0] @ unread.astype(float)
            alive = alive[lower[alive] + (more[alive] if most else more) >= kth]
        score = self.rows[alive] @ query
        top = np.lexsort((self.ids[alive], -score))[:k]
        return alive[top], score[top]


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Vectors as rows, shorter ones padded with zeros."""
    size = vectors.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(size), size.max(initial=0)), dtype=np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = vectors.flatten().to_numpy()
    return out


def _search(k: int):
    def run(rows: pa.Table) -> pa.Table:
        is_query = rows.column("is_query").to_numpy()
        ids = rows.column("vec_id").to_numpy()
        table = _matrix(rows.column("v").combine_chunks())
        lists = Lists(table[~is_query], ids[~is_query])
        out: list[tuple] = []
        for q in np.nonzero(is_query)[0] if lists.rows.size else ():
            at, score = lists.best(table[q], lists.ids == ids[q], k)
            out += [(int(ids[q]), int(lists.ids[a]), int(s)) for a, s in zip(at, score)]
        q, v, s = zip(*out) if out else ((), (), ())
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()),
                         "score": pa.array(s, pa.int64())})
    return run


def top_k(vectors: DataFrame, queries: Column, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score`` of each query's ``k`` best among all other rows.

    ``queries`` picks the rows of ``vectors`` (``vec_id, embedding``) that ask. Every block
    of candidates meets every block of queries in a task of its own, and leaves at most k
    rows per query. Vectors that are null, or hold null or non-finite components, take no
    part; shorter vectors count as padded with zeros; rows of null ``vec_id`` are left out.
    Rows that share an id never answer each other; as queries they are one, the answers
    being those of any of them, as candidates each counts.
    """
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                            scaled(F.col("embedding")).alias("v")).where(
        "vec_id IS NOT NULL AND v IS NOT NULL")
    usable = stage(usable, "vectors")
    blocks = max(1, -(-usable.count() // BLOCK))
    asking = stage(usable.where(queries).dropDuplicates(["vec_id"]), "asking")
    parts = max(1, -(-asking.count() // QUERIES))
    deal = F.xxhash64("vec_id", "v")
    dealt = usable.select(F.pmod(deal, F.lit(blocks)).cast("int").alias("block"),
                          F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
                          F.lit(False).alias("is_query"), "vec_id", "v")
    asked = asking.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                          F.pmod(deal, F.lit(parts)).cast("int").alias("part"),
                          F.lit(True).alias("is_query"), "vec_id", "v")
    found = dealt.unionByName(asked).groupBy("block", "part").applyInArrow(
        _search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


TOP_K_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= {K}
"""
