"""Joins that stay even when one key holds a large part of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "_salt"

# Ceilings for a broadcast side; beyond either the lookup is shuffled and salted.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024


# A key with at least this share of the rows is hot: it alone is cut into parts.
HOT_SHARE = 1 / 64
_TRACKED = 10_000  # keys the sketch keeps; it finds every key above 1 / _TRACKED of the rows


def hot_keys(df: DataFrame, key: str) -> list:
    """Keys that hold at least ``HOT_SHARE`` of the rows, found by a mergeable sketch.

    At most ``1 / HOT_SHARE`` keys come back, whatever the size of ``df``. Counts are
    estimates; a key near the bound may be taken for hot, which only costs copies.
    """
    most = round(1 / HOT_SHARE)
    row = df.agg(F.count(key).alias("n"),
                 F.expr(f"approx_top_k(`{key}`, {most}, {_TRACKED})").alias("top")).first()
    return [t["item"] for t in row["top"] or [] if t["count"] >= HOT_SHARE * row["n"] and row["n"] >= _TRACKED]


def spread_join(big: DataFrame, small: DataFrame, key: str, spread_by: Column,
                how: str, salts: int, hot: list | None = None) -> DataFrame:
    """Join ``big`` to ``small`` (one row per key) so that no key's rows meet in one task.

    ``hot`` lists the keys that are cut into ``salts`` parts, as ``hot_keys`` finds them;
    without such a key it is a plain join. If None, every key is cut, and ``small`` is
    repeated once per salt. ``spread_by`` must tell apart the rows of one key.
    """
    if hot is not None and not hot:
        return big.join(small, key, how)
    part = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    parts = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
        part, parts = F.when(is_hot, part).otherwise(0), F.when(is_hot, parts).otherwise(F.array(F.lit(0)))
    left = big.withColumn(_SALT, part)
    right = small.withColumn(_SALT, F.explode(parts))
    return left.join(right, [key, _SALT], how).drop(_SALT)


def sized(table: DataFrame) -> DataFrame:
    """A staged table of narrow rows, to be broadcast in a join while its rows, counted, are few.

    The optimizer goes by the length of files, and rows of ids or arrival numbers fill files a
    tenth of their size in memory: it would broadcast tables that the driver cannot hold.
    """
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table.hint("merge")


def lookup(big: DataFrame, table: DataFrame, key: str, spread_by: Column,
           rows_bound: int | None, salts: int = 16, bytes_bound: int = 0) -> DataFrame:
    """Left join to a lookup table: broadcast while its row bound is small enough.

    ``rows_bound`` is a proven upper bound of the rows of ``table``, ``bytes_bound`` one of
    their size; without the first, or above a ceiling, the join is shuffled and salted instead.
    """
    if rows_bound is not None and rows_bound <= BROADCAST_ROWS and bytes_bound <= BROADCAST_BYTES:
        return big.join(F.broadcast(table), key, "left")
    return spread_join(big, table, key, spread_by, "left", salts)
