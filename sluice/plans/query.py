"""Paged queries over the lake."""

from __future__ import annotations

import math
import re
import time
from dataclasses import dataclass, fields
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.lake import DATA, lake_path, scan_lake

ORDER = ["ingestion_time", "event_id"]

# Bounds and defaults of a query.
GLOBAL_MAX_ROWS = 10_000
BOUNDS = {
    "year": (2000, 2100),
    "month": (1, 12),
    "day": (1, 31),
    "hour": (0, 23),
    "max_rows": (1, 100_000),
    "page": (1, None),
    "page_size": (1, 10_000),
}

_FILE, _PLACE = "_page_file", "_page_row"

# The order's columns of up to this many rows are skipped by sorting; what lies before is sought.
PLAIN_OFFSET = 100_000


class FilterError(ValueError):
    """A query filter with fields out of bounds; ``errors`` maps field to message."""

    def __init__(self, errors: dict[str, str]):
        self.errors = errors
        super().__init__("; ".join(errors.values()))


class QueryError(RuntimeError):
    """A query that could not be executed."""


@dataclass(frozen=True)
class QueryFilter:
    """What to read and which page of it. Every field that is set applies."""

    prefix: str = DATA
    year: int | None = None
    month: int | None = None
    day: int | None = None
    hour: int | None = None
    source: str | None = None
    additional_where: str | None = None
    max_rows: int = 10_000
    page: int = 1
    page_size: int = 100

    def __post_init__(self) -> None:
        errors = {}
        if not isinstance(self.prefix, str) or not self.prefix.strip():
            errors["prefix"] = "prefix must not be blank"
        for name, (low, high) in BOUNDS.items():
            value = getattr(self, name)
            if value is None and name in ("year", "month", "day", "hour"):
                continue
            if isinstance(value, bool) or not isinstance(value, int):
                errors[name] = f"{name} must be a whole number"
            elif value < low or (high is not None and value > high):
                errors[name] = (f"{name} must be >= {low}" if high is None
                                else f"{name} must be between {low} and {high}")
        if errors:
            raise FilterError(errors)

    @classmethod
    def of(cls, **given: Any) -> "QueryFilter":
        """Filter from named values; numbers may come as text, unknown names are errors."""
        known = {f.name for f in fields(cls)}
        errors = {n: f"{n} is not a filter field" for n in given if n not in known}
        values = {}
        for name, value in given.items():
            if name in BOUNDS and isinstance(value, str):
                try:
                    value = int(value)
                except ValueError:
                    errors[name] = f"{name} must be a whole number"
                    continue
            values[name] = value
        if errors:
            raise FilterError(errors)
        return cls(**values)

    @property
    def limit(self) -> int:
        return min(self.page_size, self.max_rows, GLOBAL_MAX_ROWS)

    @property
    def offset(self) -> int:
        return (self.page - 1) * self.limit


@dataclass(frozen=True)
class QueryResult:
    columns: list[str]
    rows: list[dict[str, Any]]
    total_rows: int
    returned_rows: int
    page: int
    page_size: int
    total_pages: int
    execution_time_ms: int
    engine: str
    scanned_path: str


def conditions(flt: QueryFilter) -> list[Column]:
    """Predicates of the filter; those on partition columns prune folders."""
    out = [F.col(c) == F.lit(getattr(flt, c))
           for c in ("year", "month", "day", "hour") if getattr(flt, c) is not None]
    if flt.source is not None and flt.source.strip():
        out.append(F.col("source") == F.lit(flt.source))
    if flt.additional_where is not None and flt.additional_where.strip():
        out.append(F.expr(f"({flt.additional_where})"))
    return out


def filtered(lake: DataFrame, flt: QueryFilter) -> DataFrame:
    for condition in conditions(flt):
        lake = lake.where(condition)
    return lake


def count_rows(lake: DataFrame, flt: QueryFilter) -> DataFrame:
    return filtered(lake, flt).agg(F.count("*").alias("total_rows"))


def page(lake: DataFrame, flt: QueryFilter, order: list[str] | None = None,
         plain: int | None = None) -> DataFrame:
    """One page in a stable order.

    The page is found on its order's columns alone, together with each row's file and place
    in it; whole rows are then read from the page's files only, so none is ever sorted. A
    deep page is sought first (see ``seek``). Rows of a frame that is no scan of files have
    no place to be read from again and are sorted as they are.
    """
    order = order or ORDER
    rows, offset = filtered(lake, flt), flt.offset
    scanned = _is_scan(lake)
    if scanned:
        rows = rows.select(
            *dict.fromkeys([*ORDER, *order]), F.col("_metadata.file_path").alias(_FILE),
            F.col("_metadata.row_index").alias(_PLACE))
    if order == ORDER:
        rows, offset = seek(rows, offset, plain)
    if not scanned:
        return rows.orderBy(*order).offset(offset).limit(flt.limit)
    keys = rows.orderBy(*order).offset(offset).limit(flt.limit).collect()  # at most page_size rows
    if not keys:
        return lake.limit(0)
    spark = lake.sparkSession
    wanted = spark.createDataFrame([(k[_FILE], k[_PLACE]) for k in keys], f"{_FILE} string, {_PLACE} long")
    files = sorted({k[_FILE] for k in keys})
    found = lake.withColumns({_FILE: F.col("_metadata.file_path"), _PLACE: F.col("_metadata.row_index")}).where(
        F.col("_metadata.file_path").isin(files))
    return found.join(F.broadcast(wanted), [_FILE, _PLACE], "left_semi").drop(_FILE, _PLACE).orderBy(*order)


def _is_scan(lake: DataFrame) -> bool:
    try:
        lake.select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


def _levels() -> list[Column]:
    """Ever finer cuts of the default order, each with a bounded number of values."""
    time_text, key = F.col("ingestion_time"), F.col("event_id")
    return [
        F.substring(time_text, 1, 13),
        F.substring(time_text, 1, 19),
        time_text,
        *[F.substring(key, 1, n) for n in (1, 2, 3, 4, 6, 8)],
    ]


def seek(rows: DataFrame, offset: int, plain: int | None = None) -> tuple[DataFrame, int]:
    """Narrow ``rows`` to the part a deep page starts in, and what is left to skip.

    Counts rows per hour, second, time and key prefix in turn and drops the parts that
    lie wholly before the page, so that no task sorts all the skipped rows. All cuts are
    prefixes of the order's own texts, so they agree with it whatever the times look like.
    Stops when no more than ``plain`` rows are left to skip.
    """
    plain = PLAIN_OFFSET if plain is None else plain
    inside = F.lit(True)  # the part every cut so far has led to
    for level in _levels():
        if offset <= plain:
            break
        sizes = rows.where(inside).groupBy(level.alias("part")).agg(F.count("*").alias("n"))
        skipped, start = 0, None
        for row in sizes.orderBy("part").toLocalIterator():
            if skipped + row["n"] > offset:
                start = row["part"]
                break
            skipped += row["n"]
        if start is None:  # the page lies behind the last row
            return rows.limit(0), 0
        first = F.lit(start)
        rows, offset = rows.where(~(inside & (level < first))), offset - skipped
        inside = inside & (level == first)
    return rows, offset


def folder_of(flt: QueryFilter) -> str:
    """The deepest folder that holds all rows of the filter, below its prefix."""
    parts = []
    for name in ("year", "month", "day", "hour"):
        value = getattr(flt, name)
        if value is None:
            return "/".join(parts)
        parts.append(f"year={value}" if name == "year" else f"{name}={value:02d}")
    if flt.source is not None and re.fullmatch(r"[\w-]+", flt.source):
        parts.append(f"source={flt.source}")  # other characters are escaped in paths
    return "/".join(parts)


def scanned_path(root: str, flt: QueryFilter) -> str:
    folder = folder_of(flt)
    return lake_path(root, flt.prefix) + (f"/{folder}" if folder else "")


def run_query(spark: SparkSession, root: str, flt: QueryFilter) -> QueryResult:
    """Execute a filter: total count and one page, the only rows that reach the driver."""
    started = time.monotonic()
    try:
        lake = scan_lake(spark, root, flt.prefix, folder_of(flt))
        total = count_rows(lake, flt).first()["total_rows"]
        found = page(lake, flt)
        rows = [r.asDict(recursive=True) for r in found.collect()]  # at most page_size rows
    except Exception as e:
        raise QueryError(f"query failed: {e}") from e
    return QueryResult(
        columns=found.columns,
        rows=rows,
        total_rows=total,
        returned_rows=len(rows),
        page=flt.page,
        page_size=flt.limit,
        total_pages=max(1, math.ceil(total / flt.limit)),
        execution_time_ms=int((time.monotonic() - started) * 1000),
        engine="spark",
        scanned_path=scanned_path(root, flt),
    )
