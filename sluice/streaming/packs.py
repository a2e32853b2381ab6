"""Rows of one key packed into one on their way through a state operator.

A row handed to a Python state operator, or back from it, costs far more than the values it
holds, so the rows of a key go in as one text and come out as lists. Packing needs no state:
it joins what lies in one task, so that a key still has several rows.
"""

from __future__ import annotations

import json
from collections import namedtuple
from collections.abc import Iterable, Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

PACK = 32  # rows of a packed row; bounds an Arrow batch of them
OUT_PACK = 1000  # rows of a packed row that leaves a state operator
_ROWS = "-"  # how many rows a text holds; no column has this name
_BUFFER_ROWS = 200_000  # rows looked at together
_BUFFER_BYTES = 64 * 1024 * 1024


def packed(df: DataFrame, key: str) -> DataFrame:
    """Rows of one key as one row with the others' values in a JSON text, ``PACK`` rows at most.

    The other columns hold what JSON can: texts, whole numbers and lists of texts.
    """
    rows = df.select(key, *[c for c in df.columns if c != key])
    schema = T.StructType([rows.schema[0], T.StructField("rows", T.StringType())])

    def pack(batches: Iterator) -> Iterator:
        held, n, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            n, size = n + batch.num_rows, size + batch.nbytes
            if n >= _BUFFER_ROWS or size >= _BUFFER_BYTES:
                yield _packed_batch(held)
                held, n, size = [], 0, 0
        if n:
            yield _packed_batch(held)

    return rows.mapInArrow(pack, schema)


def _packed_batch(batches: list):
    import numpy as np
    import pyarrow as pa

    table = pa.Table.from_batches(batches)
    code = table.column(0).combine_chunks().dictionary_encode("encode").indices.to_numpy()
    order = np.argsort(code, kind="stable")
    code = code[order]
    table = table.take(pa.array(order))
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    lengths = np.diff(np.r_[starts, len(code)])
    cuts = -(-lengths // PACK)  # packed rows per key
    nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    firsts = np.repeat(starts, cuts) + nth * PACK
    columns = {name: _values(table.column(name)) for name in table.column_names[1:]}
    bounds = [*firsts.tolist(), len(code)]
    texts = [json.dumps({_ROWS: to - at, **{name: _shortened(c[at:to]) for name, c in columns.items()}})
             for at, to in zip(bounds, bounds[1:])]
    return pa.RecordBatch.from_arrays(
        [table.column(0).combine_chunks().take(pa.array(firsts)), pa.array(texts, pa.string())],
        names=[table.column_names[0], "rows"])


def _values(column) -> list:
    """A column's values; Arrow makes them one by one where numpy cannot hold them."""
    import pyarrow as pa

    if column.null_count == len(column):
        return [None] * len(column)
    if pa.types.is_string(column.type) or (pa.types.is_integer(column.type) and not column.null_count):
        return column.to_numpy().tolist()
    return column.to_pylist()


def _shortened(values: list) -> list:
    return values[:1] if values.count(values[0]) == len(values) else values


def packed_type(schema: str) -> str:
    """The same fields, each a list."""
    return ", ".join(f"{name} array<{kind}>" for name, kind in (f.split(" ", 1) for f in schema.split(", ")))


def unpacked(df: DataFrame) -> DataFrame:
    """One row per place in the lists."""
    return df.select(F.inline(F.arrays_zip(*[F.col(c) for c in df.columns])))


def unpack_rows(rows: Iterable[Row]) -> Iterator[tuple]:
    """The rows that were packed, without their key."""
    made = None
    for r in rows:
        held = json.loads(r[1])
        n = held.pop(_ROWS)
        if made is None:
            made = namedtuple("Unpacked", held)._make
        yield from map(made, zip(*[v if len(v) == n else v * n for v in held.values()]))


def pack_rows(rows: Iterable[Row], factory: Row) -> Iterator[Row]:
    """Rows as rows of lists, as they leave a state operator."""
    rows = iter(rows)
    while some := list(islice(rows, OUT_PACK)):
        yield factory(*map(list, zip(*some)))
