"""Record headers: read as numbers with safe defaults, written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADERS_TYPE = "map<string,string>"


def header(headers: Column, name: str) -> Column:
    return F.try_element_at(headers, F.lit(name))


def header_int(headers: Column, name: str, default: Column | int = 0) -> Column:
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(header(headers, name).try_cast("int"), fallback)


def header_long(headers: Column, name: str, default: Column) -> Column:
    return F.coalesce(header(headers, name).try_cast("bigint"), default)


def make_headers(**values: Column) -> Column:
    """Header map of the given columns, all as text; null values are left out."""
    entries: list[Column] = []
    for name, value in values.items():
        entries += [F.lit(name), value.cast("string")]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def to_kafka_headers(headers: Column) -> Column:
    """Header map in the shape the Kafka sink takes (``includeHeaders``)."""
    return F.transform(
        F.map_entries(headers),
        lambda e: F.struct(e["key"].alias("key"), F.encode(e["value"], "UTF-8").alias("value")),
    )


def from_kafka_headers(headers: Column) -> Column:
    """Header array of the Kafka source as a map; the last of equal names wins."""
    return F.aggregate(
        F.coalesce(headers, F.array().cast("array<struct<key:string,value:binary>>")),
        F.create_map().cast(HEADERS_TYPE),
        lambda acc, h: F.map_concat(
            F.map_filter(acc, lambda k, _: k != h["key"]),
            F.create_map(h["key"], F.decode(h["value"], "UTF-8")),
        ),
    )
