"""Typed access to a JSON payload read as ``map<string,variant>``.

A variant keeps the JSON type of each value, which plain strings would lose; the map
keeps the order of the keys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_MAP = "map<string,variant>"


def as_map(json_text: Column) -> Column:
    """Payload text as a map; an absent payload is an empty map."""
    return F.coalesce(
        F.from_json(json_text, EMPTY_MAP),
        F.from_json(F.lit("{}"), EMPTY_MAP),
    )


def is_absent(kind: Column) -> Column:
    """True when the key is missing or its value is JSON null."""
    return kind.isNull() | (kind == "VOID")


def json_type(kind: Column) -> Column:
    """JSON type of a variant type name: ``string``, ``number``, ``boolean``, or
    ``unknown`` for null, list and object."""
    return (
        F.when(kind == "STRING", "string")
        .when((kind == "BIGINT") | kind.startswith("DECIMAL") | (kind == "DOUBLE")
              | (kind == "FLOAT"), "number")
        .when(kind == "BOOLEAN", "boolean")
        .otherwise("unknown")
    )


def typed_key(name: Column, json_type_name: Column) -> Column:
    return F.concat(name, F.lit(":"), json_type_name)


NULL_TYPE = "null"


def typed_keys(payload: Column) -> Column:
    """All keys of a payload with their JSON types, as texts like ``amount:number``.

    A JSON null has the type ``null`` here, unlike in violations.
    """
    kinds = F.transform(F.map_entries(payload), lambda e: F.struct(
        e["key"].alias("key"), F.schema_of_variant(e["value"]).alias("kind")))
    return F.transform(kinds, lambda k: typed_key(
        k["key"], F.when(k["kind"] == "VOID", NULL_TYPE).otherwise(json_type(k["kind"]))))


def texts(json_text: Column, names: list[str]) -> Column:
    """The named members as a struct of texts; null where missing or JSON null."""
    schema = ", ".join(f"`{n}` string" for n in names)
    return F.from_json(json_text, schema)
