"""Schema drift: payload fields against the registered field list, within one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.joins import lookup
from sluice.functions.once import once
from sluice.functions.payload import NULL_TYPE, as_map, is_absent, json_type, typed_key, typed_keys
from sluice.sources.registry import Registry
from sluice.sources.tables import ARRIVAL
from sluice.spec import (
    AUTO_EVOLVE, BACKWARD, FULL, MISSING_FIELD, NEW_FIELD, NONE, REJECT, TYPE_CHANGE,
)

VIOLATIONS_TYPE = (
    "array<struct<field:string,expected_type:string,actual_type:string,violation_type:string>>"
)


def _violation(field: Column, expected: Column, actual: Column, kind: str) -> Column:
    return F.struct(field.alias("field"), expected.alias("expected_type"),
                    actual.alias("actual_type"), F.lit(kind).alias("violation_type"))


def _declared(fields: Column, payload: Column) -> Column:
    """Violations of declared fields, in registry order."""
    found = F.transform(fields, lambda f: F.struct(
        f.alias("f"), F.schema_of_variant(F.try_element_at(payload, f["name"])).alias("kind")))

    def check(x: Column) -> Column:
        f, kind = x["f"], x["kind"]
        actual = json_type(kind)
        return (
            F.when(is_absent(kind), F.when(
                f["required"],
                _violation(f["name"], f["type"], F.lit("null"), MISSING_FIELD)))
            .when(actual != f["type"], _violation(f["name"], f["type"], actual, TYPE_CHANGE))
        )

    return F.array_compact(F.transform(found, check))


def _undeclared(fields: Column, payload: Column) -> Column:
    """Violations by unknown keys, in payload order."""
    extra = F.array_except(F.map_keys(payload), fields["name"])
    return F.transform(extra, lambda key: _violation(
        key, F.lit("undefined"),
        json_type(F.schema_of_variant(F.try_element_at(payload, key))), NEW_FIELD))


def _expectations(registry: Registry) -> DataFrame:
    """Per schema the typed keys a clean payload may have, and those it must have."""
    fields = F.col("fields")
    exact = F.transform(fields, lambda f: typed_key(f["name"], f["type"]))
    optional = F.filter(fields, lambda f: ~f["required"])
    return registry.table.select(
        "schema_id", F.col("version").alias("_version"), fields.alias("_fields"),
        F.concat(exact, F.transform(optional, lambda f: typed_key(f["name"], F.lit(NULL_TYPE))))
        .alias("_allowed"),
        F.transform(F.filter(fields, lambda f: f["required"]),
                    lambda f: typed_key(f["name"], f["type"])).alias("_needed"),
    )


def check_drift(events: DataFrame, registry: Registry) -> DataFrame:
    """Adds ``schema_version``, ``violations`` and the drift summary to every event.

    The events need ``schema_id``, ``payload`` (JSON text) and an arrival number. An
    unregistered schema is itself one violation. Whether a payload is clean is told by
    two set differences over its typed keys, also added as ``payload_types``; violations
    are spelled out only for the others.
    """
    # beside its fields a schema's row holds the typed keys it allows and needs
    joined = lookup(events, _expectations(registry), "schema_id", F.col(ARRIVAL), registry.rows,
                    bytes_bound=4 * registry.size)
    joined = once(joined, "_payload", as_map(F.col("payload")))
    joined = once(joined, "payload_types", typed_keys(F.col("_payload")))
    types = F.col("payload_types")
    clean = (F.size(F.array_except(types, F.col("_allowed"))) == 0) & (
        F.size(F.array_except(F.col("_needed"), types)) == 0)
    unregistered = F.array(_violation(
        F.lit("schema_id"), F.lit("registered schema"), F.lit("unknown"), MISSING_FIELD))
    violations = (
        F.when(F.col("_fields").isNull(), unregistered)
        .when(clean, F.array().cast(VIOLATIONS_TYPE))
        .otherwise(F.concat(_declared(F.col("_fields"), F.col("_payload")),
                            _undeclared(F.col("_fields"), F.col("_payload"))))
    )
    checked = once(joined, "violations", violations).withColumn(
        "schema_version", F.coalesce("_version", F.lit("unknown")))
    return summarize(checked).drop("_version", "_fields", "_allowed", "_needed", "_payload")


def summarize(df: DataFrame) -> DataFrame:
    """Drift summary from the ``violations`` of each row."""
    v = F.col("violations")
    breaking = F.exists(v, lambda x: x["violation_type"] != NEW_FIELD)
    drifted = F.size(v) > 0
    return df.withColumn("breaking_change", breaking).withColumns({
        "drift_detected": drifted,
        "schema_valid": ~F.col("breaking_change"),
        "drift_type": F.get(v, 0)["violation_type"],
        "compatibility": F.when(F.col("breaking_change"), NONE).when(drifted, BACKWARD)
        .otherwise(FULL),
        "recommended_action": F.when(F.col("breaking_change"), REJECT).otherwise(AUTO_EVOLVE),
    })
