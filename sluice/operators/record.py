"""Stored record: flat columns, nested parts as JSON, and the partition columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.spec import STORED_FIELDS

_KEEP_NULLS = {"ignoreNullFields": "false"}


def _violations_json() -> Column:
    return F.to_json(F.transform("violations", lambda v: F.struct(
        v["field"].alias("field"),
        v["expected_type"].alias("expectedType"),
        v["actual_type"].alias("actualType"),
        v["violation_type"].alias("violationType"),
    )), _KEEP_NULLS)


def _results_json() -> Column:
    return F.to_json(F.transform("rule_results", lambda r: F.struct(
        r["rule_id"].alias("ruleId"),
        r["field"].alias("field"),
        r["severity"].alias("severity"),
        r["passed"].alias("passed"),
        r["actual_value"].alias("actualValue"),
        r["message"].alias("message"),
    )), _KEEP_NULLS)


def stored_record(validated: DataFrame) -> DataFrame:
    """The stored columns, in order."""
    made = {
        "payload_json": F.coalesce(F.col("payload"), F.lit("null")),
        "schema_violations_json": _violations_json(),
        "quality_rule_results_json": _results_json(),
    }
    return validated.select(*[made[c].alias(c) if c in made else F.col(c) for c in STORED_FIELDS])


def partition_columns(df: DataFrame) -> DataFrame:
    """Adds year, month, day and hour of the intake time (UTC), padded as in paths."""
    ts = F.col("ingestion_time").cast("timestamp")
    return df.withColumns({
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    })
