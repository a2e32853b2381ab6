"""Verdict on validated events, reasons of rejection, and the split by verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.headers import make_headers
from sluice.functions.text import fixed_two
from sluice.operators.drift import check_drift
from sluice.operators.quality import check_quality
from sluice.sources.registry import Registry
from sluice.spec import (
    PASS_SCORE, PASSED, QUARANTINE_SCORE, QUARANTINED, REJECTED, PipelineConfig,
)

# Member names of an event written as JSON to the dead letters.
REJECTED_MEMBERS = {
    "event_id": "eventId",
    "trade_group_id": "tradeGroupId",
    "trade_id": "tradeId",
    "idempotency_key": "idempotencyKey",
    "event_type": "eventType",
    "timestamp": "timestamp",
    "schema_id": "schemaId",
    "source": "source",
    "pipeline_version": "pipelineVersion",
}


def verdict(breaking: Column, quality_score: Column) -> Column:
    return (
        F.when(breaking, REJECTED)
        .when(quality_score >= PASS_SCORE, PASSED)
        .when(quality_score >= QUARANTINE_SCORE, QUARANTINED)
        .otherwise(REJECTED)
    )


def rejection_reason() -> Column:
    """Why an event was rejected; null for the others."""
    return F.when(
        F.col("validation_status") == REJECTED,
        F.when(F.col("breaking_change"),
               F.concat(F.lit("SCHEMA_BREAKING_CHANGE:"), F.col("drift_type")))
        .otherwise(F.concat(F.lit("QUALITY_REJECTED:score="), fixed_two(F.col("quality_score")))))


def enrich(df: DataFrame, ingestion_time: Column | str, cfg: PipelineConfig) -> DataFrame:
    """Adds the time of intake (ISO-8601 text) and the topic events come from."""
    time = F.lit(ingestion_time) if isinstance(ingestion_time, str) else ingestion_time
    return df.withColumns({"ingestion_time": time, "source_topic": F.lit(cfg.topics.primary)})


def validate(events: DataFrame, registry: Registry, ingestion_time: Column | str,
             cfg: PipelineConfig) -> DataFrame:
    """Drift, quality and verdict of every event; one pass, no shuffle."""
    checked = check_quality(check_drift(events, registry), cfg.quality_threshold)
    judged = checked.drop("payload_types").withColumn(
        "validation_status", verdict(F.col("breaking_change"), F.col("quality_score")))
    return enrich(judged.withColumn("rejection_reason", rejection_reason()), ingestion_time, cfg)


def passed(df: DataFrame) -> DataFrame:
    return df.where(F.col("validation_status") == PASSED)


def quarantined(df: DataFrame) -> DataFrame:
    return df.where(F.col("validation_status") == QUARANTINED)


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col("validation_status") == REJECTED)


def rejected_records(df: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Dead-letter records of rejected events: the event as JSON, keyed by its id."""
    head = F.to_json(
        F.struct(*[F.col(c).alias(m) for c, m in REJECTED_MEMBERS.items()]),
        {"ignoreNullFields": "false"})
    value = F.concat(
        F.substring(head, F.lit(1), F.length(head) - 1),
        F.lit(',"payload":'), F.coalesce(F.col("payload"), F.lit("null")), F.lit("}"))
    return rejected(df).select(
        F.col("event_id").alias("key"),
        value.alias("value"),
        make_headers(
            failure_reason=F.col("rejection_reason"),
            original_topic=F.lit(cfg.topics.primary),
            source=F.lit("intelligence-layer"),
        ).alias("headers"),
    )
