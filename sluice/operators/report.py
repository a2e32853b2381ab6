"""Reports: verdicts of a batch, counters of a run, deviating events, file statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import percent
from sluice.operators.quality import failed_rules
from sluice.spec import (
    DLQ_ROUTED, DUPLICATE, NO_CONTROL_DOC, PASSED, QUARANTINED, REJECTED, RETRY_ROUTED, SUCCESS,
)


def _batch_metrics() -> list[Column]:
    status = F.col("validation_status")
    total = F.count("*")
    out = [total.alias("total")]
    for name, verdict in (("passed", PASSED), ("quarantined", QUARANTINED), ("rejected", REJECTED)):
        n = F.count_if(status == verdict)
        out += [n.alias(name), percent(n, total).alias(f"{name}_pct")]
    return out + [
        F.count_if("drift_detected").alias("schema_drift"),
        F.coalesce(F.avg("quality_score"), F.lit(0.0)).alias("avg_quality_score"),
    ]


def batch_report(validated: DataFrame) -> DataFrame:
    """Totals, shares, drift count and mean score, in one row."""
    return validated.agg(*_batch_metrics())


def observe_batch(validated: DataFrame, name: str = "batch_report") -> DataFrame:
    """The same figures gathered while the frame is being written (also in streams)."""
    return validated.observe(name, *_batch_metrics())


def run_counters(decisions: DataFrame, elapsed_seconds: float | None = None) -> DataFrame:
    """Counters of a run over its decisions, in one row.

    Retries count events on their first attempt only; a success after a retry counts
    as recovered. All dead letters other than a missing control document are "other".
    """
    outcome, attempt = F.col("outcome"), F.col("attempt_count")
    dead = outcome == DLQ_ROUTED
    no_doc = F.coalesce(F.col("failure_reason") == NO_CONTROL_DOC, F.lit(False))
    other = (F.coalesce(F.col("retry_cause") != NO_CONTROL_DOC, F.lit(False))
             if "retry_cause" in decisions.columns else F.lit(False))
    first_retry = (outcome == RETRY_ROUTED) & (attempt == 0)
    total = F.count("*")
    metrics = [
        total.alias("total"),
        F.count_if((outcome == SUCCESS) & (attempt == 0)).alias("processed_normally"),
        F.count_if(first_retry & ~other).alias("retry_routed_control_doc"),
        F.count_if(first_retry & other).alias("retry_routed_other"),
        F.count_if((outcome == SUCCESS) & (attempt > 0)).alias("retry_recovered"),
        F.count_if(outcome == DUPLICATE).alias("duplicates"),
        F.count_if(dead & no_doc).alias("quarantined_control_doc"),
        F.count_if(dead & ~no_doc).alias("quarantined_other"),
        F.when(total > 0, F.round(F.lit(100.0) * F.count_if(first_retry) / total, 2))
        .otherwise(0.0).alias("retry_pct"),
    ]
    if elapsed_seconds is not None:
        metrics.append(F.round(total / F.lit(max(elapsed_seconds, 0.001)), 1).alias("events_per_sec"))
    return decisions.agg(*metrics)


def drift_deviations(validated: DataFrame) -> DataFrame:
    """Events with schema drift and how many violations each has."""
    return validated.where("drift_detected").select(
        "event_id", "drift_type", "breaking_change", F.size("violations").alias("violations"))


def quality_deviations(validated: DataFrame) -> DataFrame:
    """Events that did not pass although rules ran, with their failed rules."""
    return validated.where(F.col("validation_status") != PASSED).select(
        "event_id", "validation_status", "quality_score",
        failed_rules(F.col("rule_results"), with_severity=True).alias("failed_rules"),
    ).where(F.size("failed_rules") > 0)


def files(lake: DataFrame) -> DataFrame:
    """One row per file of a lake scan: its records and bytes."""
    return lake.groupBy(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("bytes"),
    ).agg(F.count("*").alias("records"))


def file_stats(lake: DataFrame) -> DataFrame:
    """Number of files; mean and median of their records and bytes."""
    return files(lake).agg(
        F.count("*").alias("files"),
        F.sum("records").alias("records"),
        F.round(F.avg("records"), 1).alias("records_mean"),
        F.round(F.median("records"), 1).alias("records_median"),
        F.round(F.avg("bytes"), 1).alias("bytes_mean"),
        F.round(F.median("bytes"), 1).alias("bytes_median"),
    )


def partition_stats(lake: DataFrame) -> DataFrame:
    """Files and records per lake partition."""
    return files_by_partition(lake).groupBy("partition").agg(
        F.count("*").alias("files"), F.sum("records").alias("records"))


def files_by_partition(lake: DataFrame) -> DataFrame:
    per_file = files(lake)
    return per_file.withColumn("partition", F.regexp_extract("file", r"(year=.*)/[^/]*$", 1))
