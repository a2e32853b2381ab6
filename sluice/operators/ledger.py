"""Group ledger: which groups arrived whole, what is missing, which events may go on.

Expected and received ids are counted per (group, id) and then per group, both with
partial aggregation, so neither repeated ids nor one huge group gather in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.headers import make_headers
from sluice.functions.joins import spread_join
from sluice.sources.tables import ARRIVAL
from sluice.spec import (
    BATCH_TIMEOUT, DLQ_ROUTED, GROUP_FAIL, GROUP_PENDING, GROUP_SUCCESS, NO_CONTROL_DOC,
    RETRY_ROUTED, SUCCESS, PipelineConfig,
)

GROUP = "trade_group_id"


def no_control_doc(events: DataFrame, control: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Events whose group no control document announced (anti join)."""
    groups = control.select(GROUP).distinct()
    return spread_join(events, groups, GROUP, F.col(ARRIVAL), "left_anti", cfg.salts)


def announced(events: DataFrame, control: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Events whose group a control document announced (semi join)."""
    groups = control.select(GROUP).distinct()
    return spread_join(events, groups, GROUP, F.col(ARRIVAL), "left_semi", cfg.salts)


def expected_ids(control: DataFrame) -> DataFrame:
    """One row per announced (group, id)."""
    return control.select(GROUP, F.explode(F.array_distinct("trade_ids")).alias("trade_id"))


def slots(taken: DataFrame, control: DataFrame) -> DataFrame:
    """Per (group, id): first arrival, if any, and whether the id was announced.

    An id counts once per group, at its first arrival, under whichever key it came.
    """
    received = taken.select(GROUP, "trade_id", ARRIVAL, F.lit(False).alias("expected"))
    awaited = expected_ids(control).select(
        GROUP, "trade_id", F.lit(None).cast("bigint").alias(ARRIVAL),
        F.lit(True).alias("expected"))
    return received.unionByName(awaited).groupBy(GROUP, "trade_id").agg(
        F.min(ARRIVAL).alias(ARRIVAL), F.max("expected").alias("expected"))


def group_status(slot: DataFrame, control: DataFrame, now_ms: int | None = None) -> DataFrame:
    """State of every announced group.

    Without ``now_ms`` every deadline counts as past. With it, an incomplete group whose
    deadline (column ``until`` of ``control``) lies after that moment is PENDING.

    A group succeeds when the announced count equals the number of announced ids, at
    least one, all of them arrived, and no other id arrived before the last of them.
    ``closed_at`` is the arrival number that completed it.
    """
    came = F.col(ARRIVAL).isNotNull()
    wanted = F.col("expected")
    tally = slot.groupBy(GROUP).agg(
        F.count_if(wanted).alias("_ids"),
        F.count_if(came).alias("_received"),
        F.count_if(wanted & ~came).alias("_missing"),
        F.max(F.when(wanted, F.col(ARRIVAL))).alias("_last"),
        F.min(F.when(~wanted, F.col(ARRIVAL))).alias("_stray"),
    )
    whole = (
        (F.col("expected_count") == F.col("_ids")) & (F.col("_ids") >= 1)
        & (F.col("_missing") == 0)
        & (F.col("_stray").isNull() | (F.col("_stray") > F.col("_last")))
    )
    zero = F.lit(0).cast("bigint")
    until = F.lit(None) if now_ms is None else F.col("until")
    joined = control.select(
        GROUP, "expected_count", F.coalesce(until > F.lit(now_ms), F.lit(False)).alias("_open")
    ).join(tally, GROUP, "left").withColumn("_whole", F.coalesce(whole, F.lit(False)))
    return joined.select(
        GROUP,
        "expected_count",
        F.when(F.col("_whole"), GROUP_SUCCESS).when(F.col("_open"), GROUP_PENDING)
        .otherwise(GROUP_FAIL).alias("status"),
        F.coalesce(F.when(F.col("_whole"), F.col("_ids")).otherwise(F.col("_received")), zero)
        .alias("actual_count"),
        F.coalesce("_missing", zero).alias("missing_count"),
        F.when(F.col("_whole"), F.col("_last")).alias("closed_at"),
    )


def missing_ids(slot: DataFrame) -> DataFrame:
    """Announced ids that never arrived."""
    return slot.where(F.col("expected") & F.col(ARRIVAL).isNull()).select(GROUP, "trade_id")


def accepted(slot: DataFrame, status: DataFrame) -> DataFrame:
    """Arrival numbers of the events that go on: announced ids of successful groups.

    Only announced ids are joined, so a group brings no more rows than its control
    document lists.
    """
    whole = status.where(F.col("status") == GROUP_SUCCESS).select(GROUP)
    return slot.where(F.col("expected") & F.col(ARRIVAL).isNotNull()).join(
        whole, GROUP, "left_semi").select(ARRIVAL)


def ready_events(events: DataFrame, slot: DataFrame, status: DataFrame) -> DataFrame:
    """Events of whole groups, each id once, moved once by their arrival number."""
    return events.join(accepted(slot, status), ARRIVAL, "left_semi")


def incomplete_events(events: DataFrame, slot: DataFrame, status: DataFrame,
                      cfg: PipelineConfig) -> DataFrame:
    """Received events of failed groups, each id once."""
    failed = status.where(F.col("status") == GROUP_FAIL).select(GROUP)
    held = spread_join(slot.where(F.col(ARRIVAL).isNotNull()), failed, GROUP,
                       F.col(ARRIVAL), "left_semi", cfg.salts).select(ARRIVAL)
    return events.join(held, ARRIVAL, "left_semi")


def close_groups(decisions: DataFrame, status: DataFrame, cfg: PipelineConfig,
                 hot: list | None = None) -> DataFrame:
    """Decisions after groups closed: an event later than its group's completion finds
    no control document any more."""
    closed = status.where(F.col("closed_at").isNotNull()).select(GROUP, "closed_at")
    joined = spread_join(decisions, closed, GROUP, F.col(ARRIVAL), "left", cfg.salts, hot)
    late = F.coalesce(
        (F.col("outcome") == SUCCESS) & (F.col(ARRIVAL) > F.col("closed_at")), F.lit(False))
    dead = late & (F.col("attempt_count") >= cfg.max_attempts)
    return joined.select(
        ARRIVAL, GROUP, "trade_id", "attempt_count",
        F.when(dead, DLQ_ROUTED).when(late, RETRY_ROUTED).otherwise(F.col("outcome")).alias("outcome"),
        F.when(dead, NO_CONTROL_DOC).otherwise(F.col("failure_reason")).alias("failure_reason"),
    )


def open_events(decisions: DataFrame, status: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Arrival numbers of the events taken in whose group is still waited for."""
    waiting = status.where(F.col("status") == GROUP_PENDING).select(GROUP)
    return spread_join(decisions.where(F.col("outcome") == SUCCESS), waiting, GROUP,
                       F.col(ARRIVAL), "left_semi", cfg.salts).select(ARRIVAL)


def failed_group_records(status: DataFrame) -> DataFrame:
    """One dead-letter record per failed group, with its counts."""
    value = F.to_json(F.struct(
        GROUP,
        F.lit(BATCH_TIMEOUT).alias("failure_reason"),
        "expected_count", "actual_count", "missing_count",
    ))
    return status.where(F.col("status") == GROUP_FAIL).select(
        F.col(GROUP).alias("key"), value.alias("value"),
        make_headers(failure_reason=F.lit(BATCH_TIMEOUT)).alias("headers"))
