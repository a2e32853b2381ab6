"""The streaming job: the operators of the batch job around the group state."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.functions.headers import header_int, make_headers
from sluice.functions.text import iso_utc
from sluice.operators import intake, ledger, verdict
from sluice.plans.ingest import dead_letter_sink, write_verdicts
from sluice.session import ROCKSDB_PROVIDER, drop_run, stage, state_parts
from sluice.sources.buffer import buffer_prefix, release
from sluice.sources.lake import DATA, QUARANTINE, Sink, forget_run, lake_path, once_per_run
from sluice.sources.records import read_claimed
from sluice.sources.registry import Registry
from sluice.sources.tables import ARRIVAL
from sluice.spec import (
    DLQ_ROUTED, DUPLICATE, FATAL_MISSING_FIELDS, FATAL_PARSE_ERROR, GROUP_FAIL, GROUP_SUCCESS,
    NO_CONTROL_DOC, PipelineConfig, SUCCESS,
)
from sluice.streaming.groups import (
    CONTROL, DECISION_TYPE, EVENT, GROUP, INCOMPLETE, KEY_SHARES, PackedEventTimeGroups, PackedGroups,
    PackedKeyMarks, TAGGED_TYPE, UNANNOUNCED,
)
from sluice.streaming.packs import packed, packed_type, unpacked

COUNTERS = "_counters"
FILL_IDLE_MS = 60_000  # an hour's buffer that got nothing for so long is released
Fetch = Callable[[DataFrame], DataFrame]  # decisions in, the same with their records' columns out


_TAGGED = [f.split()[0] for f in TAGGED_TYPE.split(", ")]
_DECISION = [f.split()[0] for f in DECISION_TYPE.split(", ")]
_DECISION_KIND = dict(f.split() for f in DECISION_TYPE.split(", "))


def use_rocksdb(spark) -> None:
    """Keep streaming state on disk; needed by the group state machine. A micro-batch writes
    what it changed, the whole state is uploaded now and then."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


def stream_dedup(events: DataFrame, key: str, cfg: PipelineConfig,
                 time: str = "timestamp") -> DataFrame:
    """First event per key within the time to live, counted from its arrival time."""
    return events.withWatermark(time, f"{cfg.dedup_ttl_minutes} minutes").dropDuplicatesWithinWatermark([key])


def _intake_fields(records: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The narrow columns decisions need; the record itself is fetched later, by its claim."""
    e = F.col("env")
    claim = F.col("claim") if "claim" in records.columns else F.lit(None).cast("string")
    return intake.parse_events(records).select(
        "timestamp", ARRIVAL, claim.alias("claim"),
        header_int(F.col("headers"), "attempt_count").alias("attempt_count"),
        e.isNotNull().alias("readable"),
        intake.dedup_key(cfg).alias("dedup_key"),
        e["trade_group_id"].alias("trade_group_id"),
        e["trade_id"].alias("trade_id"),
    )


def _own_time() -> Column:
    """A record's time as a number. Unlike the time column it carries no watermark, so
    state operators see every record, however late."""
    return F.unix_millis("timestamp").alias("time_ms")


def _as_tagged() -> list:
    """An event's columns under the schema it shares with control documents."""
    return ["trade_group_id", F.lit(EVENT).alias("kind"), "trade_id", "attempt_count", ARRIVAL,
            "claim", _own_time(), F.lit(None).cast("int").alias("expected_count"),
            F.lit(None).cast("array<string>").alias("trade_ids")]


def marked_events(fields: DataFrame, cfg: PipelineConfig, event_time: bool = False) -> DataFrame:
    """Events with their key's mark looked up: firsts stay events, the others become copies."""
    share = F.pmod(F.xxhash64("dedup_key"), F.lit(KEY_SHARES)).cast("int").alias("share")
    rows = packed(fields.select(share, "dedup_key", *_as_tagged()), "share")
    return unpacked(rows.groupBy("share").transformWithState(
        PackedKeyMarks(cfg, event_time), packed_type(TAGGED_TYPE), "Append", _mode(event_time)))


def _mode(event_time: bool) -> str:
    return "EventTime" if event_time else "ProcessingTime"


def tagged(left: DataFrame, control: DataFrame) -> DataFrame:
    """Events and control documents as one stream under one schema."""
    right = control.select(
        "trade_group_id", F.lit(CONTROL).alias("kind"), F.lit(None).cast("string").alias("trade_id"),
        F.lit(0).alias("attempt_count"), ARRIVAL, F.lit(None).cast("string").alias("claim"),
        _own_time(), "expected_count", "trade_ids")
    return left.unionByName(right).select(*_TAGGED)


def decide_stream(events: DataFrame, control: DataFrame, cfg: PipelineConfig,
                  event_time: bool = False) -> DataFrame:
    """Decisions on events and groups as a stream.

    Unreadable events and events without their required fields go straight to the dead
    letters; the rest is told from its duplicates and meets its control document in keyed
    state. Every event gets one decision, DUPLICATE included, however late it comes.
    Timers follow the clock. With ``event_time`` they follow the records' own times, so that
    a run over stored records can be repeated: waits end when the watermark has passed them,
    and what comes later than its own wait is decided at once, nothing is dropped.
    """
    if event_time:
        # The watermark only moves the timers; its delay is part of every wait.
        events, control = (
            df.withWatermark("timestamp", f"{cfg.dedup_ttl_minutes} minutes") for df in (events, control))
    fields = _intake_fields(events, cfg)
    whole = intake.complete()
    good = marked_events(fields.where(whole), cfg, event_time)
    processor = PackedEventTimeGroups(cfg) if event_time else PackedGroups(cfg)
    settled = unpacked(packed(tagged(good, control), "trade_group_id").groupBy("trade_group_id").transformWithState(
        processor, packed_type(DECISION_TYPE), "Append", _mode(event_time)))
    bad = fields.where(~whole).select(
        F.lit(EVENT).alias("kind"), "trade_group_id", "trade_id", "attempt_count", ARRIVAL, "claim",
        F.lit(DLQ_ROUTED).alias("outcome"),
        F.when(F.col("readable"), FATAL_MISSING_FIELDS).otherwise(FATAL_PARSE_ERROR)
        .alias("failure_reason"))
    for name in _DECISION:
        if name not in bad.columns:
            bad = bad.withColumn(name, F.lit(None).cast(_DECISION_KIND[name]))
    return settled.unionByName(bad.select(*_DECISION))


def control_stream(records: DataFrame) -> DataFrame:
    """Readable control documents of a record stream, with their arrival time."""
    return intake.parse_control(records, arrived_at="timestamp")


def write_batch(decisions: DataFrame, root: str, registry: Registry, ingestion_time,
                cfg: PipelineConfig, run: str | None = None, fetch: Fetch = read_claimed,
                fill_files: bool = False) -> None:
    """Sink of one micro-batch: validated events to the lake, the rest to dead letters.

    With ``fill_files`` events go to the buffer, from which ``flush`` fills files.

    The decisions are narrow; ``fetch`` reads the records of those that need one. Under the
    name ``run`` each sink is written once, however often the batch is played. Decisions
    and validated events are staged, so a lost executor costs no second pass over state.
    """
    spark = decisions.sparkSession
    work = f"{run or 'stream'}-{uuid.uuid4().hex}"

    def do(sink: str, write) -> None:
        if run is None:
            write()
        else:
            once_per_run(spark, root, run, sink, write)

    counters = Observation()
    decisions = stage(decisions.observe(counters, *stream_metrics()), "decisions", run=work)
    seen = counters.get
    try:
        if seen["success"]:
            taken = fetch(decisions.where((F.col("kind") == EVENT) & (F.col("outcome") == SUCCESS)))
            validated = stage(verdict.validate(
                intake.taken_in(intake.parse_events(taken)), registry, ingestion_time, cfg),
                "validated", by=["validation_status"], run=work)
            write_verdicts(validated, root, cfg, do, buffer_prefix if fill_files else str)
        if seen["dlq_routed"]:
            do("dead_letters", dead_letter_sink(lambda: dead_letters(decisions, fetch), root))
        if seen["failed_groups"]:
            do("failed_groups", dead_letter_sink(lambda: failed_groups(decisions), root))
        if any(seen.values()):
            do("counters", Sink(COUNTERS, lambda to: append_counters(spark, to or lake_path(root, COUNTERS), seen)))
    finally:
        drop_run(spark, work)


def flush(spark, root: str, cfg: PipelineConfig, everything: bool = False) -> None:
    """Release what is due in the buffers of lake and quarantine."""
    for prefix in (DATA, QUARANTINE):
        release(spark, root, prefix, cfg, int(time.time() * 1000), FILL_IDLE_MS, everything)


def dead_letters(decisions: DataFrame, fetch: Fetch = read_claimed) -> DataFrame:
    """Dead-letter records of the events among the decisions."""
    lost = decisions.where((F.col("kind") == EVENT) & (F.col("outcome") == DLQ_ROUTED))
    return fetch(lost).select(
        "key", "value",
        make_headers(failure_reason=F.col("failure_reason"), original_topic=F.col("topic"),
                     attempt_count=F.col("attempt_count")).alias("headers"))


def failed_groups(decisions: DataFrame) -> DataFrame:
    return ledger.failed_group_records(
        decisions.where((F.col("kind") == GROUP) & (F.col("status") == GROUP_FAIL)))


def stream_metrics() -> list[Column]:
    """What a micro-batch decided; every figure adds up over micro-batches."""
    kind, outcome, attempt = F.col("kind"), F.col("outcome"), F.col("attempt_count")
    event = kind != GROUP
    taken = kind.isin(INCOMPLETE, UNANNOUNCED) | (outcome == SUCCESS)
    dead = (kind == EVENT) & (outcome == DLQ_ROUTED)
    no_doc = F.coalesce(F.col("failure_reason") == NO_CONTROL_DOC, F.lit(False))
    return [F.count_if(c).alias(name) for name, c in {
        "total": event,
        "success": (kind == EVENT) & (outcome == SUCCESS),
        "dlq_routed": dead,
        "processed_normally": event & taken & (attempt == 0),
        "retry_recovered": event & taken & (attempt > 0),
        "duplicates": event & (outcome == DUPLICATE),
        "quarantined_control_doc": dead & no_doc,
        "quarantined_other": dead & ~no_doc,
        "whole_groups": (kind == GROUP) & (F.col("status") == GROUP_SUCCESS),
        "failed_groups": (kind == GROUP) & (F.col("status") == GROUP_FAIL),
    }.items()]


def append_counters(spark, path: str, seen: dict) -> None:
    """One row of counters, gathered while the decisions were written."""
    names = list(seen)
    spark.createDataFrame([tuple(seen[n] for n in names)], ", ".join(f"{n} long" for n in names)) \
        .coalesce(1).write.mode("append").parquet(path)


def stream_counters(spark, root: str) -> DataFrame:
    """Counters of all micro-batches the stream has written, in one row."""
    rows = spark.read.parquet(lake_path(root, COUNTERS))
    return rows.agg(*[F.sum(c).alias(c) for c in rows.columns])


def run_stream(events: DataFrame, control: DataFrame, root: str, checkpoint: str,
               registry: Registry, cfg: PipelineConfig, available_now: bool = False,
               event_time: bool = False, ingestion_time: str | None = None,
               fetch: Fetch = read_claimed, fill_files: bool = False) -> StreamingQuery:
    """Start the job. Offsets and state are checkpointed; a batch that is played again
    after a failure skips the sinks it had written.

    Without ``available_now`` a micro-batch starts every ``cfg.idle_flush``. Timers that
    follow the clock never run out, so ``available_now`` needs ``event_time``. ``fetch``
    reads records again by their claims, so the source must keep them for as long as a group
    may wait. With ``fill_files`` events wait in a buffer until they fill files or nothing
    came for a minute; call ``flush`` with ``everything`` once the query has ended.
    """
    if available_now and not event_time:
        raise ValueError("available_now needs event_time: clock timers keep the query going")
    decisions = decide_stream(events, control_stream(control), cfg, event_time)
    at = F.lit(ingestion_time) if ingestion_time else iso_utc(F.current_timestamp())

    series = "stream-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def sink(batch: DataFrame, number: int) -> None:
        write_batch(batch, root, registry, at, cfg, f"{series}-{number}", fetch, fill_files)
        if fill_files:
            flush(batch.sparkSession, root, cfg)
        # Only the last batch can be played again.
        forget_run(batch.sparkSession, root, f"{series}-{number - 1}")

    writer = decisions.writeStream.option("checkpointLocation", checkpoint).foreachBatch(sink)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=cfg.idle_flush)
    with state_parts(events.sparkSession):
        return writer.start()
