"""Batch ingestion: records in, lake and dead letters out."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from sluice.functions.joins import hot_keys, sized
from sluice.operators import intake, ledger, publish, retry, verdict
from sluice.session import drop_run, size_shuffles, stage
from sluice.sources.lake import (
    DATA, DEAD_LETTERS, QUARANTINE, Sink, forget_run, lake_path, once_per_run, record_bytes,
    records_per_file, write_dead_letters, write_lake,
)
from sluice.sources.registry import Registry
from sluice.sources.tables import ARRIVAL
from sluice.spec import (
    EVENT_FIELDS, GROUP_FAIL, PASSED, QUARANTINED, REJECTED, SUCCESS, DatasetSpec, PipelineConfig,
)

RETRIES = "retry"


@dataclass(frozen=True)
class Settled:
    """Decisions of one batch: narrow frames only, no payload."""

    control: DataFrame
    slots: DataFrame
    status: DataFrame
    decisions: DataFrame
    keys: DataFrame


def settle(keys: DataFrame, control: DataFrame, cfg: PipelineConfig,
           seen: DataFrame | None = None, run: str | None = None,
           now_ms: int | None = None, staged: bool = False) -> Settled:
    """Decide which events are taken in and which groups are whole.

    ``control`` holds one document per group (see ``control_table``). Keys and decisions
    are used several times, so these narrow tables are staged: the JSON they come from
    is parsed once; ``staged`` says that ``keys`` are read from a table already. With
    ``now_ms`` incomplete groups stay open until their deadline.
    """
    control = stage(control, "control", run=run)
    keys = keys if staged else stage(keys, "keys", run=run)
    hot = hot_keys(keys, "trade_group_id")
    decided = stage(intake.decide(keys, control, cfg, seen, hot), "decided", run=run)
    slot = ledger.slots(decided.where(F.col("outcome") == SUCCESS), control)
    status = ledger.group_status(slot, control, now_ms)
    return Settled(control, slot, status, ledger.close_groups(decided, status, cfg, hot), keys)


def control_table(control_records: DataFrame) -> DataFrame:
    """Control documents in force: per group the first readable one."""
    return intake.first_control(intake.parse_control(control_records))


def whole_groups(records: DataFrame, control: DataFrame, cfg: PipelineConfig,
                 seen: DataFrame | None = None) -> DataFrame:
    """Events of whole groups, from event records and control documents."""
    parsed = intake.parse_events(records)
    settled = settle(intake.event_keys(parsed, cfg), control, cfg, seen)
    return ledger.ready_events(intake.taken_in(parsed), settled.slots, settled.status)


def validated_table(df: DataFrame, spec: DatasetSpec, registry: Registry,
                    published_at: str, ingestion_time: str, cfg: PipelineConfig) -> DataFrame:
    """From a numbered table to validated events.

    A row has the same numbers in every scan and makes the same event. So rows are chosen by
    the arrival numbers of the accepted events, and only then made events again: what moves
    is the narrow row, not its JSON, and rows of failed groups are not made events twice.
    """
    sent = publish.publish(df, spec, published_at)
    keys = intake.event_keys(intake.parse_events(sent.events), cfg)
    settled = settle(keys, control_table(sent.control), cfg)
    accepted = sized(stage(ledger.accepted(settled.slots, settled.status), "accepted"))
    chosen = df.join(accepted, ARRIVAL, "left_semi").select(*df.columns)
    again = intake.taken_in(intake.parse_events(publish.publish(chosen, spec, published_at).events))
    return verdict.validate(again, registry, ingestion_time, cfg)


@dataclass(frozen=True)
class IngestResult:
    """Frames over staged tables, for reports; nothing here is recomputed from the source.

    ``discard`` removes the staged tables once the reports are done.
    """

    run: str
    settled: Settled
    validated: DataFrame
    counted: dict[str, int] = field(default_factory=dict)

    def discard(self) -> None:
        drop_run(self.validated.sparkSession, self.run)


def ingest(records: DataFrame, control: DataFrame, root: str, registry: Registry,
           ingestion_time: str, now_ms: int, cfg: PipelineConfig,
           seen: DataFrame | None = None, name: str | None = None) -> IngestResult:
    """Run one batch and write lake, quarantine, dead letters and retry records.

    Envelopes are parsed once, into a landing table; decisions are made on its narrow
    columns; payloads are moved once, to their decisions, and each sink is one write. A
    batch with a ``name`` may be done again after a failure: what it had written stays once.
    """
    result = decide_and_validate(
        records, control_table(control), registry, ingestion_time, cfg, seen)
    spark, run = records.sparkSession, name or result.run

    def do(sink: str, write: Callable[[], None]) -> None:
        once_per_run(spark, root, run, sink, write)

    write_result(records, result, root, cfg, do)
    if outcomes(result)["retry_routed"]:
        again = retry.retry_records(records, result.settled.decisions, now_ms, cfg).drop(ARRIVAL)
        do("retries", Sink(RETRIES, lambda to: append_retries(again, lake_path(root, RETRIES), to)))
    if name is None:
        forget_run(spark, root, run)
    return result


def landed(records: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Records parsed: the key columns of ``event_keys`` and the columns of the event."""
    fields = [F.col("env")[f].alias(f) for f in EVENT_FIELDS if f not in intake.KEY_FIELDS]
    return intake.parse_events(records).select(*intake.key_columns(cfg), *fields)


def decide_and_validate(records: DataFrame, control: DataFrame, registry: Registry,
                        ingestion_time: str, cfg: PipelineConfig,
                        seen: DataFrame | None = None, now_ms: int | None = None) -> IngestResult:
    """All of a batch but its sinks; ``control`` holds one document per group."""
    run = uuid.uuid4().hex
    size_shuffles(records.sparkSession, records, control)
    land = stage(landed(records, cfg), "landed", run=run)
    keys = land.select(*intake.KEY_FIELDS)
    settled = settle(keys, control, cfg, seen, run, now_ms, staged=True)
    status = stage(settled.status, "status", run=run)
    decisions = stage(settled.decisions, "decisions", run=run)
    events = land.where("readable").select(*EVENT_FIELDS, ARRIVAL)
    # Staged, so that its size is known: payloads stay where they are when few events go on.
    accepted = sized(stage(ledger.accepted(settled.slots, status), "accepted", run=run))
    ready = events.join(accepted, ARRIVAL, "left_semi")
    validated = stage(verdict.validate(ready, registry, ingestion_time, cfg), "validated",
                      by=["validation_status"], run=run)
    return IngestResult(run, replace(settled, status=status, decisions=decisions), validated)


def outcomes(result: IngestResult) -> dict[str, int]:
    """How many events had each outcome; counted once per result."""
    if not result.counted:
        result.counted.update(intake.outcome_counts(result.settled.decisions).first().asDict())
    return result.counted


def _now(sink: str, write: Callable[[], None]) -> None:
    write()


def write_result(records: DataFrame, result: IngestResult, root: str, cfg: PipelineConfig,
                 do: Callable[[str, Callable[[], None]], None] = _now) -> None:
    """Lake, quarantine and dead letters; a verdict that never occurred costs no job.

    Each sink goes through ``do`` under a name of its own, which may leave out those
    already written.
    """
    decisions, status = result.settled.decisions, result.settled.status
    write_verdicts(result.validated, root, cfg, do)
    if not status.where(F.col("status") == GROUP_FAIL).isEmpty():
        do("failed_groups", dead_letter_sink(lambda: ledger.failed_group_records(status), root))
    if outcomes(result)["dlq_routed"]:
        do("dead_letters", dead_letter_sink(lambda: intake.dead_letters(records, decisions), root))


def dead_letter_sink(letters: Callable[[], DataFrame], root: str) -> Sink:
    return Sink(DEAD_LETTERS, lambda to: write_dead_letters(letters(), root, to))


def write_verdicts(validated: DataFrame, root: str, cfg: PipelineConfig,
                   do: Callable[[str, Callable[[], None]], None] = _now,
                   place: Callable[[str], str] = str) -> None:
    """Validated events by verdict: lake, quarantine and dead letters of the rejected.

    ``place`` maps a prefix to the folder its files go to, which may be the buffer.

    ``validated`` is staged. With one source per verdict its rows go to files as they lie,
    in as many tasks as files are wanted; otherwise they are first sent to their folders.
    """
    found = {r["validation_status"]: r for r in validated.groupBy("validation_status").agg(
        F.count("*").alias("n"), F.min("source").alias("low"), F.max("source").alias("high"),
        F.count("source").alias("named"), F.min("ingestion_time").alias("from"),
        F.max("ingestion_time").alias("until")).collect()}

    def lake(frame: DataFrame, prefix: str, seen: Row) -> Sink:
        def write(to: str | None) -> None:
            size = record_bytes(frame.sparkSession, root, prefix, cfg)
            files = math.ceil(seen["n"] / records_per_file(size, cfg))
            one_folder = (seen["low"] == seen["high"] and seen["named"] in (0, seen["n"])
                          and seen["from"] == seen["until"])
            if one_folder:
                write_lake(frame.coalesce(files), root, place(prefix), cfg, size, None, to)
            else:
                write_lake(frame, root, place(prefix), cfg, size, files, to)
        return Sink(place(prefix), write)

    if seen := found.get(PASSED):
        do("passed", lake(verdict.passed(validated), DATA, seen))
    if seen := found.get(QUARANTINED):
        do("quarantined", lake(verdict.quarantined(validated), QUARANTINE, seen))
    if found.get(REJECTED):
        do("rejected", dead_letter_sink(lambda: verdict.rejected_records(validated, cfg), root))


def append_retries(again: DataFrame, path: str, to: str | None = None) -> None:
    """Append to the retry table under partition numbers of its own.

    Records of several sources meet there, so their numbers are moved behind those in use.
    """
    base = publish.next_free(again.sparkSession, path, "partition")
    again.withColumn("partition", F.col("partition") + F.lit(base)).write.mode("append").parquet(to or path)
