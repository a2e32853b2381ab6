"""Intake: parse records, recognise duplicates, check required fields, decide outcomes.

Decisions are made on narrow key columns; the payload is joined back once, by arrival
number, which no hot key can skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.headers import header_int, make_headers
from sluice.functions.joins import hot_keys, spread_join
from sluice.functions.once import once
from sluice.sources.tables import ARRIVAL
from sluice.spec import (
    CONTROL_FIELDS, DLQ_ROUTED, DUPLICATE, ENVELOPE_FIELDS, EVENT_FIELDS,
    FATAL_MISSING_FIELDS, FATAL_PARSE_ERROR, NO_CONTROL_DOC, RETRY_ROUTED, SUCCESS,
    PipelineConfig,
)

_CORRUPT = "_corrupt_record"
_KEY = "dedup_key"

KEY_FIELDS = [ARRIVAL, "readable", _KEY, "trade_group_id", "trade_id", "attempt_count"]
DECISION_FIELDS = [ARRIVAL, "trade_group_id", "trade_id", "attempt_count", "outcome",
                   "failure_reason"]


def _strict_json(value: Column, fields: list[str], schema: str) -> Column:
    """Parsed struct; null when malformed or when a top-level field is not in ``fields``."""
    parsed = F.from_json(value, f"{schema}, {_CORRUPT} string",
                         {"columnNameOfCorruptRecord": _CORRUPT})
    unknown = F.array_except(F.json_object_keys(value), F.array(*map(F.lit, fields)))
    return F.when(F.size(unknown) == 0, parsed)


def _nested(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _scalars_only(record: Column, parsed: Column, fields: list[str]) -> Column:
    """True when none of the text fields holds an object or a list.

    The JSON is read a second time only for rows in which a text begins like one, and as a
    whole: a reading per field makes a method too long for the JVM to compile.
    """
    suspicious = F.lit(False)
    for name in fields:
        suspicious = suspicious | F.coalesce(_nested(parsed[name]), F.lit(False))
    members = F.map_entries(F.try_variant_get(
        F.try_parse_json(record), "$", "map<string,variant>"))

    def is_nested(member: Column) -> Column:
        kind = F.schema_of_variant(member["value"])
        return member["key"].isin(*fields) & (kind.startswith("OBJECT") | kind.startswith("ARRAY"))

    nested = F.coalesce(F.exists(members, is_nested), F.lit(False))
    return F.when(suspicious, ~nested).otherwise(True)


def parse_events(records: DataFrame) -> DataFrame:
    """Records plus their envelope as struct ``env``; null where the record is unreadable.

    Unreadable is malformed JSON, an unknown top-level field, a nested value in a text
    field, or a payload that is neither an object nor null.
    """
    schema = ", ".join(f"{name} string" for name in ENVELOPE_FIELDS)
    texts = [f for f in ENVELOPE_FIELDS if f != "payload"]
    read = once(records, "_p", _strict_json(F.col("value"), ENVELOPE_FIELDS, schema))
    p = F.col("_p")
    readable = (
        p.isNotNull() & p[_CORRUPT].isNull()
        & F.coalesce(p["payload"].startswith("{"), F.lit(True))
        & _scalars_only(F.col("value"), p, texts)
    )
    env = F.struct(*[p[f].alias(f) for f in ENVELOPE_FIELDS])
    return once(read, "env", F.when(readable, env)).drop("_p")


def parse_control(records: DataFrame, arrived_at: str | None = None) -> DataFrame:
    """Readable control documents; the others are dropped, as they announce nothing.

    The document's own time can be replaced by a column of the record.
    """
    schema = ", ".join(
        f"{name} {'array<string>' if name == 'trade_ids' else 'string'}"
        for name in CONTROL_FIELDS)
    kept = records.select(
        ARRIVAL, "value", *([F.col(arrived_at).alias("_at")] if arrived_at else []))
    read = once(kept, "_p", _strict_json(F.col("value"), CONTROL_FIELDS, schema))
    p = F.col("_p")
    count = p["expected_count"].try_cast("double").cast("int")
    made = {"expected_count": F.coalesce(count, F.lit(0))}
    if arrived_at:
        made["timestamp"] = F.col("_at")
    return read.where(
        p.isNotNull() & p[_CORRUPT].isNull()
        & p["trade_group_id"].isNotNull() & p["trade_ids"].isNotNull()
        & (p["expected_count"].isNull() | count.isNotNull())
    ).select(
        *[made.get(f, p[f]).alias(f) for f in CONTROL_FIELDS],
        ARRIVAL,
    )


def first_control(documents: DataFrame) -> DataFrame:
    """Per group the control document that arrived first; later ones are ignored."""
    rest = [c for c in documents.columns if c != "trade_group_id"]
    return documents.groupBy("trade_group_id").agg(
        F.min_by(F.struct(*rest), ARRIVAL).alias("d")
    ).select("trade_group_id", "d.*")


def dedup_key(cfg: PipelineConfig) -> Column:
    """Idempotency key of the envelope, held apart by schema if so configured."""
    key = F.col("env")["idempotency_key"]
    if not cfg.dedup_by_schema:
        return key
    schema_id = F.coalesce(F.col("env")["schema_id"], F.lit(""))
    return F.when(key.isNotNull(), F.concat_ws("|", schema_id, key))


def key_columns(cfg: PipelineConfig) -> list[Column]:
    """The narrow columns every decision needs, of a parsed record."""
    e = F.col("env")
    return [
        F.col(ARRIVAL),
        e.isNotNull().alias("readable"),
        dedup_key(cfg).alias(_KEY),
        e["trade_group_id"].alias("trade_group_id"),
        e["trade_id"].alias("trade_id"),
        header_int(F.col("headers"), "attempt_count").alias("attempt_count"),
    ]


def event_keys(parsed: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return parsed.select(*key_columns(cfg))


def complete() -> Column:
    """The event names its group, its id and its idempotency key (blank text passes)."""
    return (F.col("readable") & F.col("trade_group_id").isNotNull()
            & F.col("trade_id").isNotNull() & F.col(_KEY).isNotNull())


def first_arrivals(keys: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Per idempotency key the first arrival among the given events.

    ``seen`` (one column, the key) lists keys taken in by earlier runs; those have no
    first arrival here. The minimum is taken before the shuffle, so copies of one key
    cost one row per task.
    """
    firsts = keys.groupBy(_KEY).agg(F.min(ARRIVAL).alias(ARRIVAL))
    if seen is None:
        return firsts
    return firsts.join(seen.select(F.col(seen.columns[0]).alias(_KEY)).distinct(), _KEY, "left_anti")


def deduplicate(df: DataFrame, key: str, arrival: str = ARRIVAL) -> DataFrame:
    """Per key the row that arrived first, found by a minimum and a join on arrival."""
    firsts = df.groupBy(key).agg(F.min(arrival).alias(arrival)).select(arrival).hint("merge")  # a row per key
    return df.join(firsts, arrival, "left_semi")


def registered(keys: DataFrame, control: DataFrame, cfg: PipelineConfig,
               hot: list | None = None) -> DataFrame:
    """Events with a flag that tells whether their group has a control document."""
    groups = control.select("trade_group_id").distinct().withColumn("_known", F.lit(True))
    return spread_join(
        keys, groups, "trade_group_id", F.col(ARRIVAL), "left", cfg.salts, hot
    ).withColumn("registered", F.coalesce("_known", F.lit(False))).drop("_known")


def decide(keys: DataFrame, control: DataFrame, cfg: PipelineConfig,
           seen: DataFrame | None = None, hot: list | None = None) -> DataFrame:
    """Outcome and failure reason of every event (``event_keys`` in, decisions out).

    An event with all its fields and a registered group marks its key; of equal keys
    the first arrival is taken in and all others are duplicates. An event that cannot
    mark its key is a duplicate only when its key was marked before it arrived. Each row meets
    its key's mark in one join by key, in which hot keys are cut. ``hot`` are the groups to be
    cut in joins (see ``spread_join``).
    """
    known = registered(keys, control, cfg, hot)
    able = complete() & F.col("registered")
    marks = first_arrivals(known.where(able), seen).select(
        _KEY, F.col(ARRIVAL).alias("_marked"), F.lit(True).alias("_here"))
    if seen is not None:
        old = seen.select(F.col(seen.columns[0]).alias(_KEY)).distinct()
        marks = marks.unionByName(old.select(
            _KEY, F.lit(-1).cast("bigint").alias("_marked"), F.lit(False).alias("_here")))

    # Rows without key need no mark; together they could be the largest key of all. Marks are
    # about as many as events, whatever the length of their files: they are never broadcast.
    keyed = spread_join(known.where(F.col(_KEY).isNotNull()), marks.hint("merge"), _KEY, F.col(ARRIVAL),
                        "left", cfg.salts, hot_keys(keys, _KEY))
    bare = known.where(F.col(_KEY).isNull()).withColumns({
        "_marked": F.lit(None).cast("bigint"), "_here": F.lit(None).cast("boolean")})
    mine = able & F.col("_here") & (F.col("_marked") == F.col(ARRIVAL))
    both = keyed.unionByName(bare).withColumns({
        "_first": F.coalesce(mine, F.lit(False)),
        "_late": ~able & F.coalesce(F.col("_marked") < F.col(ARRIVAL), F.lit(False))})
    exhausted = F.col("attempt_count") >= cfg.max_attempts
    outcome = (
        F.when(~F.col("readable"), DLQ_ROUTED)
        .when(F.col("_late"), DUPLICATE)
        .when(~complete(), DLQ_ROUTED)
        .when(~F.col("registered"), F.when(exhausted, DLQ_ROUTED).otherwise(RETRY_ROUTED))
        .when(F.col("_first"), SUCCESS)
        .otherwise(DUPLICATE)
    )
    reason = (
        F.when(F.col("outcome") != DLQ_ROUTED, F.lit(None).cast("string"))
        .when(~F.col("readable"), FATAL_PARSE_ERROR)
        .when(~complete(), FATAL_MISSING_FIELDS)
        .otherwise(NO_CONTROL_DOC)
    )
    return both.withColumn("outcome", outcome).withColumn("failure_reason", reason).select(
        *DECISION_FIELDS)


def taken_in(parsed: DataFrame) -> DataFrame:
    """Event columns of readable records (envelope less its version and trace id)."""
    return parsed.where(F.col("env").isNotNull()).select(
        *[F.col("env")[f].alias(f) for f in EVENT_FIELDS], ARRIVAL)


def outcome_counts(decisions: DataFrame) -> DataFrame:
    """Total and number of events per outcome, in one row."""
    def n(outcome: str, name: str) -> Column:
        return F.count_if(F.col("outcome") == outcome).alias(name)

    return decisions.agg(
        F.count("*").alias("total"), n(SUCCESS, "success"), n(DUPLICATE, "duplicates"),
        n(RETRY_ROUTED, "retry_routed"), n(DLQ_ROUTED, "dlq_routed"))


def dead_letters(records: DataFrame, decisions: DataFrame) -> DataFrame:
    """Dead-letter records of raw events: their key and value, with the reason."""
    lost = decisions.where(F.col("outcome") == DLQ_ROUTED).select(
        ARRIVAL, "failure_reason", "attempt_count")
    return records.join(lost, ARRIVAL).select(
        "key", "value",
        make_headers(failure_reason=F.col("failure_reason"), original_topic=F.col("topic"),
                     attempt_count=F.col("attempt_count")).alias("headers"),
    )
