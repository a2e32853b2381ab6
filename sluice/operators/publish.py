"""Publisher: table rows become event envelopes, announced by control documents.

Works on a numbered scan (see ``sluice.sources.tables``). Rows are cut into groups of
``group_size`` by their index in their file, which needs no shuffle; only the control
documents are aggregated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.headers import HEADERS_TYPE
from sluice.functions.text import stable_id
from sluice.sources.records import RECORD_TYPE
from sluice.sources.tables import ARRIVAL, INDEX_BITS, ROW_COLUMNS, ROW_FILE, ROW_INDEX
from sluice.spec import DatasetSpec



@dataclass(frozen=True)
class Published:
    """Control and event records; the control records are to be written first."""

    control: DataFrame
    events: DataFrame


def payload_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ROW_COLUMNS]


def payload_json(df: DataFrame) -> Column:
    """The row as a JSON object in column order, nulls kept."""
    return F.to_json(F.struct(*payload_columns(df)), {"ignoreNullFields": "false"})


def row_id(spec: DatasetSpec) -> Column:
    """Id of the row as text; a row without id stops the job with an error."""
    value = F.col(spec.id_field).cast("string")
    return F.coalesce(value, F.raise_error(F.lit(f"row has no {spec.id_field}")).cast("string"))


def canonical_row_json(columns: dict[str, str]) -> Column:
    """JSON text of a row with sorted keys and blanks after ``,`` and ``:``.

    ``columns`` maps each column to its Spark type name. Equal to the usual sorted
    JSON dump for ASCII text and for numbers printed without exponent.
    """
    parts = []
    for name in sorted(columns):
        col = F.col(name)
        if columns[name] in ("string", "date", "timestamp", "timestamp_ntz"):
            wrapped = F.to_json(F.array(col.cast("string")))
            text = F.substring(wrapped, F.lit(2), F.length(wrapped) - 2)
        else:
            text = col.cast("string")
        parts.append(F.concat(F.lit(f'"{name}": '), F.coalesce(text, F.lit("null"))))
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def idempotency_key(df: DataFrame, id_field: str) -> Column:
    """Key that recognises a repeated row: its id, else a hash of the whole row."""
    names = payload_columns(df)
    kinds = {f.name: f.dataType.typeName() for f in df.schema if f.name in names}
    whole = F.sha2(canonical_row_json(kinds), 256)
    if id_field not in names:
        return whole
    return F.coalesce(F.col(id_field).cast("string"), whole)


def group_id(spec: DatasetSpec) -> Column:
    ordinal = F.expr(f"{ROW_INDEX} div {spec.group_size}")
    return F.concat_ws("-", F.lit(spec.schema_id), F.col(ROW_FILE), ordinal.cast("string"))


def row_groups(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows with their group and id: consecutive rows of one file, ``group_size`` each."""
    return df.withColumns({"trade_group_id": group_id(spec), "trade_id": row_id(spec)})


def control_documents(grouped: DataFrame, spec: DatasetSpec, published_at: str) -> DataFrame:
    """One control document per group: how many rows, and which, in row order.

    A group holds at most ``group_size`` rows, so its id list is bounded.
    """
    listed = F.array_sort(F.collect_list(F.struct(F.col(ROW_INDEX).alias("row"), "trade_id")))
    return grouped.groupBy("trade_group_id").agg(
        F.count("*").cast("int").alias("expected_count"),
        F.transform(listed, lambda x: x["trade_id"]).alias("trade_ids"),
        F.min(ARRIVAL).alias(ARRIVAL),
    ).select(
        "trade_group_id", "expected_count", "trade_ids",
        F.lit(published_at).alias("timestamp"),
        F.lit(spec.source).alias("source"),
        F.lit(spec.pipeline_version).alias("pipeline_version"),
        F.lit(spec.schema_id).alias("schema_id"),
        ARRIVAL,
    )


def envelopes(grouped: DataFrame, spec: DatasetSpec, published_at: str,
              payload: Column, key: Column, schema_id: Column | None = None) -> DataFrame:
    """Envelope columns of each row; ``payload`` is JSON text."""
    identity = [F.lit(spec.schema_id), F.col(ROW_FILE), F.col(ROW_INDEX)]
    return grouped.select(
        stable_id(F.lit("event"), *identity).alias("event_id"),
        F.lit(spec.event_version).alias("event_version"),
        F.lit(spec.event_type).alias("event_type"),
        stable_id(F.lit("trace"), *identity).alias("trace_id"),
        key.alias("idempotency_key"),
        F.lit(published_at).alias("timestamp"),
        F.lit(spec.source).alias("source"),
        F.lit(spec.pipeline_version).alias("pipeline_version"),
        (schema_id if schema_id is not None else F.lit(spec.schema_id)).alias("schema_id"),
        "trade_group_id",
        "trade_id",
        payload.alias("payload"),
        ARRIVAL,
    )


def envelope_json(frame: DataFrame) -> Column:
    """Envelope as JSON text, the payload nested as the object it is."""
    head = [c for c in frame.columns if c not in ("payload", ARRIVAL)]
    text = F.to_json(F.struct(*head), {"ignoreNullFields": "false"})
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - 1),
        F.lit(',"payload":'), F.coalesce(F.col("payload"), F.lit("null")), F.lit("}"),
    )


def as_records(frame: DataFrame, key: Column, value: Column, topic: str,
               published_at: str) -> DataFrame:
    """Frame in the record shape; (file, row) serve as partition and offset."""
    return frame.select(
        key.alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        F.shiftright(ARRIVAL, INDEX_BITS).cast("int").alias("partition"),
        F.col(ARRIVAL).bitwiseAND(F.lit((1 << INDEX_BITS) - 1)).alias("offset"),
        F.lit(published_at).cast("timestamp").alias("timestamp"),
        F.create_map().cast(HEADERS_TYPE).alias("headers"),
        ARRIVAL,
    )


def control_records(control: DataFrame, spec: DatasetSpec, published_at: str) -> DataFrame:
    fields = [c for c in control.columns if c != ARRIVAL]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return as_records(control, F.col("trade_group_id"), value, spec.topics.control, published_at)


def event_records(events: DataFrame, spec: DatasetSpec, published_at: str) -> DataFrame:
    return as_records(
        events, F.col("event_id"), envelope_json(events), spec.topics.primary, published_at)


def publish(df: DataFrame, spec: DatasetSpec, published_at: str) -> Published:
    """Control and event records of a numbered table."""
    grouped = row_groups(df, spec)
    events = envelopes(grouped, spec, published_at, payload_json(df),
                       idempotency_key(df, spec.id_field))
    return Published(
        control_records(control_documents(grouped, spec, published_at), spec, published_at),
        event_records(events, spec, published_at),
    )


def next_free(spark: SparkSession, path: str, number: str) -> int:
    """First free offset or partition number of a record table; 0 when there is none yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return 0
    last = spark.read.schema(RECORD_TYPE).parquet(path).agg(F.max(number)).first()[0]
    return 0 if last is None else last + 1


def append_records(records: DataFrame, path: str) -> None:
    """Append to a record table, its offsets following those already there.

    One publisher per table at a time, as offsets are assigned here.
    """
    base = next_free(records.sparkSession, path, "offset")
    (records.drop(ARRIVAL)
     .withColumn("offset", F.col("offset") + F.lit(base))
     .write.mode("append").parquet(path))


def write_records(published: Published, control_path: str, events_path: str) -> None:
    """Write the control records, then the events they announce."""
    append_records(published.control, control_path)
    append_records(published.events, events_path)
