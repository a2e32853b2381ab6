"""Event and control records: the common shape of Kafka topics and of file tables."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.headers import HEADERS_TYPE, from_kafka_headers
from sluice.sources.tables import ARRIVAL

RECORD_TYPE = (
    f"key string, value string, topic string, partition int, offset bigint, "
    f"timestamp timestamp, headers {HEADERS_TYPE}"
)

# Offsets below 2^40 per partition, partitions below 2^23.
_OFFSET_BITS = 40


def arrival() -> Column:
    """Arrival order over (partition, offset) as one number."""
    return F.shiftleft(F.col("partition").cast("bigint"), _OFFSET_BITS) + F.col("offset")


def with_arrival(records: DataFrame) -> DataFrame:
    return records.withColumn(ARRIVAL, arrival())


def read_records(spark: SparkSession, *paths: str) -> DataFrame:
    """Records stored as Parquet (a published, retry or dead-letter table)."""
    return with_arrival(spark.read.schema(RECORD_TYPE).parquet(*paths))


def stream_records(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same table as a stream; ``max_files`` per trigger, if given, bounds each micro-batch.

    The claim of a record is its file.
    """
    reader = spark.readStream.schema(RECORD_TYPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_arrival(reader.parquet(path).withColumn("claim", F.col("_metadata.file_path")))


def read_claimed(decisions: DataFrame) -> DataFrame:
    """Decisions with the key, value, topic and headers of their records.

    A claim names the file that holds the record, so that only the files of these decisions
    are listed and read. Their number is bounded by what a micro-batch settles.
    """
    spark = decisions.sparkSession
    found = [r["claim"] for r in decisions.select("claim").distinct().collect() if r["claim"]]
    records = read_records(spark, *found) if found else with_arrival(spark.createDataFrame([], RECORD_TYPE))
    return _with_records(decisions, records)


def read_claimed_kafka(options: dict[str, str]) -> Callable[[DataFrame], DataFrame]:
    """The same from Kafka: only the offsets between the decisions' first and last are read."""
    def fetch(decisions: DataFrame) -> DataFrame:
        raw = decisions.sparkSession.read.format("kafka").options(
            **options, **claimed_range(decisions, options["subscribe"])).load()
        return _with_records(decisions, with_arrival(decode_kafka(raw)))
    return fetch


def claimed_range(decisions: DataFrame, topic: str) -> dict[str, str]:
    """Offsets per partition that hold all records of the decisions; the end is exclusive."""
    place = F.shiftright(ARRIVAL, _OFFSET_BITS)
    offset = F.col(ARRIVAL) - F.shiftleft(place, _OFFSET_BITS)
    bounds = decisions.groupBy(place.alias("partition")).agg(
        F.min(offset).alias("first"), F.max(offset).alias("last")).collect()
    return {"startingOffsets": json.dumps({topic: {str(r["partition"]): r["first"] for r in bounds}}),
            "endingOffsets": json.dumps({topic: {str(r["partition"]): r["last"] + 1 for r in bounds}})}


def _with_records(decisions: DataFrame, records: DataFrame) -> DataFrame:
    return decisions.drop("claim").withColumnRenamed("trade_group_id", "group_id").join(
        records.select(ARRIVAL, "key", "value", "topic", "headers"), ARRIVAL)


def kafka_options(servers: str, topic: str, max_offsets: int | None = None) -> dict[str, str]:
    """Source options: from the earliest offset; micro-batches are bounded only if asked."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "includeHeaders": "true",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def stream_kafka(spark: SparkSession, servers: str, topic: str,
                 max_offsets: int | None = None) -> DataFrame:
    """Kafka topic as record stream (needs the Kafka connector on the class path)."""
    raw = spark.readStream.format("kafka").options(
        **kafka_options(servers, topic, max_offsets)).load()
    return with_arrival(decode_kafka(raw))


def decode_kafka(raw: DataFrame) -> DataFrame:
    """Kafka source rows in the record shape."""
    return raw.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic", "partition", "offset", "timestamp",
        from_kafka_headers(F.col("headers")).alias("headers"),
    )
