"""Records to topics: a batch's control documents before its events, each once per run.

A writer takes rows in the shape of the Kafka sink (``key, value, topic, headers``) and a
topic. ``kafka_writer`` sends them; ``file_writer`` keeps them as a table and stands for it
where there is no connector.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.headers import to_kafka_headers
from sluice.operators.publish import Published
from sluice.sources.lake import once_per_run
from sluice.spec import Topics

Writer = Callable[[DataFrame, str], None]


def topic_rows(records: DataFrame, topic: str | None = None) -> DataFrame:
    """Rows as the Kafka sink takes them; ``topic`` replaces that of the records.

    The key decides the partition, so that records of one key stay in order.
    """
    return records.select(
        "key", "value", (F.lit(topic) if topic else F.col("topic")).alias("topic"),
        to_kafka_headers(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"))


def kafka_writer(options: dict[str, str]) -> Writer:
    """Sends rows to Kafka (needs the connector). Waits for all replicas and lets the producer
    tell its own repeats, so that a task done again sends no record twice within a session."""
    settings = {"kafka.acks": "all", "kafka.enable.idempotence": "true", **options}

    def write(rows: DataFrame, topic: str) -> None:
        rows.write.format("kafka").options(**settings, topic=topic, includeHeaders="true").save()
    return write


def file_writer(path: str) -> Writer:
    """Appends rows to a table with a folder per topic."""
    def write(rows: DataFrame, topic: str) -> None:
        rows.drop("topic").write.mode("append").parquet(f"{path}/topic={topic}")
    return write


def send(sent: Published, topics: Topics, write: Writer, root: str, run: str) -> list[str]:
    """Send a batch: first what announces its groups, then their events; steps done now.

    A run done again after a failure goes on with the step that failed. A step cut short is
    sent again whole: its records keep their keys, by which intake knows them.
    """
    spark = sent.events.sparkSession
    steps = [("control", sent.control, topics.control), ("events", sent.events, topics.primary)]
    return [name for name, records, topic in steps
            if once_per_run(spark, root, run, f"send-{name}", lambda: write(topic_rows(records, topic), topic))]


def send_retries(again: DataFrame, topics: Topics, write: Writer, root: str, run: str) -> bool:
    """Retry records of a run to their topic, once."""
    return once_per_run(again.sparkSession, root, run, "send-retries",
                        lambda: write(topic_rows(again, topics.retry), topics.retry))


def send_dead_letters(letters: DataFrame, topics: Topics, write: Writer, root: str, run: str) -> bool:
    """Dead letters (key, value, headers) of a run to their topic, once."""
    return once_per_run(letters.sparkSession, root, run, "send-dead-letters",
                        lambda: write(topic_rows(letters, topics.dlq), topics.dlq))
