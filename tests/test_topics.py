"""Sending records to topics, with a table in the place of Kafka."""
import pytest
from pyspark.sql import functions as F

from sluice.functions.headers import from_kafka_headers
from sluice.operators.publish import Published
from sluice.sources import topics
from sluice.spec import Topics
from tests.conftest import control_json, event_json, records

TOPICS = Topics()


def batch(spark):
    return Published(records(spark, [control_json("A", ["1", "2"])], topic="other"),
                     records(spark, [event_json("A", "1"), event_json("A", "2")], headers={1: {"attempt_count": "2"}}))


def test_control_goes_first_and_each_step_once(spark, tmp_path):
    order = []
    write = topics.file_writer(str(tmp_path / "topics"))

    def noted(rows, topic):
        order.append(topic)
        write(rows, topic)

    root = str(tmp_path / "lake")
    assert topics.send(batch(spark), TOPICS, noted, root, "r1") == ["control", "events"]
    assert topics.send(batch(spark), TOPICS, noted, root, "r1") == []
    assert order == [TOPICS.control, TOPICS.primary]
    rows = spark.read.parquet(str(tmp_path / "topics"))
    assert {(r["topic"], r["n"]) for r in rows.groupBy("topic").agg(F.count("*").alias("n")).collect()} == {
        (TOPICS.control, 1), (TOPICS.primary, 2)}
    headers = rows.where(F.size("headers") > 0).select(from_kafka_headers(F.col("headers")).alias("h")).collect()
    assert [r.h for r in headers] == [{"attempt_count": "2"}]


def test_a_failed_step_is_sent_again_but_not_the_one_before(spark, tmp_path):
    order = []

    def fails(rows, topic):
        order.append(topic)
        if topic == TOPICS.primary and order.count(topic) == 1:
            raise OSError("gone")

    root = str(tmp_path)
    with pytest.raises(OSError):
        topics.send(batch(spark), TOPICS, fails, root, "r1")
    assert topics.send(batch(spark), TOPICS, fails, root, "r1") == ["events"]
    assert order == [TOPICS.control, TOPICS.primary, TOPICS.primary]


def test_retries_and_dead_letters(spark, tmp_path):
    write = topics.file_writer(str(tmp_path / "topics"))
    again = records(spark, ["x"], headers={0: {"retry_after": "5"}})
    for _ in range(2):
        topics.send_retries(again, TOPICS, write, str(tmp_path), "r1")
        topics.send_dead_letters(again.select("key", "value", F.lit(None).cast("map<string,string>").alias("headers")),
                                 TOPICS, write, str(tmp_path), "r1")
    got = spark.read.parquet(str(tmp_path / "topics")).select("topic", "value", F.size("headers").alias("n")).collect()
    assert sorted(map(tuple, got)) == [("x", 0, TOPICS.dlq), ("x", 1, TOPICS.retry)] or sorted(
        (r.topic, r.value, r.n) for r in got) == [(TOPICS.dlq, "x", 0), (TOPICS.retry, "x", 1)]


def test_kafka_settings(spark, monkeypatch):
    seen = {}

    class Writing:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **o):
            seen.update(o)
            return self

        def save(self):
            seen["saved"] = True

    class Rows:
        write = Writing()

    topics.kafka_writer({"kafka.bootstrap.servers": "h:1"})(Rows(), "t")
    assert seen == {"format": "kafka", "kafka.acks": "all", "kafka.enable.idempotence": "true",
                    "kafka.bootstrap.servers": "h:1", "topic": "t", "includeHeaders": "true", "saved": True}
