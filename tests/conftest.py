import json

import pytest
from pyspark.sql import SparkSession

from sluice.session import configure
from sluice.sources.records import RECORD_TYPE, with_arrival
from sluice.sources.registry import load_registry
from sluice.streaming.run import use_rocksdb


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    use_rocksdb(session)
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def registry(spark):
    return load_registry(spark)


def control_json(group, ids, count=None, **more):
    doc = {"trade_group_id": group, "expected_count": len(ids) if count is None else count,
           "trade_ids": ids, "timestamp": "2024-01-01T00:00:00Z", "source": "cloud",
           "pipeline_version": "1.0.0", "schema_id": "banking_transaction_v1"}
    return json.dumps({**doc, **more})


def event_json(group, trade_id, key=None, payload=None, **more):
    event = {"event_id": f"e-{group}-{trade_id}", "event_version": "1.0",
             "event_type": "banking_transaction", "trace_id": "t",
             "idempotency_key": f"{group}-{trade_id}" if key is None else key,
             "timestamp": "2024-01-01T00:00:00Z", "source": "cloud", "pipeline_version": "1.0.0",
             "schema_id": "banking_transaction_v1", "trade_group_id": group,
             "trade_id": trade_id, "payload": {"amount": 100.0} if payload is None else payload}
    return json.dumps({**event, **more})


def records(spark, values, topic="banking-transactions", headers=None, times=None):
    """Record frame; each value's offset is its place in the list."""
    import datetime as dt

    start = dt.datetime(2024, 1, 1)
    rows = [
        (f"k{i}", v, topic, 0, i,
         start + dt.timedelta(seconds=(times[i] if times else 0)), (headers or {}).get(i, {}))
        for i, v in enumerate(values)]
    return with_arrival(spark.createDataFrame(rows, RECORD_TYPE))
