import hashlib
import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import columns, intake, publish
from sluice.session import s3a_conf
from sluice.sources.records import kafka_options, read_records
from sluice.sources.tables import number_by, read_csv, read_numbered
from sluice.spec import DatasetSpec

SPEC = DatasetSpec("banking_transaction_v1", "transaction_id", "banking_transaction", group_size=4)
AT = "2024-01-01T00:00:00Z"


@pytest.fixture()
def numbered(spark, tmp_path):
    rows = [(f"T{i}", "2024-01-05", float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "transaction_id string, transaction_date string, amount double")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    return read_numbered(spark, str(tmp_path / "in"))


def test_groups_follow_row_order(numbered):
    docs = intake.parse_control(publish.publish(numbered, SPEC, AT).control)
    got = sorted((r.expected_count, r.trade_ids) for r in docs.collect())
    assert got == [(2, ["T8", "T9"]), (4, ["T0", "T1", "T2", "T3"]), (4, ["T4", "T5", "T6", "T7"])]


def test_ids_are_repeatable_and_distinct(numbered):
    def ids():
        events = publish.publish(numbered, SPEC, AT).events
        return [r.key for r in events.orderBy("arrival").collect()]

    assert ids() == ids() and len(set(ids())) == 10


def test_min_tasks_keeps_numbering(spark, tmp_path):
    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "r"))
    spread = read_numbered(spark, str(tmp_path / "r"), min_tasks=4)
    assert spread.rdd.getNumPartitions() == 4
    assert spread.where("id <> _row_index OR id <> arrival").count() == 0


def test_nulls_stay_in_the_payload(spark, numbered):
    df = numbered.withColumn("amount", F.lit(None).cast("double"))
    value = publish.publish(df, SPEC, AT).events.first()["value"]
    assert json.loads(value)["payload"]["amount"] is None
    assert list(json.loads(value))[-1] == "payload"


def test_row_without_id_is_an_error(numbered):
    df = numbered.withColumn("transaction_id", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="row has no transaction_id"):
        publish.row_groups(df, SPEC).collect()


def test_fallback_key_is_the_hash_of_the_sorted_row(spark):
    row = {"b": 1, "a": "x \"y\"", "c": 2.5, "d": None, "e": True}
    df = spark.createDataFrame([tuple(row.values())], "b long, a string, c double, d string, e boolean")
    got = df.select(publish.idempotency_key(df, "id").alias("k")).first().k
    assert got == hashlib.sha256(json.dumps(row, sort_keys=True).encode()).hexdigest()


def test_appended_records_continue_the_offsets(numbered, spark, tmp_path):
    sent = publish.publish(numbered, SPEC, AT)
    for _ in range(2):
        publish.write_records(sent, str(tmp_path / "c"), str(tmp_path / "e"))
    again = read_records(spark, str(tmp_path / "e"))
    assert again.count() == 20 and again.select("arrival").distinct().count() == 20


def test_number_by_sort_key(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    got = number_by(df, ["k"], "t", buckets=8)
    assert got.where("_row_index <> k").count() == 0 and got.count() == 1000


def test_csv_names_aliases_and_nan(spark, tmp_path):
    (tmp_path / "x.csv").write_text(" Txn ID ,Txn_Date,Transaction Amount,ID\nA,2024-01-05,1.5,Z\n")
    raw = read_csv(spark, str(tmp_path / "x.csv"))
    got = columns.canonical_names(columns.clean_names(raw))
    assert got.columns == ["transaction_id", "transaction_date", "amount", "id"]
    assert got.schema["amount"].dataType.typeName() == "double"
    nan = spark.createDataFrame([(float("nan"), "x")], "a double, b string")
    assert columns.nan_to_null(nan).first().a is None


def test_canonical_name_present_wins(spark):
    df = spark.createDataFrame([(1, 2)], "amount int, txn_amount int")
    assert columns.canonical_names(df).columns == ["amount", "txn_amount"]


def test_store_and_kafka_settings():
    conf = s3a_conf("http://store:9000", "a", "b")
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert s3a_conf("https://store", "a", "b")["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "true"
    with pytest.raises(ValueError):
        s3a_conf("store:9000", "a", "b")
    assert kafka_options("b:1", "t", 500)["startingOffsets"] == "earliest"


def test_equal_file_names_in_different_folders(spark, tmp_path):
    """Ids, groups and arrival numbers stay apart, and are the same in every scan."""
    for part in ("x=1", "x 2"):
        spark.range(100).selectExpr("CAST(id AS STRING) AS transaction_id").coalesce(1).write.parquet(
            str(tmp_path / "tmp" / part))
        found = next((tmp_path / "tmp" / part).glob("part-*.parquet"))
        (tmp_path / "in" / part).mkdir(parents=True)
        (tmp_path / "in" / part / "part-0.parquet").write_bytes(found.read_bytes())
    rows = read_numbered(spark, f"{tmp_path}/in/*")
    sent = publish.publish(rows, SPEC, AT)
    keys = [r["key"] for r in sent.events.collect()]
    assert len(keys) == len(set(keys)) == 200
    first = {(r["_row_file"], r["_row_index"]): r["arrival"] for r in rows.collect()}
    again = {(r["_row_file"], r["_row_index"]): r["arrival"]
             for r in read_numbered(spark, f"{tmp_path}/in/*", min_tasks=5).collect()}
    assert first == again and len(set(first.values())) == 200
