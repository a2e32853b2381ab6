"""Event data derived from the given tables, with faults planted by key.

The tables themselves are clean. So that every operator has something to find, faults
are planted in rows whose key leaves a certain remainder; the SQL in ``oracles`` states
the same rule. All rows of a table stay in, faulty or not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.headers import make_headers
from sluice.functions.text import composite_key
from sluice.operators import intake, publish
from sluice.plans.runs import ingest_run
from sluice.session import stage
from sluice.sources.records import with_arrival
from sluice.sources.tables import ARRIVAL, ROW_FILE, ROW_INDEX, read_numbered
from sluice.spec import BANKING, LINEITEM, ORDERS, DatasetSpec, PipelineConfig

PUBLISHED_AT = "2024-06-01T00:00:00Z"
INGESTED_AT = "2024-06-01T05:06:07.000Z"
NOW_MS = 1_717_218_000_000
CFG = PipelineConfig()

# Fault -> (modulus, remainder) of the key; the first that fits is planted.
ORDER_FAULTS = {"missing": (97, 1), "type": (89, 2), "extra": (83, 3), "price": (79, 4),
                "unknown": (67, 7)}
BANK_FAULTS = {"missing": (97, 1), "type": (89, 2), "extra": (83, 3), "price": (79, 4),
               "blank": (73, 5), "messy": (71, 6), "unknown": (67, 7)}
INTAKE_FAULTS = {"twice": (61, 8), "no_group": (59, 9), "malformed": (53, 10),
                 "new_member": (47, 11)}
GROUP_WITHOUT_CONTROL = (11, 10)
GROUP_WITH_LOSS = (7, 6)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_numbered(spark, f"{sf_dir}/{name}.parquet",
                         min_tasks=spark.sparkContext.defaultParallelism)


def day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def fault(key: str, faults: dict[str, tuple[int, int]]) -> Column:
    out = None
    for name, (modulus, rest) in faults.items():
        hit = F.col(key) % modulus == rest
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("none")


# --- clean rows -------------------------------------------------------------------

def orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(spark, sf_dir, "orders").withColumn("o_orderdate", day("o_orderdate"))


def lineitem_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; their ids repeat, so they bring duplicates and failing groups."""
    rows = numbered(spark, sf_dir, "lineitem").withColumn("l_shipdate", day("l_shipdate"))
    first = composite_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("line_item_id")
    return rows.select(first, *rows.columns)


def banking_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions made of the event table; what it lacks follows from the key."""
    k = F.col("event_id")
    status = F.element_at(
        F.array(*map(F.lit, ["Success", "Failed", "Pending", "success"])), (k % 4 + 1).cast("int"))
    return numbered(spark, sf_dir, "events").select(
        F.concat(F.lit("TXN"), k.cast("string")).alias("transaction_id"),
        day("ts").alias("transaction_date"),
        F.col("value").alias("amount"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.when(k % 17 != 0, F.col("value") + k % 1000).alias("balance"),
        F.when(k % 13 != 0, F.lit(250.9) + k % 700).alias("credit_score"),
        status.alias("transaction_status"),
        F.col("event_type").alias("transaction_type"),
        ROW_FILE, ROW_INDEX, ARRIVAL,
    )


# --- published records ------------------------------------------------------------

def published(rows: DataFrame, spec: DatasetSpec) -> publish.Published:
    return publish.publish(rows, spec, PUBLISHED_AT)


def _json(*columns) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _records(rows: DataFrame, spec: DatasetSpec, payload: Column, key: Column,
             schema_id: Column) -> DataFrame:
    grouped = publish.row_groups(rows, spec)
    return publish.event_records(
        publish.envelopes(grouped, spec, PUBLISHED_AT, payload, key, schema_id), spec, PUBLISHED_AT)


def _events(records: DataFrame) -> DataFrame:
    return intake.taken_in(intake.parse_events(records))


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with payload faults, having gone through JSON."""
    rows = orders_rows(spark, sf_dir)
    f = fault("o_orderkey", ORDER_FAULTS)
    cust = F.when(f != "missing", F.col("o_custkey")).alias("o_custkey")
    price = F.when(f == "price", -F.col("o_totalprice")).otherwise(F.col("o_totalprice"))
    rest = ["o_orderstatus", "o_orderdate", "o_orderpriority"]
    payload = (
        F.when(f == "type", _json("o_orderkey", cust, price.cast("string").alias("o_totalprice"), *rest))
        .when(f == "extra", _json("o_orderkey", cust, price.alias("o_totalprice"), *rest,
                                  F.lit(True).alias("o_gift"), F.lit(None).cast("string").alias("o_note")))
        .otherwise(_json("o_orderkey", cust, price.alias("o_totalprice"), *rest))
    )
    schema_id = F.when(f == "unknown", "tpch_orders_v9").otherwise(ORDERS.schema_id)
    return _events(_records(rows, ORDERS, payload, F.col("o_orderkey").cast("string"), schema_id))


def banking_payload(f: Column) -> Column:
    number = F.when(f == "price", -F.col("amount")).when(f != "missing", F.col("amount"))
    messy = f == "messy"
    head = [
        F.when(f == "blank", "   ").otherwise(F.col("transaction_id")).alias("transaction_id"),
        F.when(messy, F.regexp_replace("transaction_date", "-", "/"))
        .otherwise(F.col("transaction_date")).alias("transaction_date"),
    ]
    tail = [
        "customer_id",
        F.when(messy, -1.5).otherwise(F.col("balance")).alias("balance"),
        "credit_score",
        F.when(messy, "Unknown").otherwise(F.col("transaction_status")).alias("transaction_status"),
        "transaction_type",
    ]
    plain = number.alias("amount")
    return (
        F.when(f == "type", _json(*head, number.cast("string").alias("amount"), *tail))
        .when(f == "extra", _json(*head, plain, *tail, F.lit("A-1").alias("account_number")))
        .otherwise(_json(*head, plain, *tail))
    )


def faulty_banking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Banking events with payload faults, having gone through JSON."""
    rows = banking_rows(spark, sf_dir)
    number = F.substring("transaction_id", 4, 20).cast("bigint")
    rows = rows.withColumn("_k", number)
    f = fault("_k", BANK_FAULTS)
    schema_id = F.when(f == "unknown", "banking_transaction_v9").otherwise(BANKING.schema_id)
    return _events(_records(rows, BANKING, banking_payload(f), F.col("transaction_id"), schema_id))


def orders_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(published(orders_rows(spark, sf_dir), ORDERS).events)


def lineitem_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(published(lineitem_rows(spark, sf_dir), LINEITEM).events)


# --- records with intake and group faults ------------------------------------------

def group_number(name: str = "trade_group_id") -> Column:
    return F.regexp_extract(name, r"-(\d+)$", 1).cast("bigint")


def orders_control(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """Control documents of the orders; those of some groups were never sent."""
    modulus, rest = GROUP_WITHOUT_CONTROL
    records = published(orders_rows(spark, sf_dir), ORDERS).control
    sent = records if complete else records.where(group_number("key") % modulus != rest)
    return intake.first_control(intake.parse_control(sent))


def _sent_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows in sending order; some rows are sent twice, one right after the other."""
    rows = orders_rows(spark, sf_dir)
    twice = fault("o_orderkey", INTAKE_FAULTS) == "twice"
    copies = F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    sent = rows.withColumn("_copy", F.explode(copies))
    return publish.row_groups(
        sent.withColumn(ARRIVAL, F.col(ROW_INDEX) * 2 + F.col("_copy")).drop("_copy"), ORDERS)


def _order_envelopes(sent: DataFrame) -> DataFrame:
    rows = sent.drop("trade_group_id", "trade_id")
    return publish.envelopes(sent, ORDERS, PUBLISHED_AT, publish.payload_json(rows),
                             F.col("o_orderkey").cast("string"))


def _order_records(env: DataFrame, value: Column) -> DataFrame:
    return publish.as_records(env, F.col("event_id"), value, ORDERS.topics.primary, PUBLISHED_AT)


def orders_with_intake_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records, some sent twice, some without group, some unreadable."""
    f = fault("o_orderkey", INTAKE_FAULTS)
    sent = _sent_orders(spark, sf_dir).withColumn(
        "trade_group_id", F.when(f != "no_group", F.col("trade_group_id")))
    env = _order_envelopes(sent).withColumn("_k", F.col("idempotency_key").cast("bigint"))
    value = publish.envelope_json(env.drop("_k"))
    open_text = F.substring(value, F.lit(1), F.length(value) - 1)
    bad = fault("_k", INTAKE_FAULTS)
    value = (
        F.when(bad == "malformed", open_text)
        .when(bad == "new_member", F.concat(open_text, F.lit(',"surplus":1}')))
        .otherwise(value)
    )
    return _order_records(env, value)


def orders_with_group_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records, some sent twice; some groups lose their last row."""
    sent = _sent_orders(spark, sf_dir)
    modulus, rest = GROUP_WITH_LOSS
    last = F.col(ROW_INDEX) % ORDERS.group_size == ORDERS.group_size - 1
    lost = (group_number() % modulus == rest) & last
    env = _order_envelopes(sent.where(~lost))
    return _order_records(env, publish.envelope_json(env))


def retried(records: DataFrame) -> DataFrame:
    """The same records as they lie in the retry table: attempts and due times by arrival."""
    attempt = (F.col(ARRIVAL) % 4).cast("string")
    due = F.lit(NOW_MS) + (F.col(ARRIVAL) % 5 - 2) * 1000
    bad = F.when(F.col(ARRIVAL) % 6 == 5, F.lit("soon")).otherwise(due.cast("string"))
    return records.withColumn("headers", make_headers(attempt_count=attempt, retry_after=bad))


def keys_of(records: DataFrame) -> DataFrame:
    """Staged key columns of the records."""
    return stage(intake.event_keys(intake.parse_events(records), CFG), "keys")


# --- runs in a row ------------------------------------------------------------------

RUNS_FROM_MS = 1_717_200_000_000  # when the records of the runs were sent


def first_run(records: DataFrame) -> Column:
    """Every second row, with its copies, is sent in time for the first run."""
    return F.shiftright(F.col(ARRIVAL), 1) % 2 == 0


def runs_in_a_row(spark: SparkSession, sf_dir: str, root: str, registry, runs: int,
                  repeats: int = 1) -> list:
    """Orders with group faults through up to three runs, each done ``repeats`` times.

    Rows come half by half. Some control documents come with the second half only, so
    that their events wait in between. The third run, after all deadlines, brings nothing.
    """
    modulus, rest = GROUP_WITHOUT_CONTROL
    late = group_number("key") % modulus == rest
    records = stage(orders_with_group_faults(spark, sf_dir).drop(ARRIVAL), "sent")
    control = stage(published(orders_rows(spark, sf_dir), ORDERS).control.drop(ARRIVAL), "announced")
    records, control = with_arrival(records), with_arrival(control)
    first = first_run(records)
    steps = [(records.where(first), control.where(~late), 60_000),
             (records.where(~first), control.where(late), 70_000),
             (records.limit(0), control.limit(0), 600_000)]
    results = []
    for n, (sent, announced, passed) in enumerate(steps[:runs]):
        for _ in range(repeats):
            result = ingest_run(sent, announced, root, registry, INGESTED_AT, RUNS_FROM_MS + passed,
                                CFG, f"run-{n}", f"run-{n - 1}" if n else None)
        results.append(result)
    return results
