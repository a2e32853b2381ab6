"""What the batch job does to its payloads, by its plans, and joins with hot keys."""
from pyspark.sql import functions as F

from sluice.functions.joins import hot_keys, spread_join
from sluice.operators import ledger, verdict
from sluice.plans import ingest
from sluice.session import stage
from sluice.spec import EVENT_FIELDS, PipelineConfig
from tests.conftest import control_json, event_json, records

CFG = PipelineConfig()


def plan_of(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_one_parse_and_one_payload_move(spark, registry, tmp_path):
    events = [event_json("A", str(i)) for i in range(20)]
    recs, docs = records(spark, events), ingest.control_table(records(spark, [control_json("A", [str(i) for i in range(20)])]))
    land = ingest.landed(recs, CFG)
    assert plan_of(land).count("Exchange") == 0 and plan_of(land).count("payload: string") <= 2
    land = stage(land, "landed")
    keys = land.select("arrival", "readable", "dedup_key", "trade_group_id", "trade_id", "attempt_count")
    assert "from_json" not in plan_of(keys) and "payload" not in plan_of(keys)
    settled = ingest.settle(keys, docs, CFG, staged=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a batch of any size
    try:
        accepted = stage(ledger.accepted(settled.slots, settled.status), "accepted")
        ready = land.where("readable").select(*EVENT_FIELDS, "arrival").join(accepted, "arrival", "left_semi")
        plan = plan_of(verdict.validate(ready, registry, "2024-01-05T07:08:09.000Z", CFG))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(moves) == 2  # payloads and the narrow list of accepted arrivals
    assert "rebalance" not in plan.lower()


def test_only_hot_keys_are_cut(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    assert hot_keys(rows, "k") == ["hot"]
    even = rows.where("k <> 'hot'")
    assert hot_keys(even, "k") == [] and hot_keys(rows.limit(0), "k") == []
    small = rows.select("k").distinct().where("k <> 'k1'").withColumn(
        "v", F.length("k"))
    for how in ("left", "left_semi", "left_anti"):
        want = sorted(map(tuple, rows.join(small, "k", how).collect()), key=str)
        for hot in (["hot"], [], None):
            got = spread_join(rows, small, "k", F.col("id"), how, 8, hot)
            assert sorted(map(tuple, got.collect()), key=str) == want
            assert got.columns == rows.join(small, "k", how).columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Generate" not in plan_of(spread_join(rows, small, "k", F.col("id"), "left", 8, []))
        assert "Generate" in plan_of(spread_join(rows, small, "k", F.col("id"), "left", 8, ["hot"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_named_batch_done_again_is_stored_once(spark, registry, tmp_path):
    from sluice.sources.lake import scan_lake
    from tests.test_validation import GOOD
    recs = records(spark, [event_json("A", "1", payload=GOOD), event_json("X", "1"), "{bad"])
    control = records(spark, [control_json("A", ["1"])])
    root = str(tmp_path / "lake")
    for _ in range(2):
        ingest.ingest(recs, control, root, registry, "2024-01-05T07:08:09.000Z", 0, CFG, name="monday")
    assert scan_lake(spark, root).count() == 1
    assert spark.read.parquet(f"{root}/dlq").count() == 1 and spark.read.parquet(f"{root}/retry").count() == 1


def test_a_registry_of_great_size_is_not_broadcast(spark, registry):
    from dataclasses import replace

    events = spark.range(3).select(
        *[F.lit("x").alias(c) for c in EVENT_FIELDS if c not in ("schema_id", "payload")],
        F.when(F.col("id") < 2, "tpch_orders_v1").otherwise("x").alias("schema_id"), F.lit("{}").alias("payload"), F.col("id").alias("arrival"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = plan_of(verdict.validate(events, registry, "2024-01-05T07:08:09.000Z", CFG))
        large = plan_of(verdict.validate(events, replace(registry, size=1 << 30), "2024-01-05T07:08:09.000Z", CFG))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert registry.size > 500 and "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


def test_what_grows_with_the_events_is_not_broadcast(spark, registry, monkeypatch):
    """However short the files it is staged in: the optimizer would take these for small."""
    from sluice.functions import joins
    from sluice.operators import intake
    from sluice.spec import ORDERS

    monkeypatch.setattr(joins, "BROADCAST_ROWS", 100)
    rows = stage(spark.range(1000).select(
        F.col("id").alias("o_orderkey"), F.lit(1.0).alias("o_totalprice"), F.lit("f").alias("_row_file"),
        F.col("id").alias("_row_index"), F.col("id").alias("arrival")), "rows")
    made = ingest.validated_table(rows, ORDERS, registry, "2024-06-01T00:00:00Z", "2024-06-01T05:00:00Z", CFG)
    plan = plan_of(made)
    assert "SortMergeJoin [arrival" in plan and "BroadcastHashJoin [arrival" not in plan
    assert made.count() == 1000
    keys = stage(rows.select(
        "arrival", F.lit(True).alias("readable"), F.col("o_orderkey").cast("string").alias("dedup_key"),
        F.lit("A").alias("trade_group_id"), F.lit("1").alias("trade_id"), F.lit(0).alias("attempt_count")), "keys")
    control = ingest.control_table(records(spark, [control_json("A", ["1"])]))
    for hot in ([], ["7"]):
        monkeypatch.setattr(intake, "hot_keys", lambda df, key, hot=hot: hot)
        plan = plan_of(intake.decide(keys, control, CFG, hot=[]))
        assert "SortMergeJoin [dedup_key" in plan and "BroadcastHashJoin [dedup_key" not in plan
    plan = plan_of(intake.deduplicate(keys, "dedup_key"))
    assert "SortMergeJoin [arrival" in plan
