"""Work per row of parsing, deciding and choosing rows, told by plans."""
import re
from pathlib import Path
from urllib.parse import unquote, urlparse

from pyspark.sql import functions as F

from sluice.operators import intake, verdict
from sluice.plans import ingest
from sluice.session import stage
from sluice.sources import tables
from sluice.spec import LINEITEM, PipelineConfig
from tests.conftest import control_json, event_json, records

CFG = PipelineConfig()
AT = "2024-01-05T07:08:09.000Z"


def plan_of(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def longest_method(df):
    text = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        df._jdf.queryExecution(), "codegen")
    return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text)), default=0)


def test_parsing_runs_in_methods_the_jvm_compiles(spark):
    recs = stage(records(spark, [event_json("G", "1"), event_json("G", "1", event_id={"x": 1})]), "recs")
    assert 0 < longest_method(intake.event_keys(intake.parse_events(recs), CFG)) < 8000


def test_nested_texts_are_told_from_texts_with_brackets(spark):
    values = [event_json("G", "1", source=["x"]), event_json("G", "1", source="[x"),
              event_json("G", "1", source="{", trace_id={"a": 1}), event_json("G", "{1}", payload={"a": [1]})]
    got = intake.parse_events(records(spark, values)).orderBy("arrival").select(F.col("env").isNotNull()).collect()
    assert [r[0] for r in got] == [False, True, False, True]


def test_decisions_move_rows_by_key_only(spark):
    keys = stage(intake.event_keys(intake.parse_events(records(spark, [event_json("G", "1")])), CFG), "keys")
    docs = stage(ingest.control_table(records(spark, [control_json("G", ["1"])])), "docs")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(intake.decide(keys, docs, CFG, hot=[]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(dedup_key" in plan and "hashpartitioning(arrival" not in plan


def test_rows_are_chosen_before_they_are_made_events(spark, registry, tmp_path):
    spark.range(2_000).select(
        F.concat(F.col("id") - F.when(F.col("id") == 700, 1).otherwise(0), F.lit("-1")).alias("line_item_id"),
        F.col("id").alias("l_orderkey"), F.lit(2.0).alias("l_quantity")).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = tables.read_numbered(spark, str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = ingest.validated_table(rows, LINEITEM, registry, AT, AT, CFG)
        lines = plan_of(out).split("== Initial Plan ==")[-1].split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(arrival" in line]
    assert moved and not any("payload" in line for line in moved)
    # The second group holds an id twice, so it fails as a whole; the other three are whole.
    assert out.count() == 1_500 and out.select("trade_group_id").distinct().count() == 3
    sent = ingest.publish.publish(rows, LINEITEM, AT)
    whole = ingest.whole_groups(sent.events, ingest.control_table(sent.control), CFG)
    want = verdict.validate(whole, registry, AT, CFG).drop("violations", "rule_results").select(*out.drop(
        "violations", "rule_results").columns)
    assert out.drop("violations", "rule_results").exceptAll(want).isEmpty() and want.count() == 1_500


def test_rows_of_a_group_are_dealt_out_together(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "TASK_BYTES", 16 * 1024)
    spark.range(20_000).select(F.rand(3).alias("x")).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = tables.read_numbered(spark, str(tmp_path / "t"), min_tasks=2)
    placed = rows.select(F.spark_partition_id().alias("p"), F.expr("_row_index div 500").alias("g")).distinct()
    assert rows.rdd.getNumPartitions() > 2 and placed.count() == 40 and placed.select("p").distinct().count() > 2


def test_tables_between_steps_are_packed_tightly(spark, registry, tmp_path):
    from sluice.plans.runs import ingest_run
    ids = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("x"))
    size = sum(p.stat().st_size for p in _files(stage(ids, "ids")))
    assert size < 0.75 * 64 * 20_000
    ingest_run(records(spark, [event_json("A", "1")]), records(spark, [control_json("A", ["1", "2"])]), str(tmp_path),
               registry, AT, 1_704_067_200_000, CFG, "r1")
    left = list((tmp_path / "_runs" / "r1" / "open" / "events").glob("*.parquet"))
    assert left and all(".zstd." in p.name for p in left)


def _files(df):
    return [Path(unquote(urlparse(f).path)) for f in df.inputFiles()]


def test_sides_that_choose_payloads_are_staged(spark, registry, tmp_path):
    """Their sizes are known then, so a small one is sent to the payloads and none of these moves."""
    from sluice.plans.runs import ingest_run
    from sluice.session import run_dir
    result = ingest_run(records(spark, [event_json("A", "1"), event_json("X", "1")]),
                        records(spark, [control_json("A", ["1", "2"])]), str(tmp_path),
                        registry, AT, 1_704_067_200_000, CFG, "r1")
    names = {p.name.split("-")[0] for p in Path(run_dir(spark, result.run)).iterdir()}
    assert {"accepted", "open", "due"} <= names
    assert result.validated.isEmpty()
    assert spark.read.parquet(f"{tmp_path}/_runs/r1/open/retries").count() == 1
