import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import report, verdict
from sluice.plans import query
from sluice.plans.query import QueryError, QueryFilter, run_query
from sluice.sources.lake import records_per_file, record_bytes, scan_lake, write_lake
from sluice.spec import EVENT_FIELDS, PipelineConfig
from tests.test_validation import GOOD

CFG = PipelineConfig()


@pytest.fixture(scope="module")
def lake(spark, registry, tmp_path_factory):
    """2,000 events of four hours; every 50th has no good date and status."""
    root = str(tmp_path_factory.mktemp("lake"))
    bad = json.dumps({**GOOD, "transaction_date": "x", "transaction_status": "x", "balance": -1})
    made = {
        "event_id": F.sha2(F.col("id").cast("string"), 256),
        "schema_id": F.lit("banking_transaction_v1"),
        "source": F.when(F.col("id") % 2 == 0, "cloud").otherwise("branch"),
        "payload": F.when(F.col("id") % 50 == 0, bad).otherwise(json.dumps(GOOD)),
    }
    events = spark.range(2000).select(
        *[made.get(c, F.col("id").cast("string")).alias(c) for c in EVENT_FIELDS],
        F.col("id").alias("arrival"),
        F.format_string("2024-01-05T%02d:00:%02d.000Z", (F.col("id") % 4 + 6).cast("int"),
                        (F.col("id") % 60).cast("int")).alias("_at"))
    validated = verdict.validate(events, registry, F.col("_at"), CFG)
    write_lake(verdict.passed(validated), root, "data", CFG)
    write_lake(verdict.quarantined(validated), root, "/quarantine/", CFG)
    return root


def test_split_and_layout(spark, lake):
    assert scan_lake(spark, lake).count() == 1960
    assert scan_lake(spark, lake, "quarantine").count() == 40
    assert len(scan_lake(spark, lake).columns) == 28
    parts = report.partition_stats(scan_lake(spark, lake)).collect()
    assert len(parts) == 4 and "year=2024/month=01/day=05/hour=06/source=cloud" in {
        p.partition for p in parts}


def test_filters_prune_folders(spark, lake):
    flt = QueryFilter(hour=7, source="branch", additional_where="quality_score >= 0.5")
    plan = query.filtered(scan_lake(spark, lake), flt)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hour" in plan
    assert "GreaterThanOrEqual(quality_score,0.5)" in plan


def test_query_result(spark, lake):
    got = run_query(spark, lake, QueryFilter(year=2024, month=1, day=5, hour=6, page=2, page_size=100))
    assert (got.total_rows, got.returned_rows, got.page, got.page_size, got.total_pages) == (
        480, 100, 2, 100, 5)
    assert got.engine == "spark" and len(got.columns) == 28
    assert got.scanned_path.endswith("data/year=2024/month=01/day=05/hour=06")
    assert all(r["hour"] == 6 and r["source"] == "cloud" for r in got.rows)


def test_pages_are_disjoint_and_complete(spark, lake):
    seen = []
    for n in range(1, 5):
        seen += [r["event_id"] for r in run_query(spark, lake, QueryFilter(page=n, page_size=600)).rows]
    assert len(seen) == len(set(seen)) == 1960


def test_empty_result(spark, lake):
    got = run_query(spark, lake, QueryFilter(year=2030))
    assert (got.total_rows, got.rows, got.total_pages) == (0, [], 1)
    assert run_query(spark, lake, QueryFilter(page=1000)).rows == []


def test_predicate_is_bracketed(spark, lake):
    got = query.count_rows(scan_lake(spark, lake), QueryFilter(
        hour=6, additional_where="source = 'cloud' OR source = 'branch'")).first()
    assert got.total_rows == 480


@pytest.mark.parametrize("bad", ["no_such_column = 1", "1 = 1; DROP TABLE x", "((("])
def test_bad_predicate(spark, lake, bad):
    with pytest.raises(QueryError):
        run_query(spark, lake, QueryFilter(additional_where=bad))


def test_deep_pages_equal_plain_ones(spark, lake, monkeypatch):
    rows = scan_lake(spark, lake)
    for n in (2, 20, 39, 40, 41):
        flt = QueryFilter(page=n, page_size=49)
        plain = [r.event_id for r in rows.orderBy(*query.ORDER).offset(flt.offset).limit(49).collect()]
        monkeypatch.setattr(query, "PLAIN_OFFSET", 5)
        assert [r.event_id for r in query.page(rows, flt).collect()] == plain


def test_deep_pages_with_mixed_offsets(spark, monkeypatch):
    """Intake times with an offset sort as text on shallow and deep pages alike."""
    times = ["2024-06-01T05:00:00Z", "2024-06-01T23:30:00-05:00", "2024-06-02T01:00:00+09:00"]
    rows = spark.createDataFrame(
        [(times[i % 3], f"e{i:04d}", 2024, 6, 1 + i % 2, i % 24, "s") for i in range(300)],
        "ingestion_time string, event_id string, year int, month int, day int, hour int, source string")
    whole = [r.event_id for r in rows.orderBy(*query.ORDER).collect()]
    monkeypatch.setattr(query, "PLAIN_OFFSET", 20)
    got = []
    for n in range(1, 8):
        got += [r.event_id for r in query.page(rows, QueryFilter(page=n, page_size=50)).collect()]
    assert got == whole


def test_file_sizing(spark, lake, tmp_path):
    assert records_per_file(200.0, CFG) == 167_772
    assert records_per_file(1.0, CFG) == 200_000
    assert records_per_file(1e12, CFG) == 1
    assert record_bytes(spark, str(tmp_path), "data", CFG) == 200.0
    assert 10 < record_bytes(spark, lake, "data", CFG) < 5000


def test_record_limit_bounds_files(spark, registry, lake, tmp_path):
    small = PipelineConfig(max_records_per_file=300)
    stored = scan_lake(spark, lake).where("hour = 6")
    events = stored.select(
        *[(F.col("payload_json") if c == "payload" else F.col(c)).alias(c) for c in EVENT_FIELDS],
        F.monotonically_increasing_id().alias("arrival"))
    again = verdict.validate(events, registry, "2024-01-05T06:00:00.000Z", small)
    write_lake(again, str(tmp_path), "data", small)
    per_file = report.files(scan_lake(spark, str(tmp_path)))
    assert per_file.agg(F.max("records")).first()[0] <= 300
    stats = report.file_stats(scan_lake(spark, str(tmp_path))).first()
    assert stats.records == 480 and stats.files >= 2
