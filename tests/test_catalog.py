from pathlib import Path

import pytest

import __spark_entry__ as contract
from catalog.check import compare, connect
from catalog.oracles import ORACLES
from catalog.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {"file_stats"}

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables here")


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    got = contract.entry(spark).collect()
    assert [(r.schema_id, r.validation_status, r.mean_score, r.drifted) for r in got] == [
        ("tpch_orders_v1", "PASSED", 1.0, 0)]


@pytest.mark.parametrize("name", [
    "column_aliases", "row_groups_lineitem", "sha_fallback_keys", "dedup_lineitem",
    "intake_outcomes", "group_status_lineitem", "drift_summary", "quality_score_banking",
    "query_page", "error_class", "query_deep_page", "query_result", "filter_errors", "file_records",
    "file_fill", "iso_times", "stream_outcomes", "stream_late", "stream_counters"])
def test_query_agrees_with_its_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) is None
