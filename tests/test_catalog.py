"""Registered queries against their SQL on the smallest tables, and the shape of important plans."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, rows_of  # noqa: E402

SAMPLE = [
    "flagship_distressed_firms", "d1_keep_latest", "d8_second_latest", "f9_active_firms", "j2_quarter_join", "r1_pivot_tags", "w8_fill_both_ways",
    "w9_fill_by_date", "w11_size_ntile", "h11_label", "h14_amendment_refresh", "g17_strongest_pairs", "g19_five_numbers_lineitem", "n5_best_threshold",
    "n9_slice_performance", "q2_iqr_anomalies", "s3_psi_events", "s14_drift_decision", "l3_scale", "b1_flatten_facts", "b2_zip_filings", "v4_watchlist",
    "v8_trend", "x1_land_latest", "x3_downsample", "a14_replace_partitions",
]


@pytest.fixture(scope="module")
def oracle(small):
    base = duckdb.connect()
    for t in TABLES:
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return base


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, oracle, small, name):
    df = entry.queries()[name](spark, small)
    cursor = oracle.execute(entry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def plan_of(spark, small, name):
    return entry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["d1_keep_latest", "h11_label", "r1_pivot_tags", "j1_facts_macro", "b1_flatten_facts", "v1_alerts", "v2_history", "w8_fill_both_ways"])
def test_no_single_task_no_python_no_cross_join(spark, small, name):
    plan = plan_of(spark, small, name)
    for shape in ("SinglePartition", "Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert shape not in plan, shape


def test_scan_reads_only_needed_columns(spark, small):
    plan = plan_of(spark, small, "f6_threshold")
    assert "o_orderdate" not in plan.split("ReadSchema")[1].split("\n")[0]
    before = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    pruned = plan_of(spark, small, "a12_pruned_scan")
    spark.conf.set("spark.sql.maxMetadataStringLength", before)
    assert "GreaterThan(o_totalprice,400000" in pruned


def test_results_do_not_depend_on_partitioning(spark, small):
    name = "n9_slice_performance"
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for parts in ("1", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        seen.append(sorted(map(str, entry.queries()[name](spark, small).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1]


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 10


def test_balance_checks_send_the_ranges_to_the_rows(spark, small):
    """Joined by label the rows would meet in two tasks."""
    plan = plan_of(spark, small, "l5_balance_checks")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
