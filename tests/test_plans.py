"""Physical-plan checks: pruning, pushdown, partial aggregation, no
nested-loop joins."""

import re

import pytest

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def queries():
    import __spark_entry__ as e
    return e.queries()


def plan(spark, queries, name):
    p = queries[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", p)


@pytest.mark.parametrize("name", ["ag06_risk_profile", "m05_cdc_transactions", "m07_at", "j06_metered_usage",
                                  "l05_global_metrics", "j07_watchlist", "l04_class_metrics"])
def test_no_nested_loop_join(spark, queries, name):
    p = plan(spark, queries, name)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p


def test_csv_scan_prunes_columns_and_aggregates_partially(spark, queries):
    p = plan(spark, queries, "ag01_group_two_keys")
    assert "FileScan csv [c_first_name,c_last_name]" in p
    assert "partial_count" in p


def test_parquet_filters_pushed(spark, queries):
    p = plan(spark, queries, "s06_parquet_scan")
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_returnflag), GreaterThanOrEqual(l_shipdate" in p


def test_latest_per_key_is_partial_aggregate(spark, queries):
    p = plan(spark, queries, "m07_at")
    assert "partial_max" in p and "Window" not in p


def test_top1_is_take_ordered(spark, queries):
    assert "TakeOrderedAndProject" in plan(spark, queries, "o02_best_named")
