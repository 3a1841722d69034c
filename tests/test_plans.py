"""Plan shapes that matter at scale: pushdown, hash aggregation, no cross joins."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_report_dates_reach_the_scan(spark):
    p = plan(spark, "mrt06_top_gainers")
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_shipdate" in p


@pytest.mark.parametrize("name", ["agg05_bars_from_ticks_5m", "agg01_bars_1h", "agg04_calendar_month", "agg20_flow_surface_day", "agg18_skew_25d", "mrt02_year_highs"])
def test_rollups_are_hash_aggregates(spark, name):
    p = plan(spark, name)
    assert "HashAggregate" in p and "SortAggregate" not in p


def test_scan_reads_only_used_columns(spark):
    p = plan(spark, "agg17_atm_iv_delta")
    schema = p[p.index("ReadSchema"):]
    assert "l_extendedprice" not in schema and "l_partkey" not in schema


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(("join", "mrt", "prj", "agg1", "agg2", "win0", "sig0"))))
def test_no_cross_joins(spark, name):
    p = plan(spark, name)
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p
