"""Newest versions, group maxima, NULL-skipping latest values, period dedup, joins, quality rules."""

import datetime as dt

from pyspark.sql import functions as F

from finlake.operators import dedup, joins, pivots, quality
from finlake.plans import fundamentals as fun
from tests.conftest import rows


def test_latest_version_is_idempotent(spark):
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, v int, x string")
    once = dedup.latest_version(d, "k", "v")
    assert rows(once) == [(1, 2, "b"), (2, 1, "c")] == rows(dedup.latest_version(once, "k", "v")) == rows(dedup.merge_latest(once, d, "k", "v"))


def test_latest_version_prunes_before_the_shuffle(spark):
    d = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup.latest_version(d, "k", "v")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_at_group_max_keeps_ties(spark):
    d = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("a", 2, 3), ("b", 1, 4)], "k string, t int, x int")
    assert rows(dedup.at_group_max(d, "k", "t"), "x") == [(2,), (3,), (4,)]


def test_latest_non_null_skips_null_newest(spark):
    d = spark.createDataFrame([("a", 1, 10.0, 5.0), ("a", 2, None, 6.0), ("b", 1, None, 1.0)], "k string, t int, x double, y double")
    assert rows(pivots.latest_non_null(d, ["x", "y"], "t", "k"), "k", "t", "x", "y") == [("a", 2, 10.0, 6.0), ("b", 1, None, 1.0)]


def test_original_statement_beats_amendment(spark):
    d = spark.createDataFrame([
        ("1", "2023-12-31", "FY", "10-K", "2024-02-01", 1), ("1", "2023-12-31", "FY", "10-K/A", "2024-06-01", 2),
        ("2", "2023-12-31", "FY", "10-K/A", "2024-03-01", 3), ("2", "2023-12-31", "FY", "10-K/A", "2024-05-01", 4)],
        "cik string, period_end string, fiscal_period string, form_type string, filed_date string, x int")
    assert rows(dedup.dedup_periods(d), "cik", "x") == [("1", 1), ("2", 4)]


def test_offset_join_needs_exact_days(spark):
    day = lambda n: dt.date(2024, 1, n)
    d = spark.createDataFrame([("a", day(1), 1.0), ("a", day(8), 2.0), ("a", day(15), 3.0), ("a", day(16), 4.0)], "k string, d date, v double")
    assert rows(joins.offset_join(d, "k", "d", "v", {"b": -7, "f": 7})) == [("a", day(8), 2.0, 1.0, 3.0)]


def test_interpolation_bracket(spark):
    d = spark.createDataFrame([("a", 0.2, 10.0), ("a", 0.4, 20.0), ("b", 0.25, 5.0), ("c", 0.5, 1.0)], "k string, x double, y double")
    got = {r.k: r.o for r in joins.interpolate_at(d, "k", "x", "y", 0.25, "o").collect()}
    assert abs(got["a"] - 12.5) < 1e-12 and got["b"] == 5.0 and got["c"] is None


def test_pending_months_redo_only_newest(spark):
    grid = spark.createDataFrame([("A", m) for m in (1, 2, 3)] + [("B", m) for m in (1, 2, 3)], "ticker string, month int")
    done = spark.createDataFrame([("A", 1, "ok"), ("A", 2, "failed"), ("A", 3, "ok"), ("B", 1, "empty")], "ticker string, month int, status string")
    assert rows(quality.pending_months(grid, done, 3), "ticker", "month") == [("A", 3), ("B", 2), ("B", 3)]


def test_quote_rules(spark):
    d = spark.createDataFrame([("A", (1.0, 1.1, 1.0)), ("A", (1.2, 1.1, 1.0)), (None, (1.0, 1.1, 1.0)), ("A", (1.0, 1.1, 20000.0)), ("A", (0.0, 1.1, 0.0))],
                              "ticker string, quote struct<bid:double,ask:double,last:double>")
    good, bad = quality.split_valid(d, quality.quote_rules())
    assert good.count() == 2
    assert sorted(r.reasons[0] for r in bad.collect()) == ["crossed", "missing_field", "price_range"]


def test_full_merge_keeps_all_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "d int, a double")
    b = spark.createDataFrame([(2, 20.0), (3, 30.0)], "d int, b double")
    assert rows(pivots.full_merge([a, b], "d")) == [(1, 1.0, None), (2, 2.0, 20.0), (3, None, 30.0)]


def test_dilution_falls_back_to_annual(spark):
    from finlake.functions.lookups import CONCEPTS
    cols = ["shares_outstanding", "weighted_avg_shares_diluted", "weighted_avg_shares_basic", "stock_based_compensation", "revenue", "shares_authorized", "antidilutive_shares"]
    assert set(cols) <= set(CONCEPTS)
    mk = lambda t, p: (t, dt.date(2024, 3, 31), "2024", p, None, 110.0, 100.0, 1.0, 50.0, 500.0, 1e9)
    d = spark.createDataFrame([mk("A", "Q1"), mk("A", "FY"), mk("B", "FY")], "ticker string, period_end date, fiscal_year string, fiscal_period string, " + ", ".join(f"{c} double" for c in cols))
    assert rows(fun.dilution_series(d), "ticker", "fiscal_period", "shares_outstanding") == [("A", "Q1", 110.0), ("B", "FY", 110.0)]


def test_observations_are_lenient(spark):
    raw = spark.createDataFrame([("DGS1", "2024-01-01", "4.5"), ("DGS1", "2024-01-02", "."), ("DGS2", "2024-02", "3"), ("DGS2", "bad", "3"), ("ZZZ", "2024-01-01", "1")], "series_id string, date string, value string")
    from finlake.sources.series import wide_table
    out = wide_table(raw, "treasury_yields")
    assert rows(out, "date", "yield_1_year", "yield_2_year") == [(dt.date(2024, 1, 1), 4.5, None), (dt.date(2024, 2, 1), None, 3.0)]
    assert len(out.columns) == 8
