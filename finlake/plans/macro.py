"""Macro marts over wide tables (one row per date, one column per series)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import bands
from finlake.operators.asof import asof_join
from finlake.operators.joins import month_join, month_mean
from finlake.operators.pivots import unpivot_columns
from finlake.operators.returns import change, log_return, rolling_vol

MATURITIES = {
    "yield_1_month": "1M", "yield_3_month": "3M", "yield_1_year": "1Y", "yield_2_year": "2Y", "yield_5_year": "5Y",
    "yield_10_year": "10Y", "yield_30_year": "30Y",
}


def macro_series(table: DataFrame, start=None, end=None, day: str = "date") -> DataFrame:
    """Rows of a wide table in a date range."""
    if start is not None:
        table = table.filter(F.col(day) >= start)
    if end is not None:
        table = table.filter(F.col(day) <= end)
    return table


def yield_curve(yields: DataFrame, dates: DataFrame, tolerance_days: int = 36_500) -> DataFrame:
    """(requested, date, maturity, yield) of the latest curve on or before each date.

    ``dates`` has one DATE column ``requested``; all dates are answered by one as-of join.
    """
    have = {c: m for c, m in MATURITIES.items() if c in yields.columns}
    d = asof_join(dates, yields.select("date", *have), "requested", "date", tolerance_days)
    return unpivot_columns(d.filter(F.col("date").isNotNull()), ["requested", "date"], have, "maturity", "yield", keep_null=True)


def curve_history(yields: DataFrame, start: Column) -> DataFrame:
    d = yields.filter((F.col("date") >= start) & F.col("yield_1_year").isNotNull())
    return d.select(
        "date", F.round("yield_1_year", 2).alias("y1"), F.round("yield_5_year", 2).alias("y5"), F.round("yield_10_year", 2).alias("y10"),
        F.round(F.col("yield_10_year") - F.col("yield_1_year"), 2).alias("spread_1s10s"))


def real_yield(yields: DataFrame, expectations: DataFrame, start: Column) -> DataFrame:
    """Nominal ten-year yield minus expected inflation of the month."""
    y = yields.filter((F.col("date") >= start) & F.col("yield_10_year").isNotNull()).select("date", "yield_10_year")
    e = expectations.filter(F.col("market_10_year").isNotNull()).select(F.col("date").alias("month"), "market_10_year")
    d = month_join(y, e, "date", "month")
    return d.select(
        "date", F.round("yield_10_year", 2).alias("nominal_10y"), F.round("market_10_year", 2).alias("breakeven_10y"),
        F.round(F.col("yield_10_year") - F.col("market_10_year"), 2).alias("real_yield_10y"))


def curve_vs_jobs(yields: DataFrame, labor: DataFrame, start: Column) -> DataFrame:
    """2s10s spread next to the unemployment rate of the month."""
    y = yields.filter((F.col("date") >= start) & F.col("yield_10_year").isNotNull() & F.col("yield_2_year").isNotNull())
    y = y.select("date", (F.col("yield_10_year") - F.col("yield_2_year")).alias("spread_2s10s"))
    jobs = labor.select(F.col("date").alias("month"), "unemployment_rate")
    return month_join(y, jobs, "date", "month")


def macro_dashboard(labor: DataFrame, inflation: DataFrame, expectations: DataFrame, yields: DataFrame,
                    daily: DataFrame, tickers: tuple[str, ...], start: Column) -> DataFrame:
    """One row per month: jobs, prices, expectations, yields and mean closes of some tickers."""
    base = labor.filter((F.col("date") >= start) & F.col("unemployment_rate").isNotNull())
    base = base.select(F.col("date").alias("month"), F.col("unemployment_rate").alias("unemp"))
    price = inflation.select(F.col("date").alias("month"), F.round("cpi", 1).alias("cpi"))
    exp = expectations.select(F.col("date").alias("month"), F.round("model_1_year", 1).alias("infl_exp_1y"))
    y = month_mean(yields, "date", ["yield_10_year", "yield_1_year"])
    y = y.select("month", F.round("yield_10_year", 2).alias("y10"), F.round(F.col("yield_10_year") - F.col("yield_1_year"), 2).alias("curve_1s10s"))
    close = daily.filter(F.col("ticker").isin(*tickers)).groupBy(F.trunc("day", "month").alias("month")).agg(
        *[F.round(F.avg(F.when(F.col("ticker") == t, F.col("close"))), 0).alias(f"avg_{i}") for i, t in enumerate(tickers)])
    for side in (price, exp, y, close):
        base = base.join(side, "month", "left")
    return base


def regime_dashboard(vol_prices: DataFrame, yields: DataFrame, inflation: DataFrame, labor: DataFrame, start: Column) -> DataFrame:
    """Monthly volatility, curve, price and jobs regimes.

    Each input is reduced to one row per month before the join, so days are not
    multiplied.  ``vol_prices`` holds (day, close) of one volatility proxy.
    """
    r = log_return(vol_prices.select("day", "close"), None, "day")
    v = rolling_vol(r, None, "day", "ret", 21).filter(F.col("day") >= start)
    v = v.groupBy(F.trunc("day", "month").alias("month")).agg((F.avg("vol") * 100).alias("vol"))
    c = yields.filter(F.col("yield_10_year").isNotNull() & F.col("yield_1_year").isNotNull())
    c = month_mean(c.withColumn("spread", F.col("yield_10_year") - F.col("yield_1_year")), "date", ["spread"])
    i = change(inflation.filter(F.col("cpi").isNotNull()).select("date", "cpi"), None, "date", "cpi", 12, "cpi_change")
    i = i.groupBy(F.trunc("date", "month").alias("month")).agg(F.max("cpi_change").alias("cpi_change"))
    j = change(labor.filter(F.col("unemployment_rate").isNotNull()).select("date", "unemployment_rate"), None, "date", "unemployment_rate", 6, "delta")
    j = j.groupBy(F.trunc("date", "month").alias("month")).agg(F.max("unemployment_rate").alias("unemployment"), F.max("delta").alias("delta"))
    d = v.join(c, "month", "left").join(i, "month", "left").join(j, "month", "left")
    above = lambda c, *steps: bands(-F.col(c), [(-x, label) for x, label in steps[:-1]], steps[-1])
    return d.select(
        "month", F.round("vol", 1).alias("vol"), bands("vol", [(15, "calm"), (25, "normal"), (40, "elevated")], "crisis").alias("vol_regime"),
        F.round("spread", 2).alias("spread"), bands("spread", [(-0.5, "deep_inverted"), (0, "inverted"), (1, "flat")], "steep").alias("curve_regime"),
        F.round("cpi_change", 1).alias("cpi_change"), above("cpi_change", (15, "hot"), (8, "warm"), (0, "stable"), "deflation").alias("price_regime"),
        F.round("unemployment", 1).alias("unemployment"), above("delta", (0.5, "deteriorating"), (0, "softening"), "strong").alias("jobs_regime"))

