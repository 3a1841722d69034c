"""Equity marts over daily bars (ticker, day, open, high, low, close, volume, vwap).

``as_of`` is a DATE column, usually a literal or the scalar ``max(day)`` of the base table;
day counts are calendar days.  Windows per ticker run on day grain only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import (
    beta as beta_of, count_if, latest, pct_change, pct_of, safe_corr, safe_div, sector_from_code,
)
from finlake.operators.bars import ohlcv_bars, period_return, weekly_returns
from finlake.operators.dedup import top_k_per
from finlake.operators.pairs import corr_matrix
from finlake.operators.returns import log_return, newest_two, simple_return


def recent(df: DataFrame, as_of: Column, days: int, day: str = "day") -> DataFrame:
    return df.filter((F.col(day) >= F.date_sub(as_of, days)) & (F.col(day) <= as_of))


# ---- bars -------------------------------------------------------------------------

def bars(base: DataFrame, tickers: Sequence[str], grain: str, start=None, end=None, ts: str = "timestamp") -> DataFrame:
    """Bars of some tickers at any grain; filters are applied to the base rows first."""
    d = base.filter(F.col("ticker").isin(*tickers))
    if start is not None:
        d = d.filter(F.col(ts) >= start)
    if end is not None:
        d = d.filter(F.col(ts) < end)
    return d if grain == "1m" else ohlcv_bars(d, "ticker", ts, grain)


def sparklines(daily: DataFrame, tickers: Sequence[str], as_of: Column, days: int = 30) -> DataFrame:
    """Per ticker the closes of the last ``days``, oldest first (at most ``days + 1`` points)."""
    d = recent(daily.filter(F.col("ticker").isin(*tickers)), as_of, days)
    points = F.array_sort(F.collect_list(F.struct("day", "close")))
    return d.groupBy("ticker").agg(F.transform(points, lambda p: p["close"]).alias("closes"))


def latest_prices(daily: DataFrame, tickers: Sequence[str] | None = None) -> DataFrame:
    d = daily if tickers is None else daily.filter(F.col("ticker").isin(*tickers))
    d = newest_two(d.select("ticker", "day", "close", "volume"), "ticker", "day", "close")
    change = F.when(F.col("prev_close") > 0, pct_change("close", "prev_close")).otherwise(0.0)
    return d.withColumn("change_pct", change)


# ---- universe ---------------------------------------------------------------------

def universe_filter(u: DataFrame, sector: str | None = None, exchange: str | None = None, type: str | None = None,
                    active: bool | None = None, min_cap: float | None = None, max_cap: float | None = None) -> DataFrame:
    for name, value in (("sector", sector), ("exchange", exchange), ("type", type), ("active", active)):
        if value is not None:
            u = u.filter(F.col(name) == value)
    if min_cap is not None:
        u = u.filter(F.col("market_cap") >= min_cap)
    if max_cap is not None:
        u = u.filter(F.col("market_cap") <= max_cap)
    return u


def search(u: DataFrame, text: str, limit: int = 20) -> DataFrame:
    """Ticker prefix or name substring; exact ticker first, then prefix, then name; large companies first."""
    q = text.upper()
    t, n = F.col("ticker"), F.upper("name")
    rank = F.when(t == q, 0).when(t.startswith(q), 1).otherwise(2)
    d = u.filter(t.startswith(q) | n.contains(q)).withColumn("rank", rank)
    return d.orderBy("rank", F.desc_nulls_last("market_cap"), "ticker").limit(limit)


def sector_summary(u: DataFrame) -> DataFrame:
    return u.groupBy("sector").agg(F.count(F.lit(1)).alias("count"), F.sum("market_cap").alias("total_market_cap"))


# ---- movers and breadth -----------------------------------------------------------

def _last_day_moves(daily: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    d = recent(daily, as_of, days).select("ticker", "day", "close", "volume")
    d = simple_return(d, "ticker", "day", out="_pct")
    d = d.filter((F.col("day") == as_of) & (F.col("prev_close") > 0))
    return d.select("ticker", "close", F.round("_pct", 2).alias("change_pct"), "volume")


def top_movers(daily: DataFrame, universe: DataFrame, as_of: Column, direction: str = "gainers", limit: int = 10) -> DataFrame:
    order = F.desc("change_pct") if direction == "gainers" else F.asc("change_pct")
    top = _last_day_moves(daily, as_of).orderBy(order, "ticker").limit(limit)
    return top.join(universe.select("ticker", "name"), "ticker", "left")


def most_active(daily: DataFrame, universe: DataFrame, as_of: Column, limit: int = 10) -> DataFrame:
    top = _last_day_moves(daily, as_of).orderBy(F.desc("volume"), "ticker").limit(limit)
    return top.join(universe.select("ticker", "name"), "ticker", "left")


def treemap(daily: DataFrame, universe: DataFrame, as_of: Column, min_cap: float) -> DataFrame:
    u = universe.filter((F.col("sic_code") != "") & (F.col("market_cap") >= min_cap))
    u = u.select("ticker", "name", sector_from_code("sic_code").alias("sector"), F.coalesce("market_cap", F.lit(0.0)).alias("market_cap"))
    return u.join(_last_day_moves(daily, as_of).drop("volume"), "ticker")


def screener(daily: DataFrame, universe: DataFrame, financials: DataFrame, as_of: Column) -> DataFrame:
    """Universe, latest price and the latest *reported* annual figures, column by column."""
    fy = financials.filter(F.col("fiscal_period") == "FY").groupBy("ticker").agg(
        *[latest(c, "period_end").alias(c) for c in ("revenue", "net_income", "gross_profit", "diluted_eps")])
    u = universe.filter(F.col("sic_code") != "").select(
        "ticker", "name", sector_from_code("sic_code").alias("sector"), "exchange", F.coalesce("market_cap", F.lit(0.0)).alias("market_cap"))
    d = u.join(_last_day_moves(daily, as_of), "ticker").join(fy, "ticker", "left")
    pos = F.col("revenue") > 0
    return d.select(
        "ticker", "name", "sector", "exchange", "market_cap", "close", "change_pct", "volume", "revenue", "net_income",
        F.when(pos, F.round(pct_of("gross_profit", "revenue"), 1)).alias("gross_margin"),
        F.when(pos, F.round(pct_of("net_income", "revenue"), 1)).alias("net_margin"),
        F.when(F.col("diluted_eps") > 0, F.round(safe_div("close", "diluted_eps"), 1)).alias("pe"))


def market_breadth(daily: DataFrame, as_of: Column) -> DataFrame:
    """Counts of rising, falling and unchanged tickers between their two newest days.

    The median buffer holds distinct percents rounded to two digits, so it stays small.
    """
    d = newest_two(recent(daily, as_of, 7).select("ticker", "day", "close"), "ticker", "day", "close")
    d = d.filter(F.col("prev_close") > 0).select(F.round(pct_change("close", "prev_close"), 2).alias("c"))
    return d.agg(
        count_if(F.col("c") > 0).alias("advancers"), count_if(F.col("c") < 0).alias("decliners"),
        count_if(F.col("c") == 0).alias("unchanged"), F.count(F.lit(1)).alias("total"),
        F.round(F.avg("c"), 2).alias("avg_change"), F.round(F.median("c"), 2).alias("median_change"))


def _year_range(daily: DataFrame, as_of: Column) -> DataFrame:
    year = daily.filter((F.col("day") >= F.date_sub(as_of, 252)) & (F.col("day") < F.date_sub(as_of, 1)))
    return year.groupBy("ticker").agg(F.max("close").alias("hi"), F.min("close").alias("lo"))


def year_extremes(daily: DataFrame, universe: DataFrame, as_of: Column, side: str = "high") -> DataFrame:
    """Tickers whose latest close is at or beyond the extreme of the past year.

    One conditional aggregate per ticker gives the latest close, the close before the last
    market day and the year's extreme; only named tickers are listed.
    """
    day, close = F.col("day"), F.col("close")
    newest = as_of
    in5, in10 = day >= F.date_sub(as_of, 5), (day >= F.date_sub(as_of, 10)) & (day < newest)
    in_year = (day >= F.date_sub(as_of, 252)) & (day < F.date_sub(as_of, 1))
    extreme = F.max if side == "high" else F.min
    g = recent(daily, as_of, 252).groupBy("ticker").agg(
        F.max_by(F.when(in5, close), F.when(in5, day)).alias("close"),
        F.max_by(F.when(in5, F.col("volume")), F.when(in5, day)).alias("volume"),
        F.max_by(F.when(in10, close), F.when(in10, day)).alias("_prev"),
        extreme(F.when(in_year, close)).alias("_limit"))
    hit = F.col("close") >= F.col("_limit") if side == "high" else F.col("close") <= F.col("_limit")
    g = g.filter(hit).join(universe.filter(F.col("name") != "").select("ticker", "name"), "ticker")
    return g.select("ticker", "name", "close", F.round(pct_change("close", "_prev"), 2).alias("change_pct"), "volume")


def hilo_counts(daily: DataFrame, as_of: Column) -> DataFrame:
    now = daily.filter(F.col("day") == as_of).select("ticker", "close")
    d = now.join(_year_range(daily, as_of), "ticker")
    return d.agg(count_if(F.col("close") >= F.col("hi")).alias("new_highs"),
                 count_if(F.col("close") <= F.col("lo")).alias("new_lows"), F.count(F.lit(1)).alias("total"))


def overnight_gaps(daily: DataFrame, as_of: Column, days: int = 30, pct: float = 2.0, limit: int | None = 30) -> DataFrame:
    d = recent(daily, as_of, days).select("ticker", "day", "open", "close")
    d = simple_return(d, "ticker", "day").withColumn("_gap", pct_change("open", "prev_close"))
    d = d.filter(F.abs("_gap") > pct)
    if limit:
        d = d.orderBy(F.abs("_gap").desc(), "ticker", "day").limit(limit)
    return d.select("ticker", "day", F.round("prev_close", 2).alias("prev_close"), F.round("open", 2).alias("open"),
                    F.round("_gap", 2).alias("gap_pct"))


# ---- sectors and momentum ---------------------------------------------------------

def sector_performance(daily: DataFrame, universe: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    r = period_return(recent(daily, as_of, days), "ticker", "day").filter(F.col("start_price") > 0)
    u = universe.filter(F.col("sic_code") != "").select("ticker", sector_from_code("sic_code").alias("sector"))
    return r.join(u, "ticker").groupBy("sector").agg(
        F.count(F.lit(1)).alias("ticker_count"), F.round(F.avg("return_pct"), 2).alias("avg_return_pct"))


def momentum_velocity(daily: DataFrame, tickers: Sequence[str], as_of: Column, weeks: int = 26) -> DataFrame:
    d = recent(daily.filter(F.col("ticker").isin(*tickers)), as_of, weeks * 7)
    return weekly_returns(d, "ticker", "day").select("ticker", "week", F.round("return_pct", 2).alias("return_pct"))


# ---- risk -------------------------------------------------------------------------

def _with_benchmark(daily: DataFrame, benchmark: str) -> DataFrame:
    """Log returns of every ticker next to the benchmark's return of the same day.

    The benchmark has one row per day.
    """
    r = log_return(daily.select("ticker", "day", "close"), "ticker", "day").filter(F.col("ret").isNotNull())
    b = daily.filter(F.col("ticker") == benchmark).select("ticker", "day", "close")
    b = log_return(b, "ticker", "day", out="bench").filter(F.col("bench").isNotNull()).select("day", "bench")
    return r.filter(F.col("ticker") != benchmark).join(b, "day")


def beta(daily: DataFrame, benchmark: str, as_of: Column, days: int = 252, min_days: int = 100) -> DataFrame:
    d = _with_benchmark(recent(daily, as_of, days), benchmark)
    g = d.groupBy("ticker").agg(
        F.round(beta_of("ret", "bench"), 3).alias("beta"), F.round(safe_corr("ret", "bench"), 3).alias("correlation"),
        F.round(F.stddev_pop("ret") * math.sqrt(252) * 100, 1).alias("annual_vol_pct"),
        F.count(F.lit(1)).alias("trading_days"))
    return g.filter(F.col("trading_days") > min_days)


def rotation(daily: DataFrame, tickers: Sequence[str], benchmark: str, as_of: Column, days: int = 60) -> DataFrame:
    d = recent(daily, as_of, days).filter(F.col("ticker").isin(*tickers, benchmark))
    g = _with_benchmark(d, benchmark).groupBy("ticker").agg(F.sum("ret").alias("_r"), F.sum("bench").alias("_b"))
    return g.select(
        "ticker", F.round(F.col("_r") * 100, 2).alias("total_return_pct"), F.round(F.col("_b") * 100, 2).alias("bench_return_pct"),
        F.round((F.col("_r") - F.col("_b")) * 100, 2).alias("relative_pct"),
        F.when(F.col("_r") > F.col("_b"), "outperform").otherwise("underperform").alias("vs_bench"))


def correlation_matrix(daily: DataFrame, tickers: Sequence[str], as_of: Column, days: int, on: str = "close") -> DataFrame:
    d = recent(daily, as_of, days).filter(F.col("ticker").isin(*tickers))
    if on == "returns":
        d, value = log_return(d.select("ticker", "day", "close"), "ticker", "day"), "ret"
    else:
        value = "close"
    return corr_matrix(d, "ticker", "day", value, tickers)


def realised_vol(daily: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    r = log_return(recent(daily, as_of, days).select("ticker", "day", "close"), "ticker", "day")
    return r.filter(F.col("ret").isNotNull()).groupBy("ticker").agg(
        F.round(F.stddev_pop("ret") * math.sqrt(252) * 100, 2).alias("volatility"))


def hourly_profile(minute: DataFrame, tickers: Sequence[str], hours: tuple[int, int] = (9, 16), ts: str = "timestamp") -> DataFrame:
    d = minute.filter(F.col("ticker").isin(*tickers) & F.hour(ts).between(*hours))
    return d.groupBy("ticker", F.hour(ts).alias("hour")).agg(F.avg("volume").alias("avg_volume"))


# ---- dividends --------------------------------------------------------------------

def dividend_changes(dividends: DataFrame, universe: DataFrame, as_of: Column, seq: str | None = None) -> DataFrame:
    keep = ["ticker", "ex_dividend_date", "cash_amount"] + ([seq] if seq else [])
    d = recent(dividends, as_of, 365, "ex_dividend_date").select(*keep)
    d = newest_two(d, "ticker", "ex_dividend_date", "cash_amount", seq)
    d = d.filter((F.col("prev_cash_amount") > 0) & (F.col("cash_amount") != F.col("prev_cash_amount")))
    d = d.join(universe.select("ticker", "name"), "ticker", "left")
    return d.select(
        "ticker", F.coalesce("name", F.lit("")).alias("name"), F.col("prev_cash_amount").alias("prev_amount"),
        F.col("cash_amount").alias("latest_amount"),
        F.round(pct_change("cash_amount", "prev_cash_amount"), 1).alias("change_pct"), F.col("ex_dividend_date").alias("ex_date"))


def upcoming_dividends(dividends: DataFrame, universe: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    d = dividends.filter((F.col("ex_dividend_date") >= as_of) & (F.col("ex_dividend_date") <= F.date_add(as_of, days)))
    d = d.join(universe.select("ticker", "name"), "ticker", "left")
    return d.select("ticker", F.coalesce("name", F.lit("")).alias("name"), "cash_amount", F.col("ex_dividend_date").alias("ex_date"))


def dividend_yield(dividends: DataFrame, daily: DataFrame, as_of: Column, limit: int = 20, seq: str | None = None) -> DataFrame:
    """Annualised yield from the latest dividend and the price on the last market day."""
    order = [F.desc("ex_dividend_date")] + ([F.desc(seq)] if seq else [])
    last = top_k_per(dividends, "ticker", order)
    price = daily.filter((F.col("day") == as_of) & (F.col("close") > 0)).select("ticker", "close")
    d = last.filter(F.col("frequency") > 0).join(price, "ticker")
    d = d.select(
        "ticker", F.round("close", 2).alias("price"), F.round("cash_amount", 4).alias("last_div"), "frequency",
        F.col("ex_dividend_date").alias("last_ex_date"),
        F.round(safe_div(F.col("cash_amount") * F.col("frequency"), "close") * 100, 2).alias("annual_yield_pct"))
    return d.orderBy(F.desc("annual_yield_pct"), "ticker").limit(limit)

