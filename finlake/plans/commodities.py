"""Futures and energy marts.  Futures bars: (ticker, name, date, open, high, low, close, volume)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import latest, pct_change, pct_of, safe_div, sum_if
from finlake.operators.bars import CALENDAR, calendar_bars, ohlcv_bars
from finlake.operators.dedup import at_group_max
from finlake.operators.returns import change, simple_return


def futures_bars(base: DataFrame, tickers: Sequence[str], grain: str, start=None, end=None, time: str = "date") -> DataFrame:
    """Bars of some contracts; calendar grains come from daily bars, intraday ones from finer bars."""
    d = base.filter(F.col("ticker").isin(*tickers))
    if start is not None:
        d = d.filter(F.col(time) >= start)
    if end is not None:
        d = d.filter(F.col(time) <= end)
    if grain in CALENDAR:
        return calendar_bars(d, ["ticker", "name"], time, grain)
    return d if grain == "1d" else ohlcv_bars(d, ["ticker", "name"], time, grain)


def tickers(bars: DataFrame) -> DataFrame:
    return bars.select("ticker").distinct()


def latest_bars(bars: DataFrame) -> DataFrame:
    return at_group_max(bars, "ticker", "date").select("ticker", "name", "date", "open", "high", "low", "close", "volume")


def returns(bars: DataFrame) -> DataFrame:
    d = simple_return(bars.select("ticker", "name", "date", "close"), "ticker", "date")
    return d.withColumn("return_pct", F.round("return_pct", 2))


def latest_returns(bars: DataFrame, as_of: Column) -> DataFrame:
    return returns(bars).filter(F.col("date") == as_of)


def movers(bars: DataFrame, as_of: Column, limit: int = 5) -> DataFrame:
    """Top gainers and losers of the day by open-to-close move, with a side and a rank."""
    d = bars.filter((F.col("date") == as_of) & (F.col("open") > 0))
    d = d.select("ticker", "name", "close", F.round(pct_change("close", "open"), 2).alias("change_pct"))
    up = d.filter(F.col("change_pct") > 0).orderBy(F.desc("change_pct"), "ticker").limit(limit)
    down = d.filter(F.col("change_pct") < 0).orderBy("change_pct", "ticker").limit(limit)
    return up.withColumn("side", F.lit("gainer")).unionByName(down.withColumn("side", F.lit("loser")))


def _by_symbol(bars: DataFrame, symbols: dict[str, str], since: Column) -> DataFrame:
    """One row per date, one column per contract (0 where it has no bar)."""
    d = bars.filter((F.col("date") >= since) & F.col("ticker").isin(*symbols))
    return d.groupBy("date").agg(*[sum_if("close", F.col("ticker") == s).alias(n) for s, n in symbols.items()])


def _named(exprs: dict[str, Column]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(n).alias("name"), e.cast("double").alias("value")) for n, e in exprs.items()]))


def spreads(bars: DataFrame, since: Column) -> DataFrame:
    """Crack and crush spreads, gold/silver and crude/gas: current value against the mean.

    The wide row is turned into four named values and aggregated once.
    """
    w = _by_symbol(bars, {"CL=F": "cl", "RB=F": "rb", "HO=F": "ho", "ZS=F": "zs", "ZM=F": "zm", "ZL=F": "zl",
                          "GC=F": "gold", "SI=F": "silver", "NG=F": "natgas"}, since)
    w = w.filter((F.col("cl") > 0) & (F.col("rb") > 0) & (F.col("ho") > 0))
    c = F.col
    values = {
        "Crack Spread (3:2:1)": F.round(2 * c("rb") * 42 + c("ho") * 42 - 3 * c("cl"), 2),
        "Crush Spread": F.when((c("zs") > 0) & (c("zm") > 0) & (c("zl") > 0), F.round(c("zm") * 0.022 + c("zl") * 0.11 - c("zs") / 100, 2)),
        "Gold/Silver Ratio": F.when(c("silver") > 0, F.round(safe_div("gold", "silver"), 2)),
        "Crude/NatGas Ratio": F.when(c("natgas") > 0, F.round(safe_div("cl", "natgas"), 2)),
    }
    d = w.select("date", _named(values).alias("v")).select("date", "v.name", "v.value")
    g = d.groupBy("name").agg(F.max_by("value", "date").alias("current_value"), F.round(F.avg("value"), 2).alias("avg_value"))
    g = g.filter(F.col("current_value").isNotNull() & (F.col("avg_value") != 0))
    return g.withColumn("pct_vs_avg", F.round(pct_change("current_value", "avg_value"), 2))


# Name: (numerator, denominator, factor, digits of the current ratio)
RATIOS = {
    "Gold/Silver": ("GC=F", "SI=F", 1, 2), "Crude/NatGas": ("CL=F", "NG=F", 1, 2), "Platinum/Gold": ("PL=F", "GC=F", 1, 4),
    "Corn/Wheat": ("ZC=F", "ZW=F", 1, 4), "Copper/Gold": ("HG=F", "GC=F", 100, 4),
}


def ratios(bars: DataFrame, since: Column, pairs: dict[str, tuple[str, str, int, int]] = RATIOS) -> DataFrame:
    """Price ratios with mean, population deviation and the z-score of the latest value."""
    symbols = sorted({s for a, b, *_ in pairs.values() for s in (a, b)})
    w = _by_symbol(bars, {s: f"s{i}" for i, s in enumerate(symbols)}, since)
    at = {s: F.col(f"s{i}") for i, s in enumerate(symbols)}
    d = w.select("date", _named({n: F.when(at[b] > 0, safe_div(at[a] * k, at[b])) for n, (a, b, k, _) in pairs.items()}).alias("v"))
    g = d.select("date", "v.name", "v.value").groupBy("name").agg(
        F.max_by("value", "date").alias("_now"), F.round(F.avg("value"), 4).alias("avg_ratio"), F.round(F.stddev_pop("value"), 4).alias("stddev"))
    z = F.when(F.col("stddev") > 0, F.round(safe_div(F.col("_now") - F.col("avg_ratio"), "stddev"), 2)).otherwise(0.0)
    by = lambda k: F.coalesce(*[F.when(F.col("name") == n, k(*v)) for n, v in pairs.items()])
    now = by(lambda a, b, k, digits: F.round("_now", digits))
    return g.filter(F.col("_now").isNotNull()).select(
        "name", by(lambda a, *_: F.lit(a)).alias("ticker_a"), by(lambda a, b, *_: F.lit(b)).alias("ticker_b"), now.alias("current_ratio"), "avg_ratio", "stddev", z.alias("zscore"))


def seasonality(bars: DataFrame, as_of: Column, years: int = 10) -> DataFrame:
    """Per contract and month: mean, lowest and highest month average of past years, and this year's."""
    d = bars.filter(F.col("date") >= F.add_months(as_of, -12 * years))
    m = d.groupBy("ticker", F.month("date").alias("month"), F.year("date").alias("year")).agg(F.avg("close").alias("_a"))
    past = F.when(F.col("year") < F.year(as_of), F.col("_a"))
    now = F.when(F.col("year") == F.year(as_of), F.col("_a"))
    g = m.groupBy("ticker", "month").agg(
        F.round(F.avg(past), 4).alias("avg_close"), F.round(F.min(past), 4).alias("min_close"),
        F.round(F.max(past), 4).alias("max_close"), F.round(F.max(now), 4).alias("current_year_close"))
    return g.filter(F.col("avg_close").isNotNull())


# ---- energy -----------------------------------------------------------------------

def brent_wti(prices: DataFrame, a: str = "brent_crude", b: str = "wti_crude") -> DataFrame:
    d = prices.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return d.select("date", b, a, F.round(F.col(a) - F.col(b), 2).alias("spread"), F.round(pct_change(a, b), 2).alias("spread_pct"))


def energy_latest(prices: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Latest value of each price, each from its own date."""
    return prices.agg(F.max("date").alias("date"), *[latest(c, "date").alias(c) for c in columns])


def petroleum_balance(weekly: DataFrame) -> DataFrame:
    """Net imports, total stocks, days of supply and week-on-week stock changes."""
    d = change(weekly, None, "date", "crude_stocks", 1, "crude_stocks_wow")
    d = change(d, None, "date", "spr_stocks", 1, "spr_stocks_wow")
    return d.withColumns({
        "crude_net_imports": F.round(F.col("crude_imports") - F.col("crude_exports"), 1),
        "total_stocks": F.round(F.col("crude_stocks") + F.col("spr_stocks"), 1),
        "days_of_supply": F.round(F.col("crude_stocks") / F.greatest("product_supplied", F.lit(0.001)), 1),
        "crude_stocks_wow": F.round("crude_stocks_wow", 1), "spr_stocks_wow": F.round("spr_stocks_wow", 1)})


def vs_range(weekly: DataFrame, value: str, years: int = 5) -> DataFrame:
    """This year's weekly values against mean, low and high of the same ISO week in past years."""
    this_year = F.year(weekly.select(F.max("date")).scalar())
    w = weekly.filter(F.col(value).isNotNull()).select("date", value, F.weekofyear("date").alias("iso_week"), F.year("date").alias("_y"))
    past = w.filter(F.col("_y").between(this_year - years, this_year - 1)).groupBy("iso_week").agg(
        F.avg(value).alias("range_avg"), F.min(value).alias("range_min"), F.max(value).alias("range_max"))
    d = w.filter(F.col("_y") == this_year).join(past, "iso_week")
    return d.select("date", F.col(value).alias("current"), "range_avg", "range_min", "range_max",
                    F.round(F.col(value) - F.col("range_avg"), 1).alias("vs_avg"), F.round(pct_change(value, "range_avg"), 2).alias("vs_avg_pct"))


def producer_share(monthly: DataFrame, total: str = "opec_production", parts: Sequence[str] = ("saudi", "iran", "iraq", "uae"),
                   moved: Sequence[str] = ("opec", "iran", "us")) -> DataFrame:
    """Each producer's percent of the group total and month-on-month changes."""
    d = monthly.filter(F.col(total).isNotNull())
    for m in moved:
        d = change(d, None, "date", f"{m}_production", 1, f"{m}_mom").withColumn(f"{m}_mom", F.round(f"{m}_mom", 1))
    return d.withColumns({f"{p}_pct": F.round(F.col(f"{p}_production") / F.greatest(total, F.lit(0.001)) * 100, 1) for p in parts})


def import_dependency(monthly: DataFrame, part: str = "imports_persian_gulf", total: str = "imports_total") -> DataFrame:
    d = monthly.filter(F.col(total).isNotNull()).select("date", part, total)
    d = change(change(d, None, "date", part, 1, "gulf_mom"), None, "date", total, 1, "total_mom")
    return d.select("date", part, total, F.round(pct_of(part, F.greatest(total, F.lit(0.001))), 2).alias("gulf_pct"),
                    F.round("gulf_mom", 1).alias("gulf_mom"), F.round("total_mom", 1).alias("total_mom"))
