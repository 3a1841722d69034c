"""Statement marts over ``financials`` rows (ticker, period_end, fiscal_year, fiscal_period, line items)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import pct_of, safe_div
from finlake.functions.lookups import CONCEPTS
from finlake.operators.dedup import at_group_max, clamp_outlier, top_k_per
from finlake.operators.joins import with_scalars

QUARTERS = ("Q1", "Q2", "Q3", "Q4")


def periods(financials: DataFrame, timeframe: str) -> DataFrame:
    p = F.col("fiscal_period")
    return financials.filter(p == "FY" if timeframe == "annual" else p.isin(*QUARTERS))


def statements(financials: DataFrame, ticker: str, timeframe: str = "annual", year: str | None = None,
               period: str | None = None, limit: int = 40) -> DataFrame:
    """Newest statements of a ticker; one query serves income, balance sheet and cash flow."""
    d = periods(financials, timeframe).filter(F.col("ticker") == ticker)
    if year is not None:
        d = d.filter(F.col("fiscal_year") == year)
    if period is not None:
        d = d.filter(F.col("fiscal_period") == period)
    return d.orderBy(F.desc("period_end"), "fiscal_period").limit(limit)


def metric(financials: DataFrame, tickers: Sequence[str], name: str, timeframe: str = "annual", limit: int = 20) -> DataFrame:
    """Newest ``limit`` values of one line item for each ticker."""
    if name not in CONCEPTS:
        raise ValueError(f"unknown line item: {name}")
    d = periods(financials, timeframe).filter(F.col("ticker").isin(*tickers))
    d = d.select("ticker", "period_end", "fiscal_year", "fiscal_period", F.col(name).alias("value"))
    return top_k_per(d, "ticker", [F.desc("period_end"), F.asc("fiscal_period")], limit)


def latest_period(financials: DataFrame, timeframe: str) -> DataFrame:
    return at_group_max(periods(financials, timeframe), "ticker", "period_end")


def latest_statements(financials: DataFrame) -> DataFrame:
    """Latest annual statement of each ticker."""
    return latest_period(financials, "annual")


def fundamentals_screener(financials: DataFrame, prices: DataFrame, limit: int | None = 30) -> DataFrame:
    """Valuation, margins, leverage and cash flow from the latest quarter; cheapest first.

    ``prices`` is (ticker, close) of the last market day.
    """
    f = latest_period(financials, "quarterly").filter(F.col("revenue") > 0).join(prices, "ticker")
    d = f.select(
        "ticker", F.round("close", 2).alias("price"), F.round(safe_div("close", F.col("diluted_eps") * 4), 1).alias("pe_ratio"),
        F.round(safe_div(F.col("close") * F.col("weighted_avg_shares_diluted"), F.col("revenue") * 4), 2).alias("price_to_sales"),
        F.round(pct_of("gross_profit", "revenue"), 1).alias("gross_margin"), F.round(pct_of("operating_income", "revenue"), 1).alias("op_margin"),
        F.round(pct_of("net_income", "revenue"), 1).alias("net_margin"), F.round(safe_div("total_liabilities", "total_equity"), 2).alias("debt_to_equity"),
        (F.col("operating_cash_flow") + F.col("investing_cash_flow")).alias("fcf"), F.round(pct_of("research_and_dev", "revenue"), 1).alias("rd_pct"))
    return d.orderBy(F.asc_nulls_last("pe_ratio"), "ticker").limit(limit) if limit else d


def equity_risk_premium(financials: DataFrame, prices: DataFrame, yields: DataFrame, limit: int | None = 30) -> DataFrame:
    """Annualised earnings yield of the latest quarter minus the latest ten-year yield."""
    f = latest_period(financials, "quarterly").filter(F.col("diluted_eps") > 0).join(prices, "ticker")
    rate = yields.agg(F.max_by("yield_10_year", F.when(F.col("yield_10_year").isNotNull(), F.col("date"))).alias("treasury_10y"))
    d = with_scalars(f, rate, ["treasury_10y"])
    earn = safe_div(F.col("diluted_eps") * 4, "close") * 100
    d = d.select("ticker", F.round("close", 2).alias("price"), F.round(F.col("diluted_eps") * 4, 2).alias("annual_eps"),
                 F.round(earn, 2).alias("earnings_yield"), "treasury_10y", F.round(earn - F.col("treasury_10y"), 2).alias("equity_risk_premium"))
    return d.orderBy(F.desc("equity_risk_premium"), "ticker").limit(limit) if limit else d


def pe_list(financials: DataFrame, prices: DataFrame, year: str, period: str = "FY") -> DataFrame:
    d = financials.filter((F.col("fiscal_year") == year) & (F.col("fiscal_period") == period) & (F.col("diluted_eps") > 0))
    d = d.select("ticker", "diluted_eps").join(prices, "ticker")
    return d.withColumn("pe_ratio", safe_div("close", "diluted_eps"))


# ---- dilution ---------------------------------------------------------------------

def _effective(d: DataFrame) -> DataFrame:
    shares = F.coalesce("shares_outstanding", "weighted_avg_shares_diluted", "weighted_avg_shares_basic")
    d = d.withColumn("_eff", shares)
    return d.withColumn("antidilutive_shares", clamp_outlier("antidilutive_shares", F.col("_eff"), 20.0))


def _or0(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0.0))


def dilution_snapshot(financials: DataFrame, ticker: str | None = None) -> DataFrame:
    """Annual share count (with fallback), headroom, possible dilution and net buyback."""
    d = financials.filter(F.col("fiscal_period") == "FY")
    if ticker is not None:
        d = d.filter(F.col("ticker") == ticker)
    d = _effective(d)
    possible = _or0("warrants_outstanding") + _or0("options_outstanding") + _or0("unvested_rsu_shares") + _or0("antidilutive_shares")
    room = F.col("shares_authorized") - F.col("_eff")
    return d.select(
        "ticker", "period_end", F.col("_eff").alias("shares_outstanding"), "shares_authorized", room.alias("authorized_headroom"),
        F.round(pct_of(room, "_eff"), 1).alias("headroom_pct"), "weighted_avg_shares_basic", "weighted_avg_shares_diluted",
        (F.col("weighted_avg_shares_diluted") - F.col("weighted_avg_shares_basic")).alias("dilutive_effect"), "stock_based_compensation",
        F.round(pct_of("stock_based_compensation", "revenue"), 1).alias("sbc_pct_of_revenue"), "antidilutive_shares",
        possible.alias("total_potential_dilution_shares"), F.round(pct_of(possible, "_eff"), 1).alias("total_dilution_pct"),
        (_or0("buyback_shares") - _or0("shares_issued_options") - _or0("shares_issued_rsu_vested") - _or0("shares_from_conversion")).alias("net_buyback_shares"))


def dilution_series(financials: DataFrame, timeframe: str = "quarterly") -> DataFrame:
    """Share counts over time; a ticker without quarterly rows falls back to its annual ones.

    The fallback is a flag over the ticker (its periods are few), not a second query.
    """
    d = financials.filter(F.col("fiscal_period").isin("FY", *QUARTERS))
    quarterly = F.col("fiscal_period") != "FY"
    if timeframe == "annual":
        d = d.filter(~quarterly)
    else:
        has = F.max(quarterly).over(W.partitionBy("ticker"))
        d = d.withColumn("_has", has).filter(F.col("_has") == quarterly).drop("_has")
    d = _effective(d)
    return d.select(
        "ticker", "period_end", "fiscal_year", "fiscal_period", F.col("_eff").alias("shares_outstanding"),
        "weighted_avg_shares_basic", "weighted_avg_shares_diluted",
        (F.col("weighted_avg_shares_diluted") - F.col("weighted_avg_shares_basic")).alias("dilutive_effect"), "stock_based_compensation",
        F.round(pct_of("stock_based_compensation", "revenue"), 2).alias("sbc_pct_revenue"), "shares_authorized",
        F.round(pct_of(F.col("shares_authorized") - F.col("_eff"), "_eff"), 1).alias("headroom_pct"), "revenue")
