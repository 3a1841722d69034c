"""Methods of the stored lake: the roles are loaded into tables, in two loads, and answered from there."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.checks.registry import CHECKS, add, rnd
from finlake.checks.roles import Tables
from finlake.lake import Lake
from finlake.schemas import TABLES
from finlake.session import scratch_path

OLD, NEW = "2024-01-01", "2024-02-01"


def lake(t: Tables, **roles: DataFrame | str) -> Lake:
    """A lake of some tables.  Every third row is first loaded with spoilt numbers, then everything as it is."""
    lk = Lake(t.spark, scratch_path(t.spark, "lake"))
    for name, role in roles.items():
        keys, version, _ = TABLES[name]
        rows = t.role(role) if isinstance(role, str) else role
        spoilt = {c: F.lit(-1).cast(kind) for c, kind in rows.dtypes if kind == "double" and c not in keys}
        grain = "month" if name == "option_trades" else "year"
        lk.load(name, rows.filter(F.pmod(F.xxhash64(*keys), F.lit(3)) == 0).withColumns(spoilt).withColumn(version, F.lit(OLD).cast("timestamp")), grain)
        lk.load(name, rows.withColumn(version, F.lit(NEW).cast("timestamp")), grain)
    return lk


def same_as(name: str, other: str, build) -> None:
    """The answer of the lake is that of another registered query."""
    add(name, build)
    CHECKS[name] = (build, CHECKS[other][1])


same_as("lake_market_breadth", "mrt01_market_breadth", lambda t: lake(t, ohlcv_daily="sdaily").market_breadth())
same_as("lake_year_highs", "mrt02_year_highs", lambda t: lake(t, ohlcv_daily="sdaily", universe="universe").year_highs())
same_as("lake_year_lows", "mrt02_year_lows", lambda t: lake(t, ohlcv_daily="sdaily", universe="universe").year_lows())
same_as("lake_hilo_counts", "mrt03_hilo_counts", lambda t: lake(t, ohlcv_daily="sdaily").hilo_counts())
same_as("lake_search", "prj05_search", lambda t: lake(t, universe="universe").search("1").select("ticker", "name", "rank"))
same_as("lake_ratios", "agg26_ratios", lambda t: lake(t, commodities_ohlcv="futures").ratios())
same_as("lake_spreads", "agg25_spreads", lambda t: lake(t, commodities_ohlcv="futures").spreads(700))
same_as("lake_energy_latest", "agg29_energy_latest", lambda t: lake(t, commodity_prices="energy").energy_latest())


def _thrust(t: Tables) -> DataFrame:
    lk = lake(t, ohlcv_daily="sdaily", universe="universe")
    lk.store_breadth()
    d = lk.table("zbt_breadth").drop("ingested_at").withColumn("days_in_window", F.col("days_in_window").cast("long"))
    return rnd(d, 8, "breadth_ratio", "ema_10")


same_as("lake_breadth_stored", "mrt32_breadth_thrust", _thrust)

add("lake_daily_range", lambda t: lake(t, ohlcv_daily="sdaily").daily("1995-03-01", "1995-06-30").select("ticker", "day", "open", "close", "volume"),
    "SELECT ticker, day, open, close, volume FROM sdaily WHERE day BETWEEN DATE '1995-03-01' AND DATE '1995-06-30'")


def _contracts(t: Tables) -> DataFrame:
    """One row for each contract and snapshot."""
    return t.role("chain").groupBy("underlying", "expiration", "strike", "put_call", "snapshot_date").agg(F.max("implied_vol").alias("implied_vol"), F.max("delta").alias("delta"), F.max("volume").alias("volume"), F.max("open_interest").alias("open_interest"))


add("lake_iv_surface", lambda t: lake(t, option_chains=_contracts(t)).iv_surface("R"),
    """WITH k AS (SELECT underlying, expiration, strike, put_call, snapshot_date, max(implied_vol) AS implied_vol, max(delta) AS delta, max(volume) AS volume, max(open_interest) AS open_interest FROM chain
         WHERE underlying = 'R' GROUP BY 1, 2, 3, 4, 5)
       SELECT underlying, expiration, strike, put_call, implied_vol, delta, volume, open_interest FROM k WHERE snapshot_date = (SELECT max(snapshot_date) FROM k) AND implied_vol > 0""")


# ---- saved queries ------------------------------------------------------------------

START = "1996-01-01"


def _company(t: Tables) -> Lake:
    closes = t.role("prices").withColumn("day", F.lit("2000-12-29").cast("date"))
    return lake(t, financials="financials", ohlcv_daily=closes, treasury_yields="yields")


def _macro(t: Tables) -> Lake:
    months = t.role("monthly")
    return lake(t, treasury_yields="yields", ohlcv_daily="odaily", labor_market=months.select("date", "unemployment_rate"), inflation=months.select("date", "cpi"),
                inflation_expectations=months.select("date", "market_10_year", "model_1_year"))


same_as("lake_fundamentals_screener", "mrt11_fundamentals_screener", lambda t: _company(t).fundamentals_screener(None))
same_as("lake_equity_risk_premium", "mrt12_equity_risk_premium", lambda t: _company(t).equity_risk_premium())
same_as("lake_pe_list", "mrt13_pe_list", lambda t: rnd(_company(t).pe_list("2000"), 6, "pe_ratio"))
same_as("lake_dilution_snapshot", "mrt25_dilution_snapshot", lambda t: _company(t).dilution_snapshot())
same_as("lake_curve_history", "prj16_curve_history", lambda t: rnd(_macro(t).curve_history(START), 2, "y1"))
same_as("lake_real_yield", "prj16_real_yield", lambda t: _macro(t).real_yield(START))
same_as("lake_curve_vs_jobs", "prj17_curve_vs_jobs", lambda t: rnd(_macro(t).curve_vs_jobs(START), 8, "spread_2s10s"))
same_as("lake_macro_dashboard", "agg27_macro_dashboard", lambda t: _macro(t).macro_dashboard(("5-LOW", "1-URGENT"), START))
same_as("lake_regime_dashboard", "agg28_regime_dashboard", lambda t: _macro(t).regime_dashboard(START, "5-LOW"))

# ---- more of the market, futures and energy methods ---------------------------------

FIVE = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _market(t: Tables) -> Lake:
    return lake(t, ohlcv_daily="sdaily", universe="universe")


same_as("lake_top_gainers", "mrt06_top_gainers", lambda t: _market(t).top_movers())
same_as("lake_most_active", "mrt07_most_active", lambda t: _market(t).most_active())
same_as("lake_treemap", "mrt09_treemap", lambda t: _market(t).treemap(1000))
same_as("lake_sector_performance", "agg07_sector_performance", lambda t: _market(t).sector_performance(60))
same_as("lake_overnight_gaps", "mrt18_overnight_gaps", lambda t: _market(t).overnight_gaps())
same_as("lake_beta", "mrt15_beta", lambda t: lake(t, ohlcv_daily="odaily").beta("5-LOW"))
same_as("lake_rotation", "mrt17_rotation", lambda t: lake(t, ohlcv_daily="odaily").rotation(FIVE, "5-LOW"))
same_as("lake_correlation_matrix", "mrt16_corr_returns", lambda t: rnd(lake(t, ohlcv_daily="odaily").correlation_matrix(FIVE, 365, "returns"), 6, "correlation"))
same_as("lake_futures_latest", "mrt22_latest_bars", lambda t: lake(t, commodities_ohlcv="futures").futures_latest().drop("ingested_at"))
same_as("lake_futures_latest_returns", "mrt22_latest_returns", lambda t: lake(t, commodities_ohlcv="futures").futures_latest_returns())
same_as("lake_petroleum_weekly", "mrt29_petroleum_balance", lambda t: lake(t, eia_petroleum_weekly="petro_weekly").petroleum_weekly().drop("ingested_at"))
same_as("lake_petroleum_vs_range", "agg24_vs_range", lambda t: rnd(lake(t, eia_petroleum_weekly="petro_weekly").petroleum_vs_range(), 6, "range_avg"))


def _sql(t: Tables) -> DataFrame:
    """Ad-hoc SQL over the newest rows of the stored tables."""
    return _market(t).sql("""SELECT u.type, year(d.day) AS year, count(*) AS days, max(d.close) AS high FROM ohlcv_daily d JOIN universe u USING (ticker) GROUP BY 1, 2""")


add("lake_sql", _sql, "SELECT u.type, CAST(year(d.day) AS INTEGER) AS year, count(*) AS days, max(d.close) AS high FROM sdaily d JOIN universe u USING (ticker) GROUP BY 1, 2")


# ---- table functions: SQL only ------------------------------------------------------

same_as("lake_sql_daily_returns", "win01_simple_return", lambda t: lake(t, ohlcv_daily="sdaily").sql(
    "SELECT ticker, day, close, prev_close, round(return_pct, 6) AS return_pct FROM daily_returns(NULL, NULL, NULL)"))
same_as("lake_sql_breadth", "mrt32_breadth_thrust", lambda t: rnd(_market(t).sql("SELECT * FROM breadth_between(NULL, NULL)"), 8, "breadth_ratio", "ema_10"))
add("lake_sql_movers", lambda t: _market(t).sql("""SELECT u.name, m.ticker, m.day, round(m.return_pct, 6) AS return_pct, CAST(m.place AS BIGINT) AS place FROM daily_movers(NULL, 5) m JOIN universe u USING (ticker)"""),
    """WITH r AS (SELECT ticker, day, (close - p) / nullif(p, 0) * 100 AS x FROM (SELECT ticker, day, close, lag(close) OVER (PARTITION BY ticker ORDER BY day) AS p FROM sdaily)),
       m AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY x DESC, ticker) AS place FROM r WHERE x IS NOT NULL)
       SELECT name, m.ticker, day, round(x, 6) AS return_pct, place FROM m JOIN universe USING (ticker) WHERE place <= 5""")
add("lake_sql_statements", lambda t: _company(t).sql("""SELECT ticker, timeframe, count(*) AS statements, max(revenue) AS revenue, max(period_end) AS newest FROM statements_of(NULL, NULL) GROUP BY 1, 2"""),
    """SELECT ticker, CASE WHEN fiscal_period = 'FY' THEN 'annual' ELSE 'quarterly' END AS timeframe, count(*) AS statements, max(revenue) AS revenue, max(period_end) AS newest
       FROM financials WHERE fiscal_period IN ('FY', 'Q1', 'Q2', 'Q3', 'Q4') GROUP BY 1, 2""")

# ---- corporate actions and filings of one ticker ------------------------------------


def _dividends(t: Tables) -> DataFrame:
    return t.role("dividends").groupBy("ticker", "ex_dividend_date").agg(F.max("cash_amount").alias("cash_amount"))


_PAID = "SELECT ticker, ex_dividend_date, max(cash_amount) AS cash_amount FROM dividends GROUP BY 1, 2"
add("lake_dividends_of_ticker", lambda t: lake(t, dividends=_dividends(t)).dividends("7").drop("ingested_at"), f"SELECT * FROM ({_PAID}) WHERE ticker = '7'")
add("lake_dividend_calendar", lambda t: lake(t, dividends=_dividends(t)).dividend_calendar("1998-03-01", "1998-03-31").drop("ingested_at"),
    f"SELECT * FROM ({_PAID}) WHERE ex_dividend_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'")
add("lake_splits_of_ticker", lambda t: lake(t, stock_splits=_dividends(t).select("ticker", F.col("ex_dividend_date").alias("execution_date"), F.col("cash_amount").alias("split_to"))).splits("7").drop("ingested_at"),
    f"SELECT ticker, ex_dividend_date AS execution_date, cash_amount AS split_to FROM ({_PAID}) WHERE ticker = '7'")
_NEWEST = "(SELECT max(filed_date) FROM filings)"
add("lake_filings_of_ticker", lambda t: lake(t, sec_filings="filings").filings("7", 900, None).drop("ingested_at"),
    f"SELECT * FROM filings WHERE ticker = '7' AND filed_date BETWEEN {_NEWEST} - 900 AND {_NEWEST}")
add("lake_events_of_ticker", lambda t: lake(t, sec_filings="filings").filings("7", 2000, None, "event").drop("ingested_at"),
    f"SELECT * FROM filings WHERE ticker = '7' AND form_type IN ('8-K', '8-K/A') AND filed_date BETWEEN {_NEWEST} - 2000 AND {_NEWEST}")
