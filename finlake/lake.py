"""Stored tables and the named queries over them.

``Lake(spark, root)`` reads ``root/<table>`` folders written by :mod:`finlake.sources.sinks`
(partitioned by ``year``, or by month for trades) and answers every query of the market,
option, macro, commodity, statement and filing marts as a DataFrame.  Rows are always the
newest version of their identity key.  Date limits become filters on the partition column
(year or month) too; methods without one read the whole history of their table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.exprs import sector_from_code
from finlake.operators import indicators
from finlake.operators.bars import ohlcv_bars, period_return
from finlake.operators.dedup import latest_version
from finlake.operators.pairs import wide
from finlake.operators.returns import rolling_corr
from finlake.plans import breadth, commodities as com, filings as fil, functions, fundamentals as fun, macro, market as mk, options as opt
from finlake.plans.features import storable
from finlake.schemas import TABLES
from finlake.sources import sinks

BENCHMARK = "SPY"


def _date(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


class Lake:
    def __init__(self, spark: SparkSession, root: str, as_of: str | None = None):
        self.spark, self.root, self._as_of = spark, root.rstrip("/"), as_of
        self._newest: dict[str, object] = {}

    # ---- tables -------------------------------------------------------------------

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def raw(self, name: str) -> DataFrame:
        """All stored versions of a table."""
        return self.spark.read.parquet(self.path(name))

    def table(self, name: str, start=None, end=None) -> DataFrame:
        """Newest version of each row, within a date range of the table's time column."""
        keys, version, time = TABLES[name]
        d = self.raw(name)
        for bound, op in ((start, "ge"), (end, "le")):
            if bound is not None and time:
                b = _date(bound)
                at = F.to_date(time) if time == "timestamp" else F.col(time)
                d = d.filter(at >= b if op == "ge" else at <= b)
                for part, of in (("year", F.year(b)), ("ym", F.date_format(b, "yyyyMM").cast("int"))):
                    if part in d.columns:
                        d = d.filter(F.col(part) >= of if op == "ge" else F.col(part) <= of)
        if version in d.columns:
            d = latest_version(d, list(keys), [version])
        return d.drop("year", "ym")

    def load(self, name: str, rows: DataFrame, grain: str = "year") -> None:
        """Idempotent load of new rows."""
        keys, version, time = TABLES[name]
        sinks.upsert(self.spark, rows, self.path(name), time, list(keys), [version], grain)
        self._newest = {k: v for k, v in self._newest.items() if k != name and k[0] != name}

    def as_of(self, name: str) -> Column:
        """The fixed report date, or the newest date of a table.

        The newest date is read once, from the newest year, and kept as a literal: all
        queries of one ``Lake`` agree on it and folders are pruned while planning.
        """
        if self._as_of:
            return _date(self._as_of)
        if name not in self._newest:
            time, d = TABLES[name][2], self.raw(name)
            for part in {"year", "ym"} & set(d.columns):
                d = d.filter(F.col(part) == d.select(F.max(part)).scalar())
            self._newest[name] = d.select(F.max(F.to_date(time))).first()[0]
        return F.lit(self._newest[name])

    def as_of_key(self, name: str, column: str, value: str) -> Column:
        """The newest date of one key, which may be older than the table's: two columns are read, once."""
        at = (name, column, value)
        if at not in self._newest:
            time = TABLES[name][2]
            self._newest[at] = self.raw(name).filter(F.col(column) == value).select(F.max(F.to_date(time))).first()[0]
        return F.lit(self._newest[at]).cast("date")

    def since(self, name: str, days: int) -> Column:
        return F.date_sub(self.as_of(name), days)

    def sql(self, text: str) -> DataFrame:
        """Ad-hoc SQL; every stored table is a view of its newest rows, marts are table functions (``finlake.plans.functions``)."""
        stored = {name for name in TABLES if sinks._exists(self.spark, self.path(name))}
        for name in stored:
            self.table(name).createOrReplaceTempView(name)
        for name in functions.asked(text):
            if stored.issuperset(functions.FUNCTIONS[name].needs):
                functions.create(self, name)
        return self.spark.sql(text)

    def columns(self, name: str) -> list[tuple[str, str]]:
        return self.table(name).dtypes

    # ---- bars and market ----------------------------------------------------------

    def daily(self, start=None, end=None) -> DataFrame:
        return self.table("ohlcv_daily", start, end)

    def _recent(self, days: int) -> DataFrame:
        return self.daily(self.since("ohlcv_daily", days))

    def _now(self) -> Column:
        return self.as_of("ohlcv_daily")

    def bars(self, tickers: Sequence[str], interval: str = "1d", start=None, end=None) -> DataFrame:
        if interval == "1d":
            return self.daily(start, end).filter(F.col("ticker").isin(*tickers))
        d = self.table("ohlcv", start, end).filter(F.col("ticker").isin(*tickers))
        return d if interval == "1m" else ohlcv_bars(d, "ticker", "timestamp", interval, source="source")

    def rebuild_daily(self, start=None, end=None) -> DataFrame:
        """Daily bars from minute bars."""
        return ohlcv_bars(self.table("ohlcv", start, end), "ticker", "timestamp", "1d", source="source", out="day")

    def returns(self, tickers: Sequence[str], start, end) -> DataFrame:
        return period_return(self.daily(start, end).filter(F.col("ticker").isin(*tickers)), "ticker", "day")

    def latest_prices(self, tickers: Sequence[str]) -> DataFrame:
        return mk.latest_prices(self.daily(), tickers)

    def sparklines(self, tickers: Sequence[str], days: int = 30) -> DataFrame:
        return mk.sparklines(self._recent(days), tickers, self._now(), days)

    def top_movers(self, direction: str = "gainers", limit: int = 10) -> DataFrame:
        return mk.top_movers(self._recent(7), self.universe(), self._now(), direction, limit)

    def most_active(self, limit: int = 10) -> DataFrame:
        return mk.most_active(self._recent(7), self.universe(), self._now(), limit)

    def sector_performance(self, days: int = 7) -> DataFrame:
        return mk.sector_performance(self._recent(days), self.universe(), self._now(), days)

    def treemap(self, min_cap: float = 55e9) -> DataFrame:
        return mk.treemap(self._recent(7), self.universe(), self._now(), min_cap)

    def momentum_velocity(self, ticker: str, weeks: int = 26) -> DataFrame:
        return mk.momentum_velocity(self._recent(weeks * 7), [ticker], self._now(), weeks)

    def screener(self) -> DataFrame:
        return mk.screener(self._recent(7), self.universe(), self.table("financials"), self._now())

    def correlation_matrix(self, tickers: Sequence[str], days: int = 180, on: str = "close") -> DataFrame:
        return mk.correlation_matrix(self._recent(days), tickers, self._now(), days, on)

    def market_breadth(self) -> DataFrame:
        return mk.market_breadth(self._recent(7), self._now())

    def year_highs(self) -> DataFrame:
        return mk.year_extremes(self._recent(252), self.universe(), self._now(), "high")

    def year_lows(self) -> DataFrame:
        return mk.year_extremes(self._recent(252), self.universe(), self._now(), "low")

    def hilo_counts(self) -> DataFrame:
        return mk.hilo_counts(self._recent(252), self._now())

    def beta(self, benchmark: str = BENCHMARK, days: int = 252, min_days: int = 100) -> DataFrame:
        return mk.beta(self._recent(days), benchmark, self._now(), days, min_days)

    def rotation(self, tickers: Sequence[str], benchmark: str = BENCHMARK, days: int = 60) -> DataFrame:
        return mk.rotation(self._recent(days), tickers, benchmark, self._now(), days)

    def overnight_gaps(self, days: int = 30, pct: float = 2.0) -> DataFrame:
        return mk.overnight_gaps(self._recent(days), self._now(), days, pct)

    def hourly_profile(self, tickers: Sequence[str]) -> DataFrame:
        return mk.hourly_profile(self.table("ohlcv"), tickers)

    def indicator(self, name: str, tickers: Sequence[str], start=None, end=None, **params) -> DataFrame:
        """sma, ema, bollinger, rsi, macd or cumulative_return of daily closes."""
        d = self.bars(tickers, "1d", start, end).select("ticker", "day", "close")
        return getattr(indicators, name)(d, "ticker", "day", "close", **params)

    def breadth_thrust(self) -> DataFrame:
        return breadth.breadth_thrust(self.daily(), self.universe())

    def store_breadth(self) -> None:
        """Compute the breadth thrust of all days and store it."""
        self.load("zbt_breadth", self.breadth_thrust().withColumn("ingested_at", F.current_timestamp()))

    def breadth_status(self, days: int = 15) -> DataFrame:
        """The last days of the stored breadth table."""
        return breadth.thrust_status(self.table("zbt_breadth"), days)

    def store_features(self, matrix: DataFrame) -> None:
        """Store a feature matrix (see ``finlake.plans.features``)."""
        self.load("algo_feature_matrix", storable(matrix).withColumn("computed_at", F.current_timestamp()))

    def features(self, start=None, end=None) -> DataFrame:
        return self.table("algo_feature_matrix", start, end)

    # ---- universe and corporate actions -------------------------------------------

    def universe(self, **filters) -> DataFrame:
        return mk.universe_filter(self.table("universe"), **filters)

    def ticker(self, ticker: str) -> DataFrame:
        return self.table("universe").filter(F.col("ticker") == ticker)

    def search(self, text: str, limit: int = 20) -> DataFrame:
        return mk.search(self.table("universe"), text, limit)

    def sectors(self) -> DataFrame:
        return mk.sector_summary(self.table("universe"))

    def tickers_by_sector(self, sector: str) -> DataFrame:
        return self.universe(sector=sector)

    def sector_of(self) -> DataFrame:
        return self.table("universe").select("ticker", sector_from_code("sic_code").alias("sector"))

    def dividends(self, ticker: str) -> DataFrame:
        return self.table("dividends").filter(F.col("ticker") == ticker)

    def dividend_calendar(self, start, end) -> DataFrame:
        return self.table("dividends", start, end)

    def splits(self, ticker: str) -> DataFrame:
        return self.table("stock_splits").filter(F.col("ticker") == ticker)

    def dividend_changes(self) -> DataFrame:
        return mk.dividend_changes(self.table("dividends"), self.universe(), self._now())

    def upcoming_dividends(self, days: int = 7) -> DataFrame:
        return mk.upcoming_dividends(self.table("dividends"), self.universe(), self._now(), days)

    def dividend_yield(self, limit: int = 20) -> DataFrame:
        return mk.dividend_yield(self.table("dividends"), self._recent(7), self._now(), limit)

    # ---- options ------------------------------------------------------------------

    def _chain(self, underlying: str, start=None) -> DataFrame:
        return self.table("option_chains", start).filter(F.col("underlying") == underlying)

    def _snap(self, underlying: str, date=None) -> DataFrame:
        """Rows of one snapshot, by default the underlying's own newest; only its partition is read."""
        day = self.as_of_key("option_chains", "underlying", underlying) if date is None else _date(date)
        return opt.snapshot(self.table("option_chains", day, day), underlying, day)

    def _lately(self, underlying: str, days: int = 60) -> DataFrame:
        """The last ``days`` up to the underlying's own newest snapshot."""
        return self._chain(underlying, F.date_sub(self.as_of_key("option_chains", "underlying", underlying), days))

    def option_chain(self, underlying: str, expiration, date=None) -> tuple[DataFrame, DataFrame]:
        return opt.split_chain(self._snap(underlying, date), _date(expiration))

    def expirations(self, underlying: str, date=None) -> DataFrame:
        return opt.expirations(self._snap(underlying, date))

    def iv_surface(self, underlying: str, date=None) -> DataFrame:
        return opt.surface(self._snap(underlying, date))

    def iv_skew(self, underlying: str, expiration, date=None) -> DataFrame:
        return opt.surface(self._snap(underlying, date), _date(expiration))

    def greeks(self, underlying: str, expiration, date=None) -> DataFrame:
        d = self._snap(underlying, date).filter(F.col("expiration") == _date(expiration))
        return opt.greeks(d, ("delta", "gamma", "theta", "vega", "rho", "vanna", "charm", "vomma", "veta", "speed", "zomma", "color", "ultima"))

    def iv_history(self, underlying: str, strike: float, expiration, put_call: str) -> DataFrame:
        return opt.iv_history(self.table("option_chains"), underlying, strike, _date(expiration), put_call)

    def oi_profile(self, underlying: str, expiration, date=None) -> DataFrame:
        return opt.profile(self._snap(underlying, date).filter(F.col("expiration") == _date(expiration)), "open_interest")

    def volume_profile(self, underlying: str, expiration, date=None) -> DataFrame:
        return opt.profile(self._snap(underlying, date).filter(F.col("expiration") == _date(expiration)), "volume")

    def atm_iv_history(self, underlying: str, days: int = 365) -> DataFrame:
        return opt.atm_iv(self._chain(underlying, self.since("option_chains", days)))

    def iv_gauge(self, underlying: str) -> DataFrame:
        return opt.iv_gauge(self._chain(underlying, self.since("option_chains", 365)), self.as_of("option_chains"))

    def put_call_ratio(self, underlying: str, days: int = 90) -> DataFrame:
        return opt.put_call_ratio(self._chain(underlying, self.since("option_chains", days)), self.as_of("option_chains"), days)

    def gex(self, underlying: str, date=None) -> DataFrame:
        return opt.gex_by_strike(self._snap(underlying, date))

    def term_structure(self, underlying: str, date=None) -> DataFrame:
        return opt.term_structure(self._snap(underlying, date))

    def skew_history(self, underlying: str, days: int = 180) -> DataFrame:
        return opt.skew_25d(self._chain(underlying, self.since("option_chains", days)))

    def unusual_activity(self, underlying: str, min_ratio: float = 3, min_volume: int = 500, limit: int = 30) -> DataFrame:
        return opt.unusual_activity(self._lately(underlying), min_ratio, min_volume, limit)

    def volume_over_oi(self, underlying: str, min_volume: int = 500, limit: int = 20) -> DataFrame:
        return opt.volume_over_oi(self._lately(underlying), min_volume, limit)

    def chain_table(self, underlying: str, expiration) -> DataFrame:
        d = self._lately(underlying)
        return opt.chain_table(d).filter(F.col("expiration") == _date(expiration))

    def hv_vs_iv(self, underlying: str, days: int = 365) -> DataFrame:
        daily = self._recent(days + 40).filter(F.col("ticker") == underlying)
        return opt.hv_vs_iv(daily, self._chain(underlying, self.since("option_chains", days)), self._now(), days)

    def oi_walls(self, underlying: str, date=None) -> DataFrame:
        return opt.oi_by_strike(self._snap(underlying, date))

    def latest_trade_date(self, underlying: str) -> DataFrame:
        day = self.as_of_key("option_trades", "underlying", underlying)
        return opt.latest_trade_date(self.table("option_trades", day, day), underlying)

    def flow_surface(self, underlying: str, date=None) -> DataFrame:
        day = self.as_of_key("option_trades", "underlying", underlying) if date is None else _date(date)
        return opt.flow_surface(self.table("option_trades", day, day).filter(F.col("underlying") == underlying), day)

    # ---- macro and commodities ----------------------------------------------------

    def macro(self, name: str, start=None, end=None) -> DataFrame:
        """treasury_yields, inflation, inflation_expectations, labor_market, rates, macro_*, commodity_prices."""
        return self.table(name, start, end)

    def yield_curve(self, dates: Sequence[str]) -> DataFrame:
        asked = self.spark.createDataFrame([(d,) for d in dates], "d string").select(F.to_date("d").alias("requested"))
        return macro.yield_curve(self.table("treasury_yields"), asked)

    def energy_latest(self) -> DataFrame:
        return com.energy_latest(self.table("commodity_prices"), ["wti_crude", "brent_crude", "natural_gas", "gasoline", "heating_oil"])

    def futures(self, tickers: Sequence[str], interval: str = "1d", start=None, end=None) -> DataFrame:
        """Bars at ten grains; 30m comes from 15m bars and 2h from 1h bars."""
        base = {"15m": "_15m", "30m": "_15m", "1h": "_1h", "2h": "_1h", "4h": "_4h"}.get(interval, "")
        stored = interval in ("15m", "1h", "4h")
        d = self.table(f"commodities_ohlcv{base}", start, end).filter(F.col("ticker").isin(*tickers))
        return d if stored else com.futures_bars(d, tickers, interval, time="timestamp" if base else "date")

    def futures_tickers(self) -> DataFrame:
        return com.tickers(self.table("commodities_ohlcv"))

    def futures_latest(self) -> DataFrame:
        return com.latest_bars(self.table("commodities_ohlcv"))

    def futures_returns(self, ticker: str, start=None, end=None) -> DataFrame:
        d = com.returns(self.table("commodities_ohlcv").filter(F.col("ticker") == ticker))
        return macro.macro_series(d, None if start is None else _date(start), None if end is None else _date(end))

    def _fut(self, days: int) -> DataFrame:
        return self.table("commodities_ohlcv", self.since("commodities_ohlcv", days))

    def futures_latest_returns(self) -> DataFrame:
        return com.latest_returns(self._fut(30), self.as_of("commodities_ohlcv"))

    def futures_movers(self, limit: int = 5) -> DataFrame:
        return com.movers(self._fut(7), self.as_of("commodities_ohlcv"), limit)

    def futures_volatility(self, days: int = 30) -> DataFrame:
        return mk.realised_vol(self._fut(days).withColumnRenamed("date", "day"), self.as_of("commodities_ohlcv"), days)

    def futures_correlations(self, tickers: Sequence[str], days: int = 180) -> DataFrame:
        return mk.correlation_matrix(self._fut(days).withColumnRenamed("date", "day"), tickers, self.as_of("commodities_ohlcv"), days)

    def cross_asset_correlations(self, futures: Sequence[str], stocks: Sequence[str], days: int = 180) -> DataFrame:
        both = self._fut(days).select("ticker", F.col("date").alias("day"), "close").unionByName(self._recent(days).select("ticker", "day", "close"))
        return mk.correlation_matrix(both, [*futures, *stocks], self._now(), days)

    def rolling_correlation(self, a: str, b: str, window: int = 30, days: int = 730) -> DataFrame:
        w = wide(self._fut(days), "ticker", "date", "close", (a, b)).filter(F.col("s0").isNotNull() & F.col("s1").isNotNull())
        return rolling_corr(w, None, "date", "s0", "s1", window).select("date", F.round("correlation", 4).alias("correlation"))

    def spreads(self, days: int = 90) -> DataFrame:
        return com.spreads(self._fut(days), self.since("commodities_ohlcv", days))

    def ratios(self, days: int = 730) -> DataFrame:
        return com.ratios(self._fut(days), self.since("commodities_ohlcv", days))

    def seasonality(self, ticker: str, years: int = 10) -> DataFrame:
        return com.seasonality(self._fut(366 * years).filter(F.col("ticker") == ticker), self.as_of("commodities_ohlcv"), years)

    def brent_wti(self, start=None, end=None) -> DataFrame:
        return com.brent_wti(self.table("commodity_prices", start, end))

    def petroleum_weekly(self) -> DataFrame:
        return com.petroleum_balance(self.table("eia_petroleum_weekly"))

    def petroleum_vs_range(self) -> DataFrame:
        return com.vs_range(self.table("eia_petroleum_weekly"), "crude_stocks")

    def producer_share(self) -> DataFrame:
        return com.producer_share(self.table("eia_petroleum_monthly"))

    def import_dependency(self) -> DataFrame:
        return com.import_dependency(self.table("eia_petroleum_monthly"))

    def curve_history(self, start) -> DataFrame:
        """One-, five- and ten-year yields and their spread, day by day."""
        return macro.curve_history(self.table("treasury_yields", start), _date(start))

    def real_yield(self, start) -> DataFrame:
        """Ten-year yield less the inflation that was expected in its month."""
        return macro.real_yield(self.table("treasury_yields", start), self.table("inflation_expectations"), _date(start))

    def curve_vs_jobs(self, start) -> DataFrame:
        return macro.curve_vs_jobs(self.table("treasury_yields", start), self.table("labor_market"), _date(start))

    def macro_dashboard(self, tickers: Sequence[str], start) -> DataFrame:
        """Jobs, prices, expectations, yields and mean closes by month."""
        first = F.trunc(_date(start), "month")
        return macro.macro_dashboard(self.table("labor_market", start), self.table("inflation"), self.table("inflation_expectations"),
                                     self.table("treasury_yields", first), self.daily(first), tuple(tickers), _date(start))

    def regime_dashboard(self, start, proxy: str = BENCHMARK) -> DataFrame:
        """Volatility, curve, price and jobs regimes by month; ``proxy`` is the ticker whose volatility counts."""
        return macro.regime_dashboard(self.daily().filter(F.col("ticker") == proxy), self.table("treasury_yields"), self.table("inflation"), self.table("labor_market"), _date(start))

    # ---- statements and filings ---------------------------------------------------

    def _last_closes(self) -> DataFrame:
        """(ticker, close) of the last market day; only its year is read."""
        return self.daily(self._now(), self._now()).select("ticker", "close")

    def fundamentals_screener(self, limit: int | None = 30) -> DataFrame:
        """Valuation, margins and leverage from each ticker's latest quarter, cheapest first."""
        return fun.fundamentals_screener(self.table("financials"), self._last_closes(), limit)

    def equity_risk_premium(self, limit: int | None = 30) -> DataFrame:
        """Earnings yields of the latest quarter less the newest ten-year yield."""
        return fun.equity_risk_premium(self.table("financials"), self._last_closes(), self.table("treasury_yields"), limit)

    def pe_list(self, year: str, period: str = "FY") -> DataFrame:
        return fun.pe_list(self.table("financials"), self._last_closes(), year, period)

    def latest_statements(self) -> DataFrame:
        """The newest annual statement of each ticker."""
        return fun.latest_statements(self.table("financials"))

    def statements(self, ticker: str, timeframe: str = "annual", **filters) -> DataFrame:
        return fun.statements(self.table("financials"), ticker, timeframe, **filters)

    def metric(self, tickers: Sequence[str], name: str, timeframe: str = "annual", limit: int = 20) -> DataFrame:
        return fun.metric(self.table("financials"), tickers, name, timeframe, limit)

    def dilution_snapshot(self, ticker: str | None = None) -> DataFrame:
        return fun.dilution_snapshot(self.table("financials"), ticker)

    def dilution_series(self, ticker: str, timeframe: str = "quarterly") -> DataFrame:
        return fun.dilution_series(self.table("financials").filter(F.col("ticker") == ticker), timeframe)

    def filings(self, ticker: str, days: int = 730, limit: int | None = 40, family: str | None = None) -> DataFrame:
        d = self.table("sec_filings")
        d = fil.filings_of_family(d, family) if family else d
        return fil.within_days(d, self.as_of("sec_filings"), days, "filed_date", ticker, limit)

    def material_events(self, ticker: str, days: int = 730, limit: int = 30) -> DataFrame:
        return fil.within_days(self.table("material_events"), self.as_of("material_events"), days, "filed_date", ticker, limit)

    def insider_trades(self, ticker: str, days: int = 365, limit: int = 50) -> DataFrame:
        return fil.within_days(
            fil.open_market(self.table("insider_trades")), self.as_of("insider_trades"), days, "filed_date", ticker, limit, "report_date")

    def insider_monthly(self, ticker: str | None = None) -> DataFrame:
        d = self.table("insider_trades")
        return fil.insider_monthly(d if ticker is None else d.filter(F.col("ticker") == ticker))

    def notable_buys(self, limit: int = 20) -> DataFrame:
        return fil.notable_buys(self.table("insider_trades"), self.as_of("insider_trades"), limit=limit)

    def holders(self, ticker: str, limit: int = 20) -> DataFrame:
        return fil.latest_holders(self.table("institutional_holders"), ticker, limit)
