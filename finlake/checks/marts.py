"""Market, option, macro, commodity, statement, filing and breadth marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from finlake.checks import roles as R
from finlake.checks.registry import add, rnd
from finlake.functions.exprs import sector_from_code
from finlake.operators.bars import weekly_returns
from finlake.operators.pivots import latest_non_null
from finlake.plans import breadth, commodities as com, filings as fil, fundamentals as fun, macro, market as mk, options as opt

c = F.col
day = lambda s: F.lit(s).cast("date")
AS_OF, O_AS_OF, F_AS_OF = R.S_ASOF, R.O_ASOF, R.F_ASOF
FIVE = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
SECTOR = """CASE WHEN substring(sic_code, 1, 2) IN ('10', '12', '13', '14') THEN 'Energy' WHEN substring(sic_code, 1, 2) = '28' THEN 'Pharma'
    WHEN substring(sic_code, 1, 2) IN ('35', '36', '37', '38') THEN 'Tech & Electronics' WHEN substring(sic_code, 1, 2) = '73' THEN 'Software & Services'
    WHEN substring(sic_code, 1, 2) IN ('60', '61', '62', '63', '64', '65', '67') THEN 'Financials' WHEN substring(sic_code, 1, 2) IN ('48', '49') THEN 'Telecom & Utilities'
    WHEN substring(sic_code, 1, 2) BETWEEN '52' AND '59' THEN 'Retail' WHEN substring(sic_code, 1, 2) IN ('20', '21') THEN 'Food & Beverage' ELSE 'Other' END"""

# ---- projections ------------------------------------------------------------------

add("prj01_bars_one_hour", lambda t: mk.bars(t.role("minute"), ["click", "view"], "1h", F.lit("2024-01-05").cast("timestamp"), F.lit("2024-01-20").cast("timestamp"))
    .select("ticker", "bucket", "open", "high", "low", "close", "volume"),
    """SELECT ticker, date_trunc('hour', timestamp) AS bucket, arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low, arg_max(close, timestamp) AS close,
       CAST(sum(volume) AS BIGINT) AS volume FROM minute WHERE ticker IN ('click', 'view') AND timestamp >= '2024-01-05' AND timestamp < '2024-01-20' GROUP BY 1, 2""")

add("prj02_futures_monthly", lambda t: com.futures_bars(t.role("futures"), ["CL=F", "GC=F"], "1mo", start=day("1996-01-01")),
    """SELECT ticker, name, CAST(date_trunc('month', date) AS DATE) AS period, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close,
       CAST(sum(volume) AS BIGINT) AS volume FROM futures WHERE ticker IN ('CL=F', 'GC=F') AND date >= DATE '1996-01-01' GROUP BY 1, 2, 3""")

for _n, _g, _t in (("weekly", "1wk", "week"), ("quarterly", "1q", "quarter"), ("yearly", "1yr", "year")):
    add(f"prj02_futures_{_n}", (lambda g: lambda t: com.futures_bars(t.role("futures"), ["CL=F", "GC=F"], g, end=day("1997-12-31")))(_g),
        f"""SELECT ticker, name, CAST(date_trunc('{_t}', date) AS DATE) AS period, arg_min(open, date) AS open, max(high) AS high, min(low) AS low, arg_max(close, date) AS close,
        CAST(sum(volume) AS BIGINT) AS volume FROM futures WHERE ticker IN ('CL=F', 'GC=F') AND date <= DATE '1997-12-31' GROUP BY 1, 2, 3""")

add("prj03_sparklines", lambda t: mk.sparklines(t.role("sdaily"), ["1", "2", "3", "5", "8"], R.s_asof(t), 90).select("ticker", F.concat_ws(",", F.transform("closes", lambda x: x.cast("long").cast("string"))).alias("closes")),
    f"""SELECT ticker, string_agg(CAST(CAST(trunc(close) AS BIGINT) AS VARCHAR), ',' ORDER BY day) AS closes FROM sdaily
        WHERE ticker IN ('1', '2', '3', '5', '8') AND day BETWEEN {AS_OF} - 90 AND {AS_OF} GROUP BY 1""")

add("prj04_universe_filter", lambda t: mk.universe_filter(t.role("universe"), exchange="NYSE", active=True, type="CS", min_cap=1000, max_cap=9000),
    "SELECT * FROM universe WHERE exchange = 'NYSE' AND active AND type = 'CS' AND market_cap BETWEEN 1000 AND 9000")

add("prj05_search", lambda t: mk.search(t.role("universe"), "1").select("ticker", "name", "rank"),
    """SELECT ticker, name, CASE WHEN ticker = '1' THEN 0 WHEN ticker LIKE '1%' THEN 1 ELSE 2 END AS rank FROM universe
       WHERE ticker LIKE '1%' OR upper(name) LIKE '%1%' ORDER BY rank, market_cap DESC NULLS LAST, ticker LIMIT 20""")

add("prj06_statements", lambda t: fun.statements(t.role("financials"), "7", "quarterly", limit=12).select("ticker", "period_end", "fiscal_period", "revenue", "net_income"),
    "SELECT ticker, period_end, fiscal_period, revenue, net_income FROM financials WHERE ticker = '7' AND fiscal_period <> 'FY' ORDER BY period_end DESC, fiscal_period LIMIT 12")

add("prj07_metric", lambda t: fun.metric(t.role("financials"), [str(i) for i in range(50)], "operating_income", "annual", 4),
    """SELECT ticker, period_end, fiscal_year, fiscal_period, operating_income AS value FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY period_end DESC) rn FROM financials
       WHERE fiscal_period = 'FY' AND CAST(ticker AS INTEGER) < 50) WHERE rn <= 4""")

add("prj08_dividend_calendar", lambda t: t.role("dividends").filter(c("ex_dividend_date").between(day("1998-03-01"), day("1998-03-31"))),
    "SELECT * FROM dividends WHERE ex_dividend_date BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'")

add("prj09_macro_series", lambda t: macro.macro_series(t.role("yields"), day("1997-01-01"), day("1998-12-31")),
    "SELECT * FROM yields WHERE date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")

for _f, _w in (("annual", "form_type IN ('10-K', '10-K/A', '20-F', '20-F/A')"), ("institutional", "form_type IN ('SC 13G', 'SC 13G/A', 'SC 13D', 'SC 13D/A', 'SCHEDULE 13G', 'SCHEDULE 13G/A', 'SCHEDULE 13D', 'SCHEDULE 13D/A')"),
               ("prospectus", "form_type LIKE '424B%'"), ("insider", "form_type IN ('3', '4', '5')"), ("quarterly", "form_type IN ('10-Q', '10-Q/A')"), ("event", "form_type IN ('8-K', '8-K/A')"),
               ("registration", "form_type IN ('S-1', 'S-1/A', 'S-3', 'S-3ASR', 'S-3/A', 'S-8', 'S-8 POS', 'F-1', 'F-3')")):
    add(f"prj10_filings_{_f}", (lambda f: lambda t: fil.filings_of_family(t.role("filings"), f))(_f), f"SELECT * FROM filings WHERE {_w}")

add("prj11_open_market_days", lambda t: fil.within_days(fil.open_market(t.role("insider")), F.date_add(R.o_asof(t), 2), 90),
    f"SELECT * FROM insider WHERE transaction_code IN ('P', 'S') AND NOT is_derivative AND filed_date BETWEEN {O_AS_OF} + 2 - 90 AND {O_AS_OF} + 2")

add("prj12_notable_buys", lambda t: fil.notable_buys(t.role("insider"), R.o_asof(t), tie=("ticker", "seq")),
    f"SELECT * FROM insider WHERE filed_date >= {O_AS_OF} - 14 AND transaction_code = 'P' AND NOT is_derivative AND value > 50000 ORDER BY value DESC, ticker, seq LIMIT 20")

_SNAP = "s AS (SELECT c.* FROM chain c JOIN (SELECT underlying, max(snapshot_date) AS snapshot_date FROM chain GROUP BY 1) USING (underlying, snapshot_date))"
add("prj13_chain_surface", lambda t: opt.surface(opt.snapshot(t.role("chain"))),
    f"WITH {_SNAP} SELECT underlying, expiration, strike, put_call, implied_vol, delta, volume, open_interest FROM s WHERE implied_vol > 0")
add("prj13_chain_greeks_one", lambda t: opt.greeks(opt.snapshot(t.role("chain"), "R")),
    f"WITH {_SNAP} SELECT underlying, expiration, strike, put_call, delta, gamma, theta, vega, rho FROM s WHERE underlying = 'R'")
add("prj13_expirations", lambda t: opt.expirations(opt.snapshot(t.role("chain"))), f"WITH {_SNAP} SELECT DISTINCT underlying, expiration FROM s")
add("prj13_chain_calls", lambda t: opt.split_chain(opt.snapshot(t.role("chain"), "A", day("1999-06-07")), day("1999-06-28"))[0].select("strike", "bid", "ask", "volume", "seq"),
    "SELECT strike, bid, ask, volume, seq FROM chain WHERE underlying = 'A' AND snapshot_date = DATE '1999-06-07' AND expiration = DATE '1999-06-28' AND put_call = 'call'")
add("prj13_iv_history", lambda t: opt.iv_history(t.role("chain"), "N", 25.0, day("1998-06-29"), "call"),
    "SELECT snapshot_date, implied_vol FROM chain WHERE underlying = 'N' AND strike = 25 AND expiration = DATE '1998-06-29' AND put_call = 'call'")
add("prj14_latest_trade_date", lambda t: opt.latest_trade_date(t.role("trades")), "SELECT underlying, max(trade_date) AS latest_date FROM trades GROUP BY 1")
add("prj15_spread", lambda t: com.brent_wti(t.role("energy")),
    """SELECT date, wti_crude, brent_crude, round(brent_crude - wti_crude, 2) AS spread, round((brent_crude - wti_crude) / wti_crude * 100, 2) AS spread_pct
       FROM energy WHERE wti_crude IS NOT NULL AND brent_crude IS NOT NULL""")
add("prj16_curve_history", lambda t: rnd(macro.curve_history(t.role("yields"), day("1996-01-01")), 2, "y1"),
    """SELECT date, round(yield_1_year, 2) AS y1, round(yield_5_year, 2) AS y5, round(yield_10_year, 2) AS y10, round(yield_10_year - yield_1_year, 2) AS spread_1s10s
       FROM yields WHERE date >= DATE '1996-01-01' AND yield_1_year IS NOT NULL""")
add("prj16_real_yield", lambda t: macro.real_yield(t.role("yields"), t.role("monthly"), day("1996-01-01")),
    """SELECT y.date, round(yield_10_year, 2) AS nominal_10y, round(market_10_year, 2) AS breakeven_10y, round(yield_10_year - market_10_year, 2) AS real_yield_10y
       FROM yields y JOIN monthly m ON date_trunc('month', y.date) = m.date WHERE y.date >= DATE '1996-01-01' AND yield_10_year IS NOT NULL AND market_10_year IS NOT NULL""")
add("prj17_curve_vs_jobs", lambda t: rnd(macro.curve_vs_jobs(t.role("yields"), t.role("monthly"), day("1996-01-01")), 8, "spread_2s10s"),
    """SELECT y.date, round(yield_10_year - yield_2_year, 8) AS spread_2s10s, unemployment_rate FROM yields y JOIN monthly m ON date_trunc('month', y.date) = m.date
       WHERE y.date >= DATE '1996-01-01' AND yield_10_year IS NOT NULL AND yield_2_year IS NOT NULL""")
add("prj18_tickers", lambda t: com.tickers(t.role("futures")), "SELECT DISTINCT ticker FROM futures")
add("prj19_yield_curve", lambda t: macro.yield_curve(t.role("yields").filter(c("yield_1_year") > 1), t.orders.select(F.date_add(F.to_date("o_orderdate"), 3).alias("requested")).distinct(), 30),
    """WITH y AS (SELECT * FROM yields WHERE yield_1_year > 1), q AS (SELECT DISTINCT CAST(o_orderdate AS DATE) + 3 AS requested FROM orders),
       m AS (SELECT requested, (SELECT max(date) FROM y WHERE date <= requested AND date >= requested - 30) AS date FROM q)
       SELECT requested, date, maturity, yield FROM (SELECT m.requested, y.date, unnest(['1Y', '2Y', '5Y', '10Y', '30Y']) AS maturity,
       unnest([yield_1_year, yield_2_year, yield_5_year, yield_10_year, yield_30_year]) AS yield FROM m JOIN y USING (date))""")
add("prj20_sector_from_code", lambda t: t.part.select("p_partkey", sector_from_code((c("p_partkey") % 8000 + 1000).cast("string")).alias("sector")),
    f"SELECT p_partkey, {SECTOR} AS sector FROM (SELECT p_partkey, CAST(p_partkey % 8000 + 1000 AS VARCHAR) AS sic_code FROM part)")


def _adhoc(t):
    t.role("sdaily").createOrReplaceTempView("finlake_daily")
    return t.spark.sql("SELECT ticker, count(*) AS bars, max(close) AS top FROM finlake_daily GROUP BY ticker HAVING count(*) > 10")


add("prj21_adhoc_sql", _adhoc, "SELECT ticker, count(*) AS bars, max(close) AS top FROM sdaily GROUP BY 1 HAVING count(*) > 10")

# ---- market -----------------------------------------------------------------------

_MOVES = f"""mv AS (SELECT ticker, close, round((close - p) / p * 100, 2) AS change_pct, volume FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY day) AS p
    FROM sdaily WHERE day BETWEEN {AS_OF} - 7 AND {AS_OF}) WHERE day = {AS_OF} AND p > 0)"""
add("mrt06_top_gainers", lambda t: mk.top_movers(t.role("sdaily"), t.role("universe"), R.s_asof(t)),
    f"WITH {_MOVES} SELECT ticker, close, change_pct, volume, name FROM (SELECT * FROM mv ORDER BY change_pct DESC, ticker LIMIT 10) LEFT JOIN universe USING (ticker)")
add("mrt06_top_losers", lambda t: mk.top_movers(t.role("sdaily"), t.role("universe"), R.s_asof(t), "losers"),
    f"WITH {_MOVES} SELECT ticker, close, change_pct, volume, name FROM (SELECT * FROM mv ORDER BY change_pct, ticker LIMIT 10) LEFT JOIN universe USING (ticker)")
add("mrt07_most_active", lambda t: mk.most_active(t.role("sdaily"), t.role("universe"), R.s_asof(t)),
    f"WITH {_MOVES} SELECT ticker, close, change_pct, volume, name FROM (SELECT * FROM mv ORDER BY volume DESC, ticker LIMIT 10) LEFT JOIN universe USING (ticker)")
add("mrt09_treemap", lambda t: mk.treemap(t.role("sdaily"), t.role("universe"), R.s_asof(t), 1000),
    f"WITH {_MOVES} SELECT ticker, name, {SECTOR} AS sector, market_cap, close, change_pct FROM universe JOIN mv USING (ticker) WHERE sic_code <> '' AND market_cap >= 1000")
add("mrt10_screener", lambda t: mk.screener(t.role("sdaily"), t.role("universe"), t.role("financials"), R.s_asof(t)),
    f"""WITH {_MOVES}, f AS (SELECT ticker, arg_max(revenue, period_end) AS revenue, arg_max(net_income, period_end) AS net_income, arg_max(gross_profit, period_end) AS gross_profit,
        arg_max(diluted_eps, period_end) AS eps FROM financials WHERE fiscal_period = 'FY' GROUP BY 1)
        SELECT ticker, name, {SECTOR} AS sector, exchange, market_cap, close, change_pct, volume, revenue, net_income, CASE WHEN revenue > 0 THEN round(gross_profit / revenue * 100, 1) END AS gross_margin,
        CASE WHEN revenue > 0 THEN round(net_income / revenue * 100, 1) END AS net_margin, CASE WHEN eps > 0 THEN round(close / eps, 1) END AS pe
        FROM universe JOIN mv USING (ticker) LEFT JOIN f USING (ticker) WHERE sic_code <> ''""")
add("agg30_latest_statement_values", lambda t: latest_non_null(
    t.role("financials").filter(c("fiscal_period") == "FY"), ["revenue", "gross_profit", "research_and_dev", "shares_outstanding"], "period_end", "ticker"),
    """SELECT ticker, max(period_end) AS period_end, arg_max(revenue, period_end) AS revenue, arg_max(gross_profit, period_end) AS gross_profit, arg_max(research_and_dev, period_end) AS research_and_dev,
       arg_max(shares_outstanding, period_end) AS shares_outstanding FROM financials WHERE fiscal_period = 'FY' GROUP BY 1""")
add("mrt01_market_breadth", lambda t: mk.market_breadth(t.role("sdaily"), R.s_asof(t)),
    f"""WITH p AS (SELECT ticker, max(close) FILTER (rn = 1) AS a, max(close) FILTER (rn = 2) AS b FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY day DESC) rn FROM sdaily
        WHERE day BETWEEN {AS_OF} - 7 AND {AS_OF}) GROUP BY 1), x AS (SELECT round((a - b) / b * 100, 2) AS v FROM p WHERE b > 0)
        SELECT count(*) FILTER (v > 0) AS advancers, count(*) FILTER (v < 0) AS decliners, count(*) FILTER (v = 0) AS unchanged, count(*) AS total, round(avg(v), 2) AS avg_change, round(median(v), 2) AS median_change FROM x""")


def _extreme_sql(agg, op):
    return f"""WITH l AS (SELECT ticker, arg_max(close, day) AS close, arg_max(volume, day) AS volume FROM sdaily WHERE day >= {AS_OF} - 5 GROUP BY 1),
        p AS (SELECT ticker, arg_max(close, day) AS prev FROM sdaily WHERE day >= {AS_OF} - 10 AND day < {AS_OF} GROUP BY 1),
        y AS (SELECT ticker, {agg}(close) AS lim FROM sdaily WHERE day >= {AS_OF} - 252 AND day < {AS_OF} - 1 GROUP BY 1)
        SELECT l.ticker, u.name, l.close, round((l.close - p.prev) / p.prev * 100, 2) AS change_pct, l.volume FROM l JOIN y USING (ticker) LEFT JOIN p USING (ticker) LEFT JOIN universe u USING (ticker)
        WHERE l.close {op} y.lim AND u.name <> ''"""


add("mrt02_year_highs", lambda t: mk.year_extremes(t.role("sdaily"), t.role("universe"), R.s_asof(t), "high"), _extreme_sql("max", ">="))
add("mrt02_year_lows", lambda t: mk.year_extremes(t.role("sdaily"), t.role("universe"), R.s_asof(t), "low"), _extreme_sql("min", "<="))
add("mrt03_hilo_counts", lambda t: mk.hilo_counts(t.role("sdaily"), R.s_asof(t)),
    f"""WITH l AS (SELECT ticker, close FROM sdaily WHERE day = {AS_OF}), y AS (SELECT ticker, max(close) AS hi, min(close) AS lo FROM sdaily WHERE day >= {AS_OF} - 252 AND day < {AS_OF} - 1 GROUP BY 1)
        SELECT count(*) FILTER (close >= hi) AS new_highs, count(*) FILTER (close <= lo) AS new_lows, count(*) AS total FROM l JOIN y USING (ticker)""")
add("mrt04_dividend_changes", lambda t: mk.dividend_changes(t.role("dividends"), t.role("universe"), R.s_asof(t), "seq"),
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ex_dividend_date DESC, seq DESC) rn FROM dividends WHERE ex_dividend_date >= {AS_OF} - 365)
        SELECT a.ticker, coalesce(name, '') AS name, b.cash_amount AS prev_amount, a.cash_amount AS latest_amount, round((a.cash_amount - b.cash_amount) / b.cash_amount * 100, 1) AS change_pct,
        a.ex_dividend_date AS ex_date FROM r a JOIN r b ON a.ticker = b.ticker AND a.rn = 1 AND b.rn = 2 LEFT JOIN universe u ON u.ticker = a.ticker WHERE b.cash_amount > 0 AND a.cash_amount <> b.cash_amount""")
add("mrt05_upcoming_dividends", lambda t: mk.upcoming_dividends(t.role("dividends"), t.role("universe"), F.date_sub(R.s_asof(t), 7)),
    f"""SELECT d.ticker, coalesce(name, '') AS name, cash_amount, ex_dividend_date AS ex_date FROM dividends d LEFT JOIN universe u USING (ticker)
        WHERE ex_dividend_date BETWEEN {AS_OF} - 7 AND {AS_OF}""")
add("mrt08_futures_movers", lambda t: com.movers(t.role("futures"), F.date_sub(R.f_asof(t), 7)),
    f"""WITH d AS (SELECT ticker, name, close, round((close - open) / open * 100, 2) AS change_pct FROM futures WHERE date = {F_AS_OF} - 7 AND open > 0)
        (SELECT *, 'gainer' AS side FROM d WHERE change_pct > 0 ORDER BY change_pct DESC, ticker LIMIT 5) UNION ALL (SELECT *, 'loser' FROM d WHERE change_pct < 0 ORDER BY change_pct, ticker LIMIT 5)""")
add("mrt14_dividend_yield", lambda t: mk.dividend_yield(t.role("dividends"), t.role("sdaily"), R.s_asof(t), seq="seq"),
    f"""WITH d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ex_dividend_date DESC, seq DESC) rn FROM dividends) WHERE rn = 1)
        SELECT ticker, round(close, 2) AS price, round(cash_amount, 4) AS last_div, frequency, ex_dividend_date AS last_ex_date, round(cash_amount * frequency / close * 100, 2) AS annual_yield_pct
        FROM d JOIN sdaily s USING (ticker) WHERE s.day = {AS_OF} AND frequency > 0 AND close > 0 ORDER BY annual_yield_pct DESC, ticker LIMIT 20""")

_RET = "r AS (SELECT ticker, day, ln(close) - ln(lag(close) OVER (PARTITION BY ticker ORDER BY day)) AS ret FROM {src} WHERE day BETWEEN {a} - {n} AND {a}{w})"
_BENCH = "b AS (SELECT day, ret AS bench FROM r WHERE ticker = '5-LOW')"
add("mrt15_beta", lambda t: mk.beta(t.role("odaily"), "5-LOW", R.o_asof(t)),
    f"""WITH {_RET.format(src='odaily', a=O_AS_OF, n=252, w='')}, {_BENCH} SELECT ticker, round(covar_pop(ret, bench) / var_pop(bench), 3) AS beta, round(covar_pop(ret, bench) / nullif(stddev_pop(ret) * stddev_pop(bench), 0), 3) AS correlation,
        round(stddev_pop(ret) * sqrt(252) * 100, 1) AS annual_vol_pct, count(*) AS trading_days FROM r JOIN b USING (day) WHERE ticker <> '5-LOW' AND ret IS NOT NULL AND bench IS NOT NULL
        GROUP BY 1 HAVING count(*) > 100""")
add("mrt16_corr_returns", lambda t: rnd(mk.correlation_matrix(t.role("odaily"), FIVE, R.o_asof(t), 365, "returns"), 6, "correlation"),
    f"WITH {_RET.format(src='odaily', a=O_AS_OF, n=365, w='')} SELECT x.ticker AS a, y.ticker AS b, round(covar_pop(x.ret, y.ret) / nullif(stddev_pop(x.ret) * stddev_pop(y.ret), 0), 6) AS correlation FROM r x JOIN r y ON x.day = y.day AND x.ticker < y.ticker WHERE x.ret IS NOT NULL AND y.ret IS NOT NULL GROUP BY 1, 2")
add("mrt16_corr_closes_two_tables", lambda t: rnd(mk.correlation_matrix(
    t.role("odaily").select("ticker", "day", "close").unionByName(t.role("futures").select("ticker", c("date").alias("day"), "close")), ["5-LOW", "2-HIGH", "CL=F", "GC=F", "SI=F"], R.o_asof(t), 1500), 6, "correlation"),
    f"""WITH u AS (SELECT ticker, day, close FROM odaily UNION ALL SELECT ticker, date, close FROM futures),
        d AS (SELECT * FROM u WHERE ticker IN ('5-LOW', '2-HIGH', 'CL=F', 'GC=F', 'SI=F') AND day BETWEEN {O_AS_OF} - 1500 AND {O_AS_OF})
        SELECT x.ticker AS a, y.ticker AS b, round(covar_pop(x.close, y.close) / nullif(stddev_pop(x.close) * stddev_pop(y.close), 0), 6) AS correlation FROM d x JOIN d y ON x.day = y.day AND x.ticker < y.ticker GROUP BY 1, 2""")
add("mrt17_rotation", lambda t: mk.rotation(t.role("odaily"), FIVE, "5-LOW", R.o_asof(t)),
    f"""WITH {_RET.format(src='odaily', a=O_AS_OF, n=60, w='')}, {_BENCH}, g AS (SELECT ticker, sum(ret) AS s, sum(bench) AS q FROM r JOIN b USING (day) WHERE ticker <> '5-LOW' AND ret IS NOT NULL AND bench IS NOT NULL GROUP BY 1)
        SELECT ticker, round(s * 100, 2) AS total_return_pct, round(q * 100, 2) AS bench_return_pct, round((s - q) * 100, 2) AS relative_pct, CASE WHEN s > q THEN 'outperform' ELSE 'underperform' END AS vs_bench FROM g""")
_GAP = f"""g AS (SELECT ticker, day, open, p, (open - p) / p * 100 AS gap FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY day) AS p FROM sdaily WHERE day BETWEEN {AS_OF} - 30 AND {AS_OF}))"""
add("mrt18_overnight_gaps", lambda t: mk.overnight_gaps(t.role("sdaily"), R.s_asof(t)),
    f"WITH {_GAP} SELECT ticker, day, round(p, 2) AS prev_close, round(open, 2) AS open, round(gap, 2) AS gap_pct FROM g WHERE abs(gap) > 2 ORDER BY abs(gap) DESC, ticker, day LIMIT 30")
add("mrt19_realised_vol", lambda t: mk.realised_vol(t.role("sdaily"), R.s_asof(t), 60),
    f"WITH {_RET.format(src='sdaily', a=AS_OF, n=60, w='')} SELECT ticker, round(stddev_pop(ret) * sqrt(252) * 100, 2) AS volatility FROM r WHERE ret IS NOT NULL GROUP BY 1")
add("mrt21_latest_prices", lambda t: rnd(mk.latest_prices(t.role("sdaily")), 6, "change_pct"),
    """SELECT ticker, max(day) FILTER (rn = 1) AS day, max(close) FILTER (rn = 1) AS close, max(volume) FILTER (rn = 1) AS volume, max(close) FILTER (rn = 2) AS prev_close,
       round(CASE WHEN max(close) FILTER (rn = 2) > 0 THEN (max(close) FILTER (rn = 1) - max(close) FILTER (rn = 2)) / max(close) FILTER (rn = 2) * 100 ELSE 0 END, 6) AS change_pct
       FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY day DESC) rn FROM sdaily) GROUP BY 1""")
add("mrt22_latest_bars", lambda t: com.latest_bars(t.role("futures")), "SELECT f.* FROM futures f JOIN (SELECT ticker, max(date) AS date FROM futures GROUP BY 1) USING (ticker, date)")
add("mrt22_latest_returns", lambda t: com.latest_returns(t.role("futures"), R.f_asof(t)),
    f"""SELECT ticker, name, date, close, p AS prev_close, round((close - p) / p * 100, 2) AS return_pct FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS p FROM futures) WHERE date = {F_AS_OF}""")
add("agg07_sector_performance", lambda t: mk.sector_performance(t.role("sdaily"), t.role("universe"), R.s_asof(t), 60),
    f"""WITH x AS (SELECT ticker, arg_min(close, day) AS a, arg_max(close, day) AS b FROM sdaily WHERE day BETWEEN {AS_OF} - 60 AND {AS_OF} GROUP BY 1)
        SELECT {SECTOR} AS sector, count(*) AS ticker_count, round(avg((b - a) / a * 100), 2) AS avg_return_pct FROM x JOIN universe USING (ticker) WHERE sic_code <> '' AND a > 0 GROUP BY 1""")
add("agg08_weekly_returns", lambda t: rnd(weekly_returns(t.role("odaily"), "ticker", "day"), 6, "return_pct"),
    """SELECT ticker, CAST(date_trunc('week', day) AS DATE) AS week, arg_min(close, day) AS week_open, arg_max(close, day) AS week_close,
       round((arg_max(close, day) - arg_min(close, day)) / arg_min(close, day) * 100, 6) AS return_pct FROM odaily GROUP BY 1, 2""")
add("agg08_momentum_velocity", lambda t: mk.momentum_velocity(t.role("odaily"), ["5-LOW"], R.o_asof(t)),
    f"""SELECT ticker, CAST(date_trunc('week', day) AS DATE) AS week, round((arg_max(close, day) - arg_min(close, day)) / arg_min(close, day) * 100, 2) AS return_pct
        FROM odaily WHERE ticker = '5-LOW' AND day BETWEEN {O_AS_OF} - 182 AND {O_AS_OF} GROUP BY 1, 2""")
add("agg09_sector_summary", lambda t: rnd(mk.sector_summary(t.role("universe")), 2, "total_market_cap"), "SELECT sector, count(*) AS count, round(sum(market_cap), 2) AS total_market_cap FROM universe GROUP BY 1")
add("agg22_hourly_profile", lambda t: rnd(mk.hourly_profile(t.role("minute"), ["click", "view", "error"]), 6, "avg_volume"),
    "SELECT ticker, CAST(hour(timestamp) AS INTEGER) AS hour, round(avg(volume), 6) AS avg_volume FROM minute WHERE ticker IN ('click', 'view', 'error') AND hour(timestamp) BETWEEN 9 AND 16 GROUP BY 1, 2")

# ---- options ----------------------------------------------------------------------

_DTE = "(expiration - snapshot_date)"
_ATM = "abs(strike - underlying_price) / underlying_price < 0.02"
C_ASOF = "(SELECT max(snapshot_date) FROM chain)"


def c_asof(t):
    return F.trunc(R.s_asof(t), "week")


add("agg11_put_call_ratio", lambda t: opt.put_call_ratio(t.role("chain"), c_asof(t), 900),
    f"""WITH g AS (SELECT underlying, snapshot_date, CAST(sum(CASE WHEN put_call = 'put' THEN volume ELSE 0 END) AS BIGINT) AS put_volume, CAST(sum(CASE WHEN put_call = 'call' THEN volume ELSE 0 END) AS BIGINT) AS call_volume
        FROM chain WHERE snapshot_date >= {C_ASOF} - 900 GROUP BY 1, 2) SELECT *, round(put_volume / greatest(call_volume, 1), 3) AS ratio FROM g""")
add("agg12_gex_by_strike", lambda t: opt.gex_by_strike(opt.snapshot(t.role("chain"))),
    f"""WITH {_SNAP}, g AS (SELECT underlying, strike, coalesce(sum(gamma * open_interest * 100) FILTER (put_call = 'call'), 0) AS a, coalesce(sum(gamma * open_interest * 100) FILTER (put_call = 'put'), 0) AS b
        FROM s WHERE {_DTE} <= 45 AND open_interest > 0 GROUP BY 1, 2) SELECT underlying, strike, round(a, 2) AS call_gamma, round(b, 2) AS put_gamma, round(a - b, 2) AS net_gamma FROM g WHERE abs(round(a - b, 2)) > 0""")
for _k, _e in (("spot_squared", "open_interest * gamma * underlying_price * underlying_price * 0.01::DOUBLE"), ("contract", "gamma * open_interest * 100"), ("spot", "open_interest * gamma * 100 * underlying_price")):
    add(f"agg13_net_gex_{_k}", (lambda k: lambda t: rnd(opt.net_gex(t.role("chain"), scale=k).withColumn("gex_sign", F.signum(F.round("gex_net", 4)).cast("int")), 4, "gex_net"))(_k),
        f"""SELECT underlying, snapshot_date, round(sum(CASE put_call WHEN 'call' THEN {_e} ELSE -({_e}) END), 4) AS gex_net, CAST(sign(round(sum(CASE put_call WHEN 'call' THEN {_e} ELSE -({_e}) END), 4)) AS INTEGER) AS gex_sign
            FROM chain WHERE gamma > 0 AND open_interest > 0 AND {_DTE} BETWEEN 0 AND 60 GROUP BY 1, 2""")
add("agg14_oi_by_strike", lambda t: opt.oi_by_strike(opt.snapshot(t.role("chain"))),
    f"""WITH {_SNAP}, g AS (SELECT underlying, strike, CAST(sum(CASE WHEN put_call = 'call' THEN open_interest ELSE 0 END) AS BIGINT) AS call_oi, CAST(sum(CASE WHEN put_call = 'put' THEN open_interest ELSE 0 END) AS BIGINT) AS put_oi,
        CAST(sum(open_interest) AS BIGINT) AS total_oi FROM s WHERE {_DTE} <= 45 AND open_interest > 0 GROUP BY 1, 2) SELECT * FROM g WHERE total_oi > 100""")
add("agg14_volume_profile", lambda t: opt.profile(opt.snapshot(t.role("chain"), date=day("1999-06-07")), "volume"),
    """SELECT underlying, expiration, strike, CAST(sum(CASE WHEN put_call = 'call' THEN volume ELSE 0 END) AS BIGINT) AS call_volume, CAST(sum(CASE WHEN put_call = 'put' THEN volume ELSE 0 END) AS BIGINT) AS put_volume
       FROM chain WHERE snapshot_date = DATE '1999-06-07' GROUP BY 1, 2, 3""")
add("agg15_term_structure", lambda t: opt.term_structure(opt.snapshot(t.role("chain"))),
    f"""WITH {_SNAP} SELECT underlying, expiration, CAST({_DTE} AS INTEGER) AS dte, round(avg(implied_vol), 4) AS iv FROM s WHERE put_call = 'call' AND abs(delta) BETWEEN 0.35 AND 0.65 AND implied_vol > 0 AND {_DTE} BETWEEN 1 AND 365 GROUP BY 1, 2, 3""")
_TERM = f"""(SELECT underlying, snapshot_date, {_DTE} AS dte, avg(implied_vol) AS iv FROM chain WHERE put_call = 'call' AND implied_vol > 0 AND {_ATM} AND {_DTE} BETWEEN 7 AND 90 GROUP BY 1, 2, 3)"""
add("agg16_term_slope", lambda t: rnd(opt.term_slope(t.role("chain")), 6, "term_structure_slope"),
    f"SELECT underlying, snapshot_date, round(arg_min(iv, dte) - arg_max(iv, dte), 6) AS term_structure_slope FROM {_TERM} GROUP BY 1, 2")
_ATMIV = "SELECT underlying, snapshot_date, avg(implied_vol) AS iv FROM chain WHERE put_call = 'call' AND {n} AND (expiration - snapshot_date) BETWEEN 20 AND 40 AND implied_vol > 0 GROUP BY 1, 2"
add("agg17_atm_iv_delta", lambda t: rnd(opt.atm_iv(t.role("chain")), 6, "iv"), f"SELECT underlying, snapshot_date, round(iv, 6) AS iv FROM ({_ATMIV.format(n='abs(delta) BETWEEN 0.40 AND 0.60')})")
add("agg17_atm_iv_strike", lambda t: rnd(opt.atm_iv(t.role("chain"), "strike"), 6, "iv"), f"SELECT underlying, snapshot_date, round(iv, 6) AS iv FROM ({_ATMIV.format(n=_ATM)})")
_SKEW = f"""SELECT underlying, snapshot_date, avg(implied_vol) FILTER (put_call = 'put' AND delta BETWEEN -0.30 AND -0.20) AS p, avg(implied_vol) FILTER (put_call = 'call' AND delta BETWEEN 0.20 AND 0.30) AS k
    FROM chain WHERE implied_vol > 0 AND {_DTE} BETWEEN 20 AND 40 GROUP BY 1, 2"""
add("agg18_skew_25d", lambda t: rnd(opt.skew_25d(t.role("chain")), 6, "put_iv_25d", "call_iv_25d", "skew"),
    f"SELECT underlying, snapshot_date, round(p, 6) AS put_iv_25d, round(k, 6) AS call_iv_25d, round(p - k, 6) AS skew FROM ({_SKEW}) WHERE p > 0 AND k > 0")
_HIST = f"""h AS (SELECT c.underlying, c.expiration, c.strike, c.put_call, avg(c.volume) AS av FROM chain c JOIN (SELECT underlying, max(snapshot_date) AS d FROM chain GROUP BY 1) m ON c.underlying = m.underlying
    AND c.snapshot_date BETWEEN m.d - 25 AND m.d - 1 GROUP BY 1, 2, 3, 4)"""
_SIDE = ", ".join(f"""max(bid) FILTER (put_call = '{s}') AS {s}_bid, max(ask) FILTER (put_call = '{s}') AS {s}_ask, max(close) FILTER (put_call = '{s}') AS {s}_last, max(volume) FILTER (put_call = '{s}') AS {s}_volume,
    max(open_interest) FILTER (put_call = '{s}') AS {s}_oi, round(max(implied_vol) FILTER (put_call = '{s}'), 4) AS {s}_iv, round(max(delta) FILTER (put_call = '{s}'), 3) AS {s}_delta,
    round(max(av) FILTER (put_call = '{s}'), 0) AS {s}_avg_vol""" for s in ("call", "put"))
add("agg19_chain_table", lambda t: opt.chain_table(t.role("chain")),
    f"WITH {_SNAP}, {_HIST} SELECT underlying, expiration, strike, {_SIDE} FROM s LEFT JOIN h USING (underlying, expiration, strike, put_call) GROUP BY 1, 2, 3")
_FLOW = """g AS (SELECT underlying, trade_date, expiration, strike,
    sum(CASE WHEN (put_call = 'call' AND aggressor_side = 'buy') OR (put_call = 'put' AND aggressor_side = 'sell') THEN notional WHEN aggressor_side = 'mid' THEN notional * 0.25 ELSE 0 END) AS b,
    sum(CASE WHEN (put_call = 'call' AND aggressor_side = 'sell') OR (put_call = 'put' AND aggressor_side = 'buy') THEN notional WHEN aggressor_side = 'mid' THEN notional * 0.25 ELSE 0 END) AS s
    FROM trades t WHERE {w} AND expiration >= trade_date GROUP BY 1, 2, 3, 4)
    SELECT underlying, trade_date, expiration, strike, round(b, 5) AS bullish_notional, round(s, 5) AS bearish_notional, CAST(expiration - trade_date AS INTEGER) AS dte, round(b - s, 5) AS net_flow,
    round(coalesce((b - s) / nullif(b + s, 0), 0), 6) AS bias_ratio FROM g WHERE b + s >= 10000"""
_flow = lambda d: rnd(rnd(d, 5, "bullish_notional", "bearish_notional", "net_flow"), 6, "bias_ratio")
add("agg20_flow_surface_latest", lambda t: _flow(opt.flow_surface(t.role("trades"))), "WITH " + _FLOW.format(w="trade_date = (SELECT max(trade_date) FROM trades i WHERE i.underlying = t.underlying)"))
add("agg20_flow_surface_day", lambda t: _flow(opt.flow_surface(t.role("trades"), day("1998-11-02"))), "WITH " + _FLOW.format(w="trade_date = DATE '1998-11-02'"))
add("agg21_zero_day_flow", lambda t: rnd(opt.zero_day_flow(t.role("chain")), 6, "zero_dte_pc_ratio"),
    """SELECT underlying, snapshot_date, CAST(sum(CASE WHEN put_call = 'put' THEN volume ELSE 0 END) AS BIGINT) AS zero_dte_put_volume, CAST(sum(CASE WHEN put_call = 'call' THEN volume ELSE 0 END) AS BIGINT) AS zero_dte_call_volume,
       round(sum(CASE WHEN put_call = 'put' THEN volume ELSE 0 END) / nullif(sum(CASE WHEN put_call = 'call' THEN volume ELSE 0 END), 0), 6) AS zero_dte_pc_ratio FROM chain WHERE expiration = snapshot_date AND volume > 0 GROUP BY 1, 2""")
_G = "open_interest * gamma * 100 * underlying_price"
add("agg31_max_gex_strike", lambda t: opt.max_gex_strike(t.role("chain")),
    f"""WITH g AS (SELECT underlying, snapshot_date, strike, max(underlying_price) AS spot, coalesce(sum({_G}) FILTER (put_call = 'call'), 0) - coalesce(sum({_G}) FILTER (put_call = 'put'), 0) AS gex, sum(open_interest) AS oi
        FROM chain WHERE expiration = snapshot_date AND underlying_price IS NOT NULL AND open_interest > 0 GROUP BY 1, 2, 3),
        r AS (SELECT *, row_number() OVER (PARTITION BY underlying, snapshot_date ORDER BY round(abs(gex), 6) DESC, strike DESC) rn FROM g WHERE oi > 100)
        SELECT underlying, snapshot_date, spot, strike AS max_gex_strike, round(abs(spot - strike) / spot * 100, 3) AS pct_from_max_gex FROM r WHERE rn = 1""")
add("agg32_gex_stress", lambda t: rnd(opt.gex_stress(t.role("chain"), day("1998-01-01"), day("1998-12-31")), 4, "call_gex", "put_gex", "net_gex"),
    f"""SELECT underlying, snapshot_date, max(underlying_price) AS spot, round(coalesce(sum({_G}) FILTER (put_call = 'call'), 0), 4) AS call_gex, round(coalesce(sum({_G}) FILTER (put_call = 'put'), 0), 4) AS put_gex,
        CAST(sum(open_interest) AS BIGINT) AS total_oi, round(coalesce(sum({_G}) FILTER (put_call = 'call'), 0) - coalesce(sum({_G}) FILTER (put_call = 'put'), 0), 4) AS net_gex FROM chain
        WHERE expiration = snapshot_date AND underlying_price IS NOT NULL AND snapshot_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' GROUP BY 1, 2""")
add("win09_iv_gauge", lambda t: opt.iv_gauge(t.role("chain"), c_asof(t)),
    f"""WITH d AS (SELECT underlying, snapshot_date, round(iv, 4) AS iv FROM ({_ATMIV.format(n='abs(delta) BETWEEN 0.40 AND 0.60')}) WHERE snapshot_date >= {C_ASOF} - 365),
        n AS (SELECT underlying, arg_max(iv, snapshot_date) AS cur FROM d GROUP BY 1) SELECT underlying, cur AS current_iv, round(count(*) FILTER (iv <= cur) / count(*) * 100, 1) AS percentile_rank, min(iv) AS min_1y, max(iv) AS max_1y,
        round(avg(iv), 4) AS avg_1y FROM d JOIN n USING (underlying) GROUP BY 1, 2""")


def _renamed_chain(t):
    return t.role("chain").withColumn("underlying", F.when(c("underlying") == "R", "5-LOW").when(c("underlying") == "A", "1-URGENT").otherwise(c("underlying")))


add("mrt20_hv_vs_iv", lambda t: opt.hv_vs_iv(t.role("odaily"), _renamed_chain(t), R.o_asof(t)),
    f"""WITH r AS (SELECT ticker, day, ln(close) - ln(lag(close) OVER (PARTITION BY ticker ORDER BY day)) AS ret FROM odaily WHERE day BETWEEN {O_AS_OF} - 405 AND {O_AS_OF}),
        v AS (SELECT ticker, day, round(stddev_pop(ret) OVER (PARTITION BY ticker ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) * sqrt(252) * 100, 2) AS hv30 FROM r WHERE ret IS NOT NULL),
        i AS (SELECT CASE underlying WHEN 'R' THEN '5-LOW' WHEN 'A' THEN '1-URGENT' ELSE underlying END AS ticker, snapshot_date AS day, round(iv * 100, 2) AS iv30 FROM ({_ATMIV.format(n='abs(delta) BETWEEN 0.40 AND 0.60')})
              WHERE snapshot_date BETWEEN {O_AS_OF} - 365 AND {O_AS_OF}) SELECT ticker, day, hv30, iv30 FROM v JOIN i USING (ticker, day) WHERE day >= {O_AS_OF} - 365 AND hv30 > 0""")
_ACT = f"""underlying, expiration, strike, put_call, volume, open_interest, round(coalesce(av, 0), 0) AS avg_volume, round(volume / greatest(coalesce(av, 1), 1), 1) AS vol_ratio, round(implied_vol, 4) AS implied_vol,
    round(delta, 3) AS delta, bid, ask, underlying_price, CAST({_DTE} AS INTEGER) AS dte"""
add("mrt23_unusual_activity", lambda t: opt.unusual_activity(t.role("chain"), min_ratio=1.2, min_volume=100),
    f"""WITH {_SNAP}, {_HIST} SELECT {_ACT} FROM s JOIN h USING (underlying, expiration, strike, put_call) WHERE av > 0 AND volume >= 100 AND volume / greatest(av, 1) >= 1.2
        ORDER BY vol_ratio DESC, underlying, expiration, strike, put_call LIMIT 30""")
add("mrt24_volume_over_oi", lambda t: opt.volume_over_oi(t.role("chain"), limit=None),
    f"""WITH {_SNAP}, {_HIST} SELECT {_ACT} FROM s LEFT JOIN (SELECT * FROM h WHERE av > 0) USING (underlying, expiration, strike, put_call) WHERE volume > open_interest AND volume >= 500""")

# ---- statements and filings -------------------------------------------------------

_LATESTQ = "q AS (SELECT f.* FROM financials f JOIN (SELECT ticker, max(period_end) AS period_end FROM financials WHERE fiscal_period <> 'FY' GROUP BY 1) USING (ticker, period_end) WHERE fiscal_period <> 'FY')"
add("mrt11_fundamentals_screener", lambda t: fun.fundamentals_screener(t.role("financials"), t.role("prices"), None),
    f"""WITH {_LATESTQ} SELECT ticker, round(close, 2) AS price, round(close / nullif(diluted_eps * 4, 0), 1) AS pe_ratio, round(close * weighted_avg_shares_diluted / nullif(revenue * 4, 0), 2) AS price_to_sales,
        round(gross_profit / nullif(revenue, 0) * 100, 1) AS gross_margin, round(operating_income / nullif(revenue, 0) * 100, 1) AS op_margin, round(net_income / nullif(revenue, 0) * 100, 1) AS net_margin,
        round(total_liabilities / nullif(total_equity, 0), 2) AS debt_to_equity, operating_cash_flow + investing_cash_flow AS fcf, round(research_and_dev / nullif(revenue, 0) * 100, 1) AS rd_pct
        FROM q JOIN prices USING (ticker) WHERE revenue > 0""")
add("mrt12_equity_risk_premium", lambda t: fun.equity_risk_premium(t.role("financials"), t.role("prices"), t.role("yields")),
    f"""WITH {_LATESTQ}, y AS (SELECT arg_max(yield_10_year, date) AS r FROM yields) SELECT ticker, round(close, 2) AS price, round(diluted_eps * 4, 2) AS annual_eps, round(diluted_eps * 4 / close * 100, 2) AS earnings_yield,
        r AS treasury_10y, round(diluted_eps * 4 / close * 100 - r, 2) AS equity_risk_premium FROM q JOIN prices USING (ticker) CROSS JOIN y WHERE diluted_eps > 0 ORDER BY equity_risk_premium DESC, ticker LIMIT 30""")
add("mrt13_pe_list", lambda t: rnd(fun.pe_list(t.role("financials"), t.role("prices"), "2000"), 6, "pe_ratio"),
    "SELECT ticker, diluted_eps, close, round(close / diluted_eps, 6) AS pe_ratio FROM financials JOIN prices USING (ticker) WHERE fiscal_year = '2000' AND fiscal_period = 'FY' AND diluted_eps > 0")
_EFF = "coalesce(shares_outstanding, weighted_avg_shares_diluted, weighted_avg_shares_basic)"
_CLEAN = f"CASE WHEN antidilutive_shares > coalesce({_EFF}, 1) * 20 THEN NULL ELSE antidilutive_shares END"
_POSSIBLE = "coalesce(warrants_outstanding, 0) + coalesce(options_outstanding, 0) + coalesce(unvested_rsu_shares, 0) + coalesce(clean, 0)"
add("mrt25_dilution_snapshot", lambda t: fun.dilution_snapshot(t.role("financials")),
    f"""WITH d AS (SELECT *, {_EFF} AS eff, {_CLEAN} AS clean FROM financials WHERE fiscal_period = 'FY') SELECT ticker, period_end, eff AS shares_outstanding, shares_authorized, shares_authorized - eff AS authorized_headroom,
        round((shares_authorized - eff) / nullif(eff, 0) * 100, 1) AS headroom_pct, weighted_avg_shares_basic, weighted_avg_shares_diluted, weighted_avg_shares_diluted - weighted_avg_shares_basic AS dilutive_effect,
        stock_based_compensation, round(stock_based_compensation / nullif(revenue, 0) * 100, 1) AS sbc_pct_of_revenue, clean AS antidilutive_shares, {_POSSIBLE} AS total_potential_dilution_shares,
        round(({_POSSIBLE}) / nullif(eff, 0) * 100, 1) AS total_dilution_pct, coalesce(buyback_shares, 0) - coalesce(shares_issued_options, 0) - coalesce(shares_issued_rsu_vested, 0) - coalesce(shares_from_conversion, 0) AS net_buyback_shares FROM d""")
for _tf, _w in (("quarterly", "CASE WHEN (SELECT count(*) FROM financials i WHERE i.ticker = f.ticker AND i.fiscal_period <> 'FY') > 0 THEN fiscal_period <> 'FY' ELSE fiscal_period = 'FY' END"), ("annual", "fiscal_period = 'FY'")):
    add(f"mrt26_dilution_series_{_tf}", (lambda k: lambda t: fun.dilution_series(t.role("financials"), k))(_tf),
        f"""WITH d AS (SELECT *, {_EFF} AS eff FROM financials f WHERE {_w}) SELECT ticker, period_end, fiscal_year, fiscal_period, eff AS shares_outstanding, weighted_avg_shares_basic, weighted_avg_shares_diluted,
            weighted_avg_shares_diluted - weighted_avg_shares_basic AS dilutive_effect, stock_based_compensation, round(stock_based_compensation / nullif(revenue, 0) * 100, 2) AS sbc_pct_revenue, shares_authorized,
            round((shares_authorized - eff) / nullif(eff, 0) * 100, 1) AS headroom_pct, revenue FROM d""")
add("mrt27_latest_statements", lambda t: fun.latest_statements(t.role("financials")).select("ticker", "period_end", "revenue", "net_income"),
    "SELECT ticker, period_end, revenue, net_income FROM financials JOIN (SELECT ticker, max(period_end) AS period_end FROM financials WHERE fiscal_period = 'FY' GROUP BY 1) USING (ticker, period_end) WHERE fiscal_period = 'FY'")
add("mrt28_latest_holders", lambda t: fil.latest_holders(t.role("holders")),
    "SELECT h.* FROM holders h JOIN (SELECT ticker, holder_name, max(filed_date) AS filed_date FROM holders GROUP BY 1, 2) USING (ticker, holder_name, filed_date)")
add("agg10_insider_monthly", lambda t: rnd(fil.insider_monthly(t.role("insider")), 2, "buy_value", "sell_value", "net_value"),
    """SELECT ticker, CAST(date_trunc('month', report_date) AS DATE) AS month, count(*) FILTER (transaction_code = 'P') AS buy_count, count(*) FILTER (transaction_code = 'S') AS sell_count,
       round(sum(CASE WHEN transaction_code = 'P' THEN value ELSE 0 END), 2) AS buy_value, round(sum(CASE WHEN transaction_code = 'S' THEN value ELSE 0 END), 2) AS sell_value,
       sum(CASE WHEN transaction_code = 'P' THEN shares ELSE 0 END) AS buy_shares, sum(CASE WHEN transaction_code = 'S' THEN shares ELSE 0 END) AS sell_shares,
       round(sum(CASE WHEN transaction_code = 'P' THEN value ELSE 0 END) - sum(CASE WHEN transaction_code = 'S' THEN value ELSE 0 END), 2) AS net_value FROM insider WHERE transaction_code IN ('P', 'S') GROUP BY 1, 2""")

# ---- commodities and macro --------------------------------------------------------

add("agg23_seasonality", lambda t: com.seasonality(t.role("futures"), R.f_asof(t), 5),
    f"""WITH m AS (SELECT ticker, month(date) AS month, year(date) AS y, avg(close) AS a FROM futures WHERE date >= {F_AS_OF} - INTERVAL 60 MONTH GROUP BY 1, 2, 3), z AS (SELECT year({F_AS_OF}) AS y)
        SELECT ticker, CAST(month AS INTEGER) AS month, round(avg(a) FILTER (m.y < z.y), 4) AS avg_close, round(min(a) FILTER (m.y < z.y), 4) AS min_close, round(max(a) FILTER (m.y < z.y), 4) AS max_close,
        round(max(a) FILTER (m.y = z.y), 4) AS current_year_close FROM m, z GROUP BY 1, 2 HAVING count(*) FILTER (m.y < z.y) > 0""")
add("agg24_vs_range", lambda t: rnd(com.vs_range(t.role("petro_weekly"), "crude_stocks"), 6, "range_avg"),
    """WITH z AS (SELECT year(max(date)) AS y FROM petro_weekly), p AS (SELECT weekofyear(date) AS w, avg(crude_stocks) AS a, min(crude_stocks) AS lo, max(crude_stocks) AS hi FROM petro_weekly, z
       WHERE year(date) BETWEEN z.y - 5 AND z.y - 1 GROUP BY 1) SELECT date, crude_stocks AS current, round(a, 6) AS range_avg, lo AS range_min, hi AS range_max, round(crude_stocks - a, 1) AS vs_avg,
       round((crude_stocks - a) / a * 100, 2) AS vs_avg_pct FROM petro_weekly JOIN p ON weekofyear(date) = p.w, z WHERE year(date) = z.y""")
_PV = "p AS (SELECT date, " + ", ".join(f"coalesce(sum(close) FILTER (ticker = '{s}'), 0) AS {s[:-2].lower()}" for s in R.SYMBOLS) + " FROM futures WHERE date >= {since} GROUP BY 1)"
add("agg25_spreads", lambda t: com.spreads(t.role("futures"), F.date_sub(R.f_asof(t), 700)),
    f"""WITH {_PV.format(since=F_AS_OF + ' - 700')}, s AS (SELECT date, round(2 * rb * 42 + ho * 42 - 3 * cl, 2) AS a, CASE WHEN zs > 0 AND zm > 0 AND zl > 0 THEN round(zm * 0.022::DOUBLE + zl * 0.11::DOUBLE - zs / 100, 2) END AS b,
        CASE WHEN si > 0 THEN round(gc / si, 2) END AS c, CASE WHEN ng > 0 THEN round(cl / ng, 2) END AS d FROM p WHERE cl > 0 AND rb > 0 AND ho > 0),
        u AS (SELECT date, unnest(['Crack Spread (3:2:1)', 'Crush Spread', 'Gold/Silver Ratio', 'Crude/NatGas Ratio']) AS name, unnest([a, b, c, d]) AS v FROM s),
        g AS (SELECT name, max(v) FILTER (date = (SELECT max(date) FROM s)) AS current_value, round(avg(v), 2) AS avg_value FROM u GROUP BY 1)
        SELECT name, current_value, avg_value, round((current_value - avg_value) / avg_value * 100, 2) AS pct_vs_avg FROM g WHERE current_value IS NOT NULL AND avg_value <> 0""")
add("agg26_ratios", lambda t: com.ratios(t.role("futures"), F.date_sub(R.f_asof(t), 730)),
    f"""WITH {_PV.format(since=F_AS_OF + ' - 730')}, r AS (SELECT date, unnest(['Gold/Silver', 'Crude/NatGas', 'Platinum/Gold', 'Corn/Wheat', 'Copper/Gold']) AS name,
        unnest([CASE WHEN si > 0 THEN gc / si END, CASE WHEN ng > 0 THEN cl / ng END, CASE WHEN gc > 0 THEN pl / gc END, CASE WHEN zw > 0 THEN zc / zw END, CASE WHEN gc > 0 THEN hg * 100 / gc END]) AS v FROM p),
        g AS (SELECT name, max(v) FILTER (date = (SELECT max(date) FROM p)) AS now, round(avg(v), 4) AS avg_ratio, round(stddev_pop(v), 4) AS stddev FROM r GROUP BY 1)
        SELECT name, CASE name WHEN 'Gold/Silver' THEN 'GC=F' WHEN 'Crude/NatGas' THEN 'CL=F' WHEN 'Platinum/Gold' THEN 'PL=F' WHEN 'Corn/Wheat' THEN 'ZC=F' ELSE 'HG=F' END AS ticker_a,
          CASE name WHEN 'Gold/Silver' THEN 'SI=F' WHEN 'Crude/NatGas' THEN 'NG=F' WHEN 'Corn/Wheat' THEN 'ZW=F' ELSE 'GC=F' END AS ticker_b,
          CASE WHEN name IN ('Gold/Silver', 'Crude/NatGas') THEN round(now, 2) ELSE round(now, 4) END AS current_ratio, avg_ratio, stddev, CASE WHEN stddev > 0 THEN round((now - avg_ratio) / stddev, 2) ELSE 0 END AS zscore FROM g WHERE now IS NOT NULL""")
add("agg27_macro_dashboard", lambda t: macro.macro_dashboard(t.role("monthly"), t.role("monthly"), t.role("monthly"), t.role("yields"), t.role("odaily"), ("5-LOW", "1-URGENT"), day("1996-01-01")),
    """WITH y AS (SELECT date_trunc('month', date) AS m, avg(yield_10_year) AS a, avg(yield_1_year) AS b FROM yields GROUP BY 1),
       k AS (SELECT date_trunc('month', day) AS m, avg(close) FILTER (ticker = '5-LOW') AS a, avg(close) FILTER (ticker = '1-URGENT') AS b FROM odaily GROUP BY 1)
       SELECT x.date AS month, unemployment_rate AS unemp, round(cpi, 1) AS cpi, round(model_1_year, 1) AS infl_exp_1y, round(y.a, 2) AS y10, round(y.a - y.b, 2) AS curve_1s10s, round(k.a, 0) AS avg_0, round(k.b, 0) AS avg_1
       FROM monthly x LEFT JOIN y ON x.date = y.m LEFT JOIN k ON x.date = k.m WHERE x.date >= DATE '1996-01-01' AND unemployment_rate IS NOT NULL""")
add("agg28_regime_dashboard", lambda t: macro.regime_dashboard(t.role("odaily").filter(c("ticker") == "5-LOW"), t.role("yields"), t.role("monthly"), t.role("monthly"), day("1996-01-01")),
    """WITH r AS (SELECT day, ln(close) - ln(lag(close) OVER (ORDER BY day)) AS ret FROM odaily WHERE ticker = '5-LOW'),
       v AS (SELECT day, stddev_pop(ret) OVER (ORDER BY day ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) * sqrt(252) * 100 AS vol FROM r), vm AS (SELECT date_trunc('month', day) AS m, avg(vol) AS vol FROM v WHERE day >= DATE '1996-01-01' GROUP BY 1),
       cm AS (SELECT date_trunc('month', date) AS m, avg(yield_10_year - yield_1_year) AS sp FROM yields WHERE yield_10_year IS NOT NULL AND yield_1_year IS NOT NULL GROUP BY 1),
       im AS (SELECT date AS m, cpi - lag(cpi, 12) OVER (ORDER BY date) AS ch FROM monthly), jm AS (SELECT date AS m, unemployment_rate AS u, unemployment_rate - lag(unemployment_rate, 6) OVER (ORDER BY date) AS d FROM monthly WHERE unemployment_rate IS NOT NULL)
       SELECT CAST(vm.m AS DATE) AS month, round(vol, 1) AS vol, CASE WHEN vol < 15 THEN 'calm' WHEN vol < 25 THEN 'normal' WHEN vol < 40 THEN 'elevated' WHEN vol IS NOT NULL THEN 'crisis' END AS vol_regime, round(sp, 2) AS spread,
       CASE WHEN sp < -0.5 THEN 'deep_inverted' WHEN sp < 0 THEN 'inverted' WHEN sp < 1 THEN 'flat' WHEN sp IS NOT NULL THEN 'steep' END AS curve_regime, round(ch, 1) AS cpi_change,
       CASE WHEN ch > 15 THEN 'hot' WHEN ch > 8 THEN 'warm' WHEN ch > 0 THEN 'stable' WHEN ch IS NOT NULL THEN 'deflation' END AS price_regime, round(u, 1) AS unemployment,
       CASE WHEN d > 0.5 THEN 'deteriorating' WHEN d > 0 THEN 'softening' WHEN d IS NOT NULL THEN 'strong' END AS jobs_regime FROM vm LEFT JOIN cm USING (m) LEFT JOIN im USING (m) LEFT JOIN jm USING (m)""")
add("agg29_energy_latest", lambda t: com.energy_latest(t.role("energy"), ["wti_crude", "brent_crude", "natural_gas", "gasoline", "heating_oil"]),
    "SELECT max(date) AS date, " + ", ".join(f"arg_max({x}, date) AS {x}" for x in ("wti_crude", "brent_crude", "natural_gas", "gasoline", "heating_oil")) + " FROM energy")
add("mrt29_petroleum_balance", lambda t: com.petroleum_balance(t.role("petro_weekly")),
    """SELECT *, round(crude_imports - crude_exports, 1) AS crude_net_imports, round(crude_stocks + spr_stocks, 1) AS total_stocks, round(crude_stocks / greatest(product_supplied, 0.001), 1) AS days_of_supply,
       round(crude_stocks - lag(crude_stocks) OVER (ORDER BY date), 1) AS crude_stocks_wow, round(spr_stocks - lag(spr_stocks) OVER (ORDER BY date), 1) AS spr_stocks_wow FROM petro_weekly""")
add("mrt30_producer_share", lambda t: com.producer_share(t.role("petro_monthly")),
    "SELECT *, " + ", ".join(f"round({p}_production / greatest(opec_production, 0.001) * 100, 1) AS {p}_pct" for p in ("saudi", "iran", "iraq", "uae")) + ", "
    + ", ".join(f"round({p}_production - lag({p}_production) OVER (ORDER BY date), 1) AS {p}_mom" for p in ("opec", "iran", "us")) + " FROM petro_monthly")
add("mrt31_import_dependency", lambda t: com.import_dependency(t.role("petro_monthly")),
    """SELECT date, imports_persian_gulf, imports_total, round(imports_persian_gulf / greatest(imports_total, 0.001) * 100, 2) AS gulf_pct, round(imports_persian_gulf - lag(imports_persian_gulf) OVER (ORDER BY date), 1) AS gulf_mom,
       round(imports_total - lag(imports_total) OVER (ORDER BY date), 1) AS total_mom FROM petro_monthly""")

# ---- breadth thrust ---------------------------------------------------------------

_AD = """ad AS (SELECT day, count(*) FILTER (close > p) AS advancing, count(*) FILTER (close < p) AS declining, count(*) FILTER (close = p) AS unchanged, count(*) AS total
    FROM (SELECT s.ticker, day, close, lag(close) OVER (PARTITION BY s.ticker ORDER BY day) AS p FROM sdaily s JOIN universe u USING (ticker) WHERE exchange IN ('NYSE', 'NYSE American') AND close > 0) WHERE p IS NOT NULL GROUP BY 1)"""
_THRUST = f"""WITH RECURSIVE {_AD}, n AS (SELECT *, advancing / nullif(advancing + declining, 0) AS ratio, row_number() OVER (ORDER BY day) AS i FROM ad),
    o AS (SELECT *, row_number() OVER (ORDER BY day) AS k FROM n WHERE ratio IS NOT NULL),
    e AS (SELECT k, day, ratio AS y FROM o WHERE k = 1 UNION ALL SELECT o.k, o.day, o.ratio * (2.0::DOUBLE / 11) + e.y * (1 - 2.0::DOUBLE / 11) FROM e JOIN o ON o.k = e.k + 1),
    f AS (SELECT *, coalesce(y < 0.40::DOUBLE, FALSE) AS oversold, coalesce(y > 0.615::DOUBLE, FALSE) AS thrust FROM (SELECT n.*, last_value(e.y IGNORE NULLS) OVER (ORDER BY n.day) AS y FROM n LEFT JOIN e USING (day))),
    g AS (SELECT *, sum(CAST(oversold AS INTEGER)) OVER w AS seg, max(CASE WHEN oversold THEN i END) OVER w AS oi FROM f WINDOW w AS (ORDER BY i ROWS UNBOUNDED PRECEDING)),
    h AS (SELECT *, i - oi AS d, coalesce(thrust AND i - oi <= 10, FALSE) AS hit FROM g), k AS (SELECT *, coalesce(max(CAST(hit AS INTEGER)) OVER (PARTITION BY seg ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS already FROM h),
    z AS (SELECT *, coalesce(oi IS NOT NULL AND NOT already AND d <= 10, FALSE) AS active FROM k)"""
add("mrt32_breadth_thrust", lambda t: rnd(breadth.breadth_thrust(t.role("sdaily"), t.role("universe")).withColumn("days_in_window", c("days_in_window").cast("long")), 8, "breadth_ratio", "ema_10"),
    _THRUST + """ SELECT day, advancing, declining, unchanged, total, round(ratio, 8) AS breadth_ratio, round(y, 8) AS ema_10, oversold, thrust, active AS signal_active, CASE WHEN active THEN d END AS days_in_window,
        hit AND active AS signal_fired FROM z""")
add("mrt33_thrust_status", lambda t: breadth.thrust_status(breadth.breadth_thrust(t.role("sdaily"), t.role("universe"))).withColumn("days_left", c("days_left").cast("long")),
    _THRUST + """ SELECT day, round(ratio, 4) AS breadth_ratio, round(y, 4) AS ema_10, CASE WHEN hit AND active THEN 'fired' WHEN oversold THEN 'oversold' WHEN active THEN 'active' WHEN thrust THEN 'thrust' ELSE 'none' END AS status,
        CASE WHEN active THEN 10 - d END AS days_left FROM z ORDER BY day DESC LIMIT 15""")
