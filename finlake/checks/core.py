"""Hygiene, joins, windows, bars, indicators, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from finlake.checks import roles as R
from finlake.checks.registry import add, rnd
from finlake.operators import asof, bars, dedup, events, indicators as ind, joins, pairs, quality, quantiles, returns
from finlake.operators.series import Split

c = F.col
TICKS = Split(every="6 hours", rows=500)

# ---- DQ ---------------------------------------------------------------------------

add("dq01_latest_version", lambda t: dedup.latest_version(
    t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]),
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC) rn FROM lineitem) WHERE rn = 1""")


def _raw_bars(t):
    """Line items as raw bars with defects: disordered prices, missing closes, negative volume, repeats."""
    k, p = c("l_linenumber"), c("l_extendedprice")
    return t.lineitem.select(
        c("l_suppkey").cast("string").alias("ticker"), c("l_shipdate").alias("timestamp"), p.alias("open"), (p + 5 - k).alias("high"), (p - 1).alias("low"),
        F.when(c("l_tax") > 0, p).alias("close"), F.when(c("l_discount") == 0, F.lit(-1)).otherwise(c("l_quantity").cast("long")).alias("volume"),
        (c("l_orderkey") * 10 + k).alias("ingested_at"))


_RAW_BARS = """raw AS (SELECT CAST(l_suppkey AS VARCHAR) AS ticker, l_shipdate AS timestamp, l_extendedprice AS open, l_extendedprice + 5 - l_linenumber AS high,
    l_extendedprice - 1 AS low, CASE WHEN l_tax > 0 THEN l_extendedprice END AS close, CASE WHEN l_discount = 0 THEN -1 ELSE CAST(l_quantity AS BIGINT) END AS volume,
    l_orderkey * 10 + l_linenumber AS ingested_at FROM lineitem)"""
_SANE = "high >= low AND high >= open AND high >= close AND low <= open AND low <= close"

add("dq02_validate_bars", lambda t: quality.validate_bars(_raw_bars(t)),
    f"""WITH {_RAW_BARS} SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ticker, timestamp ORDER BY ingested_at DESC) rn FROM raw
        WHERE close IS NOT NULL AND {_SANE} AND volume >= 0) WHERE rn = 1""")

add("dq02_bar_report", lambda t: quality.bar_report(_raw_bars(t)),
    f"""WITH {_RAW_BARS}, f AS (SELECT *, close IS NOT NULL AS ok1, close IS NOT NULL AND {_SANE} AS ok2, close IS NOT NULL AND {_SANE} AND volume >= 0 AS ok3 FROM raw)
        SELECT count(*) AS input_rows, count(*) FILTER (NOT ok1) AS null_rows, count(*) FILTER (ok1 AND NOT ok2) AS disordered_rows,
        count(*) FILTER (ok2 AND NOT ok3) AS negative_volume_rows, count(*) FILTER (ok3) - count(DISTINCT (ticker, timestamp)) FILTER (ok3) AS duplicate_rows,
        count(DISTINCT (ticker, timestamp)) FILTER (ok3) AS output_rows FROM f""")

add("dq03_validate_chain", lambda t: quality.validate_chain(
    t.role("chain").withColumn("theta", F.when(c("theta") != 0, c("theta"))), ["snapshot_date", "seq"])
    .select("underlying", "expiration", "strike", "put_call", "snapshot_date", "bid", "ask", "theta", "implied_vol", "seq"),
    """SELECT underlying, expiration, strike, put_call, snapshot_date, bid, ask, theta, implied_vol, seq FROM (SELECT *, row_number() OVER
       (PARTITION BY underlying, expiration, strike, put_call ORDER BY snapshot_date DESC, seq DESC) rn FROM chain WHERE theta <> 0) WHERE rn = 1""")

add("dq05_missing_keys", lambda t: quality.missing_keys(t.customer.select(c("c_custkey").alias("k")), t.orders.filter(c("o_orderstatus") == "F").select(c("o_custkey").alias("k")), "k"),
    "SELECT DISTINCT c_custkey AS k FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")

add("dq06_pending_dates", lambda t: quality.pending_dates(
    t.role("odaily").select(c("ticker").alias("symbol"), "day"),
    t.orders.filter(c("o_orderstatus") == "F").select(c("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("day")), F.lit("1996-01-01").cast("date")),
    """SELECT ticker AS symbol, day FROM odaily WHERE day >= DATE '1996-01-01' AND NOT EXISTS
       (SELECT 1 FROM orders WHERE o_orderpriority = ticker AND CAST(o_orderdate AS DATE) = day AND o_orderstatus = 'F')""")


def _progress(t):
    month = F.trunc(F.to_date("l_shipdate"), "month")
    grid = t.lineitem.select(c("l_suppkey").alias("ticker"), month.alias("month")).distinct()
    done = t.lineitem.filter(c("l_linenumber") <= 2).groupBy(c("l_suppkey").alias("ticker"), month.alias("month")).agg(
        F.when(F.max("l_tax") > 0.06, "failed").otherwise("ok").alias("status"))
    return quality.pending_months(grid, done, F.trunc(R.s_asof(t), "month"))


add("dq07_pending_months", _progress,
    """WITH g AS (SELECT DISTINCT l_suppkey AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS month FROM lineitem),
       p AS (SELECT l_suppkey AS ticker, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CASE WHEN max(l_tax) > 0.06 THEN 'failed' ELSE 'ok' END AS status
             FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1, 2)
       SELECT ticker, month, status FROM g LEFT JOIN p USING (ticker, month) WHERE status IS NULL OR month = (SELECT max(month) FROM g)""")

add("dq08_calendar_coverage", lambda t: (
    quality.weekday_grid(t.spark, R.o_asof(t), 2400).join(t.orders.select(F.to_date("o_orderdate").alias("day"), "o_totalprice"), "day", "left")
    .groupBy("day").agg(F.count("o_totalprice").alias("orders"))
    .join(quality.month_grid(t.spark, R.o_asof(t), 70), F.trunc("day", "month") == c("month"))),
    """WITH g AS (SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(x - INTERVAL 2400 DAY, x, INTERVAL 1 DAY)) AS d FROM (SELECT max(o_orderdate) AS x FROM orders)) WHERE isodow(d) < 6),
       m AS (SELECT CAST(d AS DATE) AS month FROM (SELECT unnest(generate_series(date_trunc('month', x) - INTERVAL 69 MONTH, date_trunc('month', x), INTERVAL 1 MONTH)) AS d FROM (SELECT max(o_orderdate) AS x FROM orders)))
       SELECT day, count(o_totalprice) AS orders, month FROM g LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day JOIN m ON date_trunc('month', day) = month GROUP BY day, month""")

add("dq09_clamp_outlier", lambda t: t.role("financials").select(
    "ticker", "period_end", "fiscal_period", dedup.clamp_outlier("antidilutive_shares", F.coalesce("shares_outstanding", "weighted_avg_shares_diluted")).alias("clean")),
    """SELECT ticker, period_end, fiscal_period, CASE WHEN antidilutive_shares > coalesce(shares_outstanding, weighted_avg_shares_diluted) * 20 THEN NULL
       ELSE antidilutive_shares END AS clean FROM financials""")

add("dq10_audit_overview", lambda t: quality.audit_overview(t.role("chain")),
    """SELECT count(*) AS total_rows, count(DISTINCT underlying) AS underlyings, count(DISTINCT snapshot_date) AS trading_days, min(snapshot_date) AS earliest,
       max(snapshot_date) AS latest, count(DISTINCT expiration) AS expirations, round(avg(expiration - snapshot_date), 1) AS avg_dte,
       count(*) FILTER (put_call = 'call') AS calls, count(*) FILTER (put_call = 'put') AS puts FROM chain""")

add("dq11_audit_quality", lambda t: quality.audit_quality(t.role("chain")),
    """SELECT count(*) FILTER (bid = 0 AND ask = 0) AS zero_bid_ask, count(*) FILTER (implied_vol = 0) AS zero_iv, count(*) FILTER (implied_vol > 5) AS iv_above_500pct,
       count(*) FILTER (delta = 0 AND gamma = 0 AND theta = 0) AS zero_greeks, count(*) FILTER (open IS NULL AND high IS NULL AND low IS NULL AND close IS NULL) AS null_ohlc,
       count(*) FILTER (underlying_price IS NULL) AS null_underlying_px, count(*) FILTER (volume = 0) AS zero_volume, count(*) FILTER (open_interest = 0) AS zero_oi,
       round(100.0 * count(*) FILTER (bid = 0 AND ask = 0) / count(*), 2) AS pct_zero_bid_ask, round(100.0 * count(*) FILTER (implied_vol = 0) / count(*), 2) AS pct_zero_iv FROM chain""")

_BREAKDOWN = """SELECT {k}, count(*) AS rows, count(DISTINCT underlying) AS underlyings, count(DISTINCT snapshot_date) AS days, min(snapshot_date) AS earliest,
    max(snapshot_date) AS latest, count(DISTINCT expiration) AS expirations, round(avg(implied_vol), 4) AS avg_iv, round(avg(expiration - snapshot_date), 0) AS avg_dte FROM chain GROUP BY 1 {tail}"""
add("dq12_audit_by_year", lambda t: quality.audit_breakdown(t.role("chain"), F.year("snapshot_date"), "year"),
    _BREAKDOWN.format(k="CAST(year(snapshot_date) AS INTEGER) AS year", tail=""))
add("dq12_audit_by_source", lambda t: quality.audit_breakdown(t.role("chain").withColumn("source", F.concat(F.lit("feed_"), "put_call")), c("source"), "source"), _BREAKDOWN.format(k="'feed_' || put_call AS source", tail=""))
add("dq12_audit_top_underlyings", lambda t: quality.audit_breakdown(t.role("chain"), c("underlying"), "underlying", 20).drop("underlyings"),
    "SELECT * EXCLUDE (underlyings) FROM (" + _BREAKDOWN.format(k="underlying", tail="ORDER BY rows DESC, 1 LIMIT 20") + ")")


def _quotes(t):
    bid = c("l_extendedprice") / 10
    return t.lineitem.select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("seq"), c("l_partkey"), F.when(c("l_linenumber") != 7, c("l_suppkey").cast("string")).alias("ticker"),
        F.struct(bid.alias("bid"), (bid + c("l_discount") - 0.02).alias("ask"), (c("l_extendedprice") / 10).alias("last")).alias("quote"))


add("dq13_quote_rules", lambda t: quality.with_reasons(_quotes(t), quality.quote_rules()).select("seq", "l_partkey", F.concat_ws(",", "reasons").alias("reasons")),
    """SELECT l_orderkey * 10 + l_linenumber AS seq, l_partkey, concat_ws(',', CASE WHEN l_linenumber = 7 THEN 'missing_field' END,
       CASE WHEN NOT (l_extendedprice / 10 < l_extendedprice / 10 + l_discount - 0.02::DOUBLE) THEN 'crossed' END,
       CASE WHEN l_extendedprice / 10 > 10000 THEN 'price_range' END) AS reasons FROM lineitem""")

# ---- joins ------------------------------------------------------------------------

add("join01_fact_dimension", lambda t: joins.join_dim(t.role("sdaily"), t.role("universe").select("ticker", "name", "exchange"), "ticker")
    .groupBy("exchange").agg(F.count(F.lit(1)).alias("bars"), F.countDistinct("ticker").alias("tickers"), F.sum("volume").alias("volume")),
    "SELECT exchange, count(*) AS bars, count(DISTINCT ticker) AS tickers, CAST(sum(volume) AS BIGINT) AS volume FROM sdaily JOIN universe USING (ticker) GROUP BY 1")

add("join02_left_fill", lambda t: joins.left_fill(
    t.customer.select(c("c_custkey").alias("k"), "c_name"),
    t.orders.filter(c("o_orderstatus") == "F").groupBy(c("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.max("o_orderpriority").alias("p")), "k", {"n": 0, "p": "none"}),
    """SELECT c_custkey AS k, c_name, coalesce(n, 0) AS n, coalesce(p, 'none') AS p FROM customer LEFT JOIN
       (SELECT o_custkey, count(*) AS n, max(o_orderpriority) AS p FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) ON c_custkey = o_custkey""")

add("join03_pair_stats_all", lambda t: rnd(pairs.pair_stats(t.role("sdaily"), "ticker", "day", "close").withColumn("covariance", c("covariance") / 1e6).filter("n > 2"), 5, "covariance", "correlation"),
    """SELECT x.ticker AS a, y.ticker AS b, count(*) AS n, round(covar_pop(x.close, y.close) / 1e6, 5) AS covariance, round(corr(x.close, y.close), 5) AS correlation
       FROM sdaily x JOIN sdaily y ON x.day = y.day AND x.ticker < y.ticker GROUP BY 1, 2 HAVING count(*) > 2""")
_PAIRS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
add("join03_pair_stats", lambda t: rnd(pairs.pair_stats(t.role("odaily"), "ticker", "day", "close", _PAIRS).withColumn("covariance", c("covariance") / 1e9), 6, "covariance", "correlation"),
    """SELECT x.ticker AS a, y.ticker AS b, count(*) AS n, round(covar_pop(x.close, y.close) / 1e9, 6) AS covariance, round(corr(x.close, y.close), 6) AS correlation
       FROM odaily x JOIN odaily y ON x.day = y.day AND x.ticker < y.ticker GROUP BY 1, 2""")

add("join04_newest_two", lambda t: returns.newest_two(t.role("sdaily").select("ticker", "day", "close"), "ticker", "day", "close"),
    """SELECT ticker, max(day) FILTER (rn = 1) AS day, max(close) FILTER (rn = 1) AS close, max(close) FILTER (rn = 2) AS prev_close
       FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY day DESC) rn FROM sdaily) GROUP BY 1""")

add("join05_offset_days", lambda t: joins.offset_join(t.role("odaily").select("ticker", "day", "close"), "ticker", "day", "close", {"before": -7, "after": 7}),
    """SELECT a.ticker, a.day, a.close, b.close AS before, f.close AS after FROM odaily a JOIN odaily b ON a.ticker = b.ticker AND b.day = a.day - 7
       JOIN odaily f ON a.ticker = f.ticker AND f.day = a.day + 7""")


add("join06_asof_rates", lambda t: asof.asof_join(t.role("odaily").select("day").distinct(), t.role("rates").withColumnRenamed("date", "rate_date"), "day", "rate_date", 5),
    """WITH d AS (SELECT DISTINCT day FROM odaily), r AS (SELECT date AS rate_date, tips_10y, hy_oas, commercial_paper_3m, tbill_3m FROM rates)
       SELECT d.day, r.* FROM d LEFT JOIN r ON r.rate_date = (SELECT max(rate_date) FROM r WHERE rate_date <= d.day AND rate_date >= d.day - 5)""")

add("join06_asof_required", lambda t: asof.asof_join(t.role("odaily").select("day").distinct(), t.role("monthly").select(c("date").alias("month"), "sahm_rule"), "day", "month", 45, require="sahm_rule"),
    """WITH d AS (SELECT DISTINCT day FROM odaily), r AS (SELECT date AS month, sahm_rule FROM monthly WHERE sahm_rule IS NOT NULL)
       SELECT d.day, r.* FROM d LEFT JOIN r ON r.month = (SELECT max(month) FROM r WHERE month <= d.day AND month >= d.day - 45)""")

# Trades of one kind next to the last purchase of the same user: both sides are raw rows.
add("join06_asof_ticks", lambda t: asof.asof_join(
    t.events.filter(c("event_type") != "purchase").select("user_id", "event_id", "ts"),
    t.events.filter(c("event_type") == "purchase").select("user_id", c("ts").alias("bought_at"), c("value").alias("paid")), "ts", "bought_at", 2, by="user_id", slot_seconds=6 * 3600),
    """SELECT l.user_id, l.event_id, l.ts, CASE WHEN r.bought_at >= l.ts - INTERVAL 2 DAY THEN r.bought_at END AS bought_at, CASE WHEN r.bought_at >= l.ts - INTERVAL 2 DAY THEN r.paid END AS paid
       FROM (SELECT user_id, event_id, ts FROM events WHERE event_type <> 'purchase') l ASOF LEFT JOIN
       (SELECT user_id, ts AS bought_at, value AS paid FROM events WHERE event_type = 'purchase') r ON l.user_id = r.user_id AND l.ts >= r.bought_at""")

add("join07_month_join", lambda t: joins.month_join(t.role("yields").select("date", "yield_10_year"), t.role("monthly").select(c("date").alias("month"), "unemployment_rate"), "date", "month"),
    "SELECT y.date, yield_10_year, unemployment_rate FROM yields y JOIN monthly m ON date_trunc('month', y.date) = m.date")

add("join08_one_row", lambda t: joins.with_scalars(
    t.role("prices"), t.role("yields").agg(F.max("date").alias("last_date"), F.max("yield_10_year").alias("top_yield")), ["last_date", "top_yield"]),
    "SELECT ticker, close, last_date, top_yield FROM prices CROSS JOIN (SELECT max(date) AS last_date, max(yield_10_year) AS top_yield FROM yields)")

add("join09_at_group_max", lambda t: dedup.at_group_max(t.role("holders"), ["ticker", "holder_name"], "filed_date"),
    "SELECT h.* FROM holders h JOIN (SELECT ticker, holder_name, max(filed_date) AS filed_date FROM holders GROUP BY 1, 2) USING (ticker, holder_name, filed_date)")

add("join10_anti", lambda t: joins.anti(t.part.select(c("p_partkey").alias("k"), "p_name"), t.lineitem.filter(c("l_quantity") > 45).select(c("l_partkey").alias("k")), "k"),
    "SELECT p_partkey AS k, p_name FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 45)")


def _series(t, p, name):
    return t.orders.filter(c("o_orderpriority") == p).groupBy(F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias(name))


def _full_merge(t):
    from finlake.operators.pivots import full_merge
    return full_merge([_series(t, "1-URGENT", "a"), _series(t, "2-HIGH", "b"), _series(t, "3-MEDIUM", "c")], "date")


add("join11_full_merge", _full_merge,
    """SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) FILTER (o_orderpriority = '1-URGENT') AS a, max(o_totalprice) FILTER (o_orderpriority = '2-HIGH') AS b,
       max(o_totalprice) FILTER (o_orderpriority = '3-MEDIUM') AS c FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""")

add("join12_scalar_max", lambda t: t.role("sdaily").filter(c("day") == joins.scalar_max(t.lineitem.select(R.day_of("l_shipdate").alias("day")), "day")).select("ticker", "day", "close"),
    f"SELECT ticker, day, close FROM sdaily WHERE day = {R.S_ASOF}")

_HIST = "SELECT underlying, expiration, strike, put_call, avg(volume) AS avg_volume, count(*) AS seen FROM chain GROUP BY ALL"
add("join13_contract_history", lambda t: t.role("chain").select(
    "underlying", "expiration", "strike", "put_call", "snapshot_date", "volume", "seq").join(
    t.role("chain").groupBy("underlying", "expiration", "strike", "put_call").agg(F.round(F.avg("volume"), 6).alias("avg_volume"), F.count(F.lit(1)).alias("seen")),
    ["underlying", "expiration", "strike", "put_call"]),
    f"""SELECT underlying, expiration, strike, put_call, snapshot_date, volume, seq, round(avg_volume, 6) AS avg_volume, seen FROM chain JOIN ({_HIST}) USING (underlying, expiration, strike, put_call)""")

add("join14_interpolate", lambda t: rnd(joins.interpolate_at(t.role("chain").filter(c("put_call") == "call"), ["underlying", "snapshot_date"], "delta", "implied_vol", 0.3, "iv_30d"), 6, "iv_30d"),
    """WITH p AS (SELECT underlying, snapshot_date, max({'x': delta, 'y': implied_vol}) FILTER (delta <= 0.3::DOUBLE) AS lo, min({'x': delta, 'y': implied_vol}) FILTER (delta >= 0.3::DOUBLE) AS hi
       FROM chain WHERE put_call = 'call' GROUP BY 1, 2)
       SELECT underlying, snapshot_date, round(CASE WHEN lo.x = 0.3::DOUBLE THEN lo.y ELSE lo.y + (0.3::DOUBLE - lo.x) / nullif(hi.x - lo.x, 0) * (hi.y - lo.y) END, 6) AS iv_30d FROM p""")

# ---- bars -------------------------------------------------------------------------

_TICK_BARS = """SELECT ticker, {b} AS bucket, arg_min(price, {o}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {o}) AS close,
    CAST(sum(size) AS BIGINT) AS volume, round(sum(price * size) / sum(size), 11) AS vwap, count(*) AS transactions FROM ticks GROUP BY 1, 2"""


def _tick_bars(grain):
    return lambda t: rnd(bars.bars_from_ticks(t.role("ticks"), "ticker", "timestamp", "price", "size", grain, "seq"), 11, "vwap")


for _g, _b in {"5m": "time_bucket(INTERVAL '5 minutes', timestamp)", "15m": "time_bucket(INTERVAL '15 minutes', timestamp)", "1h": "date_trunc('hour', timestamp)",
               "1d": "CAST(timestamp AS DATE)"}.items():
    add(f"agg05_bars_from_ticks_{_g}", _tick_bars(_g), _TICK_BARS.format(b=_b, o=R.TICK_ORDER))

_BARS = """SELECT ticker, {b} AS bucket, arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low, arg_max(close, timestamp) AS close, CAST(sum(volume) AS BIGINT) AS volume,
    round(sum(volume * vwap) FILTER (vwap IS NOT NULL) / nullif(sum(volume) FILTER (vwap IS NOT NULL), 0), 11) AS vwap, CAST(sum(transactions) AS BIGINT) AS transactions{s} FROM {src} GROUP BY 1, 2"""


def _rolled(grain):
    return lambda t: rnd(bars.ohlcv_bars(t.role("minute"), "ticker", "timestamp", grain), 11, "vwap")


for _id, _g, _w in (("agg01", "5m", "5 minutes"), ("agg01", "15m", "15 minutes"), ("agg01", "1h", "1 hour"), ("agg02", "30m", "30 minutes"), ("agg02", "2h", "2 hours"), ("agg03", "4h", "4 hours")):
    add(f"{_id}_bars_{_g}", _rolled(_g), _BARS.format(b=f"time_bucket(INTERVAL '{_w}', timestamp)", s="", src="minute"))


def _sourced(t):
    m = t.role("minute").withColumn("vwap", F.when(c("volume") % 5 != 0, c("vwap"))).withColumn("source", F.when(c("volume") % 3 == 0, "backfill").otherwise("live"))
    return rnd(bars.ohlcv_bars(m, "ticker", "timestamp", "1d", source="source"), 11, "vwap")


add("agg01_bars_1d_source", _sourced, "WITH m AS (SELECT * REPLACE (CASE WHEN volume % 5 <> 0 THEN vwap END AS vwap), CASE WHEN volume % 3 = 0 THEN 'backfill' ELSE 'live' END AS source FROM minute) "
    + _BARS.format(b="CAST(timestamp AS DATE)", s=", min(source) AS source", src="m"))

for _g, _u in (("1wk", "week"), ("1mo", "month"), ("1q", "quarter"), ("1yr", "year")):
    add(f"agg04_calendar_{_u}", (lambda g: lambda t: bars.calendar_bars(t.role("odaily"), "ticker", "day", g))(_g),
        f"""SELECT ticker, CAST(date_trunc('{_u}', day) AS DATE) AS period, arg_min(open, day) AS open, max(high) AS high, min(low) AS low, arg_max(close, day) AS close,
            CAST(sum(volume) AS BIGINT) AS volume FROM odaily GROUP BY 1, 2""")

add("agg06_period_return", lambda t: rnd(bars.period_return(t.role("sdaily"), "ticker", "day", start=F.lit("1997-01-01").cast("date"), end=F.lit("1999-12-31").cast("date")), 6, "return_pct"),
    """SELECT ticker, arg_min(close, day) AS start_price, arg_max(close, day) AS end_price, round((arg_max(close, day) - arg_min(close, day)) / arg_min(close, day) * 100, 6) AS return_pct
       FROM sdaily WHERE day BETWEEN DATE '1997-01-01' AND DATE '1999-12-31' GROUP BY 1""")

# ---- windows ----------------------------------------------------------------------

add("win01_simple_return", lambda t: rnd(returns.simple_return(t.role("sdaily").select("ticker", "day", "close"), "ticker", "day"), 6, "return_pct"),
    """SELECT ticker, day, close, p AS prev_close, round((close - p) / nullif(p, 0) * 100, 6) AS return_pct
       FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY day) AS p FROM sdaily)""")

add("win01_tick_return_split", lambda t: rnd(returns.simple_return(t.role("ticks").select("ticker", "timestamp", "seq", "price"), "ticker", "timestamp", "price", seq="seq", split=TICKS), 6, "return_pct"),
    """SELECT ticker, timestamp, seq, price, p AS prev_close, round((price - p) / nullif(p, 0) * 100, 6) AS return_pct
       FROM (SELECT *, lag(price) OVER (PARTITION BY ticker ORDER BY timestamp, seq) AS p FROM ticks)""")

add("win02_log_return", lambda t: rnd(returns.log_return(t.role("odaily").select("ticker", "day", "close"), "ticker", "day"), 8, "ret"),
    "SELECT ticker, day, close, round(ln(close) - ln(lag(close) OVER (PARTITION BY ticker ORDER BY day)), 8) AS ret FROM odaily")

add("win03_change_n", lambda t: rnd(returns.change(returns.change(t.role("monthly").select("date", "cpi", "unemployment_rate"), None, "date", "cpi", 12), None, "date", "unemployment_rate", 6), 6, "unemployment_rate_change_6"),
    """SELECT date, cpi, unemployment_rate, cpi - lag(cpi, 12) OVER (ORDER BY date) AS cpi_change_12,
       round(unemployment_rate - lag(unemployment_rate, 6) OVER (ORDER BY date), 6) AS unemployment_rate_change_6 FROM monthly""")

add("win04_newest_n", lambda t: returns.newest_n(t.role("dividends"), "ticker", "ex_dividend_date", 2, "seq").withColumn("rn", c("rn").cast("long")),
    "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ex_dividend_date DESC, seq DESC) AS rn FROM dividends) WHERE rn <= 2")

_LOGS = "r AS (SELECT ticker, day, close, ln(close) - ln(lag(close) OVER (PARTITION BY ticker ORDER BY day)) AS ret FROM odaily)"
for _n in (21, 30):
    add(f"win05_rolling_vol_{_n}", (lambda n: lambda t: rnd(returns.rolling_vol(returns.log_return(t.role("odaily").select("ticker", "day", "close"), "ticker", "day"), "ticker", "day", "ret", n)
        .select("ticker", "day", "vol"), 6, "vol"))(_n),
        f"WITH {_LOGS} SELECT ticker, day, round(stddev_pop(ret) OVER (PARTITION BY ticker ORDER BY day ROWS BETWEEN {_n - 1} PRECEDING AND CURRENT ROW) * sqrt(252), 6) AS vol FROM r")

add("win06_prior_mean", lambda t: rnd(returns.rolling_mean(t.role("sdaily").select("ticker", "day", "volume"), "ticker", "day", "volume", 20), 6, "rolling_mean"),
    "SELECT ticker, day, volume, round(avg(volume) OVER (PARTITION BY ticker ORDER BY day ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean FROM sdaily")

add("win06_tick_mean_split", lambda t: rnd(returns.rolling_mean(t.role("ticks"), "ticker", "timestamp", "size", 20, seq="seq", split=TICKS), 6, "rolling_mean"),
    "SELECT *, round(avg(size) OVER (PARTITION BY ticker ORDER BY timestamp, seq ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean FROM ticks")


def _paired(t):
    return pairs.wide(t.role("odaily"), "ticker", "day", "close", ("1-URGENT", "5-LOW")).filter(c("s0").isNotNull() & c("s1").isNotNull())


add("win07_rolling_corr", lambda t: rnd(returns.rolling_corr(_paired(t), None, "day", "s0", "s1", 30), 5, "correlation"),
    """SELECT x.day, x.close AS s0, y.close AS s1, CASE WHEN row_number() OVER w > 1 THEN round(covar_pop(x.close, y.close) OVER f / (stddev_pop(x.close) OVER f * stddev_pop(y.close) OVER f), 5) END AS correlation
       FROM odaily x JOIN odaily y ON x.day = y.day AND x.ticker = '1-URGENT' AND y.ticker = '5-LOW'
       WINDOW w AS (ORDER BY x.day), f AS (ORDER BY x.day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")

add("win08_range_mean", lambda t: rnd(returns.range_mean(t.role("ticks"), "ticker", "timestamp", "size", 3600), 6, "range_mean"),
    "SELECT *, round(avg(size) OVER (PARTITION BY ticker ORDER BY timestamp RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW), 6) AS range_mean FROM ticks")

_IVD = "SELECT underlying, snapshot_date, max(implied_vol + gamma) AS iv FROM chain WHERE put_call = 'call' AND strike = 25 GROUP BY 1, 2"


def _ivd(t):
    return t.role("chain").filter((c("put_call") == "call") & (c("strike") == 25)).groupBy("underlying", "snapshot_date").agg(F.max(c("implied_vol") + c("gamma")).alias("iv"))


for _s, _op in ((True, "<"), (False, "<=")):
    add(f"win09_percentile_rank_{'below' if _s else 'at_most'}", (lambda s: lambda t: rnd(returns.percentile_rank(_ivd(t), "underlying", "snapshot_date", "iv", 365, s, 20), 6, "rank"))(_s),
        f"""WITH d AS ({_IVD}) SELECT x.underlying, x.snapshot_date, x.iv, CASE WHEN count(*) >= 20 THEN round(count(*) FILTER (y.iv {_op} x.iv) / count(*), 6) END AS rank
            FROM d x JOIN d y ON x.underlying = y.underlying AND y.snapshot_date BETWEEN x.snapshot_date - 365 AND x.snapshot_date GROUP BY 1, 2, 3""")

for _s, _op in ((True, "<"), (False, "<=")):
    add(f"win09_tick_rank_{'below' if _s else 'at_most'}", (lambda s: lambda t: rnd(returns.tick_rank(t.events.select("event_type", "event_id", "ts", "value"), "event_type", "ts", "value", 86_400, s, 20), 6, "rank"))(_s),
        f"""SELECT x.event_type, x.event_id, x.ts, x.value, CASE WHEN count(y.value) >= 20 AND x.value IS NOT NULL THEN round(count(*) FILTER (y.value {_op} x.value) / count(y.value), 6) END AS rank
            FROM events x JOIN events y ON x.event_type = y.event_type AND y.ts BETWEEN x.ts - INTERVAL 1 DAY AND x.ts GROUP BY 1, 2, 3, 4""")

add("win10_minmax_rank", lambda t: rnd(returns.minmax_rank(t.role("odaily").select("ticker", "day", "close"), "ticker", "day", "close"), 6, "minmax_rank"),
    """SELECT ticker, day, close, round((close - min(close) OVER w) / nullif(max(close) OVER w - min(close) OVER w, 0), 6) AS minmax_rank FROM odaily
       WINDOW w AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)""")

_GAPS = """g AS (SELECT event_type AS ticker, ts, event_id, CASE WHEN event_id % 7 = 0 THEN value END AS price, CASE WHEN event_id % 3 = 0 THEN user_id END AS who FROM events)"""


def _gaps(t):
    return t.events.select(c("event_type").alias("ticker"), "ts", "event_id", F.when(c("event_id") % 7 == 0, c("value")).alias("price"), F.when(c("event_id") % 3 == 0, c("user_id")).alias("who"))


add("win11_ffill_split", lambda t: asof.ffill(_gaps(t), "ticker", "ts", ["price", "who"], seq="event_id", slot="12 hours"),
    f"""WITH {_GAPS} SELECT ticker, ts, event_id, last_value(price IGNORE NULLS) OVER w AS price, last_value(who IGNORE NULLS) OVER w AS who FROM g
        WINDOW w AS (PARTITION BY ticker ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

add("win11_ffill_max_age", lambda t: asof.ffill(t.role("rates").select("date", "tips_10y", "hy_oas"), None, "date", ["tips_10y", "hy_oas"], 5),
    """SELECT date, CASE WHEN date - max(CASE WHEN tips_10y IS NOT NULL THEN date END) OVER w <= 5 THEN last_value(tips_10y IGNORE NULLS) OVER w END AS tips_10y,
       CASE WHEN date - max(CASE WHEN hy_oas IS NOT NULL THEN date END) OVER w <= 5 THEN last_value(hy_oas IGNORE NULLS) OVER w END AS hy_oas
       FROM rates WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""")

# ---- indicators -------------------------------------------------------------------

_D = lambda t: t.role("odaily").select("ticker", "day", "close")

add("ind01_sma", lambda t: rnd(ind.sma(_D(t), "ticker", "day", "close", 20), 4, "sma"),
    """SELECT ticker, day, close, round(s, 4) AS sma FROM (SELECT ticker, day, close, avg(close) OVER w AS s, count(*) OVER w AS n FROM odaily
       WINDOW w AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) WHERE n = 20""")


def ema_sql(src, key, order, value, n, seed, digits=4, cols="close"):
    first = n if seed == "sma" else 1
    init = f"(SELECT avg({value}) FROM o i WHERE i.{key} = o.{key} AND i.rn <= {n})" if seed == "sma" else value
    return f"""WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {src}),
        e AS (SELECT {key}, rn, CAST({init} AS DOUBLE) AS y FROM o WHERE rn = {first}
              UNION ALL SELECT o.{key}, o.rn, (o.{value} - e.y) * (2.0::DOUBLE / {n + 1}) + e.y FROM e JOIN o ON o.{key} = e.{key} AND o.rn = e.rn + 1)
        SELECT {cols}, round(y, {digits}) AS ema FROM e JOIN o USING ({key}, rn)"""


add("ind02_ema_sma_seed", lambda t: rnd(ind.ema(_D(t), "ticker", "day", "close", 20), 4, "ema"), ema_sql("odaily", "ticker", "day", "close", 20, "sma", cols="ticker, day, close"))
add("ind02_ema_first_seed", lambda t: rnd(ind.ema(_D(t), "ticker", "day", "close", 10, "first"), 4, "ema"), ema_sql("odaily", "ticker", "day", "close", 10, "first", cols="ticker, day, close"))
add("ind02_ema_ticks_split", lambda t: rnd(ind.ema(t.role("ticks"), "ticker", "timestamp", "price", 12, seq="seq", split=TICKS), 4, "ema"),
    ema_sql("ticks", "ticker", "timestamp, seq", "price", 12, "sma", cols="ticker, timestamp, price, size, seq"))

# every seventh price is missing: also some that seed a mean, and some on the edges of chunks
_HOLES = "CASE WHEN dayofyear(day) % 7 <> 3 THEN close END AS close"
_HOLES_SQL = "(SELECT ticker, day, close FROM odaily WHERE dayofyear(day) % 7 <> 3) p"
for _name, _split in (("ind02_ema_nulls", None), ("ind02_ema_nulls_split", Split("90 days", 50))):
    add(_name, lambda t, s=_split: rnd(ind.ema(_D(t).selectExpr("ticker", "day", _HOLES), "ticker", "day", "close", 5, split=s), 4, "ema"), ema_sql(_HOLES_SQL, "ticker", "day", "close", 5, "sma", cols="ticker, day, close"))

add("ind03_bollinger_ticks_split", lambda t: rnd(ind.bollinger(t.role("ticks").select("ticker", "timestamp", "seq", "price"), "ticker", "timestamp", "price", 50, seq="seq", split=TICKS), 4, "middle", "upper", "lower"),
    """SELECT ticker, timestamp, seq, price, round(m, 4) AS middle, round(m + 2 * s, 4) AS upper, round(m - 2 * s, 4) AS lower FROM (SELECT ticker, timestamp, seq, price, avg(price) OVER w AS m,
       stddev_pop(price) OVER w AS s, count(*) OVER w AS n FROM ticks WINDOW w AS (PARTITION BY ticker ORDER BY timestamp, seq ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)) WHERE n = 50""")
add("ind03_bollinger", lambda t: rnd(ind.bollinger(_D(t), "ticker", "day", "close"), 4, "middle", "upper", "lower"),
    """SELECT ticker, day, close, round(m, 4) AS middle, round(m + 2 * s, 4) AS upper, round(m - 2 * s, 4) AS lower FROM (SELECT ticker, day, close, avg(close) OVER w AS m,
       stddev_pop(close) OVER w AS s, count(*) OVER w AS n FROM odaily WINDOW w AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) WHERE n = 20""")


def rsi_sql(src, order, value, n, cols):
    return f"""WITH RECURSIVE d AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY {order}) - 1 AS i, {value} - lag({value}) OVER (PARTITION BY ticker ORDER BY {order}) AS ch FROM {src}),
        o AS (SELECT *, greatest(ch, 0) AS g, greatest(-ch, 0) AS l FROM d),
        e AS (SELECT ticker, i, (SELECT avg(x.g) FROM o x WHERE x.ticker = o.ticker AND x.i BETWEEN 1 AND {n}) AS ag, (SELECT avg(x.l) FROM o x WHERE x.ticker = o.ticker AND x.i BETWEEN 1 AND {n}) AS al
              FROM o WHERE i = {n} UNION ALL SELECT o.ticker, o.i, (e.ag * {n - 1} + o.g) / {n}, (e.al * {n - 1} + o.l) / {n} FROM e JOIN o ON o.ticker = e.ticker AND o.i = e.i + 1)
        SELECT {cols}, round(100 - 100 / (1 + CASE WHEN al = 0 THEN 100 ELSE ag / al END), 6) AS rsi FROM e JOIN o USING (ticker, i)"""


add("ind04_rsi", lambda t: rnd(ind.rsi(_D(t), "ticker", "day", "close"), 6, "rsi"), rsi_sql("odaily", "day", "close", 14, "ticker, day, close"))
add("ind04_rsi_ticks_split", lambda t: rnd(ind.rsi(t.role("ticks").select("ticker", "timestamp", "seq", "price"), "ticker", "timestamp", "price", seq="seq", split=TICKS), 6, "rsi"),
    rsi_sql("ticks", "timestamp, seq", "price", 14, "ticker, timestamp, seq, price"))

_MACD = """WITH RECURSIVE o AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY day) AS rn FROM odaily),
    s AS (SELECT ticker, avg(close) FILTER (rn <= 12) AS f0, avg(close) FILTER (rn <= 26) AS s0 FROM o GROUP BY 1),
    f AS (SELECT o.ticker, o.rn, s.f0 AS y FROM o JOIN s USING (ticker) WHERE rn = 12 UNION ALL SELECT o.ticker, o.rn, (o.close - f.y) * (2.0::DOUBLE / 13) + f.y FROM f JOIN o ON o.ticker = f.ticker AND o.rn = f.rn + 1),
    w AS (SELECT o.ticker, o.rn, s.s0 AS y FROM o JOIN s USING (ticker) WHERE rn = 26 UNION ALL SELECT o.ticker, o.rn, (o.close - w.y) * (2.0::DOUBLE / 27) + w.y FROM w JOIN o ON o.ticker = w.ticker AND o.rn = w.rn + 1),
    m AS (SELECT f.ticker, f.rn, f.y - w.y AS macd FROM f JOIN w USING (ticker, rn)),
    g AS (SELECT m.ticker, m.rn, (SELECT avg(x.macd) FROM m x WHERE x.ticker = m.ticker AND x.rn <= 34) AS y FROM m WHERE rn = 34
          UNION ALL SELECT m.ticker, m.rn, (m.macd - g.y) * (2.0::DOUBLE / 10) + g.y FROM g JOIN m ON m.ticker = g.ticker AND m.rn = g.rn + 1)
    SELECT ticker, day, close, round(macd, 4) AS macd, round(g.y, 4) AS signal, round(macd - g.y, 4) AS histogram FROM g JOIN m USING (ticker, rn) JOIN o USING (ticker, rn)"""
add("ind05_macd", lambda t: rnd(ind.macd(_D(t), "ticker", "day", "close"), 4, "macd", "signal", "histogram"), _MACD)
add("ind05_macd_split", lambda t: rnd(ind.macd(_D(t), "ticker", "day", "close", split=Split("90 days", 400)), 4, "macd", "signal", "histogram"), _MACD)

_BASE = "b AS (SELECT ticker, arg_min(close, day) AS base FROM sdaily GROUP BY 1)"
add("ind06_normalise", lambda t: rnd(ind.normalise(t.role("sdaily").select("ticker", "day", "open", "high", "low", "close"), "ticker", "day"), 6, "open", "high", "low", "close"),
    f"WITH {_BASE} SELECT ticker, day, round(open * (100 / base), 6) AS open, round(high * (100 / base), 6) AS high, round(low * (100 / base), 6) AS low, round(close * (100 / base), 6) AS close FROM sdaily JOIN b USING (ticker)")
add("ind07_cumulative_return", lambda t: rnd(ind.cumulative_return(t.role("sdaily").select("ticker", "day", "close"), "ticker", "day"), 6, "return_pct"),
    f"WITH {_BASE} SELECT ticker, day, close, round((close - base) / base * 100, 6) AS return_pct FROM sdaily JOIN b USING (ticker)")

add("ind08_yoy", lambda t: rnd(ind.yoy(t.role("financials").select("ticker", c("fiscal_year").cast("int").alias("fiscal_year"), "fiscal_period", "net_income"), "net_income"), 4, "growth_pct"),
    """WITH f AS (SELECT ticker, CAST(fiscal_year AS INTEGER) AS fiscal_year, fiscal_period, net_income FROM financials)
       SELECT a.ticker, a.fiscal_year, a.fiscal_period, a.net_income, b.net_income AS prior_value, round((a.net_income - b.net_income) / nullif(abs(b.net_income), 0) * 100, 4) AS growth_pct
       FROM f a LEFT JOIN f b ON a.ticker = b.ticker AND a.fiscal_period = b.fiscal_period AND b.fiscal_year = a.fiscal_year - 1""")
add("ind09_margins", lambda t: rnd(ind.margins(t.role("financials")).select("ticker", "period_end", "fiscal_period", "gross_margin", "operating_margin", "net_margin"), 6, "gross_margin", "operating_margin", "net_margin"),
    """SELECT ticker, period_end, fiscal_period, round(gross_profit / nullif(revenue, 0) * 100, 6) AS gross_margin, round(operating_income / nullif(revenue, 0) * 100, 6) AS operating_margin,
       round(net_income / nullif(revenue, 0) * 100, 6) AS net_margin FROM financials""")

# ---- sorts, limits, sets ----------------------------------------------------------

add("srt01_nulls_last", lambda t: t.role("financials").select("ticker", "period_end", "fiscal_period", "gross_profit").orderBy(
    F.asc_nulls_last("gross_profit"), "ticker", "period_end", "fiscal_period"),
    "SELECT ticker, period_end, fiscal_period, gross_profit FROM financials ORDER BY gross_profit ASC NULLS LAST, 1, 2, 3")
add("srt02_top_k", lambda t: t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(30),
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY 3 DESC, 1, 2 LIMIT 30")
add("srt03_top_k_per", lambda t: dedup.top_k_per(t.role("sdaily").select("ticker", "day", "volume"), "ticker", [F.desc("volume"), F.asc("day")], 5),
    "SELECT ticker, day, volume FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY volume DESC, day) rn FROM sdaily) WHERE rn <= 5")
add("set01_union_all", lambda t: t.role("odaily").select("ticker", "day", "close").unionByName(t.role("futures").select("ticker", c("date").alias("day"), "close")),
    "SELECT ticker, day, close FROM odaily UNION ALL SELECT ticker, date, close FROM futures")
add("set02_union_fill", lambda t: t.role("rates").select("date", "tips_10y").unionByName(t.role("macro_daily").select("date", "vix"), allowMissingColumns=True),
    "SELECT date, tips_10y, NULL::DOUBLE AS vix FROM rates UNION ALL SELECT date, NULL, vix FROM macro_daily")

# ---- event studies and labels -----------------------------------------------------


def _fwd(t, src="odaily"):
    d = joins.offset_join(t.role(src).select("ticker", "day", "close", "volume"), "ticker", "day", "close", {"b": -7, "f": 7})
    return d.withColumns({"ret_5d": c("close") / c("b") - 1, "fwd_5d": c("f") / c("close") - 1})


_FWD = """e AS (SELECT a.ticker, a.day, a.volume, a.close / b.close - 1 AS ret_5d, f.close / a.close - 1 AS fwd_5d FROM odaily a JOIN odaily b ON a.ticker = b.ticker AND b.day = a.day - 7
    JOIN odaily f ON a.ticker = f.ticker AND f.day = a.day + 7)"""
_STUDY = """count(*) AS obs, round(avg(fwd_5d) * 10000, 4) AS avg_fwd_bps, round(count(*) FILTER (fwd_5d > 0) / count(*) * 100, 4) AS win_rate, round(median(fwd_5d) * 10000, 4) AS med_fwd_bps"""


def _study(df, bucket):
    return rnd(events.event_study(df, bucket, "fwd_5d"), 4, "avg_fwd_bps", "win_rate", "med_fwd_bps")


def _past_bucket():
    from finlake.functions.exprs import bands
    return bands("ret_5d", [(-0.05, "1_big_drop"), (-0.02, "2_drop"), (0.02, "3_flat"), (0.05, "4_up")], "5_big_up")


add("agg33_study_past_return", lambda t: _study(_fwd(t), _past_bucket()),
    f"""WITH {_FWD} SELECT CASE WHEN ret_5d < -0.05::DOUBLE THEN '1_big_drop' WHEN ret_5d < -0.02::DOUBLE THEN '2_drop' WHEN ret_5d < 0.02::DOUBLE THEN '3_flat' WHEN ret_5d < 0.05::DOUBLE THEN '4_up' ELSE '5_big_up' END AS bucket,
        {_STUDY} FROM e GROUP BY 1""")


def _volume_study(t):
    m = returns.rolling_mean(t.role("odaily").select("ticker", "day", "volume"), "ticker", "day", "volume", 20).drop("volume")
    d = _fwd(t).join(m.filter(c("rolling_mean") > 0), ["ticker", "day"]).withColumn("ratio", c("volume") / c("rolling_mean"))
    bucket = F.when(c("ret_5d") >= -0.05, "no_drop").when(c("ratio") < 1.5, "drop_low_vol").when(c("ratio") < 2.5, "drop_med_vol").otherwise("drop_high_vol")
    return _study(d, bucket)


add("agg33_study_volume", _volume_study,
    f"""WITH {_FWD}, m AS (SELECT ticker, day, avg(volume) OVER (PARTITION BY ticker ORDER BY day ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS av FROM odaily)
        SELECT CASE WHEN ret_5d >= -0.05::DOUBLE THEN 'no_drop' WHEN volume / av < 1.5 THEN 'drop_low_vol' WHEN volume / av < 2.5 THEN 'drop_med_vol' ELSE 'drop_high_vol' END AS bucket,
        {_STUDY} FROM e JOIN m USING (ticker, day) WHERE av > 0 GROUP BY 1""")


def _pcr_study(t):
    from finlake.functions.exprs import bands
    from finlake.plans.options import is_call, is_put
    from finlake.functions.exprs import sum_if
    flow = t.role("chain").groupBy(c("snapshot_date").alias("day")).agg((sum_if("volume", is_put()) / F.greatest(sum_if("volume", is_call()), F.lit(1))).alias("pc"))
    d = joins.offset_join(t.role("odaily").filter(c("ticker") == "5-LOW").select("ticker", "day", "close"), "ticker", "day", "close", {"f": 7})
    d = d.withColumn("fwd_5d", c("f") / c("close") - 1).join(flow, "day")
    return _study(d, bands("pc", [(0.7, "call_heavy"), (1.0, "slight_call"), (1.3, "balanced"), (1.8, "slight_put")], "put_heavy"))


add("agg33_study_put_call", _pcr_study,
    f"""WITH p AS (SELECT snapshot_date AS day, sum(CASE WHEN put_call = 'put' THEN volume ELSE 0 END) / greatest(sum(CASE WHEN put_call = 'call' THEN volume ELSE 0 END), 1)::DOUBLE AS pc FROM chain GROUP BY 1),
        e AS (SELECT a.day, pc, f.close / a.close - 1 AS fwd_5d FROM odaily a JOIN odaily f ON a.ticker = f.ticker AND f.day = a.day + 7 JOIN p ON p.day = a.day WHERE a.ticker = '5-LOW')
        SELECT CASE WHEN pc < 0.7 THEN 'call_heavy' WHEN pc < 1.0 THEN 'slight_call' WHEN pc < 1.3 THEN 'balanced' WHEN pc < 1.8 THEN 'slight_put' ELSE 'put_heavy' END AS bucket, {_STUDY} FROM e GROUP BY 1""")



def _otm_study(t):
    from finlake.plans.options import otm_flow
    flow = otm_flow(t.role("chain").withColumn("underlying", F.when(c("underlying") == "R", "5-LOW").otherwise("1-URGENT")), 0)
    flow = flow.filter(c("otm_call_vol") > c("atm_call_vol") * 1.5).select(c("underlying").alias("ticker"), c("snapshot_date").alias("day"))
    d = joins.offset_join(t.role("odaily").select("ticker", "day", "close"), "ticker", "day", "close", {"b": -7, "f": 7})
    d = d.withColumns({"past": c("close") / c("b") - 1, "fwd_5d": c("f") / c("close") - 1}).join(flow, ["ticker", "day"])
    return _study(d, F.when(c("past") < -0.03, "otm_calls_after_drop").when(c("past") > 0.03, "otm_calls_after_rally").otherwise("otm_calls_flat"))


add("agg33_study_otm_flow", _otm_study,
    f"""WITH {_FWD}, k AS (SELECT CASE underlying WHEN 'R' THEN '5-LOW' ELSE '1-URGENT' END AS ticker, snapshot_date AS day,
        sum(CASE WHEN put_call = 'call' AND abs(strike - underlying_price) / underlying_price < 0.02 THEN volume ELSE 0 END) AS atm,
        sum(CASE WHEN put_call = 'call' AND strike > underlying_price * 1.03::DOUBLE AND strike < underlying_price * 1.10::DOUBLE THEN volume ELSE 0 END) AS otm FROM chain WHERE underlying_price > 0 GROUP BY 1, 2 HAVING sum(volume) > 0)
        SELECT CASE WHEN ret_5d < -0.03::DOUBLE THEN 'otm_calls_after_drop' WHEN ret_5d > 0.03::DOUBLE THEN 'otm_calls_after_rally' ELSE 'otm_calls_flat' END AS bucket, {_STUDY} FROM e JOIN k USING (ticker, day) WHERE otm > atm * 1.5 GROUP BY 1""")

add("agg33_group_quantiles", lambda t: rnd(quantiles.group_quantiles(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", {"p05": 0.05, "p25": 0.25, "p50": 0.5, "p999": 0.999}, rows=200), 6, "p05", "p25", "p50", "p999"),
    "SELECT l_returnflag, l_linestatus, " + ", ".join(f"round(quantile_cont(l_extendedprice, {p}), 6) AS {n}" for n, p in (("p05", 0.05), ("p25", 0.25), ("p50", 0.5), ("p999", 0.999))) + " FROM lineitem GROUP BY 1, 2")
add("agg33_group_median", lambda t: rnd(events.group_median(t.lineitem, "l_returnflag", "l_extendedprice"), 6, "median"),
    "SELECT l_returnflag, round(median(l_extendedprice), 6) AS median FROM lineitem GROUP BY 1")

add("fea11_forward_labels", lambda t: events.forward_labels(_D(t), "ticker", "day"),
    """WITH r AS (SELECT ticker, day, close, close / lag(close) OVER (PARTITION BY ticker ORDER BY day) - 1 AS x FROM odaily),
       v AS (SELECT *, CASE WHEN count(x) OVER p >= 20 THEN stddev_pop(x) OVER p END AS base, CASE WHEN count(x) OVER a >= 3 THEN stddev_pop(x) OVER a END AS v3,
             CASE WHEN count(x) OVER b >= 5 THEN stddev_pop(x) OVER b END AS v5, lead(close, 5) OVER (PARTITION BY ticker ORDER BY day) AS ahead FROM r
             WINDOW p AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), a AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 3 FOLLOWING),
             b AS (PARTITION BY ticker ORDER BY day ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING))
       SELECT ticker, day, close, CAST(v3 > base * 1.3::DOUBLE AS INTEGER) AS vol_expansion_3d, CAST(v5 > base * 1.3::DOUBLE AS INTEGER) AS vol_expansion_5d,
       CAST(sign(ahead - close) AS INTEGER) AS fwd_sign_5d FROM v""")

add("fea12_walk_forward", lambda t: events.walk_forward(t.role("odaily").select("ticker", "day"), "day").withColumn("fold", c("fold").cast("long")),
    """WITH d AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT day FROM odaily)),
       f AS (SELECT day, k AS fold, CASE WHEN i - k * 20 < 60 THEN 'train' ELSE 'test' END AS part FROM d, range(0, 2000) r(k) WHERE i >= k * 20 AND i < k * 20 + 80 AND k * 20 + 80 <= n)
       SELECT ticker, day, fold, part FROM odaily JOIN f USING (day)""")
