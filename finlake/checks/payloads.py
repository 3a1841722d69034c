"""Loaders: payload text derived from the given tables by Spark, then parsed by the loader.

The oracle computes the expected rows straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from finlake import schemas as S
from finlake.checks import roles as R
from finlake.checks.registry import add
from finlake.functions.lookups import EXCHANGES, TRANSACTION_TYPES
from finlake.operators import dedup
from finlake.session import scratch_path
from finlake.sources import bars as sb, common, filings as sf, options as so, reference as sr, series as ss, sinks

c = F.col


def stamp() -> Column:
    return F.lit("2024-02-01 00:00:00").cast("timestamp")



def js(**fields: Column) -> Column:
    return F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]))


# ---- bars -------------------------------------------------------------------------


def _aggs(t):
    v = c("value")
    d = t.events.select(c("event_type").alias("ticker"), js(
        t=F.unix_millis(c("ts").cast("timestamp")), o=v, h=v + 1, l=v - 1, c=v, v=c("event_id") % 100 + 1,
        vw=F.when(c("event_id") % 3 != 0, v), n=F.when(c("event_id") % 4 != 0, c("user_id"))).alias("payload"))
    return sb.bars_from_aggs(common.parse_text(d, "payload", S.MINUTE_BARS, ("ticker",)), ingested_at=stamp()).drop("ingested_at")


add("src01_minute_aggs", _aggs,
    """SELECT event_type AS ticker, date_trunc('milliseconds', ts) AS timestamp, value AS open, value + 1 AS high, value - 1 AS low, value AS close, event_id % 100 + 1 AS volume,
       CASE WHEN event_id % 3 <> 0 THEN value END AS vwap, CASE WHEN event_id % 4 <> 0 THEN user_id END AS transactions, 'polygon_backfill' AS source FROM events""")


def _candles(t):
    v = c("o_totalprice")
    d = t.orders.select(c("o_orderpriority").alias("ticker"), js(
        datetime=F.unix_millis(c("o_orderdate").cast("timestamp")), open=v, high=v * 2, low=v / 2, close=v, volume=c("o_custkey")).alias("payload"))
    return sb.bars_from_candles(common.parse_text(d, "payload", S.DAILY_CANDLES, ("ticker",)), ingested_at=stamp()).drop("ingested_at")


add("src02_daily_candles", _candles,
    """SELECT o_orderpriority AS ticker, o_orderdate AS timestamp, o_totalprice AS open, o_totalprice * 2 AS high, o_totalprice / 2 AS low, o_totalprice AS close, o_custkey AS volume,
       NULL::DOUBLE AS vwap, NULL::BIGINT AS transactions, 'schwab' AS source FROM orders""")


def _grouped(t):
    p = c("l_extendedprice")
    d = t.lineitem.select(F.to_date("l_shipdate").alias("day"), js(
        T=c("l_suppkey").cast("string"), o=p, h=p + 1 - c("l_discount") * 20, l=p, c=p - 30000, v=c("l_quantity") - 5, vw=p, n=c("l_linenumber")).alias("payload"))
    parsed = common.parse_text(d, "payload", S.GROUPED_DAILY, ("day",))
    nyse = t.role("universe").filter(c("exchange") == "NYSE").select("ticker")
    return sb.daily_from_grouped(parsed, tickers=nyse, ingested_at=stamp()).drop("ingested_at")


add("src03_grouped_daily", _grouped,
    """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS day, l_extendedprice AS open, l_extendedprice + 1 - l_discount * 20 AS high, l_extendedprice AS low, l_extendedprice - 30000 AS close,
       CAST(l_quantity - 5 AS BIGINT) AS volume, l_extendedprice AS vwap, CAST(l_linenumber AS BIGINT) AS transactions, 'polygon' AS source FROM lineitem JOIN universe u ON u.ticker = CAST(l_suppkey AS VARCHAR)
       WHERE exchange = 'NYSE' AND l_extendedprice + 1 - l_discount * 20 >= l_extendedprice AND l_quantity > 5 AND l_extendedprice > 30000""")

# ---- options ----------------------------------------------------------------------


def _contract_fields(t):
    d = t.role("chain")
    return d, dict(symbol=c("underlying"), expiration=c("expiration").cast("string"), strike=c("strike"), right=F.upper("put_call"))


def _greeks(t):
    d, k = _contract_fields(t)
    d = d.select("snapshot_date", "seq", js(
        **k, open=c("open"), close=c("close"), volume=F.when(c("volume") % 10 == 3, F.lit("n/a")).otherwise(c("volume").cast("string")), count=c("open_interest"),
        bid=c("bid"), ask=c("ask"), delta=c("delta"), gamma=c("gamma"), implied_vol=c("implied_vol"), underlying_price=c("underlying_price"), extra=F.lit("ignored")).alias("payload"))
    return common.parse_text(d, "payload", S.OPTION_GREEKS, ("snapshot_date", "seq"))


def _chain(t):
    return so.chain_from_greeks(_greeks(t), c("snapshot_date")).select(
        "underlying", "expiration", "strike", "put_call", "open", "high", "close", "volume", "trade_count", "bid", "ask", "bid_size", "delta", "gamma", "theta", "implied_vol", "underlying_price", "snapshot_date", "source")


_CHAIN_SQL = """SELECT underlying, expiration, strike, put_call, open, NULL::DOUBLE AS high, close, CASE WHEN volume % 10 = 3 THEN 0 ELSE volume END AS volume, open_interest AS trade_count, bid, ask,
    0::BIGINT AS bid_size, delta, gamma, NULL::DOUBLE AS theta, implied_vol, underlying_price, snapshot_date, 'thetadata' AS source FROM chain"""
add("src04_option_greeks", _chain, _CHAIN_SQL)


def _oi(t):
    d, k = _contract_fields(t)
    d = d.select("snapshot_date", js(**k, open_interest=F.when(c("open_interest") % 7 == 0, F.lit("-")).otherwise(c("open_interest").cast("string"))).alias("payload"))
    parsed = common.parse_text(d, "payload", S.OPEN_INTEREST, ("snapshot_date",))
    return so.oi_from_ndjson(parsed)


_OI_SQL = "SELECT underlying, expiration, strike, put_call, CASE WHEN open_interest % 7 = 0 THEN 0 ELSE open_interest END AS open_interest FROM chain"
add("src05_open_interest", _oi, _OI_SQL)
add("src06_merge_chain_oi", lambda t: so.merge_chain_oi(
    _chain(t).select("underlying", "expiration", "strike", "put_call", "bid"), _oi(t).groupBy("underlying", "expiration", "strike", "put_call").agg(F.max("open_interest").alias("open_interest"))),
    f"""SELECT x.underlying, x.expiration, x.strike, x.put_call, bid, coalesce(o.open_interest, 0) AS open_interest FROM chain x LEFT JOIN
        (SELECT underlying, expiration, strike, put_call, max(open_interest) AS open_interest FROM ({_OI_SQL}) GROUP BY 1, 2, 3, 4) o USING (underlying, expiration, strike, put_call)""")


def _trades(t):
    ts, v = c("ts").cast("timestamp"), c("value")
    text = F.when(c("event_id") % 11 == 0, F.lit("not a time")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    d = t.events.select(js(
        symbol=c("event_type"), expiration=F.lit("2024-03-15"), strike=(c("user_id") % 10).cast("double"), right=F.when(c("user_id") % 2 == 0, "CALL").otherwise("put"), trade_timestamp=text,
        sequence=c("event_id").cast("string"), price=v, size=F.when(c("event_id") % 13 != 0, (c("event_id") % 50).cast("string")), exchange=F.lit("5"), condition=F.lit("x"),
        bid=v - c("event_id") % 3, ask=v + c("event_id") % 2, bid_size=F.lit("1"), ask_size=F.lit("2")).alias("payload"))
    return so.trades_from_ndjson(common.parse_text(d, "payload", S.TRADE_QUOTES))


add("src07_classified_trades", _trades,
    """WITH e AS (SELECT *, CASE WHEN event_id % 13 <> 0 THEN event_id % 50 ELSE 0 END AS sz FROM events WHERE event_id % 11 <> 0)
       SELECT event_type AS underlying, DATE '2024-03-15' AS expiration, CAST(user_id % 10 AS DOUBLE) AS strike, CASE WHEN user_id % 2 = 0 THEN 'call' ELSE 'put' END AS put_call, date_trunc('milliseconds', ts) AS trade_timestamp,
       event_id AS sequence, value AS price, sz AS size, 5::BIGINT AS exchange, 0::BIGINT AS condition, value - event_id % 3 AS bid, value + event_id % 2 AS ask, 1::BIGINT AS bid_size, 2::BIGINT AS ask_size,
       CASE WHEN value >= value + event_id % 2 THEN 'buy' WHEN value <= value - event_id % 3 THEN 'sell' ELSE 'mid' END AS aggressor_side, CAST(ts AS DATE) AS trade_date, value * sz * 100 AS notional, 'thetadata' AS source FROM e""")

# ---- reference --------------------------------------------------------------------


def _dividends(t):
    d = t.lineitem.select(js(
        ticker=c("l_suppkey").cast("string"), ex_dividend_date=F.to_date("l_shipdate").cast("string"), record_date=F.when(c("l_linenumber") == 3, F.lit("soon")), cash_amount=F.when(c("l_tax") > 0, c("l_discount")),
        frequency=F.when(c("l_linenumber") < 6, c("l_linenumber")), dividend_type=F.when(c("l_linenumber") == 1, F.lit("CD"))).alias("payload"))
    return sr.dividends_from_json(common.parse_text(d, "payload", S.DIVIDENDS))


add("src08_dividends", _dividends,
    """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS ex_dividend_date, NULL::DATE AS declaration_date, NULL::DATE AS record_date, NULL::DATE AS pay_date,
       CASE WHEN l_tax > 0 THEN l_discount ELSE 0 END AS cash_amount, 'USD' AS currency, CASE WHEN l_linenumber < 6 THEN l_linenumber ELSE 0 END AS frequency, CASE WHEN l_linenumber = 1 THEN 'CD' ELSE '' END AS dividend_type FROM lineitem""")
add("src09_splits", lambda t: sr.splits_from_json(common.parse_text(t.lineitem.select(js(
    ticker=c("l_suppkey").cast("string"), execution_date=F.to_date("l_shipdate").cast("string"), split_from=F.when(c("l_tax") > 0, F.lit(1.0)), split_to=c("l_quantity")).alias("payload")), "payload", S.SPLITS)),
    """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS execution_date, CASE WHEN l_tax > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS split_from, l_quantity AS split_to FROM lineitem""")

_MICS = [*list(EXCHANGES)[:12], "XXXX"]


def _details(t):
    mic = F.element_at(F.array(*[F.lit(m) for m in _MICS]), (c("s_suppkey") % 13 + 1).cast("int"))
    d = t.supplier.select(c("s_suppkey").cast("string").alias("ticker"), js(
        name=c("s_name"), type=F.lit("CS"), primary_exchange=mic, sic_code=F.when(c("s_suppkey") % 2 == 0, F.lit("2834")), market_cap=c("s_acctbal"), total_employees=c("s_suppkey"),
        list_date=F.when(c("s_suppkey") % 3 == 0, F.lit("2001-05-06")), address=F.struct(F.concat(F.lit("City "), c("s_nationkey").cast("string")).alias("city"))).alias("payload"))
    fields = ("name", "type", "primary_exchange", "sic_code", "market_cap", "description", "homepage_url", "total_employees", "list_date", "cik", "sic_description", "composite_figi", "address")
    parsed = d.select("ticker", F.from_json("payload", S.TICKER_DETAILS).alias("j")).select("ticker", *[f"j.{x}" for x in fields])
    return sr.universe_from_details(parsed)


_MIC_SQL = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(_MICS))
_EX_SQL = " ".join(f"WHEN {i} THEN '{EXCHANGES.get(m, m)}'" for i, m in enumerate(_MICS))
add("src10_ticker_details", _details,
    f"""SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name, 'CS' AS type, CASE WHEN s_suppkey % 2 = 0 THEN '2834' ELSE '' END AS sic_code, '' AS description, '' AS homepage_url, '' AS cik, '' AS sic_description,
        CASE s_suppkey % 13 {_MIC_SQL} END AS mic_code, CASE s_suppkey % 13 {_EX_SQL} END AS exchange, s_acctbal AS market_cap, s_suppkey AS total_employees,
        CASE WHEN s_suppkey % 3 = 0 THEN DATE '2001-05-06' ELSE DATE '1970-01-01' END AS list_date, 'City ' || s_nationkey AS address_city, '' AS address_state, '' AS composite_figi, TRUE AS active FROM supplier""")
add("src21_attach_cik", lambda t: sr.attach_cik(t.role("dividends").select(F.lower("ticker").alias("ticker"), "seq"), sr.cik_map(
    t.supplier.filter(c("s_acctbal") > 0).select(c("s_suppkey").cast("string").alias("ticker"), c("s_suppkey").alias("cik"), F.lit(None).cast("string").alias("exchange")))),
    "SELECT d.ticker, seq, lpad(ticker, 10, '0') AS cik FROM dividends d JOIN supplier ON ticker = CAST(s_suppkey AS VARCHAR) WHERE s_acctbal > 0")
add("src22_filing_url", lambda t: t.role("filings").select("seq", sf.filing_url(c("cik"), c("accession_number")).alias("url")),
    "SELECT seq, 'https://www.sec.gov/Archives/edgar/data/' || ltrim(cik, '0') || '/' || replace(accession_number, '-', '') || '/' AS url FROM filings")
add("src23_universe_lines", lambda t: common.only_tickers(t.part.select(F.upper("p_name").alias("ticker"), "p_partkey"), common.universe_from_lines(
    t.part.filter(c("p_size") > 45).select(F.concat(F.lit("  "), F.when(c("p_size") < 50, c("p_name")).otherwise(""), F.lit(" ")).alias("value")))),
    "SELECT upper(p_name) AS ticker, p_partkey FROM part WHERE upper(p_name) IN (SELECT upper(trim(p_name)) FROM part WHERE p_size > 45 AND p_size < 50)")

# ---- series -----------------------------------------------------------------------


def _yield_observations(t):
    p, k = c("o_orderpriority"), c("o_orderkey")
    sid = F.element_at(F.create_map(*[F.lit(x) for kv in R.YIELD_SERIES.items() for x in kv]), p)
    value = F.when(k % 9 == 0, ".").when(k % 9 == 1, "oops").otherwise((c("o_totalprice") / 100000).cast("string"))
    return t.orders.select(sid.alias("series_id"), F.to_date("o_orderdate").cast("string").alias("date"), value.alias("value"), k.alias("seq"))


add("src11_treasury_wide", lambda t: ss.wide_table(_yield_observations(t), "treasury_yields", seq="seq"),
    "WITH o AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS p, o_totalprice / 100000 AS v, o_orderkey AS k FROM orders WHERE o_orderkey % 9 > 1) SELECT date, NULL::DOUBLE AS yield_1_month, NULL::DOUBLE AS yield_3_month, "
    + ", ".join(f"arg_max(v, k) FILTER (p = '{p}') AS {x}" for p, x in (("1-URGENT", "yield_1_year"), ("2-HIGH", "yield_2_year"), ("3-MEDIUM", "yield_5_year"), ("4-NOT SPECIFIED", "yield_10_year"), ("5-LOW", "yield_30_year")))
    + " FROM o GROUP BY 1")

_REGIONS = {1: "SAU", 2: "IRN", 3: "IRQ", 4: "ARE", 5: "MCRFPUS2", 6: "RUS", 7: "MCRIMUSPG2"}
_RCOLS = {1: "saudi_production", 2: "iran_production", 3: "iraq_production", 4: "uae_production", 5: "us_production", 6: "russia_production", 7: "imports_persian_gulf"}


def _energy_observations(t):
    sid = F.element_at(F.create_map(*[F.lit(x) for kv in _REGIONS.items() for x in kv]), c("l_linenumber"))
    d = t.lineitem.groupBy(sid.alias("series_id"), F.date_format("l_shipdate", "yyyy-MM").alias("date")).agg(F.sum("l_quantity").alias("value"))
    return ss.wide_table(d.withColumn("value", c("value").cast("string")), "eia_petroleum_monthly")


add("src12_energy_monthly", _energy_observations,
    "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, " + ", ".join(f"sum(l_quantity) FILTER (l_linenumber = {i}) AS {x}" for i, x in _RCOLS.items())
    + ", " + ", ".join(f"NULL::DOUBLE AS {x}" for x in ("opec_production", "world_production", "imports_canada", "imports_mexico", "imports_total")) + " FROM lineitem GROUP BY 1")


def _matrix(t):
    nan = F.lit(float("nan"))
    aggs = []
    for s in R.SYMBOLS:
        mine = c("ticker") == s
        for f in ("Open", "High", "Low", "Close", "Volume"):
            v = F.max(F.when(mine, c(f.lower()).cast("double")))
            aggs.append((F.when(F.max(F.when(mine, c("volume") % 5)) == 0, nan).otherwise(v) if f == "Open" else F.coalesce(v, nan) if f == "Close" else v).alias(f"{f}|{s}"))
    return ss.futures_bars(t.role("futures").groupBy("date").agg(*aggs)).withColumn("volume", c("volume").cast("long"))


add("src13_futures_matrix", _matrix, "SELECT ticker, name, date, CASE WHEN volume % 5 = 0 THEN 0 ELSE open END AS open, high, low, close, volume FROM futures")

# ---- company facts ----------------------------------------------------------------

_CONCEPT = {0: "Revenues", 1: "RevenueFromContractWithCustomerExcludingAssessedTax", 2: "NetIncomeLoss", 3: "Assets"}


def _facts(t):
    k, day = c("o_orderkey"), F.to_date("o_orderdate")
    q = F.quarter(day)
    fp = F.when(q == 4, "FY").otherwise(F.concat(F.lit("Q"), q.cast("string")))
    form = F.concat(F.when(k % 7 == 0, "8-K").when(q == 4, "10-K").otherwise("10-Q"), F.when(k % 5 == 0, "/A").otherwise(""))
    fact = F.struct(F.trunc(day, "quarter").cast("string").alias("start"), F.last_day(F.add_months(F.trunc(day, "quarter"), 2)).cast("string").alias("end"), c("o_totalprice").alias("val"),
                    fp.alias("fp"), form.alias("form"), F.date_add(day, 30).cast("string").alias("filed"), k.cast("string").alias("accn"))
    concept = F.element_at(F.create_map(*[F.lit(x) for kv in _CONCEPT.items() for x in kv]), (k % 4).cast("int"))
    tax = F.when(c("o_custkey") % 6 == 0, "ifrs-full").otherwise("us-gaap")
    doc = F.struct(F.create_map(tax, F.create_map(concept, F.struct(F.create_map(F.lit("USD"), F.array(fact)).alias("units")))).alias("facts"))
    return t.orders.select(F.lpad(c("o_custkey").cast("string"), 10, "0").alias("cik"), F.to_json(doc).alias("payload"))


_FACTS_SQL = """WITH f AS (SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CASE o_orderkey % 4 WHEN 0 THEN 'revenue' WHEN 1 THEN 'revenue' WHEN 2 THEN 'net_income' ELSE 'total_assets' END AS field,
      CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS prio, CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 5 ELSE 13 END AS no, o_totalprice AS val,
      CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS s, CAST(last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) AS VARCHAR) AS e,
      CASE WHEN quarter(o_orderdate) = 4 THEN 'FY' ELSE 'Q' || quarter(o_orderdate) END AS fp,
      CASE WHEN o_orderkey % 7 = 0 THEN '8-K' WHEN quarter(o_orderdate) = 4 THEN '10-K' ELSE '10-Q' END || CASE WHEN o_orderkey % 5 = 0 THEN '/A' ELSE '' END AS form,
      CAST(CAST(o_orderdate AS DATE) + 30 AS VARCHAR) AS filed, CAST(o_orderkey AS VARCHAR) AS accn FROM orders),
    g AS (SELECT * FROM f JOIN (SELECT cik, field, min(prio) AS prio FROM f GROUP BY 1, 2) USING (cik, field, prio) WHERE form IN ('10-K', '10-K/A', '10-Q', '10-Q/A')),
    m AS (SELECT *, row_number() OVER (PARTITION BY cik, e, fp, form ORDER BY no, s, filed, accn) AS r FROM g),
    p AS (SELECT cik, e AS period_end, fp AS fiscal_period, form AS form_type, max(s) FILTER (r = 1) AS period_start, max(filed) FILTER (r = 1) AS filed_date, max(accn) FILTER (r = 1) AS accession_number,
      max(val) FILTER (field = 'revenue') AS revenue, max(val) FILTER (field = 'net_income') AS net_income, max(val) FILTER (field = 'total_assets') AS total_assets FROM m GROUP BY 1, 2, 3, 4),
    z AS (SELECT *, row_number() OVER (PARTITION BY cik, period_end, fiscal_period ORDER BY form_type LIKE '%A%', filed_date DESC, form_type DESC) AS rn FROM p) """
_KEEP = ("cik", "period_end", "fiscal_period", "form_type", "period_start", "filed_date", "accession_number", "revenue", "net_income", "total_assets")
add("src14_financials_from_facts", lambda t: sf.financials_from_facts(_facts(t)).select(*_KEEP), _FACTS_SQL + f"SELECT {', '.join(_KEEP)} FROM z WHERE rn = 1")
add("dq04_dedup_periods", lambda t: dedup.dedup_periods(t.orders.select(
    c("o_custkey").alias("cik"), F.year("o_orderdate").alias("period_end"), F.lit("FY").alias("fiscal_period"), F.when(c("o_orderkey") % 2 == 0, "10-K/A").otherwise("10-K").alias("form_type"),
    F.to_date("o_orderdate").alias("filed_date"), "o_orderkey").groupBy("cik", "period_end", "fiscal_period", "form_type", "filed_date").agg(F.max("o_orderkey").alias("k"))),
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY cik, period_end ORDER BY form_type = '10-K/A', filed_date DESC) AS rn FROM (SELECT o_custkey AS cik, CAST(year(o_orderdate) AS INTEGER) AS period_end,
       'FY' AS fiscal_period, CASE WHEN o_orderkey % 2 = 0 THEN '10-K/A' ELSE '10-K' END AS form_type, CAST(o_orderdate AS DATE) AS filed_date, max(o_orderkey) AS k FROM orders GROUP BY ALL)) WHERE rn = 1""")
add("src15_shape_financials", lambda t: sf.shape_financials(sf.financials_from_facts(_facts(t)), t.customer.filter(c("c_acctbal") > 0).select(
    c("c_name").alias("ticker"), F.lpad(c("c_custkey").cast("string"), 10, "0").alias("cik"))).select("ticker", "cik", "period_start", "period_end", "fiscal_year", "fiscal_period", "revenue", "filing_url", "source"),
    _FACTS_SQL + """SELECT c_name AS ticker, cik, CAST(period_start AS DATE) AS period_start, CAST(period_end AS DATE) AS period_end, substring(period_end, 1, 4) AS fiscal_year, fiscal_period, revenue,
       'https://www.sec.gov/Archives/edgar/data/' || ltrim(cik, '0') || '/' || accession_number || '/' AS filing_url, 'sec_edgar' AS source FROM z JOIN customer ON lpad(CAST(c_custkey AS VARCHAR), 10, '0') = cik WHERE rn = 1 AND c_acctbal > 0""")

# ---- submissions ------------------------------------------------------------------


def _submissions(t):
    f = t.role("filings")
    arr = lambda *x: F.array(*x)
    recent = F.struct(arr(c("form_type"), F.lit("8-K")).alias("form"), arr(c("accession_number")).alias("accessionNumber"), arr(c("filed_date").cast("string"), F.lit("2002-01-01")).alias("filingDate"),
                      arr(F.coalesce(c("report_date").cast("string"), F.lit(""))).alias("reportDate"), arr(F.lit("a.htm"), F.lit("b.htm"), F.lit("c.htm")).alias("primaryDocument"),
                      arr(F.coalesce("items", F.lit("")), F.lit("8.01")).alias("items"), arr((c("seq") % 2).cast("int")).alias("isXBRL"))
    d = f.select("ticker", "cik", F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings"))).alias("payload"))
    return sf.filings_from_submissions(d)


_URL = "'https://www.sec.gov/Archives/edgar/data/' || ltrim(cik, '0') || '/' || replace(accession_number, '-', '') || '/'"
_SUB_SQL = f"""SELECT ticker, cik, accession_number, form_type, filed_date, report_date, 'a.htm' AS primary_doc, NULL::VARCHAR AS primary_doc_desc, items, seq % 2 = 1 AS is_xbrl, {_URL} AS filing_url, 'sec_edgar' AS source FROM filings
    UNION ALL SELECT ticker, cik, '', '8-K', DATE '2002-01-01', NULL, 'b.htm', NULL, '8.01', FALSE, '', 'sec_edgar' FROM filings"""
add("src16_submissions", _submissions, _SUB_SQL)
add("src17_report_items", lambda t: sf.explode_items(_submissions(t)),
    f"""WITH s AS ({_SUB_SQL}), x AS (SELECT *, trim(unnest(string_split(items, ','))) AS item_code FROM s WHERE form_type IN ('8-K', '8-K/A') AND items IS NOT NULL)
        SELECT ticker, cik, accession_number, filed_date, report_date, item_code, CASE item_code WHEN '2.02' THEN 'Results of Operations' WHEN '9.01' THEN 'Financial Statements and Exhibits'
        WHEN '5.02' THEN 'Officer Departure/Appointment' WHEN '8.01' THEN 'Other Events' ELSE 'Unknown' END AS item_description, primary_doc, filing_url, source FROM x WHERE item_code <> ''""")

# ---- forms ------------------------------------------------------------------------


def _text(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


_CODES = [*TRANSACTION_TYPES, "?"]


def _insider(t):
    k = c("o_orderkey")
    code = F.element_at(F.array(*[F.lit(x) for x in _CODES]), (k % len(_CODES) + 1).cast("int"))
    tx = lambda tag, shares, price: _text(
        f"<{tag}><securityTitle><value>Common</value></securityTitle><transactionCoding><transactionFormType>4</transactionFormType><transactionCode>", code, "</transactionCode></transactionCoding><transactionAmounts>"
        "<transactionShares><value>", shares, "</value></transactionShares><transactionPricePerShare>", price, "</transactionPricePerShare><transactionAcquiredDisposedCode><value>A</value></transactionAcquiredDisposedCode>"
        "</transactionAmounts><postTransactionAmounts><sharesOwnedFollowingTransaction><value>", c("o_custkey"), f"</value></sharesOwnedFollowingTransaction></postTransactionAmounts></{tag}>")
    xml = _text(
        "<?xml version=\"1.0\"?><ownershipDocument><periodOfReport>", F.to_date("o_orderdate"), "</periodOfReport><issuer><issuerTradingSymbol>X</issuerTradingSymbol></issuer>"
        "<reportingOwner><reportingOwnerId><rptOwnerCik>", c("o_custkey"), "</rptOwnerCik><rptOwnerName>Owner ", c("o_custkey"), "</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isOfficer>",
        F.when(k % 2 == 0, "1").otherwise("false"), "</isOfficer><isDirector>true</isDirector></reportingOwnerRelationship></reportingOwner><nonDerivativeTable>",
        tx("nonDerivativeTransaction", k % 1000, F.concat(F.lit("<value>"), F.lit("12.5"), F.lit("</value>"))), tx("nonDerivativeTransaction", F.lit("1,000"), F.lit("2")), "</nonDerivativeTable>",
        F.when(k % 3 == 0, F.concat(F.lit("<derivativeTable>"), tx("derivativeTransaction", F.lit("7"), F.lit("<footnoteId id=\"F1\"/>")), F.lit("</derivativeTable>"))).otherwise(""), "</ownershipDocument>")
    d = t.orders.select(k.alias("seq"), F.when(k % 50 == 7, F.lit("<broken")).otherwise(xml).alias("payload"))
    return sf.insider_from_xml(d, keep=("seq",)).drop("reporter_title", "ownership_type", "is_ten_pct_owner")


_TYPE_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TRANSACTION_TYPES.items())
_CODE_SQL = " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(_CODES))
add("src18_insider_forms", _insider,
    f"""WITH o AS (SELECT *, CASE o_orderkey % {len(_CODES)} {_CODE_SQL} END AS code FROM orders WHERE o_orderkey % 50 <> 7),
        x AS (SELECT *, FALSE AS der, CAST(o_orderkey % 1000 AS DOUBLE) AS sh, 12.5::DOUBLE AS px FROM o UNION ALL SELECT *, FALSE, 1000.0::DOUBLE, 2.0::DOUBLE FROM o UNION ALL SELECT *, TRUE, 7.0::DOUBLE, NULL FROM o WHERE o_orderkey % 3 = 0)
        SELECT o_orderkey AS seq, CAST(o_orderdate AS DATE) AS report_date, CAST(o_custkey AS VARCHAR) AS reporter_cik, 'Owner ' || o_custkey AS reporter_name, o_orderkey % 2 = 0 AS is_officer, TRUE AS is_director,
        'Common' AS security_title, code AS transaction_code, CASE code {_TYPE_SQL} ELSE 'other' END AS transaction_type, der AS is_derivative, sh AS shares, px AS price, CASE WHEN sh <> 0 AND px <> 0 THEN sh * px END AS value,
        'A' AS acquired_or_disposed, CAST(o_custkey AS DOUBLE) AS shares_owned_after FROM x""")


def _ownership(t):
    k, day = c("o_orderkey"), F.to_date("o_orderdate")
    total = F.when(k % 3 == 0, F.lit("")).otherwise(_text("<n1:reportingPersonBeneficiallyOwnedAggregateNumberOfShares>", k, ",000</n1:reportingPersonBeneficiallyOwnedAggregateNumberOfShares>"))
    xml = _text(
        "<?xml version=\"1.0\"?><n1:edgarSubmission xmlns:n1=\"http://example.org/schedule13g\"><n1:headerData><n1:filerInfo><n1:filer><n1:filerCredentials><n1:cik>", c("o_custkey"),
        "</n1:cik></n1:filerCredentials></n1:filer></n1:filerInfo></n1:headerData><n1:formData><n1:coverPageHeader><n1:eventDateRequiresFilingThisStatement>", F.date_format(day, "MM/dd/yyyy"),
        "</n1:eventDateRequiresFilingThisStatement>", F.when(k % 4 == 0, "<n1:amendmentNo>2</n1:amendmentNo>").otherwise(""), "</n1:coverPageHeader><n1:coverPageHeaderReportingPersonDetails><n1:reportingPersonName>Fund ",
        c("o_custkey"), "</n1:reportingPersonName><n1:reportingPersonBeneficiallyOwnedNumberOfShares><n1:soleVotingPower>5</n1:soleVotingPower></n1:reportingPersonBeneficiallyOwnedNumberOfShares>", total,
        "</n1:coverPageHeaderReportingPersonDetails><n1:items><n1:item4><n1:amountBeneficiallyOwned>77</n1:amountBeneficiallyOwned><n1:classPercent>4.5%</n1:classPercent></n1:item4></n1:items></n1:formData></n1:edgarSubmission>")
    d = t.orders.select(k.alias("seq"), F.when(k % 50 == 7, F.lit("<html>no form</html>")).otherwise(xml).alias("payload"))
    return sf.holders_from_xml(d, keep=("seq",)).select("seq", "holder_cik", "holder_name", "shares_held", "class_percent", "sole_voting_power", "event_date", "amendment_number", "is_amendment")


add("src19_ownership_forms", _ownership,
    """SELECT o_orderkey AS seq, CAST(o_custkey AS VARCHAR) AS holder_cik, 'Fund ' || o_custkey AS holder_name, CASE WHEN o_orderkey % 3 = 0 THEN 77.0::DOUBLE ELSE o_orderkey * 1000.0::DOUBLE END AS shares_held,
       CASE WHEN o_orderkey % 3 = 0 THEN 4.5::DOUBLE END AS class_percent, 5.0::DOUBLE AS sole_voting_power, CAST(o_orderdate AS DATE) AS event_date, CASE WHEN o_orderkey % 4 = 0 THEN 2 END AS amendment_number,
       o_orderkey % 4 = 0 AS is_amendment FROM orders WHERE o_orderkey % 50 <> 7""")


def _ownership_html(t):
    k = c("o_orderkey")
    page = _text("<html><body><p>1. NAME OF REPORTING\n<b>PERSONS</b></p><td>Fund Alpha, Inc. &amp; Co </td><td>2 CHECK THE BOX</td><p>9 AGGREGATE AMOUNT BENEFICIALLY OWNED</p><td>", k + 10, ",500</td>",
                 "<p>PERCENT OF CLASS</p><td>", F.round(c("o_totalprice") / 100000, 1), "%</td></body></html>")
    d = t.orders.select(k.alias("seq"), F.when(k % 6 == 0, F.lit("<p>nothing here</p>")).otherwise(page).alias("payload"))
    return sf.holders_from_html(d, keep=("seq",))


add("src20_ownership_html", _ownership_html,
    r"""WITH p AS (SELECT o_orderkey AS seq, regexp_replace(regexp_replace('<html><body><p>1. NAME OF REPORTING' || chr(10) || '<b>PERSONS</b></p><td>Fund Alpha, Inc. &amp; Co </td><td>2 CHECK THE BOX</td><p>9 AGGREGATE AMOUNT BENEFICIALLY OWNED</p><td>'
        || (o_orderkey + 10) || ',500</td><p>PERCENT OF CLASS</p><td>' || round(o_totalprice / 100000, 1) || '%</td></body></html>', '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g') AS t FROM orders WHERE o_orderkey % 6 <> 0)
        SELECT seq, trim(regexp_extract(t, '(?i)NAME OF REPORTING PERSON[S]?\s*[:\-]?\s*([A-Z][\w\s,\.&]+?)(?:\d|\n|CHECK)', 1)) AS holder_name,
        CAST(replace(regexp_extract(t, '(?i)AGGREGATE AMOUNT[^:]*?(\d[\d,]+)', 1), ',', '') AS DOUBLE) AS shares_held, CAST(regexp_extract(t, '(?i)PERCENT OF CLASS[^:]*?([\d.]+)\s*%?', 1) AS DOUBLE) AS class_percent FROM p""")
add("src20_page_text", lambda t: t.pages.select("page_id", F.md5(sf.plain_text(c("html"))).alias("digest"), F.length(sf.plain_text(c("html"))).cast("long").alias("chars")),
    r"""SELECT page_id, md5(t) AS digest, length(t) AS chars FROM (SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g') AS t FROM pages)""")

# ---- sinks ------------------------------------------------------------------------


def _roundtrip(t):
    from finlake.session import checkpoint_root
    import uuid
    path = f"{checkpoint_root(t.spark)}/snk01-{uuid.uuid4().hex}"
    sinks.append(t.role("odaily"), path, "day", ["ticker", "day"])
    return t.spark.read.parquet(path).withColumn("year", c("year").cast("int")).select("ticker", "day", "close", "volume", "year")


add("snk01_append_roundtrip", _roundtrip, "SELECT ticker, day, close, volume, CAST(year(day) AS INTEGER) AS year FROM odaily")
add("snk02_reconcile_months", lambda t: sinks.reconcile(
    t.lineitem.select(F.date_format("l_shipdate", "yyyyMM").cast("int").alias("ym")), t.lineitem.filter(c("l_quantity") < 50).select(F.date_format("l_shipdate", "yyyyMM").cast("int").alias("ym")), "ym"),
    """WITH s AS (SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS ym, count(*) AS source_rows, count(*) FILTER (l_quantity < 50) AS target_rows FROM lineitem GROUP BY 1)
       SELECT ym, source_rows, target_rows, source_rows = target_rows AS matches FROM s""")
def _copied(t):
    """Rows of both sides of a copy by month, and what the written side adds up to."""
    path = scratch_path(t.spark, "snk02")
    d = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    counts = sinks.copy_by_month(d, path, "l_shipdate", ["l_orderkey", "l_linenumber"])
    written = t.spark.read.parquet(path).groupBy("ym").agg(F.sum("l_quantity").alias("quantity"), F.min("l_shipdate").cast("date").alias("first_day"), F.max("l_orderkey").alias("last_order"))
    return counts.join(written, "ym")


add("snk02_copy_by_month", _copied,
    """SELECT CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS ym, count(*) AS source_rows, count(*) AS target_rows, TRUE AS matches, sum(l_quantity) AS quantity, CAST(min(l_shipdate) AS DATE) AS first_day,
       max(l_orderkey) AS last_order FROM lineitem GROUP BY 1""")
add("snk03_merge_latest", lambda t: dedup.merge_latest(
    t.orders.filter(c("o_orderstatus") == "F"), t.orders.withColumn("o_totalprice", c("o_totalprice") + (c("o_orderkey") % 3 - 1)), ["o_orderkey"], ["o_totalprice"]),
    """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN o_totalprice ELSE o_totalprice + (o_orderkey % 3 - 1) END AS o_totalprice, o_orderdate, o_orderpriority FROM orders""")
