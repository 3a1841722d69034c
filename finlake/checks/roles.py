"""Test tables in the roles of market tables.

Each role exists twice: as a DataFrame built from the given tables, and as SQL text for
the independent oracle.  ``ORACLE_ROLES`` holds the SQL; ``oracle()`` puts the roles a
query names in front of it as CTEs.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.lookups import FUTURES
from finlake.operators.bars import bars_from_ticks

ORACLE_ROLES: dict[str, str] = {}

SYMBOLS = ("GC=F", "SI=F", "CL=F", "NG=F", "PL=F", "ZC=F", "ZW=F", "HG=F", "RB=F", "HO=F", "ZS=F", "ZM=F", "ZL=F")
FORMS = ("10-K", "10-Q", "8-K", "4", "SC 13G", "S-1", "424B5", "10-K/A", "8-K/A", "SCHEDULE 13D", "S-8 POS", "6-K", "424B2", "3")


def oracle(sql: str) -> str:
    """SQL with the CTEs of every role it names (and of the roles those name)."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for r in ORACLE_ROLES:
            if r not in needed and re.search(rf"\b(FROM|JOIN)\s+{r}\b", text):
                visit(ORACLE_ROLES[r])
                if r not in needed:
                    needed.append(r)

    visit(sql)
    body = sql.strip()
    ctes = ", ".join(f"{r} AS ({ORACLE_ROLES[r]})" for r in needed)
    if not ctes:
        return body
    for head in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(head):
            return f"{head}{ctes}, {body[len(head):]}"
    return f"WITH {ctes} {body}"


class Tables:
    """The given tables of one folder, and the roles built from them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def role(self, name: str) -> DataFrame:
        return ROLES[name](self)


ROLES: dict[str, Callable[[Tables], DataFrame]] = {}


def role(name: str, sql: str) -> Callable:
    def register(fn: Callable[[Tables], DataFrame]) -> Callable:
        ROLES[name] = fn
        ORACLE_ROLES[name] = sql
        return fn
    return register


def day_of(c: str) -> Column:
    return F.to_date(c)


def week_of(c: str) -> Column:
    return F.trunc(F.to_date(c), "week")


# ---- trades and bars --------------------------------------------------------------

@role("ticks", """SELECT event_type AS ticker, ts AS timestamp, value AS price,
    CAST(event_id % 100 + 1 AS BIGINT) AS size, event_id AS seq FROM events""")
def ticks(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("price"),
        (F.col("event_id") % 100 + 1).alias("size"), F.col("event_id").alias("seq"))


BARS_SQL = """SELECT ticker, {t}, arg_min(price, {o}) AS open, max(price) AS high, min(price) AS low, arg_max(price, {o}) AS close,
    CAST(sum(size) AS BIGINT) AS volume, sum(price * size) / sum(size) AS vwap, count(*) AS transactions FROM {src} GROUP BY 1, 2"""
TICK_ORDER = "CAST(epoch_us(timestamp) AS HUGEINT) * 10000000000000000000 + seq"


@role("minute", BARS_SQL.format(t="time_bucket(INTERVAL '1 minute', timestamp) AS timestamp", o=TICK_ORDER, src="ticks"))
def minute(t: Tables) -> DataFrame:
    return bars_from_ticks(ticks(t), "ticker", "timestamp", "price", "size", "1m", "seq", "timestamp")


@role("oticks", """SELECT o_orderpriority AS ticker, o_orderdate AS timestamp, o_totalprice AS price,
    CAST(o_orderkey % 100 + 1 AS BIGINT) AS size, o_orderkey AS seq FROM orders""")
def oticks(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderpriority").alias("ticker"), F.col("o_orderdate").alias("timestamp"), F.col("o_totalprice").alias("price"),
        (F.col("o_orderkey") % 100 + 1).alias("size"), F.col("o_orderkey").alias("seq"))


@role("odaily", BARS_SQL.format(t="CAST(timestamp AS DATE) AS day", o="seq", src="oticks"))
def odaily(t: Tables) -> DataFrame:
    """Five long daily series; one trade time per day, so the sequence alone orders it."""
    return bars_from_ticks(oticks(t), "ticker", "timestamp", "price", "size", "1d", "seq", "day")


@role("sticks", """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, l_shipdate AS timestamp, l_extendedprice AS price,
    CAST(l_quantity AS BIGINT) AS size, l_orderkey * 10 + l_linenumber AS seq FROM lineitem""")
def sticks(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").cast("string").alias("ticker"), F.col("l_shipdate").alias("timestamp"), F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("long").alias("size"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))


@role("sdaily", BARS_SQL.format(t="CAST(timestamp AS DATE) AS day", o="seq", src="sticks"))
def sdaily(t: Tables) -> DataFrame:
    """Many sparse daily series."""
    return bars_from_ticks(sticks(t), "ticker", "timestamp", "price", "size", "1d", "seq", "day")


def newest(df: DataFrame, day: Column) -> Column:
    """Newest date of a table as a literal: one value from a one-column scan.

    A literal lets Spark prune row groups and folders while planning.
    """
    return F.lit(df.select(F.max(day)).first()[0])


def s_asof(t: Tables) -> Column:
    """Last market day of the many series."""
    return newest(t.lineitem, day_of("l_shipdate"))


S_ASOF = "(SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)"


def o_asof(t: Tables) -> Column:
    return newest(t.orders, day_of("o_orderdate"))


O_ASOF = "(SELECT max(CAST(o_orderdate AS DATE)) FROM orders)"


@role("universe", """SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name,
    CASE WHEN s_nationkey % 3 = 0 THEN 'NYSE' WHEN s_nationkey % 3 = 1 THEN 'NASDAQ' ELSE 'NYSE American' END AS exchange,
    r_name AS sector, CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE CAST(10 + s_suppkey % 65 AS VARCHAR) || '00' END AS sic_code,
    CASE WHEN s_suppkey % 5 = 0 THEN 'ETF' ELSE 'CS' END AS type, s_suppkey % 10 <> 0 AS active, s_acctbal AS market_cap
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def universe(t: Tables) -> DataFrame:
    s, n = F.col("s_suppkey"), F.col("s_nationkey")
    d = t.supplier.join(t.nation, n == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return d.select(
        s.cast("string").alias("ticker"), F.col("s_name").alias("name"),
        F.when(n % 3 == 0, "NYSE").when(n % 3 == 1, "NASDAQ").otherwise("NYSE American").alias("exchange"), F.col("r_name").alias("sector"),
        F.when(s % 11 == 0, "").otherwise(F.concat((10 + s % 65).cast("string"), F.lit("00"))).alias("sic_code"),
        F.when(s % 5 == 0, "ETF").otherwise("CS").alias("type"), (s % 10 != 0).alias("active"), F.col("s_acctbal").alias("market_cap"))


@role("dividends", """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS ex_dividend_date,
    l_extendedprice / 10000 AS cash_amount, l_linenumber AS frequency, l_orderkey * 10 + l_linenumber AS seq FROM lineitem""")
def dividends(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").cast("string").alias("ticker"), day_of("l_shipdate").alias("ex_dividend_date"),
        (F.col("l_extendedprice") / 10000).alias("cash_amount"), F.col("l_linenumber").alias("frequency"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))


# ---- options ----------------------------------------------------------------------

_WEEK = "CAST(date_trunc('week', l_shipdate) AS DATE)"
_CONTRACT_SQL = f"""l_returnflag AS underlying, {_WEEK} + CAST((l_linenumber - 1) * 7 AS INTEGER) AS expiration,
    CAST(20 + CAST(l_quantity AS BIGINT) % 11 AS DOUBLE) AS strike, CASE l_linestatus WHEN 'O' THEN 'call' ELSE 'put' END AS put_call"""


def _contract() -> list[Column]:
    week = week_of("l_shipdate")
    return [F.col("l_returnflag").alias("underlying"), F.date_add(week, (F.col("l_linenumber") - 1) * 7).alias("expiration"),
            (F.lit(20.0) + F.col("l_quantity").cast("long") % 11).alias("strike"),
            F.when(F.col("l_linestatus") == "O", "call").otherwise("put").alias("put_call")]


@role("chain", f"""SELECT {_CONTRACT_SQL}, {_WEEK} AS snapshot_date,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice / 1000 END AS open,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice / 1000 + 1 END AS high,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice / 1000 - 1 END AS low,
    CASE WHEN l_linenumber = 6 THEN NULL ELSE l_extendedprice / 1000 END AS close,
    l_partkey % 1000 AS volume, l_partkey % 500 AS open_interest,
    CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN 0.0 ELSE l_extendedprice / 1000 END AS bid,
    CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN 0.0 ELSE l_extendedprice / 1000 + l_discount END AS ask,
    CASE l_linestatus WHEN 'O' THEN 0.05 + l_tax * 10 ELSE -(0.05 + l_tax * 10) END AS delta, l_tax AS gamma, -l_discount AS theta,
    l_tax * 2 AS vega, 0.01::DOUBLE AS rho, l_discount * 5 AS implied_vol, CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE 25.0::DOUBLE END AS underlying_price,
    l_orderkey * 10 + l_linenumber AS seq FROM lineitem""")
def chain(t: Tables) -> DataFrame:
    c = F.col
    px, six = c("l_extendedprice") / 1000, c("l_linenumber") == 6
    empty = (c("l_linenumber") == 7) & (c("l_tax") == 0)
    delta = F.lit(0.05) + c("l_tax") * 10
    return t.lineitem.select(
        *_contract(), week_of("l_shipdate").alias("snapshot_date"), F.when(~six, px).alias("open"), F.when(~six, px + 1).alias("high"),
        F.when(~six, px - 1).alias("low"), F.when(~six, px).alias("close"), (c("l_partkey") % 1000).alias("volume"),
        (c("l_partkey") % 500).alias("open_interest"), F.when(empty, 0.0).otherwise(px).alias("bid"),
        F.when(empty, 0.0).otherwise(px + c("l_discount")).alias("ask"), F.when(c("l_linestatus") == "O", delta).otherwise(-delta).alias("delta"),
        c("l_tax").alias("gamma"), (-c("l_discount")).alias("theta"), (c("l_tax") * 2).alias("vega"), F.lit(0.01).alias("rho"),
        (c("l_discount") * 5).alias("implied_vol"), F.when(c("l_suppkey") % 50 != 0, 25.0).alias("underlying_price"),
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("seq"))


@role("trades", f"""SELECT {_CONTRACT_SQL}, {_WEEK} AS trade_date, l_extendedprice / 1000 AS price, CAST(l_quantity AS BIGINT) AS size,
    CASE WHEN l_tax <= 0.02 THEN 'buy' WHEN l_discount <= 0.03 THEN 'sell' ELSE 'mid' END AS aggressor_side,
    l_extendedprice / 1000 * CAST(l_quantity AS BIGINT) * 100 AS notional FROM lineitem""")
def trades(t: Tables) -> DataFrame:
    price, size = F.col("l_extendedprice") / 1000, F.col("l_quantity").cast("long")
    side = F.when(F.col("l_tax") <= 0.02, "buy").when(F.col("l_discount") <= 0.03, "sell").otherwise("mid")
    return t.lineitem.select(*_contract(), week_of("l_shipdate").alias("trade_date"), price.alias("price"), size.alias("size"),
                             side.alias("aggressor_side"), (price * size * 100).alias("notional"))


# ---- statements and filings -------------------------------------------------------

_LINE_ITEMS = {  # column: (SQL over revenue v, orders n, customer k)
    "gross_profit": "CASE WHEN n % 3 <> 0 THEN v * 0.4 END", "operating_income": "v * 0.2", "net_income": "v * 0.1 - 5000",
    "diluted_eps": "(v * 0.1 - 5000) / 10000", "research_and_dev": "CASE WHEN n > 1 THEN v * 0.05 END", "total_liabilities": "v * 0.5",
    "total_equity": "v * 0.3 - 20000", "operating_cash_flow": "v * 0.15", "investing_cash_flow": "v * -0.05",
    "stock_based_compensation": "v * 0.02", "weighted_avg_shares_basic": "CAST(1000 + k AS DOUBLE)",
    "weighted_avg_shares_diluted": "CAST(1010 + k AS DOUBLE)", "shares_outstanding": "CASE WHEN k % 3 <> 0 THEN CAST(900 + k AS DOUBLE) END",
    "shares_authorized": "CAST(5000 + k AS DOUBLE)", "antidilutive_shares": "CASE WHEN k % 7 = 0 THEN 1.0e9 ELSE 50.0e0 END",
    "options_outstanding": "CAST(k % 100 AS DOUBLE)", "warrants_outstanding": "CAST(NULL AS DOUBLE)", "unvested_rsu_shares": "5.0e0",
    "buyback_shares": "CAST(n AS DOUBLE)", "shares_issued_options": "CASE WHEN n > 1 THEN 2.0e0 END", "shares_issued_rsu_vested": "CAST(NULL AS DOUBLE)",
    "shares_from_conversion": "1.0e0",
}
_ITEMS_SQL = ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in _LINE_ITEMS.items())
_FIN_BASE = """SELECT o_custkey AS k, {p} AS fiscal_period, year(o_orderdate) AS y, {e} AS period_end, CAST(round(sum(o_totalprice), 2) AS DOUBLE) AS v,
    count(*) AS n FROM orders {w} GROUP BY ALL"""


@role("financials", f"""SELECT CAST(k AS VARCHAR) AS ticker, period_end, CAST(y AS VARCHAR) AS fiscal_year, fiscal_period, v AS revenue, {_ITEMS_SQL} FROM (
    {_FIN_BASE.format(p="'Q' || quarter(o_orderdate)", e="last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH)", w="WHERE o_orderpriority = '1-URGENT'")}
    UNION ALL {_FIN_BASE.format(p="'FY'", e="make_date(year(o_orderdate), 12, 31)", w="")})""")
def financials(t: Tables) -> DataFrame:
    o, day = t.orders, F.to_date("o_orderdate")
    sums = [F.round(F.sum("o_totalprice"), 2).alias("v"), F.count(F.lit(1)).alias("n")]
    q = o.filter(F.col("o_orderpriority") == "1-URGENT").groupBy(
        F.col("o_custkey").alias("k"), F.concat(F.lit("Q"), F.quarter(day).cast("string")).alias("fiscal_period"), F.year(day).alias("y"),
        F.last_day(F.add_months(F.trunc(day, "quarter"), 2)).alias("period_end")).agg(*sums)
    fy = o.groupBy(F.col("o_custkey").alias("k"), F.lit("FY").alias("fiscal_period"), F.year(day).alias("y"),
                   F.make_date(F.year(day), F.lit(12), F.lit(31)).alias("period_end")).agg(*sums)
    d = q.unionByName(fy)
    return d.select(F.col("k").cast("string").alias("ticker"), "period_end", F.col("y").cast("string").alias("fiscal_year"), "fiscal_period",
                    F.col("v").alias("revenue"), *[F.expr(e).cast("double").alias(c) for c, e in _LINE_ITEMS.items()])


@role("prices", """SELECT CAST(o_custkey AS VARCHAR) AS ticker, arg_max(o_totalprice, o_orderkey) / 611.7::DOUBLE AS close FROM orders GROUP BY 1""")
def prices(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.col("o_custkey").cast("string").alias("ticker")).agg((F.max_by("o_totalprice", "o_orderkey") / 611.7).alias("close"))


@role("insider", """SELECT CAST(o_custkey % 200 AS VARCHAR) AS ticker, 'C' || o_custkey AS reporter_name,
    CASE o_orderstatus WHEN 'P' THEN 'P' WHEN 'F' THEN 'S' ELSE 'A' END AS transaction_code, o_orderpriority = '5-LOW' AS is_derivative,
    CAST(o_orderkey % 1000 AS DOUBLE) AS shares, o_totalprice AS value, CAST(o_orderdate AS DATE) AS report_date,
    CAST(o_orderdate AS DATE) + 2 AS filed_date, o_orderkey AS seq FROM orders""")
def insider(t: Tables) -> DataFrame:
    day, s = F.to_date("o_orderdate"), F.col("o_orderstatus")
    return t.orders.select(
        (F.col("o_custkey") % 200).cast("string").alias("ticker"), F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("reporter_name"),
        F.when(s == "P", "P").when(s == "F", "S").otherwise("A").alias("transaction_code"), (F.col("o_orderpriority") == "5-LOW").alias("is_derivative"),
        (F.col("o_orderkey") % 1000).cast("double").alias("shares"), F.col("o_totalprice").alias("value"), day.alias("report_date"),
        F.date_add(day, 2).alias("filed_date"), F.col("o_orderkey").alias("seq"))


_FORM_SQL = "CASE o_orderkey % {n} {w} END"


@role("filings", f"""SELECT CAST(o_custkey % 200 AS VARCHAR) AS ticker, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik,
    lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-24-000001' AS accession_number,
    {_FORM_SQL.format(n=len(FORMS), w=" ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(FORMS)))} AS form_type,
    CAST(o_orderdate AS DATE) AS filed_date, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) - 1 END AS report_date,
    CASE o_orderkey % 5 WHEN 0 THEN '2.02, 9.01' WHEN 1 THEN '5.02' WHEN 2 THEN '7.77,8.01,' ELSE NULL END AS items, o_orderkey AS seq FROM orders""")
def filings(t: Tables) -> DataFrame:
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    form = F.element_at(F.array(*[F.lit(f) for f in FORMS]), (k % len(FORMS) + 1).cast("int"))
    return t.orders.select(
        (F.col("o_custkey") % 200).cast("string").alias("ticker"), F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("cik"),
        F.concat(F.lpad(k.cast("string"), 10, "0"), F.lit("-24-000001")).alias("accession_number"), form.alias("form_type"), day.alias("filed_date"),
        F.when(k % 4 != 0, F.date_sub(day, 1)).alias("report_date"),
        F.when(k % 5 == 0, "2.02, 9.01").when(k % 5 == 1, "5.02").when(k % 5 == 2, "7.77,8.01,").alias("items"), k.alias("seq"))


@role("holders", """SELECT CAST(o_custkey % 50 AS VARCHAR) AS ticker, 'H' || o_custkey AS holder_name, CAST(o_orderdate AS DATE) AS filed_date,
    CAST(o_orderkey AS DOUBLE) AS shares_held, o_totalprice / 100000 AS class_percent FROM orders""")
def holders(t: Tables) -> DataFrame:
    return t.orders.select(
        (F.col("o_custkey") % 50).cast("string").alias("ticker"), F.concat(F.lit("H"), F.col("o_custkey").cast("string")).alias("holder_name"),
        F.to_date("o_orderdate").alias("filed_date"), F.col("o_orderkey").cast("double").alias("shares_held"), (F.col("o_totalprice") / 100000).alias("class_percent"))


# ---- economic series --------------------------------------------------------------

YIELD_SERIES = {"1-URGENT": "DGS1", "2-HIGH": "DGS2", "3-MEDIUM": "DGS5", "4-NOT SPECIFIED": "DGS10", "5-LOW": "DGS30"}
_YIELD_COLS = {"1-URGENT": "yield_1_year", "2-HIGH": "yield_2_year", "3-MEDIUM": "yield_5_year", "4-NOT SPECIFIED": "yield_10_year", "5-LOW": "yield_30_year"}


@role("yields", "SELECT CAST(o_orderdate AS DATE) AS date, " + ", ".join(
    f"max(CASE WHEN o_orderpriority = '{p}' THEN o_totalprice / 100000 END) AS {c}" for p, c in _YIELD_COLS.items()) + " FROM orders GROUP BY 1")
def yields(t: Tables) -> DataFrame:
    p, v = F.col("o_orderpriority"), F.col("o_totalprice") / 100000
    return t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(*[F.max(F.when(p == k, v)).alias(c) for k, c in _YIELD_COLS.items()])


@role("monthly", """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, CAST(100 + count(*) % 50 AS DOUBLE) AS cpi,
    max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) / 100000 AS unemployment_rate, max(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END) / 200000 AS model_1_year,
    min(o_totalprice) / 10000 AS market_10_year, CASE WHEN month(min(o_orderdate)) % 4 = 0 THEN NULL ELSE count(*) / 100.0e0 END AS sahm_rule FROM orders GROUP BY 1""")
def monthly(t: Tables) -> DataFrame:
    s, v = F.col("o_orderstatus"), F.col("o_totalprice")
    return t.orders.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("date")).agg(
        (100 + F.count(F.lit(1)) % 50).cast("double").alias("cpi"), (F.max(F.when(s == "F", v)) / 100000).alias("unemployment_rate"),
        (F.max(F.when(s == "P", v)) / 200000).alias("model_1_year"), (F.min(v) / 10000).alias("market_10_year"),
        F.when(F.month(F.min("o_orderdate")) % 4 != 0, F.count(F.lit(1)) / 100).alias("sahm_rule"))


# Weekly dates leave the seventh day outside a five-day tolerance; ten-day dates leave
# half of the days outside.  The size condition leaves gaps in single columns.
_GAPPY = "max(CASE WHEN l_linenumber = {i} AND l_quantity > {q} THEN l_extendedprice END) / 10000 AS {c}"
_RATES = {1: "tips_10y", 2: "hy_oas", 3: "commercial_paper_3m", 4: "tbill_3m"}


@role("rates", f"SELECT {_WEEK} AS date, " + ", ".join(_GAPPY.format(i=i, q=48, c=c) for i, c in _RATES.items()) + " FROM lineitem GROUP BY 1")
def rates(t: Tables) -> DataFrame:
    n, v = F.col("l_linenumber"), F.col("l_extendedprice")
    return t.lineitem.groupBy(week_of("l_shipdate").alias("date")).agg(
        *[(F.max(F.when((n == i) & (F.col("l_quantity") > 48), v)) / 10000).alias(c) for i, c in _RATES.items()])


_TEN_DAYS = "CAST(date_trunc('month', l_shipdate) AS DATE) + CAST(least((day(l_shipdate) - 1) // 10, 2) * 10 AS INTEGER)"


@role("macro_daily", f"SELECT {_TEN_DAYS} AS date, {_GAPPY.format(i=1, q=47, c='yield_curve_10y2y')}, {_GAPPY.format(i=2, q=47, c='yield_curve_10y3m')}, "
      "min(l_extendedprice) / 50 AS vix FROM lineitem GROUP BY 1")
def macro_daily(t: Tables) -> DataFrame:
    n, v, day = F.col("l_linenumber"), F.col("l_extendedprice"), F.to_date("l_shipdate")
    step = F.least(F.floor((F.dayofmonth(day) - 1) / 10), F.lit(2)).cast("int") * 10
    big = F.col("l_quantity") > 47
    return t.lineitem.groupBy(F.date_add(F.trunc(day, "month"), step).alias("date")).agg(
        (F.max(F.when((n == 1) & big, v)) / 10000).alias("yield_curve_10y2y"), (F.max(F.when((n == 2) & big, v)) / 10000).alias("yield_curve_10y3m"), (F.min(v) / 50).alias("vix"))


@role("macro_weekly", """SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS date, max(o_totalprice) / 100000 AS financial_stress,
    min(o_totalprice) / 100000 AS financial_conditions, CASE WHEN count(*) % 7 = 0 THEN NULL ELSE CAST(count(*) AS DOUBLE) END AS initial_claims FROM orders GROUP BY 1""")
def macro_weekly(t: Tables) -> DataFrame:
    v, n = F.col("o_totalprice"), F.count(F.lit(1))
    return t.orders.groupBy(week_of("o_orderdate").alias("date")).agg(
        (F.max(v) / 100000).alias("financial_stress"), (F.min(v) / 100000).alias("financial_conditions"), F.when(n % 7 != 0, n.cast("double")).alias("initial_claims"))


# ---- commodities ------------------------------------------------------------------

_SYMBOL_SQL = "CASE o_orderkey % {n} {w} END".format(n=len(SYMBOLS), w=" ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SYMBOLS)))
_NAME_SQL = "CASE o_orderkey % {n} {w} END".format(n=len(SYMBOLS), w=" ".join(f"WHEN {i} THEN '{FUTURES[s]}'" for i, s in enumerate(SYMBOLS)))


@role("futures", f"""SELECT {_SYMBOL_SQL} AS ticker, {_NAME_SQL} AS name, CAST(date_trunc('week', o_orderdate) AS DATE) AS date,
    arg_min(o_totalprice, o_orderkey) / 611.7::DOUBLE AS open, max(o_totalprice) / 611.7::DOUBLE AS high, min(o_totalprice) / 611.7::DOUBLE AS low,
    arg_max(o_totalprice, o_orderkey) / 611.7::DOUBLE AS close, CAST(sum(o_orderkey % 100) AS BIGINT) AS volume FROM orders GROUP BY 1, 2, 3""")
def futures(t: Tables) -> DataFrame:
    at = (F.col("o_orderkey") % len(SYMBOLS) + 1).cast("int")
    v, k = F.col("o_totalprice"), F.col("o_orderkey")
    g = t.orders.groupBy(at.alias("_s"), week_of("o_orderdate").alias("date")).agg(
        (F.min_by(v, k) / 611.7).alias("open"), (F.max(v) / 611.7).alias("high"), (F.min(v) / 611.7).alias("low"), (F.max_by(v, k) / 611.7).alias("close"),
        F.sum(k % 100).alias("volume"))
    name = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), F.col("_s"))
    return g.select(name(SYMBOLS).alias("ticker"), name([FUTURES[s] for s in SYMBOLS]).alias("name"), "date", "open", "high", "low", "close", "volume")


F_ASOF = "(SELECT max(CAST(date_trunc('week', o_orderdate) AS DATE)) FROM orders)"


def f_asof(t: Tables) -> Column:
    return newest(t.orders, week_of("o_orderdate"))


_ENERGY = {"click": "wti_crude", "view": "brent_crude", "purchase": "natural_gas", "signup": "gasoline", "error": "heating_oil"}


@role("energy", "SELECT CAST(ts AS DATE) AS date, " + ", ".join(
    f"max(CASE WHEN event_type = '{e}' AND day(ts) % {3 + i} <> 0 THEN value END) AS {c}" for i, (e, c) in enumerate(_ENERGY.items())) + " FROM events GROUP BY 1")
def energy(t: Tables) -> DataFrame:
    e, d = F.col("event_type"), F.dayofmonth("ts")
    return t.events.groupBy(F.to_date("ts").alias("date")).agg(
        *[F.max(F.when((e == k) & (d % (3 + i) != 0), F.col("value"))).alias(c) for i, (k, c) in enumerate(_ENERGY.items())])


@role("petro_weekly", """SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS date, sum(l_quantity) AS crude_production,
    sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS crude_imports, sum(CASE WHEN l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS crude_exports,
    sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0 END) * 10 AS crude_stocks, CAST(count(*) AS DOUBLE) AS spr_stocks,
    sum(CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0 END) / 7 AS product_supplied FROM lineitem GROUP BY 1""")
def petro_weekly(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    part = lambda cond: F.sum(F.when(cond, q).otherwise(0.0))
    flag = lambda f: part(F.col("l_returnflag") == f)
    return t.lineitem.groupBy(week_of("l_shipdate").alias("date")).agg(
        F.sum(q).alias("crude_production"), flag("R").alias("crude_imports"), flag("A").alias("crude_exports"), (flag("N") * 10).alias("crude_stocks"),
        F.count(F.lit(1)).cast("double").alias("spr_stocks"), (part(F.col("l_linenumber") == 1) / 7).alias("product_supplied"))


_PRODUCERS = {1: "saudi_production", 2: "iran_production", 3: "iraq_production", 4: "uae_production", 5: "us_production", 6: "russia_production", 7: "imports_persian_gulf"}


@role("petro_monthly", "SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, sum(l_quantity) AS opec_production, "
      + ", ".join(f"sum(CASE WHEN l_linenumber = {i} THEN l_quantity ELSE 0 END) AS {c}" for i, c in _PRODUCERS.items())
      + ", sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS imports_total FROM lineitem GROUP BY 1")
def petro_monthly(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    part = lambda cond: F.sum(F.when(cond, q).otherwise(0.0))
    return t.lineitem.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("date")).agg(
        F.sum(q).alias("opec_production"), *[part(F.col("l_linenumber") == i).alias(c) for i, c in _PRODUCERS.items()],
        part(F.col("l_returnflag") == "R").alias("imports_total"))

