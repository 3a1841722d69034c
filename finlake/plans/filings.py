"""Filing, event, insider and holder marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import count_if, sum_if
from finlake.functions.lookups import FORM_FAMILIES
from finlake.operators.dedup import at_group_max


def filings_of_family(filings: DataFrame, family: str, form: str = "form_type") -> DataFrame:
    """Filings whose form belongs to a family; an entry ending in * is a prefix."""
    forms = FORM_FAMILIES[family]
    exact = [f for f in forms if not f.endswith("*")]
    test = F.col(form).isin(*exact) if exact else F.lit(False)
    for f in forms:
        if f.endswith("*"):
            test = test | F.col(form).startswith(f[:-1])
    return filings.filter(test)


def within_days(df: DataFrame, as_of: Column, days: int, day: str = "filed_date", ticker: str | None = None,
                limit: int | None = None, newest_by: str | None = None) -> DataFrame:
    """Rows of the last ``days`` (of a ticker); with a limit the newest ones."""
    d = df.filter((F.col(day) >= F.date_sub(as_of, days)) & (F.col(day) <= as_of))
    if ticker is not None:
        d = d.filter(F.col("ticker") == ticker)
    return d.orderBy(F.desc(newest_by or day)).limit(limit) if limit else d


def open_market(insider: DataFrame, derivative: bool = False) -> DataFrame:
    """Open-market purchases and sales."""
    d = insider.filter(F.col("transaction_code").isin("P", "S"))
    return d if derivative else d.filter(~F.col("is_derivative"))


def notable_buys(insider: DataFrame, as_of: Column, days: int = 14, floor: float = 50_000, limit: int | None = 20,
                 tie: tuple[str, ...] = ("ticker",)) -> DataFrame:
    d = insider.filter((F.col("filed_date") >= F.date_sub(as_of, days)) & (F.col("transaction_code") == "P")
                       & ~F.col("is_derivative") & (F.col("value") > floor))
    return d.orderBy(F.desc("value"), *tie).limit(limit) if limit else d


def insider_monthly(insider: DataFrame) -> DataFrame:
    """Open-market buys and sells per ticker and month; nothing counts as 0."""
    buy, sell = F.col("transaction_code") == "P", F.col("transaction_code") == "S"
    g = insider.filter(buy | sell).groupBy("ticker", F.trunc("report_date", "month").alias("month")).agg(
        count_if(buy).alias("buy_count"), count_if(sell).alias("sell_count"), sum_if("value", buy).alias("buy_value"),
        sum_if("value", sell).alias("sell_value"), sum_if("shares", buy).alias("buy_shares"), sum_if("shares", sell).alias("sell_shares"))
    return g.withColumn("net_value", F.col("buy_value") - F.col("sell_value"))


def latest_holders(holders: DataFrame, ticker: str | None = None, limit: int | None = None) -> DataFrame:
    """Latest filing of each holder in each ticker, largest position first."""
    d = holders if ticker is None else holders.filter(F.col("ticker") == ticker)
    d = at_group_max(d, ["ticker", "holder_name"], "filed_date")
    return d.orderBy(F.desc("shares_held"), "ticker", "holder_name").limit(limit) if limit else d
