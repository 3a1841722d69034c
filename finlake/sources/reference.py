"""Corporate actions, ticker details and ticker/company-id mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import lookup
from finlake.functions.lookups import EXCHANGES
from finlake.sources.common import lenient_date


def dividends_from_json(df: DataFrame) -> DataFrame:
    dates = ("ex_dividend_date", "declaration_date", "record_date", "pay_date")
    return df.select(
        F.coalesce("ticker", F.lit("")).alias("ticker"), *[lenient_date(c).alias(c) for c in dates],
        F.coalesce("cash_amount", F.lit(0.0)).alias("cash_amount"),
        F.coalesce("currency", F.lit("USD")).alias("currency"),
        F.coalesce("frequency", F.lit(0)).cast("int").alias("frequency"),
        F.coalesce("dividend_type", F.lit("")).alias("dividend_type"))


def splits_from_json(df: DataFrame) -> DataFrame:
    return df.select(
        F.coalesce("ticker", F.lit("")).alias("ticker"), lenient_date("execution_date").alias("execution_date"),
        F.coalesce("split_from", F.lit(0.0)).alias("split_from"), F.coalesce("split_to", F.lit(0.0)).alias("split_to"))


def universe_from_details(df: DataFrame) -> DataFrame:
    """Nested ticker details -> flat universe row; an unknown exchange code is kept as is."""
    mic = F.coalesce("primary_exchange", F.lit(""))
    text = ("name", "type", "sic_code", "description", "homepage_url", "cik", "sic_description")
    return df.select(
        "ticker", *[F.coalesce(c, F.lit("")).alias(c) for c in text], mic.alias("mic_code"),
        F.coalesce(lookup(mic, EXCHANGES), mic).alias("exchange"),
        F.coalesce("market_cap", F.lit(0.0)).alias("market_cap"),
        F.coalesce("total_employees", F.lit(0)).cast("long").alias("total_employees"),
        F.coalesce(lenient_date("list_date"), F.lit("1970-01-01").cast("date")).alias("list_date"),
        F.coalesce("address.city", F.lit("")).alias("address_city"),
        F.coalesce("address.state", F.lit("")).alias("address_state"),
        F.coalesce("composite_figi", F.lit("")).alias("composite_figi"), F.lit(True).alias("active"))


def cik_map(df: DataFrame) -> DataFrame:
    """Bulk mapping rows -> upper-case ticker and ten-digit company id."""
    return df.select(F.upper("ticker").alias("ticker"), F.lpad(F.col("cik").cast("string"), 10, "0").alias("cik"),
                     F.coalesce("exchange", F.lit("")).alias("exchange"))


def attach_cik(df: DataFrame, mapping: DataFrame, ticker: str = "ticker") -> DataFrame:
    """Add the company id; tickers without one are dropped."""
    m = mapping.select(F.col("ticker").alias("_t"), "cik")
    return df.join(m, F.upper(F.col(ticker)) == F.col("_t")).drop("_t")
