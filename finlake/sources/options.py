"""Option payloads -> chain snapshots and classified trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.operators.joins import left_fill
from finlake.operators.quality import CONTRACT
from finlake.schemas import GREEK_COLUMNS
from finlake.sources.common import lenient_date, whole


def _contract() -> list[Column]:
    return [F.col("symbol").alias("underlying"), lenient_date("expiration").alias("expiration"),
            F.col("strike").cast("double").alias("strike"), F.lower("right").alias("put_call")]


def chain_from_greeks(df: DataFrame, snapshot_date: Column, source: str = "thetadata") -> DataFrame:
    """End-of-day greeks -> typed chain rows; integer columns default to 0."""
    return df.select(
        *_contract(), *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close")],
        whole("volume").alias("volume"), whole("count").alias("trade_count"),
        F.col("bid").cast("double").alias("bid"), F.col("ask").cast("double").alias("ask"),
        whole("bid_size").alias("bid_size"), whole("ask_size").alias("ask_size"),
        *[F.col(f"`{g}`").cast("double").alias(g) for g in GREEK_COLUMNS],
        F.col("implied_vol").cast("double").alias("implied_vol"), F.col("iv_error").cast("double").alias("iv_error"),
        F.col("underlying_price").cast("double").alias("underlying_price"),
        snapshot_date.cast("date").alias("snapshot_date"), F.lit(source).alias("source"))


def oi_from_ndjson(df: DataFrame) -> DataFrame:
    return df.select(*_contract(), whole("open_interest").alias("open_interest"))


def merge_chain_oi(chain: DataFrame, oi: DataFrame | None, extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Attach open interest by contract; contracts without it (or no feed at all) get 0."""
    if oi is None:
        return chain.withColumn("open_interest", F.lit(0).cast("long"))
    return left_fill(chain, oi, [*CONTRACT, *extra_keys], {"open_interest": 0})


def aggressor(price: str = "price", bid: str = "bid", ask: str = "ask") -> Column:
    """At or above the ask is a buy, at or below the bid a sell, anything else mid."""
    p = F.col(price)
    return F.when(p >= F.col(ask), "buy").when(p <= F.col(bid), "sell").otherwise("mid")


def trades_from_ndjson(df: DataFrame, source: str = "thetadata") -> DataFrame:
    """Trades with the quote at trade time; rows without a readable timestamp are dropped."""
    ts = F.try_to_timestamp(F.col("trade_timestamp"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS"))
    d = df.select(
        *_contract(), ts.alias("trade_timestamp"), whole("sequence").alias("sequence"),
        F.col("price").cast("double").alias("price"), whole("size").alias("size"),
        whole("exchange").alias("exchange"), whole("condition").alias("condition"),
        F.col("bid").cast("double").alias("bid"), F.col("ask").cast("double").alias("ask"),
        whole("bid_size").alias("bid_size"), whole("ask_size").alias("ask_size"))
    d = d.filter(F.col("trade_timestamp").isNotNull())
    return d.withColumns({
        "aggressor_side": aggressor(), "trade_date": F.to_date("trade_timestamp"),
        "notional": F.col("price") * F.col("size") * 100, "source": F.lit(source)})
