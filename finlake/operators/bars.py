"""Price-bar roll-ups.

Every roll-up is one hash aggregate with map-side combine: a hot key or a hot bucket
leaves each map task as a single partial row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import bucket, names, order_key, pct_change, period_start, safe_div

GRAINS = {
    "1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "30m": "30 minutes", "1h": "1 hour",
    "2h": "2 hours", "4h": "4 hours", "1d": "1 day",
}
CALENDAR = {"1wk": "week", "1mo": "month", "1q": "quarter", "1yr": "year"}


def grain_start(ts: str | Column, grain: str) -> Column:
    """Bucket start for a grain name; day and longer grains give a DATE."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if grain == "1d":
        return F.to_date(c)
    if grain in CALENDAR:
        return period_start(c, CALENDAR[grain])
    return bucket(c, GRAINS[grain])


def bars_from_ticks(df: DataFrame, key: str | Sequence[str], ts: str, price: str, size: str, grain: str,
                    seq: str | None = None, out: str = "bucket") -> DataFrame:
    """Open, high, low, close, volume, volume-weighted price and count straight from trades."""
    order = order_key(ts, seq) if seq else F.col(ts)
    p, q = F.col(price), F.col(size)
    return df.groupBy(*names(key), grain_start(ts, grain).alias(out)).agg(
        F.min_by(p, order).alias("open"), F.max(p).alias("high"), F.min(p).alias("low"),
        F.max_by(p, order).alias("close"), F.sum(q).alias("volume"),
        safe_div(F.sum(p * q), F.sum(q)).alias("vwap"), F.count(F.lit(1)).alias("transactions"))


def ohlcv_bars(df: DataFrame, key: str | Sequence[str], ts: str, grain: str, seq: str | None = None,
               source: str | None = None, out: str = "bucket") -> DataFrame:
    """Coarser bars from finer ones; vwap weights only the rows that have one.

    ``source`` keeps the smallest source name.  A string cannot live in a hash-aggregate
    buffer, so it is made a grouping key first and reduced on the already small result.
    """
    ks = names(key)
    order = order_key(ts, seq) if seq else F.col(ts)
    has = F.col("vwap").isNotNull()
    aggs = [
        F.min_by("open", order).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", order).alias("close"), F.sum("volume").alias("volume"),
        F.sum(F.when(has, F.col("volume") * F.col("vwap"))).alias("_pv"),
        F.sum(F.when(has, F.col("volume"))).alias("_v"), F.sum("transactions").alias("transactions"),
    ]
    g = df.groupBy(*ks, grain_start(ts, grain).alias(out), *names(source)).agg(
        *aggs, *([F.min(order).alias("_first"), F.max(order).alias("_last")] if source else []))
    if source:
        g = g.groupBy(*ks, out).agg(
            F.min_by("open", "_first").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
            F.max_by("close", "_last").alias("close"), F.sum("volume").alias("volume"),
            F.sum("_pv").alias("_pv"), F.sum("_v").alias("_v"), F.sum("transactions").alias("transactions"),
            F.min(source).alias(source))
    return g.select(*ks, out, "open", "high", "low", "close", "volume", safe_div("_pv", "_v").alias("vwap"),
                    "transactions", *names(source))


def calendar_bars(df: DataFrame, key: str | Sequence[str], day: str, grain: str) -> DataFrame:
    """Weekly (Monday), monthly, quarterly or yearly bars from daily bars."""
    return df.groupBy(*names(key), period_start(day, CALENDAR[grain]).alias("period")).agg(
        F.min_by("open", day).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", day).alias("close"), F.sum("volume").alias("volume"))


def period_return(df: DataFrame, key: str | Sequence[str], day: str, price: str = "close",
                  start=None, end=None) -> DataFrame:
    """First and last price per key inside a date range, and the percent between them."""
    d = df
    if start is not None:
        d = d.filter(F.col(day) >= start)
    if end is not None:
        d = d.filter(F.col(day) <= end)
    d = d.groupBy(*names(key)).agg(F.min_by(price, day).alias("start_price"), F.max_by(price, day).alias("end_price"))
    return d.withColumn("return_pct", pct_change("end_price", "start_price"))


def weekly_returns(df: DataFrame, key: str | Sequence[str], day: str, price: str = "close") -> DataFrame:
    d = df.groupBy(*names(key), period_start(day, "week").alias("week")).agg(
        F.min_by(price, day).alias("week_open"), F.max_by(price, day).alias("week_close"))
    d = d.filter(F.col("week_open") > 0)
    return d.withColumn("return_pct", pct_change("week_close", "week_open"))
