"""Validation, audits and load planning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.functions.exprs import count_if, names, pct_of
from finlake.operators.dedup import latest_version

BAR_REQUIRED = ("ticker", "timestamp", "open", "high", "low", "close", "volume")
CHAIN_REQUIRED = ("delta", "gamma", "theta", "vega", "implied_vol", "bid", "ask")
CONTRACT = ("underlying", "expiration", "strike", "put_call")


def _all_present(cols: Sequence[str]) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return ok


def bar_sane() -> Column:
    return ((F.col("high") >= F.col("low")) & (F.col("high") >= F.col("open")) & (F.col("high") >= F.col("close"))
            & (F.col("low") <= F.col("open")) & (F.col("low") <= F.col("close")))


def validate_bars(df: DataFrame, keys: Sequence[str] = ("ticker", "timestamp"),
                  version: Sequence[str] = ("ingested_at",)) -> DataFrame:
    """Complete, ordered, non-negative bars; the last loaded row of each key."""
    good = df.filter(_all_present(BAR_REQUIRED) & bar_sane() & (F.col("volume") >= 0))
    return latest_version(good, list(keys), list(version))


def bar_report(df: DataFrame, keys: Sequence[str] = ("ticker", "timestamp")) -> DataFrame:
    """How many rows each validation step drops, as one row."""
    complete = _all_present(BAR_REQUIRED)
    sane = complete & bar_sane()
    kept = sane & (F.col("volume") >= 0)
    # Distinct keys are counted by grouping first: no task holds the key set.
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), count_if(complete).alias("complete"), count_if(sane).alias("sane"),
        count_if(kept).alias("kept"))
    return per_key.agg(
        F.sum("rows").alias("input_rows"), F.sum(F.col("rows") - F.col("complete")).alias("null_rows"),
        F.sum(F.col("complete") - F.col("sane")).alias("disordered_rows"),
        F.sum(F.col("sane") - F.col("kept")).alias("negative_volume_rows"),
        F.sum(F.greatest(F.col("kept") - 1, F.lit(0))).alias("duplicate_rows"),
        count_if(F.col("kept") > 0).alias("output_rows"))


def validate_chain(df: DataFrame, version: Sequence[str]) -> DataFrame:
    """Rows with all required greeks and quotes, one per contract."""
    return latest_version(df.filter(_all_present(CHAIN_REQUIRED)), list(CONTRACT), list(version))


def missing_keys(a: DataFrame, b: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct keys of ``a`` absent from ``b`` (NULL-safe, unlike NOT IN)."""
    return a.select(*names(on)).distinct().join(b.select(*names(on)), names(on), "left_anti")


def pending_dates(calendar: DataFrame, loaded: DataFrame, cutoff, symbol: str = "symbol", day: str = "day") -> DataFrame:
    """(symbol, day) pairs on or after the cutoff that are not loaded yet."""
    return calendar.filter(F.col(day) >= cutoff).join(loaded.select(symbol, day), [symbol, day], "left_anti")


def pending_months(grid: DataFrame, progress: DataFrame, newest) -> DataFrame:
    """(ticker, month) pairs without a recorded status, plus the newest month of every ticker.

    ok, empty and failed all count as done; the newest month is still growing.
    """
    d = grid.join(progress.select("ticker", "month", "status"), ["ticker", "month"], "left")
    return d.filter(F.col("status").isNull() | (F.col("month") == newest))


def month_grid(spark: SparkSession, as_of: str | Column, months: int) -> DataFrame:
    """First days of the last ``months`` months up to the month of ``as_of``."""
    last = F.trunc(F.lit(as_of).cast("date"), "month")
    return spark.range(1).select(F.explode(F.sequence(F.add_months(last, 1 - months), last, F.expr("interval 1 month"))).alias("month"))


def weekday_grid(spark: SparkSession, as_of: str | Column, days: int) -> DataFrame:
    """Monday-to-Friday dates of the last ``days`` calendar days up to ``as_of``."""
    last = F.lit(as_of).cast("date")
    d = spark.range(1).select(F.explode(F.sequence(F.date_sub(last, days), last)).alias("day"))
    return d.filter(F.weekday("day") < 5)


def audit_overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"), F.countDistinct("underlying").alias("underlyings"),
        F.countDistinct("snapshot_date").alias("trading_days"), F.min("snapshot_date").alias("earliest"),
        F.max("snapshot_date").alias("latest"), F.countDistinct("expiration").alias("expirations"),
        F.round(F.avg(F.datediff("expiration", "snapshot_date")), 1).alias("avg_dte"),
        count_if(F.col("put_call") == "call").alias("calls"), count_if(F.col("put_call") == "put").alias("puts"))


def audit_quality(df: DataFrame) -> DataFrame:
    zero_quote = (F.col("bid") == 0) & (F.col("ask") == 0)
    no_ohlc = F.col("open").isNull() & F.col("high").isNull() & F.col("low").isNull() & F.col("close").isNull()
    counts = {
        "zero_bid_ask": zero_quote, "zero_iv": F.col("implied_vol") == 0, "iv_above_500pct": F.col("implied_vol") > 5,
        "zero_greeks": (F.col("delta") == 0) & (F.col("gamma") == 0) & (F.col("theta") == 0), "null_ohlc": no_ohlc,
        "null_underlying_px": F.col("underlying_price").isNull(), "zero_volume": F.col("volume") == 0,
        "zero_oi": F.col("open_interest") == 0,
    }
    n = F.count(F.lit(1))
    return df.agg(
        *[count_if(cond).alias(c) for c, cond in counts.items()],
        F.round(pct_of(count_if(zero_quote), n), 2).alias("pct_zero_bid_ask"),
        F.round(pct_of(count_if(counts["zero_iv"]), n), 2).alias("pct_zero_iv"))


def audit_breakdown(df: DataFrame, by: Column, name: str, limit: int | None = None) -> DataFrame:
    """Rows, distinct days and expirations, date span, mean iv and days to expiry per group."""
    g = df.groupBy(by.alias(name)).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("underlying").alias("underlyings"),
        F.countDistinct("snapshot_date").alias("days"), F.min("snapshot_date").alias("earliest"),
        F.max("snapshot_date").alias("latest"), F.countDistinct("expiration").alias("expirations"),
        F.round(F.avg("implied_vol"), 4).alias("avg_iv"),
        F.round(F.avg(F.datediff("expiration", "snapshot_date")), 0).alias("avg_dte"))
    return g.orderBy(F.desc("rows"), name).limit(limit) if limit else g


def with_reasons(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reasons``: names of the rules a row breaks (a NULL test counts as broken)."""
    tests = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(r)) for r, ok in rules.items()]
    return df.withColumn("reasons", F.filter(F.array(*tests), lambda r: r.isNotNull()))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with their reasons and all original columns)."""
    d = with_reasons(df, rules)
    return d.filter(F.size("reasons") == 0).drop("reasons"), d.filter(F.size("reasons") > 0)


def quote_rules(q: str = "quote.") -> dict[str, Column]:
    """Required fields present; not crossed; last price inside (0, 10000].

    A zero bid, ask or last counts as "no value" and passes the sanity tests.
    """
    bid, ask, last = F.col(f"{q}bid"), F.col(f"{q}ask"), F.col(f"{q}last")
    return {
        "missing_field": bid.isNotNull() & ask.isNotNull() & last.isNotNull() & F.col("ticker").isNotNull(),
        "crossed": bid.isNull() | ask.isNull() | (bid == 0) | (ask == 0) | (bid < ask),
        "price_range": last.isNull() | (last == 0) | ((last > 0) & (last <= 10000)),
    }
