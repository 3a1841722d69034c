"""Trading signals with given formulas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import bands, safe_div
from finlake.functions.lookups import VOLATILITY_REGIMES, VOLATILITY_SPIKE
from finlake.operators.dedup import top_k_per
from finlake.operators.events import momentum_slope


def oversold(daily: DataFrame, drop: float = -0.05, volume: tuple[float, float] = (1.5, 2.5)) -> DataFrame:
    """Five-row return below the drop on 1.5 to 2.5 times the mean volume of the 20 rows before."""
    w = W.partitionBy("ticker").orderBy("day")
    d = daily.withColumns({
        "ret_5d": safe_div(F.col("close"), F.lag("close", 5).over(w)) - 1,
        "vol_ratio": safe_div("volume", F.avg("volume").over(w.rowsBetween(-20, -1)))})
    flag = (F.col("ret_5d") < drop) & (F.col("vol_ratio") >= volume[0]) & (F.col("vol_ratio") < volume[1])
    return d.withColumn("oversold", F.coalesce(flag, F.lit(False)))


def otm_call_signal(flow: DataFrame, ratio: float = 2.0, floor: int = 5000) -> DataFrame:
    """Heavy out-of-the-money call buying on a chain's daily flow."""
    hit = (F.col("otm_call_vol") > F.col("atm_call_vol") * ratio) & (F.col("otm_call_vol") > floor)
    return flow.withColumns({"otm_ratio": safe_div("otm_call_vol", "atm_call_vol"), "otm_signal": hit})


def insider_cluster(insider: DataFrame, days: int = 30, boost: int = 20) -> DataFrame:
    """Open-market buys and their value over the trailing ``days``, per ticker and filing day.

    Trades are reduced to one row per ticker and day before the range window.
    """
    buys = insider.filter((F.col("transaction_code") == "P") & ~F.col("is_derivative"))
    d = buys.groupBy("ticker", "filed_date").agg(F.count(F.lit(1)).alias("buys"), F.sum("value").alias("buy_value"))
    w = W.partitionBy("ticker").orderBy(F.unix_date("filed_date")).rangeBetween(-(days - 1), 0)
    d = d.withColumns({"buys_window": F.sum("buys").over(w), "value_window": F.sum("buy_value").over(w)})
    return d.withColumn("boost", F.when(F.col("buys_window") > 0, boost).otherwise(0))


def sector_relative(daily: DataFrame, universe: DataFrame, rows: int = 5) -> DataFrame:
    """Own return minus the mean return of the sector that day."""
    w = W.partitionBy("ticker").orderBy("day")
    d = daily.select("ticker", "day", "close").withColumn("ret", safe_div("close", F.lag("close", rows).over(w)) - 1)
    d = d.filter(F.col("ret").isNotNull()).join(universe.select("ticker", "sector"), "ticker")
    mean = d.groupBy("sector", "day").agg(F.avg("ret").alias("sector_ret"))
    d = d.join(mean, ["sector", "day"])
    return d.withColumn("relative_ret", F.col("ret") - F.col("sector_ret"))


def regime(vol_index: str | Column) -> Column:
    c = F.col(vol_index) if isinstance(vol_index, str) else vol_index
    return bands(c, [(limit, name) for limit, name, _ in VOLATILITY_REGIMES], VOLATILITY_SPIKE[0])


def regime_size(vol_index: str) -> Column:
    """Largest position, in percent, allowed in the regime."""
    out = F.when(F.col(vol_index).isNull(), F.lit(None).cast("double"))
    for limit, _, size in VOLATILITY_REGIMES:
        out = out.when(F.col(vol_index) < limit, size)
    return out.otherwise(VOLATILITY_SPIKE[1])


def regime_bucket(df: DataFrame, vol_index: str) -> DataFrame:
    return df.withColumns({"regime": regime(vol_index), "position_pct": regime_size(vol_index)})


def composite(scores: DataFrame, weights: DataFrame, n: int, parts: tuple[str, ...], day: str = "day", tie: str = "ticker") -> DataFrame:
    """Regime-weighted sum of scores and the ``n`` best tickers of each day.

    ``scores`` has (day, ticker, regime, one column per part); ``weights`` one row per
    regime (a handful) with the same part columns.
    """
    w = weights.select("regime", *[F.col(p).alias(f"_w_{p}") for p in parts])
    d = scores.join(w, "regime")
    total = sum((F.coalesce(F.col(p), F.lit(0.0)) * F.col(f"_w_{p}") for p in parts), F.lit(0.0))
    d = d.withColumn("composite", total).drop(*[f"_w_{p}" for p in parts])
    return top_k_per(d, day, [F.desc("composite"), F.asc(tie)], n, rank="rank")


# ---- intraday session -------------------------------------------------------------

def exposure_levels(snapshots: DataFrame, by: tuple[str, ...] = ("underlying", "snapshot")) -> DataFrame:
    """Per snapshot: net exposure, call/put ratio, flip strike and wall strike.

    Exposure is open interest x gamma x 100 x spot, puts negative.  The flip strike is the
    first one, going up, where the running exposure turns from positive to not positive;
    the wall has the largest absolute exposure.
    """
    g = F.col("open_interest") * F.col("gamma") * 100 * F.col("underlying_price")
    call = F.col("put_call") == "call"
    s = snapshots.groupBy(*by, "strike").agg(
        F.sum(F.when(call, g).otherwise(-g)).alias("_net"), F.sum(F.when(call, g)).alias("_c"), F.sum(F.when(~call, g)).alias("_p"),
        F.max("underlying_price").alias("_spot"))
    w = W.partitionBy(*by).orderBy("strike")
    s = s.withColumn("_run", F.round(F.sum("_net").over(w.rowsBetween(W.unboundedPreceding, 0)), 6))
    flips = (F.lag("_run").over(w) > 0) & (F.col("_run") <= 0)
    s = s.withColumn("_flip", F.when(flips, F.col("strike")))
    out = s.groupBy(*by).agg(
        F.max("_spot").alias("spot"), F.sum("_net").alias("gex_net"), safe_div(F.sum("_c"), F.sum("_p")).alias("gex_imbalance"),
        F.min("_flip").alias("gex_flip_strike"), F.max(F.struct(F.round(F.abs("_net"), 6).alias("g"), "strike")).alias("_m"))
    return out.select(
        *by, "spot", "gex_net", "gex_imbalance", "gex_flip_strike", F.col("_m.strike").alias("wall_strike"),
        (safe_div(F.col("spot") - F.col("_m.strike"), "spot") * 100).alias("gamma_wall_distance"),
        (safe_div(F.col("spot") - F.col("gex_flip_strike"), "gex_flip_strike") * 100).alias("price_vs_gex_flip"))


def session_features(minute: DataFrame, iv: Column | None = None, ts: str = "timestamp", session_minutes: int = 390) -> DataFrame:
    """Running session features of minute bars: distance to the session vwap, share of the
    expected range used, five-minute slope and volume surge.

    Windows run inside one ticker and day, at most a day of minutes.
    """
    d = minute.withColumn("session", F.to_date(ts))
    w = W.partitionBy("ticker", "session").orderBy(ts)
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    vwap = safe_div(F.sum(F.col("close") * F.col("volume")).over(upto), F.sum("volume").over(upto))
    d = d.withColumns({
        "session_vwap": vwap, "_hi": F.max("high").over(upto), "_lo": F.min("low").over(upto), "_i": F.row_number().over(w),
        "volume_surge": safe_div("volume", F.avg("volume").over(w.rowsBetween(-20, -1)))})
    left = F.greatest(F.lit(session_minutes) - F.col("_i"), F.lit(0))
    move = F.col("close") * (iv if iv is not None else F.lit(0.2)) * F.sqrt(left / 252 / session_minutes)
    d = d.withColumns({
        "vwap_distance": safe_div(F.col("close") - F.col("session_vwap"), "session_vwap") * 100,
        "range_pct": safe_div(F.col("_hi") - F.col("_lo"), move) * 100})
    d = momentum_slope(d, ["ticker", "session"], ts, "close", 5, "momentum_5m")
    return d.drop("_hi", "_lo", "_i")

