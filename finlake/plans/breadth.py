"""Breadth thrust: a breadth average rising from oversold to strong within ten days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import count_if, safe_div
from finlake.operators.indicators import ema
from finlake.operators.returns import simple_return

# Fixed values of the signal definition.
OVERSOLD, THRUST, WINDOW_DAYS, EMA_DAYS = 0.40, 0.615, 10, 10


def advance_decline(daily: DataFrame, universe: DataFrame | None = None, exchanges: Sequence[str] = ("NYSE", "NYSE American")) -> DataFrame:
    """Rising, falling and unchanged tickers per day and the share of risers among movers."""
    d = daily.filter(F.col("close") > 0).select("ticker", "day", "close")
    if universe is not None:
        d = d.join(universe.filter(F.col("exchange").isin(*exchanges)).select("ticker"), "ticker", "left_semi")
    d = simple_return(d, "ticker", "day").filter(F.col("prev_close").isNotNull())
    up, down = F.col("close") > F.col("prev_close"), F.col("close") < F.col("prev_close")
    g = d.groupBy("day").agg(count_if(up).alias("advancing"), count_if(down).alias("declining"),
                             count_if(~up & ~down).alias("unchanged"), F.count(F.lit(1)).alias("total"))
    return g.withColumn("breadth_ratio", safe_div("advancing", F.col("advancing") + F.col("declining")))


def thrust_signal(breadth: DataFrame) -> DataFrame:
    """Oversold / thrust state per day (one row per day, so a single ordered window is small).

    ``seg`` numbers the stretches that start with an oversold day; a thrust within ten
    rows of the oversold day fires once per stretch.  A day on which nothing moved has no
    ratio: it counts as a day and keeps the average of the day before.
    """
    average = ema(breadth.select("day", "breadth_ratio"), None, "day", "breadth_ratio", EMA_DAYS, seed="first", out="ema_10").select("day", "ema_10")
    w = W.orderBy("day")
    upto = w.rowsBetween(W.unboundedPreceding, 0)
    d = breadth.join(average, "day", "left").withColumn("ema_10", F.last("ema_10", ignorenulls=True).over(upto))
    d = d.withColumns({"oversold": F.coalesce(F.col("ema_10") < OVERSOLD, F.lit(False)), "thrust": F.coalesce(F.col("ema_10") > THRUST, F.lit(False)), "_i": F.row_number().over(w)})
    d = d.withColumns({"_seg": F.sum(F.col("oversold").cast("int")).over(upto),
                       "_o": F.last(F.when(F.col("oversold"), F.col("_i")), ignorenulls=True).over(upto)})
    d = d.withColumn("_d", F.col("_i") - F.col("_o"))
    d = d.withColumn("_hit", F.coalesce(F.col("thrust") & (F.col("_d") <= WINDOW_DAYS), F.lit(False)))
    before = W.partitionBy("_seg").orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    fired = F.coalesce(F.max("_hit").over(before), F.lit(False))
    d = d.withColumn("signal_active", F.col("_o").isNotNull() & ~fired & (F.col("_d") <= WINDOW_DAYS))
    d = d.withColumns({
        "signal_active": F.coalesce("signal_active", F.lit(False)),
        "days_in_window": F.when(F.coalesce("signal_active", F.lit(False)), F.col("_d")),
        "signal_fired": F.col("_hit") & F.coalesce("signal_active", F.lit(False))})
    return d.drop("_i", "_seg", "_o", "_d", "_hit")


def breadth_thrust(daily: DataFrame, universe: DataFrame | None = None, exchanges: Sequence[str] = ("NYSE", "NYSE American")) -> DataFrame:
    return thrust_signal(advance_decline(daily, universe, exchanges))


def thrust_status(signal: DataFrame, days: int = 15) -> DataFrame:
    """Last ``days`` rows with a status and the days left in an open window."""
    d = signal.orderBy(F.desc("day")).limit(days)
    status = (F.when(F.col("signal_fired"), "fired").when(F.col("oversold"), "oversold")
              .when(F.col("signal_active"), "active").when(F.col("thrust"), "thrust").otherwise("none"))
    return d.select("day", F.round("breadth_ratio", 4).alias("breadth_ratio"), F.round("ema_10", 4).alias("ema_10"), status.alias("status"),
                    F.when(F.col("signal_active"), WINDOW_DAYS - F.col("days_in_window")).alias("days_left"))
