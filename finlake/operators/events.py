"""Event studies, exact distributed medians, forward labels and walk-forward folds."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import names, safe_div
from finlake.operators.quantiles import group_quantiles
from finlake.operators.series import Split, over_rows
from finlake.session import materialise


def group_median(df: DataFrame, by: str | Sequence[str], value: str, out: str = "median", rows: int = 1_000_000) -> DataFrame:
    """Exact interpolated median of each group; no task sees a whole group or orders more than ``rows`` values."""
    return group_quantiles(df, by, value, {out: 0.5}, rows)


def event_study(df: DataFrame, bucket: Column, forward: str, name: str = "bucket") -> DataFrame:
    """Observations, mean, median (basis points) and win rate of a forward return per bucket.

    The (bucket, return) pairs are written once: the mean and the steps of the exact
    median read them several times.
    """
    d = materialise(df.select(bucket.alias(name), F.col(forward)).filter(F.col(name).isNotNull()))
    agg = d.groupBy(name).agg(
        F.count(F.lit(1)).alias("obs"), (F.avg(forward) * 10000).alias("avg_fwd_bps"),
        (safe_div(F.count(F.when(F.col(forward) > 0, 1)), F.count(F.lit(1))) * 100).alias("win_rate"))
    med = group_median(d, name, forward, "_median").withColumn("med_fwd_bps", F.col("_median") * 10000)
    return agg.join(med.drop("_median"), name, "left")


def forward_labels(df: DataFrame, key: str | Sequence[str] | None, day: str, price: str = "close",
                   horizons: Sequence[int] = (3, 5), expansion: float = 0.30, base: int = 20) -> DataFrame:
    """Labels from the rows after each row (day grain).

    ``vol_expansion_<h>d``: did realised volatility of the next ``h`` returns exceed the
    trailing ``base``-return volatility by more than ``expansion``; ``fwd_sign_5d``: sign
    of the return over the longest horizon.  NULL where the future or past is too short.
    """
    w = W.partitionBy(*names(key)).orderBy(day)
    d = df.withColumn("_ret", safe_div(F.col(price) - F.lag(price).over(w), F.lag(price).over(w)))
    past = w.rowsBetween(-(base - 1), 0)
    trail = F.when(F.count("_ret").over(past) >= base, F.stddev_pop("_ret").over(past) * math.sqrt(252))
    d = d.withColumn("_trail", trail)
    for h in horizons:
        nxt = w.rowsBetween(1, h)
        vol = F.when(F.count("_ret").over(nxt) >= h, F.stddev_pop("_ret").over(nxt) * math.sqrt(252))
        d = d.withColumn(f"vol_expansion_{h}d", (vol > F.col("_trail") * (1 + expansion)).cast("int"))
    far = max(horizons)
    ahead = F.lead(price, far).over(w)
    d = d.withColumn(f"fwd_sign_{far}d", F.signum(ahead - F.col(price)).cast("int"))
    return d.drop("_ret", "_trail")


def walk_forward(df: DataFrame, day: str, train: int = 60, test: int = 20, step: int = 20) -> DataFrame:
    """Assign each row to its walk-forward folds: (fold, part) with part 'train' or 'test'.

    Days are numbered on the distinct-day table (one row per day), then joined back; a day
    belongs to at most ``train / step + 1`` folds.
    """
    days = df.select(day).distinct().withColumn("_i", F.row_number().over(W.orderBy(day)) - 1)
    last = days.select(F.floor((F.max("_i") + 1 - train - test) / step)).scalar()
    lo = F.greatest(F.lit(0), F.ceil((F.col("_i") - (train + test) + 1) / step))
    hi = F.least(F.floor(F.col("_i") / step), last)
    folds = days.filter(lo <= hi).withColumn("fold", F.explode(F.sequence(lo, hi)))
    offset = F.col("_i") - F.col("fold") * step
    folds = folds.withColumn("part", F.when(offset < train, "train").otherwise("test"))
    return df.join(folds.drop("_i"), day)


def momentum_slope(df: DataFrame, key, time: str, price: str, n: int = 5, out: str = "slope",
                   split: Split | None = None) -> DataFrame:
    """Least-squares slope of the last ``n`` prices against their row number."""
    xs = list(range(n))
    mean_x = sum(xs) / n
    sxx = sum((x - mean_x) ** 2 for x in xs)

    def build(w):
        total = F.lit(0.0)
        for i in range(n):
            total = total + F.lit(xs[n - 1 - i] - mean_x) * F.lag(price, i).over(w)
        return {out: total / sxx}
    return over_rows(df, key, time, build, n, None, split)
