"""Row-frame and range-frame statistics on ordered series.

``split`` (see :mod:`finlake.operators.series`) is for series longer than day grain.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import names, pct_change, positive_log, safe_corr, safe_div
from finlake.operators.dedup import top_k_per
from finlake.operators.ranks import trailing_rank
from finlake.operators.series import Split, mean_over_range, over_rows


def simple_return(df: DataFrame, key, time: str, price: str = "close", prev: str = "prev_close",
                  out: str = "return_pct", seq=None, split: Split | None = None) -> DataFrame:
    """Previous price and percent change; the first row of a key has neither."""
    d = over_rows(df, key, time, lambda w: {prev: F.lag(price).over(w)}, 1, seq, split)
    return d.withColumn(out, pct_change(price, prev))


def log_return(df: DataFrame, key, time: str, price: str = "close", out: str = "ret", seq=None,
               split: Split | None = None) -> DataFrame:
    def build(w):
        return {out: positive_log(price) - positive_log(F.lag(price).over(w))}
    return over_rows(df, key, time, build, 1, seq, split)


def change(df: DataFrame, key, time: str, column: str, n: int = 1, out: str | None = None,
           split: Split | None = None) -> DataFrame:
    """Difference to the value ``n`` rows earlier."""
    name = out or f"{column}_change_{n}"
    return over_rows(df, key, time, lambda w: {name: F.col(column) - F.lag(column, n).over(w)}, n, None, split)


def newest_two(df: DataFrame, key, time: str, value: str, seq: str | None = None) -> DataFrame:
    """Newest row per key next to the second newest value (NULL when there is none).

    The two rows are picked with a group limit (two rows per map task and key leave the
    shuffle) and folded by one aggregate; no self join.
    """
    order = [F.col(time).desc()] + ([F.col(seq).desc()] if seq else [])
    two = top_k_per(df, key, order, 2, rank="_rn")
    before = F.lead(value).over(W.partitionBy(*names(key)).orderBy("_rn"))
    others = [c for c in df.columns if c not in names(key)]
    return two.withColumn(f"prev_{value}", before).filter(F.col("_rn") == 1).select(*names(key), *others, f"prev_{value}")


def rolling_mean(df: DataFrame, key, time: str, column: str, n: int, include_current: bool = False,
                 out: str = "rolling_mean", seq=None, split: Split | None = None) -> DataFrame:
    lo, hi = (-(n - 1), 0) if include_current else (-n, -1)
    return over_rows(df, key, time, lambda w: {out: F.avg(column).over(w.rowsBetween(lo, hi))}, n, seq, split)


def rolling_vol(df: DataFrame, key, time: str, ret: str, n: int, annual: int = 252, full: bool = False,
                out: str = "vol", split: Split | None = None) -> DataFrame:
    """Annualised population deviation of the last ``n`` rows; ``full`` wants ``n`` values."""
    def build(w):
        f = w.rowsBetween(-(n - 1), 0)
        v = F.stddev_pop(ret).over(f) * math.sqrt(annual)
        return {out: F.when(F.count(ret).over(f) >= n, v) if full else v}
    return over_rows(df, key, time, build, n, None, split)


def rolling_corr(df: DataFrame, key, time: str, x: str, y: str, n: int, min_rows: int = 2,
                 out: str = "correlation", split: Split | None = None) -> DataFrame:
    def build(w):
        f = w.rowsBetween(-(n - 1), 0)
        pairs = F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).over(f)
        return {out: F.when(pairs >= min_rows, safe_corr(x, y, f))}
    return over_rows(df, key, time, build, n, None, split)


def range_mean(df: DataFrame, key, ts: str, column: str, seconds: int = 3600, out: str = "range_mean") -> DataFrame:
    """Mean over the trailing time range, the row itself included; rows without a time are left out."""
    return mean_over_range(df, key, ts, seconds, column, out)


def percentile_rank(df: DataFrame, key, day: str, column: str, days: int = 365, strict: bool = True,
                    min_rows: int = 1, out: str = "rank", split: bool = False) -> DataFrame:
    """Share of the trailing ``days`` with a value below (or at most) today's."""
    return trailing_rank(df, key, F.unix_date(day).cast("bigint"), column, days, strict, min_rows, out, split)


def tick_rank(df: DataFrame, key, ts: str, column: str, seconds: int = 3600, strict: bool = True,
              min_rows: int = 1, out: str = "rank", split: bool = True) -> DataFrame:
    """Share of the trailing ``seconds`` with a value below (or at most) the row's own."""
    return trailing_rank(df, key, F.unix_micros(F.col(ts).cast("timestamp")), column, seconds * 1_000_000, strict, min_rows, out, split)


def minmax_rank(df: DataFrame, key, time: str, column: str, n: int = 252, out: str = "minmax_rank",
                split: Split | None = None) -> DataFrame:
    """Position of the value between the lowest and highest of the last ``n`` rows."""
    def build(w):
        f = w.rowsBetween(-(n - 1), 0)
        lo, hi = F.min(column).over(f), F.max(column).over(f)
        return {out: safe_div(F.col(column) - lo, hi - lo)}
    return over_rows(df, key, time, build, n, None, split)


def newest_n(df: DataFrame, key, time: str, n: int, seq: str | None = None) -> DataFrame:
    order = [F.col(time).desc()] + ([F.col(seq).desc()] if seq else [])
    return top_k_per(df, key, order, n, rank="rn")


