"""Newest-version and group-maximum selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import names


def top_k_per(df: DataFrame, by: str | Sequence[str], order: Sequence[Column], k: int = 1,
              rank: str | None = None) -> DataFrame:
    """First ``k`` rows of every group.

    ``row_number <= k`` lets Catalyst put a WindowGroupLimit below the shuffle, so each
    map task ships at most ``k`` rows per group however large the group is.
    """
    rn = rank or "_rn"
    out = df.withColumn(rn, F.row_number().over(W.partitionBy(*names(by)).orderBy(*order)))
    out = out.filter(F.col(rn) <= k)
    return out if rank else out.drop(rn)


def latest_version(df: DataFrame, keys: str | Sequence[str], version: str | Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest version (columns compared in order)."""
    return top_k_per(df, keys, [F.col(v).desc_nulls_last() for v in names(version)])


def at_group_max(df: DataFrame, keys: str | Sequence[str], time: str) -> DataFrame:
    """All rows whose ``time`` equals the maximum of their group (ties kept).

    ``rank = 1`` lets Catalyst cut older rows of a group in each map task before the
    shuffle (WindowGroupLimit), in one scan.
    """
    r = F.rank().over(W.partitionBy(*names(keys)).orderBy(F.col(time).desc()))
    return df.filter(F.col(time).isNotNull()).withColumn("_rank", r).filter(F.col("_rank") == 1).drop("_rank")


def merge_latest(existing: DataFrame, incoming: DataFrame, keys: str | Sequence[str],
                 version: str | Sequence[str]) -> DataFrame:
    """Union of old and new rows, newest version per key: loading twice changes nothing."""
    return latest_version(existing.unionByName(incoming), keys, version)


def dedup_periods(df: DataFrame, keys: Sequence[str] = ("cik", "period_end", "fiscal_period"),
                  form: str = "form_type", filed: str = "filed_date") -> DataFrame:
    """One statement per period: an original form beats an amendment, then latest filing."""
    original = ~F.col(form).contains("A")
    return top_k_per(df, list(keys), [original.desc(), F.col(filed).desc_nulls_last(), F.col(form).desc()])


def clamp_outlier(value: str | Column, base: Column, factor: float = 20.0) -> Column:
    """NULL when the value exceeds ``factor`` times its base (mis-scaled report)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v > F.coalesce(base, F.lit(1.0)) * factor, F.lit(None)).otherwise(v)
