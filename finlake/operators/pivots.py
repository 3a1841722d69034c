"""Long <-> wide reshaping and latest-value summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import latest, names


def series_to_wide(long: DataFrame, columns: Mapping[str, str], series: str = "series_id", day: str = "date",
                   value: str = "value", seq: str | None = None) -> DataFrame:
    """One row per date, one column per registered series (NULL where it has no value).

    One aggregate replaces a chain of full outer joins.  The last loaded value wins when
    a series reports a date twice and ``seq`` names the load order.
    """
    d = long.filter(F.col(series).isin(*columns) & F.col(value).isNotNull() & F.col(day).isNotNull())
    def pick(s):
        v = F.when(F.col(series) == s, F.col(value))
        return F.max_by(v, F.when(v.isNotNull(), F.col(seq))) if seq else F.max(v)
    return d.groupBy(day).agg(*[pick(s).alias(c) for s, c in columns.items()])


def parse_observations(raw: DataFrame, day: str = "date", value: str = "value") -> DataFrame:
    """Text dates and values -> DATE and DOUBLE; '.', bad numbers and bad dates are dropped.

    A ``YYYY-MM`` period means the first of the month.
    """
    p = F.trim(F.col(day))
    full = F.when(F.length(p) == 7, F.concat(p, F.lit("-01"))).otherwise(p)
    d = raw.withColumn(day, full.try_cast("date"))
    d = d.withColumn(value, F.col(value).try_cast("double"))
    return d.filter(F.col(day).isNotNull() & F.col(value).isNotNull())


def matrix_to_long(df: DataFrame, time: str, symbols: Mapping[str, str],
                   fields: Sequence[str] = ("Open", "High", "Low", "Close", "Volume")) -> DataFrame:
    """One column per ``Field|SYMBOL`` -> one row per (time, symbol) with its name.

    Rows without a close are dropped; other missing numbers become 0.
    """
    have = set(df.columns)
    rows = F.array(*[
        F.struct(F.lit(s).alias("ticker"), F.lit(name).alias("name"), *[
            (F.nanvl(F.col(f"`{f}|{s}`").cast("double"), F.lit(None).cast("double"))
             if f"{f}|{s}" in have else F.lit(None).cast("double")).alias(f.lower()) for f in fields])
        for s, name in symbols.items() if f"Close|{s}" in have])
    d = df.select(F.col(time), F.explode(rows).alias("_r")).select(time, "_r.*").filter(F.col("close").isNotNull())
    return d.fillna(0.0, [f.lower() for f in fields if f != "Close"])


def latest_non_null(df: DataFrame, cols: Sequence[str], time: str,
                    by: str | Sequence[str] | None = None) -> DataFrame:
    """Latest non-NULL value of each column, each from its own date, in one pass."""
    aggs = [latest(c, time).alias(c) for c in cols]
    return df.groupBy(*names(by)).agg(F.max(time).alias(time), *aggs)


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], name: str, value: str, keep_null: bool = False) -> DataFrame:
    """Wide row -> (name, value) rows, NULL values dropped unless ``keep_null``."""
    rows = F.array(*[F.struct(F.lit(label).alias(name), F.col(c).cast("double").alias(value))
                     for c, label in columns.items()])
    d = df.select(*ids, F.explode(rows).alias("_r")).select(*ids, f"_r.{name}", f"_r.{value}")
    return d if keep_null else d.filter(F.col(value).isNotNull())


def full_merge(frames: Sequence[DataFrame], on: str) -> DataFrame:
    """N-way full outer merge with key coalescing, as one union and one aggregate.

    Each frame has unique keys and its own value columns.
    """
    cols = [c for f in frames for c in f.columns if c != on]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.groupBy(on).agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
