"""Join shapes.  The physical join is left to Catalyst and AQE: a side is broadcast only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import names, safe_div


def join_dim(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner") -> DataFrame:
    return fact.join(dim, names(on), how)


def left_fill(left: DataFrame, right: DataFrame, on: str | Sequence[str], defaults: Mapping[str, object]) -> DataFrame:
    """Left join with default values for the unmatched right columns."""
    d = left.join(right, names(on), "left")
    return d.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def anti(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return left.join(right.select(*names(on)), names(on), "left_anti")


def scalar_max(df: DataFrame, column: str) -> Column:
    """Largest value of a column as a scalar subquery, usable in any filter or projection."""
    return df.select(F.max(column)).scalar()


def with_scalars(df: DataFrame, one_row: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach columns of a one-row result to every row.

    Each becomes a scalar subquery (computed once, inlined as a literal), so there is no
    cross join; more than one row is an error instead of a silent multiplication.
    """
    return df.withColumns({c: one_row.select(c).scalar() for c in columns})


def offset_join(df: DataFrame, key: str | Sequence[str], day: str, value: str, offsets: Mapping[str, int]) -> DataFrame:
    """Attach ``value`` of the same key exactly ``n`` calendar days away, for each (name, n).

    Rows without every offset day are dropped.  Day grain: one row per key and day.
    One scan: every row is sent to its own day and, as a lookup value, to the days that
    ask for it; one aggregate on (key, day) puts them together.
    """
    ks = names(key)
    own = [c for c in df.columns if c not in ks and c != day]

    def sent(to: Column, name: str | None) -> Column:
        carried = [(F.col(c) if name is None else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in own]
        looked = [(F.col(value).cast("double") if m == name else F.lit(None).cast("double")).alias(m) for m in offsets]
        return F.struct(to.alias(day), *carried, F.lit(1 if name is None else None).cast("int").alias("_here"), *looked)

    rows = F.array(sent(F.col(day), None), *[sent(F.date_sub(F.col(day), n), m) for m, n in offsets.items()])
    parts = df.select(*ks, F.explode(rows).alias("_s")).select(*ks, "_s.*")
    g = parts.groupBy(*ks, day).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in own], F.max("_here").alias("_here"),
        *[F.max(m).alias(m) for m in offsets])
    for m in ("_here", *offsets):
        g = g.filter(F.col(m).isNotNull())
    return g.drop("_here")


def month_mean(df: DataFrame, day: str, columns: Sequence[str], month: str = "month") -> DataFrame:
    """Monthly means; aggregating before the month join avoids day x day fan-out."""
    return df.groupBy(F.trunc(day, "month").alias(month)).agg(*[F.avg(c).alias(c) for c in columns])


def month_join(daily: DataFrame, monthly: DataFrame, day: str, month: str, how: str = "inner") -> DataFrame:
    """Daily rows next to the monthly row of their month."""
    d = daily.withColumn("_month", F.trunc(day, "month"))
    m = monthly.withColumnRenamed(month, "_month")
    return d.join(m, "_month", how).drop("_month")


def interpolate_at(df: DataFrame, by: str | Sequence[str], x: str, y: str, x0: float, out: str) -> DataFrame:
    """Linear interpolation of ``y`` at ``x0`` between the bracketing points of each group.

    Two conditional aggregates find the bracket; no join.
    """
    lo, hi = F.col(x) <= x0, F.col(x) >= x0
    pt = F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    g = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*names(by)).agg(
        F.max(F.when(lo, pt)).alias("_lo"),
        F.min(F.when(hi, pt)).alias("_hi"))
    w = safe_div(F.lit(x0) - F.col("_lo.x"), F.col("_hi.x") - F.col("_lo.x"))
    value = (F.when(F.col("_lo.x") == x0, F.col("_lo.y"))
             .otherwise(F.col("_lo.y") + w * (F.col("_hi.y") - F.col("_lo.y"))))
    return g.select(*names(by), value.alias(out))
