"""As-of join with tolerance and last-observation fill."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import bucket, names, seconds
from finlake.operators.pivots import full_merge


def asof_join(left: DataFrame, right: DataFrame, left_time: str, right_time: str, tolerance_days: int,
              by: str | Sequence[str] | None = None, require: str | Sequence[str] | None = None,
              seq: str | None = None, slot_seconds: int | None = None) -> DataFrame:
    """Latest right row at or before each left row and at most ``tolerance_days`` older.

    Left columns are kept, right columns (except ``by``) are NULL without a match.
    ``require`` skips right rows where one of the columns is NULL; otherwise the latest
    row wins even if its values are NULL.

    Both sides are cut into time slots and unioned, so one shuffle on (by, slot) does the
    work and a hot key is spread over its slots.  Only the last right row of a slot can
    matter to later slots; those (one per slot) are copied into the slots within reach.
    The default slot is as wide as the tolerance, a year at most; choose a narrow one for
    tick data.
    """
    keys = names(by)
    width = slot_seconds or min(max(tolerance_days, 1), 366) * 86400
    copies = math.ceil(tolerance_days * 86400 / width)
    values = [c for c in right.columns if c not in keys]

    r = right.filter(F.col(right_time).isNotNull())
    for c in names(require):
        r = r.filter(F.col(c).isNotNull())
    tie = [F.col(seq)] if seq else []
    r = r.select(*keys, F.struct(*values).alias("_r"), seconds(right_time).alias("_t"),
                 F.unix_micros(F.col(right_time).cast("timestamp")).alias("_us"),
                 (tie[0] if tie else F.lit(0)).cast("long").alias("_tie"))
    r = r.withColumn("_slot", F.floor(F.col("_t") / width))

    ends = r.groupBy(*keys, "_slot").agg(F.max(F.struct("_us", "_tie", "_r")).alias("_m"))
    carried = ends.select(
        *keys, F.col("_m._r").alias("_r"), F.col("_m._us").alias("_us"), F.col("_m._tie").alias("_tie"),
        F.explode(F.sequence(F.col("_slot") + 1, F.col("_slot") + max(copies, 1))).alias("_slot"))

    lcols = left.columns
    lf = left.select(*keys, F.struct(*lcols).alias("_l"),
                     F.unix_micros(F.col(left_time).cast("timestamp")).alias("_us"),
                     F.floor(seconds(left_time) / width).alias("_slot"))
    both = (
        lf.withColumn("_side", F.lit(1)).withColumn("_tie", F.lit(0).cast("long"))
        .unionByName(r.drop("_t").withColumn("_side", F.lit(0)), allowMissingColumns=True)
        .unionByName(carried.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    )
    w = W.partitionBy(*keys, "_slot").orderBy("_us", "_side", "_tie").rowsBetween(W.unboundedPreceding, 0)
    both = both.withColumn("_m", F.last("_r", ignorenulls=True).over(w)).filter(F.col("_side") == 1)
    fresh = F.col(f"_m.{right_time}") >= F.date_sub(F.col(f"_l.{left_time}"), tolerance_days)
    if dict(left.dtypes)[left_time].startswith("timestamp"):
        fresh = F.col(f"_m.{right_time}") >= F.col(f"_l.{left_time}") - F.expr(f"interval {tolerance_days} days")
    clash = set(lcols)
    return both.select(
        *[F.col(f"_l.{c}").alias(c) for c in lcols],
        *[F.when(fresh, F.col(f"_m.{c}")).alias(c if c not in clash else f"right_{c}") for c in values])


def asof_timeline(calendar: DataFrame, sides: dict[str, tuple[DataFrame, str, int]], date: str = "date") -> DataFrame:
    """As-of join of a calendar with many day-grain tables at once.

    ``sides`` maps a name to (table, its date column, tolerance in days); each table has at
    most one row per date.  All tables are merged into one row per date by a single
    aggregate, and one ordered window carries the latest row of each forward.  The window
    sees one row per date, so its single partition stays small.  The result has one
    struct column per side, NULL where nothing is recent enough.
    """
    parts = [calendar.select(date).withColumn("_ask", F.lit(1))]
    for name, (df, time, _) in sides.items():
        parts.append(df.select(F.col(time).alias(date), F.struct(*df.columns).alias(name)))
    w = W.orderBy(date).rowsBetween(W.unboundedPreceding, 0)
    d = full_merge(parts, date)
    d = d.select(date, "_ask", *[F.last(n, ignorenulls=True).over(w).alias(n) for n in sides]).filter(F.col("_ask") == 1)
    return d.select(date, *[F.when(F.col(f"{n}.{time}") >= F.date_sub(date, days), F.col(n)).alias(n)
                            for n, (_, time, days) in sides.items()])


def ffill(df: DataFrame, keys: str | Sequence[str] | None, time: str, cols: str | Sequence[str],
          max_age_days: int | None = None, seq: str | Sequence[str] | None = None,
          slot: str | None = None) -> DataFrame:
    """Replace NULLs by the last earlier value, if not older than ``max_age_days``.

    With ``slot`` (for example ``'1 day'``) long keys are cut into time slots; the last
    value of each column per slot is carried forward on a table with one row per slot.
    """
    ks, cs = names(keys), names(cols)
    d = df.withColumns({f"_o_{c}": F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col(time).alias("t")))
                        for c in cs})
    group = ks
    if slot:
        group = [*ks, "_slot"]
        d = d.withColumn("_slot", bucket(time, slot))
        order = F.struct(time, *names(seq))
        ends = d.groupBy(*group).agg(
            *[F.max_by(f"_o_{c}", F.when(F.col(c).isNotNull(), order)).alias(f"_e_{c}") for c in cs])
        prior = W.partitionBy(*ks).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
        ends = ends.select(*group, *[F.last(f"_e_{c}", ignorenulls=True).over(prior).alias(f"_c_{c}") for c in cs])
        d = d.join(ends, group)
    w = W.partitionBy(*group).orderBy(time, *names(seq)).rowsBetween(W.unboundedPreceding, 0)
    for c in cs:
        seen = F.last(f"_o_{c}", ignorenulls=True).over(w)
        if slot:
            seen = F.coalesce(seen, F.col(f"_c_{c}"))
        d = d.withColumn(f"_f_{c}", seen)
    for c in cs:
        ok = F.lit(True)
        if max_age_days is not None:
            ok = F.datediff(F.col(time), F.col(f"_f_{c}.t")) <= max_age_days
        d = d.withColumn(c, F.when(ok, F.col(f"_f_{c}.v")))
    return d.select(*df.columns)
