"""Exact quantiles of groups of any size: sketches narrow the range, only what is left is ordered.

A mergeable quantile sketch (KLL) of a group's values names two cuts between which a wanted rank lies but for a small chance.  The
next reading counts exactly what is at and below the cuts and sketches what is strictly between them, until no range has more
than ``rows`` distinct values; those are counted by value and ordered.  Since counts are exact, a sketch that missed only costs a
further reading: the rank is then looked for on the other side of the cut.  A value that fills much of a group ends up as a
cut and is found by its count.

A reading leaves a hot group as one sketch for each task, so no task ever sees a whole group; a range shrinks about
fortyfold each time, and a group of 10**12 values is done after five readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from finlake.functions.exprs import names
from finlake.session import stored

#: Size of a sketch, and twice the rank error that it keeps in 99 of 100 cases.
SKETCH, MARGIN = 1024, 0.009
#: Sketches are asked for this many quantiles; of them the nearest outside the margin are the cuts.
GRID = 500
#: Groups up to which their ranges are broadcast, and the copies of each range beyond.
BROADCAST_GROUPS, SALTS = 50_000, 32


def _with_ranges(d: DataFrame, ranges: DataFrame, ks: list[str], few: bool) -> DataFrame:
    """The values of each group next to each of its ranges."""
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in ks]
    ranges = ranges.withColumnsRenamed({k: f"_of_{k}" for k in ks})
    if few:
        return d.join(F.broadcast(ranges), on).drop(*[f"_of_{k}" for k in ks])
    salted = ranges.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return d.withColumn("_s", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int")).join(salted, [*on, F.col("_s") == F.col("_salt")]).drop("_s", "_salt", *[f"_of_{k}" for k in ks])


def group_quantiles(df: DataFrame, by: str | Sequence[str] | None, value: str, probs: dict[str, float], rows: int = 1_000_000) -> DataFrame:
    """Interpolated quantiles of each group: a column for each of ``probs`` (name -> share from 0 to 1).

    Missing values and NaN are left out; a group without values has no row.  ``rows`` bounds what one task orders.
    """
    ks = names(by)
    if not ks:
        return group_quantiles(df.select(F.lit(0).alias("_g"), value), "_g", value, probs, rows).drop("_g")
    d = df.select(*ks, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL AND NOT isnan(_v)").withColumn("_v", F.col("_v") + 0.0)
    inf = float("inf")
    total = stored(d.groupBy(*ks).agg(F.count(F.lit(1)).alias("_all")).filter("_all > 0"))
    size = total.agg(F.count(F.lit(1)), F.count(F.when(F.col("_all") > rows, 1))).first()
    few, large = size[0] <= BROADCAST_GROUPS, size[1]
    place = lambda p: (F.col("_all") - 1).cast("double") * p
    wanted = F.array(*[f(place(float(p))).cast("bigint") for p in probs.values() for f in (F.floor, F.ceil)])
    ranks = total.select(*ks, "_all", F.explode(F.array_distinct(wanted)).alias("_r"))

    def ordered(values: DataFrame) -> DataFrame:
        counts = values.groupBy(*ks, "_r", "_below", "_v").agg(F.count(F.lit(1)).alias("_n"))
        upto = F.col("_below") + F.sum("_n").over(W.partitionBy(*ks, "_r").orderBy("_v"))
        return counts.withColumn("_to", upto).filter("_r < _to AND _r >= _to - _n").select(*ks, "_r", "_v")

    # groups within the bound are ordered at once
    found = ordered(_with_ranges(d, ranks.filter(F.col("_all") <= rows).select(*ks, "_r", F.lit(0).alias("_below")), ks, few))
    ranges = ranks.filter(F.col("_all") > rows).select(*ks, "_r", F.lit(-inf).alias("_lo"), F.lit(inf).alias("_hi"), F.lit(-inf).alias("_past_lo"), F.lit(inf).alias("_past_hi"))
    while large:
        # values outside the outer range only have to be counted below it
        v, inside = F.col("_v"), (F.col("_v") > F.col("_lo")) & (F.col("_v") < F.col("_hi"))
        seen = _with_ranges(d, ranges, ks, few).groupBy(*ks, "_r", "_lo", "_hi", "_past_lo", "_past_hi").agg(
            F.count(F.when(v < F.col("_lo"), 1)).alias("_under"), F.count(F.when(v <= F.col("_lo"), 1)).alias("_below"), F.count(F.when(inside, 1)).alias("_n"),
            F.count(F.when(v == F.col("_hi"), 1)).alias("_top"), F.approx_count_distinct(F.when(inside, v)).alias("_kinds"), F.kll_sketch_agg_double(F.when(inside, v), SKETCH).alias("_sketch"))
        r = F.col("_r")
        end = F.col("_below") + F.col("_n")
        state = (F.when((r >= F.col("_under")) & (r < F.col("_below")), F.lit("low")).when((r >= end) & (r < end + F.col("_top")), F.lit("high")).when(r < F.col("_under"), F.lit("left"))
                 .when(r >= end, F.lit("right")).when(F.col("_kinds") <= rows, F.lit("order")).otherwise(F.lit("narrow")))
        at = F.when(F.col("_n") > 0, (r - F.col("_below") + 0.5) / F.col("_n"))
        cut = lambda step: F.element_at("_grid", F.greatest(F.lit(1), F.least(F.lit(GRID + 1), step.cast("int") + 1)))
        narrow = F.col("_state") == "narrow"
        seen = seen.withColumn("_state", state).withColumn("_grid", F.when(narrow, F.kll_sketch_get_quantile_double("_sketch", F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))))
        seen = seen.withColumns({"_cut_lo": F.when(at > MARGIN, cut(F.floor((at - MARGIN) * GRID))), "_cut_hi": F.when(at < 1 - MARGIN, cut(F.ceil((at + MARGIN) * GRID)))})
        seen = stored(seen.drop("_sketch", "_grid"))
        done = seen.filter("_state IN ('low', 'high')").select(*ks, "_r", F.when(F.col("_state") == "low", F.col("_lo")).otherwise(F.col("_hi")).alias("_v"))
        order = seen.filter("_state = 'order'")
        inner = _with_ranges(d, order.select(*ks, "_r", "_lo", "_hi", "_below"), ks, few).filter("_v > _lo AND _v < _hi")
        found = found.unionByName(done).unionByName(ordered(inner))
        left = seen.filter("_state IN ('left', 'right', 'narrow')")
        if left.isEmpty():
            break
        state = F.col("_state")
        # a missed cut: the rank lies between it and the range before
        lo = F.when(state == "left", F.col("_past_lo")).when(state == "right", F.col("_hi")).otherwise(F.coalesce("_cut_lo", "_lo"))
        hi = F.when(state == "left", F.col("_lo")).when(state == "right", F.col("_past_hi")).otherwise(F.coalesce("_cut_hi", "_hi"))
        past = [F.when(narrow, F.col(x)).otherwise(F.col(f"_past{x}")).alias(f"_past{x}") for x in ("_lo", "_hi")]
        ranges = left.select(*ks, "_r", lo.alias("_lo"), hi.alias("_hi"), *past)
    found = stored(found)
    values = F.map_from_entries(F.collect_list(F.struct("_r", "_v")))  # at most two ranks for each quantile
    out = _with_values(total, found.groupBy(*ks).agg(values.alias("_values")), ks)
    columns = []
    for name, p in probs.items():
        x, y = (F.element_at("_values", f(place(float(p))).cast("bigint")) for f in (F.floor, F.ceil))
        share = place(float(p)) - F.floor(place(float(p)))
        columns.append(F.when(x == y, x).otherwise(x + (y - x) * share).alias(name))
    return out.select(*ks, *columns)


def _with_values(total: DataFrame, found: DataFrame, ks: list[str]) -> DataFrame:
    found = found.withColumnsRenamed({k: f"_of_{k}" for k in ks})
    return total.join(found, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in ks]).drop(*[f"_of_{k}" for k in ks])
