"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets.  The sources, in the order of their names, have weights that repeat, and share a budget of words in proportion
to them.  A target stops at ``most`` times its source's size, and what is above goes to the others by weight, until none is
above: target = min(most * size, weight * level).  The level follows from prefix sums over the sources in the order in
which they stop.

Sampling.  Each document draws the exponential key -ln(u) / quality, u from a digest of its id, so reruns agree and a document of
twice the quality comes first twice as often.  A target of more than a source's size takes complete epochs first (every document once
for each); what remains is filled with documents by rising key, up to the document at which the prefix sum of the sizes meets the
budget.  That one is cut there, so a source misses its target by less than a word (``cut=False``: it is taken whole if that
comes nearer).

Scale.  No source is sorted.  A source of n documents has about sqrt(n) slices of sqrt(n) documents, by a rising function of the key; the
sizes of the slices are added up first, and only the one slice of each source in which the budget ends is put in order; slices
before it are taken whole, those behind it not at all.  Per-source figures are joined by broadcast only if their number is small, else by salted keys.

Defined cases: a null or empty text has size 0 and is never taken; a null source is a source of its own and the last; rows that repeat are
documents of their own, with equal keys, taken in the order of their sizes; rows without an id draw by their text; a null or non-positive quality counts as 1; a source without
words has target 0; an empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finlake.session import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Sources up to which their figures are broadcast, and the copies of each beyond.
BROADCAST_SOURCES, SALTS = 20_000, 64


def targets(sources: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size) with target double; one row for each source, which is all that the windows here see."""
    # sources are few against documents; their rows alone pass through a window without a key
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    s = sources.select("source", "source_size", w.alias("w")).withColumn("cap", most * F.col("source_size"))
    stops = Window.orderBy(F.col("cap") / F.col("w"), "w", F.col("source").asc_nulls_last())
    every = stops.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    # level at which all sources up to this one are at their caps, if it was the first that is not
    level = (share * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    s = s.select("source", "source_size", "w", "cap", level.alias("level"))
    # the first of them has the highest level of those that are not
    free = F.max(F.when(F.col("cap") > F.col("w") * F.col("level"), F.col("level"))).over(Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return s.select("source", "source_size", F.least("cap", F.coalesce(F.col("w") * free, "cap")).alias("target"))


def uniform(name: Column) -> Column:
    """A number in (0, 1) from a digest of the name."""
    return (F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("bigint") + 0.5) / float(1 << 48)


def _per_source(rows: DataFrame, figures: DataFrame, n_sources: int) -> DataFrame:
    """``rows`` with the figures of their source."""
    on = rows["source"].eqNullSafe(figures["source"])
    if n_sources <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(figures), on).drop(figures["source"])
    salted = figures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "key"), F.lit(SALTS)).cast("int"))
    return rows.join(salted, rows["source"].eqNullSafe(salted["source"]) & (rows["salt"] == salted["salt"])).drop(salted["source"]).drop("salt")


def mix(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, cut: bool = True) -> DataFrame:
    """(id, source, size, source_size, target, key, taken): how many words of each document the mix takes, repeats counted.

    ``quality`` has (id, quality) rows: the weights of documents; documents that it leaves out weigh 1, and of several rows the
    largest counts.
    """
    rows = docs.select(F.col(id_col).alias("id"), uniform(F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit(""))).alias("u"), F.col(source_col).alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"))
    if quality is not None:
        best = quality.groupBy(F.col(id_col).alias("id")).agg(F.max("quality").alias("quality"))
        rows = rows.join(best, "id", "left")
    else:
        rows = rows.withColumn("quality", F.lit(1.0))
    key = -F.log("u") / F.when(F.col("quality") > 0, F.col("quality")).otherwise(1.0)
    rows = stored(rows.select("id", "source", "size", key.alias("key")))

    shape = stored(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"), F.avg("key").alias("mean")))
    n_sources = shape.count()
    aims = targets(shape, weights, share, most).select(F.col("source").alias("of"), "target")
    figures = stored(shape.join(aims, F.col("source").eqNullSafe(F.col("of"))).drop("of"))
    # keys are about exponential with the source's mean, so 1 - exp(-key / mean) spreads them evenly over slices
    slices = F.ceil(F.sqrt("n"))
    of = F.least(F.floor((1 - F.exp(-F.col("key") / F.col("mean"))) * slices), slices - 1).cast("bigint")
    held = _per_source(rows, figures, n_sources).withColumn("slice", of)

    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    sums = held.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("target").alias("target"), F.first("source_size").alias("source_size"))
    ahead = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "slice", "words", epochs.alias("epochs"), F.floor(F.col("target") - epochs * F.col("source_size")).alias("budget"), F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("before"))
    # the slice in which the budget ends; none if nothing remains to take
    ends = sums.filter((F.col("before") <= F.col("budget")) & (F.col("budget") < F.col("before") + F.col("words"))).select("source", "slice", (F.col("budget") - F.col("before")).alias("left"))
    ends = stored(ends).select(F.col("source").alias("of"), F.col("slice").alias("last"), "left")
    figures = figures.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").select("source", "source_size", "target", "n", "mean", epochs.alias("epochs"), "last", "left")

    held = _per_source(rows, figures, n_sources).withColumn("slice", of)
    out = ["id", "source", "size", "source_size", "target", "key"]
    plain = held.filter("last IS NULL OR slice <> last").select(*out, "epochs", F.when(F.col("slice") < F.col("last"), F.col("size")).otherwise(0).alias("more"))
    order = Window.partitionBy("source", "slice").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    room = F.col("left") - F.sum("size").over(order) + F.col("size")
    part = F.greatest(F.lit(0), F.least("size", room)) if cut else F.when(2 * room >= F.col("size"), F.col("size")).otherwise(0)
    edge = held.filter("slice = last").select(*out, "epochs", part.alias("more"))
    taken = F.col("size") * F.col("epochs") + F.col("more")
    return plain.unionByName(edge).select(F.col("id").alias(id_col), *out[1:], taken.cast("bigint").alias("taken"))
