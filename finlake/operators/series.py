"""Ordered series: window calculations and recurrences over (key, time).

A plain window or grouped-pandas call puts one key into one task.  That is fine at day
grain (a century is 25,000 rows) and wrong for ticks, where one key may hold a third of
all rows.  Passing ``split`` turns the same calculation into evenly sized tasks:

* rows are numbered per key in two steps (row number inside a time slot, plus the
  running count of earlier slots), so no task ever sees a whole key;
* the position is cut into chunks of ``split.rows`` rows, and the ``before`` last rows
  of a chunk are also sent to the next one, which makes row frames exact;
* a recurrence ``y = a*y_prev + b`` is scanned per chunk, the chunk ends are combined
  on a table with one row per chunk, and every row is corrected with its chunk's carry.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.functions.exprs import bucket, names


@dataclass(frozen=True)
class Split:
    """How to cut a long series: slot width for numbering, rows per task."""

    every: str = "1 hour"
    rows: int = 100_000


@dataclass(frozen=True)
class Recurrence:
    """``out = decay * out_prev + b`` from position ``first``, where ``out`` is ``b`` itself.

    ``b`` has a value in every row from ``first`` on; rows without one are left out before numbering.
    """

    b: str
    out: str
    decay: float
    first: int


Builder = Callable[[W], dict[str, Column]]


class OrderedSeries:
    """A frame ordered by (time, seq) inside each key, optionally cut into chunks."""

    def __init__(self, df: DataFrame, keys: str | Sequence[str] | None, time: str,
                 seq: str | Sequence[str] | None = None, split: Split | None = None, before: int = 0):
        self.keys, self.time, self.seq, self.split = names(keys), time, names(seq), split
        self.order = [time, *self.seq]
        self.columns = df.columns
        if split is None:
            w = W.partitionBy(*self.keys).orderBy(*self.order)
            self.df = df.withColumn("_pos", F.row_number().over(w) - 1)
            self.group = self.keys
        else:
            if before > split.rows:
                raise ValueError("split.rows must be at least the frame length")
            self.df = self._chunk(self._number(df), before)
            self.group = [*self.keys, "_chunk"]
        self.window = W.partitionBy(*self.group).orderBy("_pos")

    def _number(self, df: DataFrame) -> DataFrame:
        d = df.withColumn("_slot", bucket(self.time, self.split.every))
        slots = d.groupBy(*self.keys, "_slot").agg(F.count(F.lit(1)).alias("_n"))
        earlier = W.partitionBy(*self.keys).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
        slots = slots.select(*self.keys, "_slot", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
        in_slot = W.partitionBy(*self.keys, "_slot").orderBy(*self.order)
        d = d.withColumn("_rank", F.row_number().over(in_slot))
        d = d.join(slots, [*self.keys, "_slot"])
        return d.withColumn("_pos", F.col("_base") + F.col("_rank") - 1).drop("_slot", "_base", "_rank")

    def _chunk(self, d: DataFrame, before: int) -> DataFrame:
        n = self.split.rows
        d = d.withColumn("_home", F.floor(F.col("_pos") / n))
        if before == 0:
            return d.withColumn("_chunk", F.col("_home"))
        tail = F.col("_pos") % n >= n - before
        return d.withColumn("_chunk", F.explode(
            F.when(tail, F.array(F.col("_home"), F.col("_home") + 1)).otherwise(F.array(F.col("_home")))))

    def with_columns(self, build: Builder) -> OrderedSeries:
        """Add window columns; ``build`` receives the ordered window."""
        self.df = self.df.withColumns(build(self.window))
        return self

    def only_home(self) -> OrderedSeries:
        """Drop the rows borrowed from the previous chunk."""
        if self.split is not None:
            self.df = self.df.filter(F.col("_home") == F.col("_chunk"))
        return self

    def scan(self, states: Sequence[Recurrence]) -> OrderedSeries:
        """Add the solution of each recurrence as a column."""
        self.only_home()
        if self.split is None:
            self.df = _solve(self.df, self.group, states)
            return self
        n = self.split.rows
        if any(r.first >= n for r in states):
            raise ValueError("split.rows must exceed the seed position, so that seeds lie in the first chunk")
        # Value a chunk would end with if it started from zero, and what its start adds:
        # plain aggregates, so the rows are not scanned a second time.
        last = (F.col("_chunk") + 1) * n - 1
        ends = self.df.groupBy(*self.group).agg(*[
            F.sum(F.when(F.col("_pos") >= r.first, F.col(r.b)).otherwise(0.0) * F.pow(F.lit(r.decay), last - F.col("_pos"))).alias(f"_end_{r.out}")
            for r in states])
        carry = _carry(ends, self.keys, n, states)
        d = _solve(self.df, self.group, states).join(carry, self.group, "left")
        for r in states:
            reach = F.pow(F.lit(r.decay), F.col("_pos") - F.col("_chunk") * n + 1)
            d = d.withColumn(r.out, F.col(r.out) + F.when(F.col("_chunk") * n > r.first, reach * F.coalesce(f"_in_{r.out}", F.lit(0.0))).otherwise(0.0))
        self.df = d.drop(*[f"_in_{r.out}" for r in states])
        return self

    def done(self, *keep: str) -> DataFrame:
        """Input columns plus the added ones, helper columns removed."""
        self.only_home()
        return self.df.drop("_pos", "_home", "_chunk", *keep)


def _scan(values: np.ndarray, seed: int | None, decay: float) -> np.ndarray:
    """``y = decay*y_prev + b`` from zero, or from the value at index ``seed`` (nothing before it)."""
    out = np.full(len(values), np.nan)
    start = 0 if seed is None else seed
    b = values[start:]
    if not len(b):
        return out
    head = b[0] if seed is not None else 0.0
    tail = (b[1:] if seed is not None else b) / (1 - decay)
    y = pd.Series(np.concatenate(([head], tail))).ewm(alpha=1 - decay, adjust=False).mean().to_numpy()
    out[start:] = y if seed is not None else y[1:]
    return out


def _solve(df: DataFrame, group: Sequence[str], states: Sequence[Recurrence]) -> DataFrame:
    """Solve the recurrences inside each group, starting from zero or from the seed position."""
    states = list(states)
    schema = T.StructType(list(df.schema.fields) + [T.StructField(r.out, T.DoubleType()) for r in states])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_pos", kind="stable")
        at = int(pdf["_pos"].iloc[0])
        for r in states:
            seed = r.first - at if at <= r.first else None
            pdf[r.out] = _scan(pdf[r.b].to_numpy(dtype="float64"), seed, r.decay)
        return pdf

    return df.groupBy(*group).applyInPandas(run, schema)


def _carry(ends: DataFrame, keys: Sequence[str], rows: int, states: Sequence[Recurrence]) -> DataFrame:
    """(keys, chunk, value entering the chunk): one row per chunk, combined in order."""
    states = list(states)
    fields = [f for f in ends.schema.fields if f.name in (*keys, "_chunk")]
    schema = T.StructType(fields + [T.StructField(f"_in_{r.out}", T.DoubleType()) for r in states])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_chunk")
        out = pdf[[f.name for f in fields]].copy()
        for r in states:
            y, entering = 0.0, []
            for chunk, end in zip(pdf["_chunk"].tolist(), pdf[f"_end_{r.out}"].tolist()):
                entering.append(y)
                y = end + (r.decay ** rows * y if chunk * rows > r.first else 0.0)
            out[f"_in_{r.out}"] = entering
        return out

    return ends.groupBy(*keys).applyInPandas(run, schema)


def over_rows(df: DataFrame, keys: str | Sequence[str] | None, time: str, build: Builder, before: int,
              seq: str | Sequence[str] | None = None, split: Split | None = None) -> DataFrame:
    """Window columns whose frames reach at most ``before`` rows back."""
    if split is None:
        return df.withColumns(build(W.partitionBy(*names(keys)).orderBy(time, *names(seq))))
    return OrderedSeries(df, keys, time, seq, split, before).with_columns(build).done()


def mean_over_range(df: DataFrame, keys: str | Sequence[str] | None, time: str, reach_seconds: int, column: str, out: str) -> DataFrame:
    """``out``: mean of ``column`` over the trailing ``reach_seconds``, the row and those at its time included.

    A sliding range frame adds up all its rows anew for each row, which is quadratic in their density.  Here a key is cut into time
    slots as wide as the range: a frame is the head of the row's own slot and the tail of the slot before it.  Heads are running
    sums forwards; tails are running sums backwards, for which each row is also sent to the next slot, to the last moment that still
    sees it.  Nothing is subtracted, so large values, NaN and infinities leave no trace once they are out of range.
    Rows without a time are left out.
    """
    ks, reach = names(keys), reach_seconds * 1_000_000
    kind = df.select(F.avg(column)).schema[0].dataType
    value = F.col(column) if isinstance(kind, T.DecimalType) else F.col(column).cast("double")
    carried = [c for c in df.columns if c != out]
    d = df.select(*[F.col(k).alias(f"k{n}") for n, k in enumerate(ks)], F.unix_micros(F.col(time).cast("timestamp")).alias("us"), value.alias("x"), F.struct(*carried).alias("row"))
    d = d.filter("us IS NOT NULL").withColumn("home", F.floor(F.col("us") / reach))
    own = F.struct("home", "us", F.col("x").alias("head"), F.lit(None).cast(d.schema["x"].dataType).alias("tail"), "row")
    sent = F.struct((F.col("home") + 1).alias("home"), (F.col("us") + reach).alias("us"), F.lit(None).cast(d.schema["x"].dataType).alias("head"), F.col("x").alias("tail"), F.lit(None).cast(d.schema["row"].dataType).alias("row"))
    group = [*[f"k{n}" for n in range(len(ks))], "home"]
    d = d.select(*group[:-1], F.inline(F.array(own, sent)))
    until = lambda order: W.partitionBy(*group).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow)
    head, tail = until(F.col("us").asc()), until(F.col("us").desc())
    d = d.withColumns({"n": F.count("head").over(head) + F.count("tail").over(tail), "s": F.coalesce(F.sum("head").over(head), F.lit(0)) + F.coalesce(F.sum("tail").over(tail), F.lit(0))})
    mean = F.when(F.col("n") > 0, F.col("s") / F.col("n")).cast(kind)
    return d.filter("row IS NOT NULL").select("row.*", mean.alias(out))
