"""Ranks of values within a trailing range, by counting in a tree over the values.

Every row asks how many values of its range lie below its own.  All questions of a task are answered together: values are
numbered in their order, and the numbers are gone through bit by bit from the highest, each level splitting the rows, in their
order, into those without and with the bit.  A question keeps the two ends of its range in that order; where its own bit
is set, what its range holds on the left counts as below.  A level is a few passes over arrays, so n rows take n log n steps and memory
for a handful of arrays, whatever the length of the ranges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.functions.exprs import names


def count_below(number: np.ndarray, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
    """For each question the numbers below ``than`` among number[low:high]; numbers are whole and not negative."""
    low, high, below = low.copy(), high.copy(), np.zeros(len(than), np.int64)
    top = int(max(number.max(initial=0), than.max(initial=0)))
    for bit in range(max(1, top.bit_length()) - 1, -1, -1):
        clear = (number >> bit) & 1 == 0
        before = np.concatenate([[0], np.cumsum(clear)])
        left, right = before[low], before[high]
        asks = (than >> bit) & 1 == 1
        below += np.where(asks, right - left, 0)
        low, high = np.where(asks, before[-1] + low - left, left), np.where(asks, before[-1] + high - right, right)
        number = np.concatenate([number[clear], number[~clear]])
    return below


def trailing_rank(df: DataFrame, key, at: Column, column: str, reach: int, strict: bool, min_rows: int, out: str, split: bool) -> DataFrame:
    """``df`` with the share of values in (at - reach .. at) that are below, or at most, the row's own.

    Rows at one time see each other.  Rows without a value count for nothing and have no rank, nor have rows without a time, and those
    with fewer than ``min_rows`` values in their range.  NaN is the largest value.  With ``split`` a key is cut into slots four times as
    wide as the range, and rows of a slot's last quarter are also sent to the next; without, a key is one task.
    """
    keys = names(key)
    df = df.drop(out)
    carried = df.columns
    width = 4 * reach if split else None
    slot = F.floor(F.col("at") / width) if split else F.lit(0).cast("bigint")
    d = df.select(F.struct("*").alias("row"), at.alias("at"), F.col(column).cast("double").alias("x"), *[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)])
    d = d.withColumn("home", slot)
    if split:
        late = F.pmod(F.col("at"), F.lit(width)) >= width - reach
        d = d.withColumn("slot", F.explode(F.when(late, F.array("home", F.col("home") + 1)).otherwise(F.array("home"))))
    else:
        d = d.withColumn("slot", F.col("home"))
    # a row that is only looked at leaves its other columns behind
    d = d.withColumn("row", F.when(F.col("home").isNull() | (F.col("slot") == F.col("home")), F.col("row")))

    def ranked(table: pa.Table) -> pa.Table:
        table = table.sort_by([("at", "ascending")])
        n = len(table) - table.column("at").null_count  # rows without a time come last
        when = table.column("at").slice(0, n).to_numpy()
        known = table.column("x").is_valid().to_numpy()[:n]
        x = table.column("x").slice(0, n).fill_null(0.0).to_numpy()[known]
        _, number = np.unique(x, return_inverse=True)
        held = np.concatenate([[0], np.cumsum(known)])
        low, high = held[np.searchsorted(when, when[known] - reach, side="left")], held[np.searchsorted(when, when[known], side="right")]
        below = count_below(number.astype(np.int64), low, high, number.astype(np.int64) + (0 if strict else 1))
        rank, there = np.zeros(len(table)), np.zeros(len(table), bool)
        rank[:n][known] = below / np.maximum(high - low, 1)
        there[:n][known] = high - low >= max(min_rows, 1)
        row = table.column("row").combine_chunks()
        mine = np.flatnonzero(row.is_valid().to_numpy(zero_copy_only=False))
        cols = dict(zip(carried, row.take(pa.array(mine)).flatten()))
        return pa.table(cols | {out: pa.array(rank[mine], mask=~there[mine])})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), f"`{out}` double"])
    return d.groupBy(*[f"k{n}" for n in range(len(keys))], "slot").applyInArrow(ranked, schema)
