"""Connected components of a link table, as joins and groupings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.session import stored

#: Links that a task holds at a time.
BLOCK_LINKS = 1 << 20


def components(links: DataFrame, block: int = BLOCK_LINKS) -> DataFrame:
    """(node, component): the smallest node that each linked node (columns a, b, whole numbers) reaches.

    Links are first contracted in blocks of ``block``: each block becomes a forest of stars, which links the same nodes by
    fewer rows.  Then come alternating stars: every node tells its larger neighbours the smallest one it knows, then its smaller ones; both
    keep the components and shrink the paths, so few rounds are needed even for long chains.  Each round is a grouping
    for the smallest neighbour and a join with it for either star; its links are contracted where they are and stored.  No
    step makes the sum of the links' smaller ends larger, so a round that changes nothing is the end.  Nodes without links have no row.
    """
    edges = stored(links.select(F.least("a", "b").cast("bigint").alias("a"), F.greatest("a", "b").cast("bigint").alias("b")).filter("a < b"))
    edges = stored(_contracted(edges.repartition(-(-edges.count() // block) or 1), block))
    seen = _print(edges)
    while seen[0]:
        larger = _star(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), True)
        smaller = _star(larger.select(F.col("b").alias("a"), F.col("a").alias("b")), False).distinct()
        edges, before = stored(_contracted(smaller, block)), seen
        seen = _print(edges)
        if seen == before:  # nothing moved: every link joins a node and the smallest of its component
            break
    return edges.select(F.explode(F.array("a", "b")).alias("node"), F.col("a").alias("component")).distinct()


def _contracted(links: DataFrame, block: int) -> DataFrame:
    """Each block of the links of a task as (smallest node reached within the block, node)."""
    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= block:
                yield _forest(held)
                held, n = [], 0
        if n:
            yield _forest(held)

    return links.select("a", "b").mapInArrow(forests, "a bigint, b bigint")


def _forest(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    ends = [np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held]) for k in (0, 1)]
    node, at = np.unique(np.concatenate(ends), return_inverse=True)
    x, y = at[:len(ends[0])], at[len(ends[0]):]
    top = np.arange(len(node))
    while True:
        low, high = np.minimum(top[x], top[y]), np.maximum(top[x], top[y])
        if not (apart := low < high).any():
            break
        x, y, low, high = x[apart], y[apart], low[apart], high[apart]
        np.minimum.at(top, high, low)
        while (top[top] != top).any():
            top = top[top]
    below = top < np.arange(len(node))
    return pa.record_batch({"a": pa.array(node[top[below]], pa.int64()), "b": pa.array(node[below], pa.int64())})


def _star(links: DataFrame, to_larger: bool) -> DataFrame:
    """Links a - b seen from a: its neighbours (larger than a only, or all, and then a too) are linked to the smallest one, a counted in."""
    least = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = links.join(least, "a")
    out = met.filter("b > a").select(F.col("m").alias("a"), "b") if to_larger else met.select(F.col("m").alias("a"), F.explode(F.array("b", "a")).alias("b"))
    return out.filter("a < b")


def _print(links: DataFrame) -> tuple:
    """Rows and the sum of their hashes."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
