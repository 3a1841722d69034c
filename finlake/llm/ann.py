"""Approximate nearest neighbours by multiprobe hashing with p-stable (normal) projections.

Each table cuts ``hashes`` random projections into slots of one width; the slots together are a vector's bucket.  A query
visits, in every table, its own bucket and then the neighbouring ones in the order of their estimated success: the
squared distances from the query's projections to the slot borders that a perturbation crosses, smallest sum first.
Buckets are dealt over parts of bounded size; in a part, distances of the queries to the vectors of the buckets that
they probe are taken block by block and the best of each query leave it.  The candidates of all parts and tables are
merged by query and ranked by their exact distances.

A bucket with more than ``part_rows`` vectors (copies of one, say) is cut by a hash of the id, and its probes go to every
cut; one with more than ``part_queries`` probes is cut likewise, and its vectors go to every cut.  Nothing is capped.

Queries whose buckets hold fewer than ``k`` candidates (outliers, small tables) go on through an exact way: all rows are
one bucket for them, cut as above, so these queries meet every vector and their neighbours are the true ones.

Slot widths are fitted on at most ``sample_rows`` vectors; every vector is indexed.  Recall depends on the data: on vectors
without any structure near neighbours are hardly nearer than the rest, and the probes cover much of the table.

Defined cases: vectors that are null, zero, of another length than most (the shorter of two as frequent), or hold null or non-finite components take no
part, neither as queries nor as candidates; a query's own row (its id) is no candidate, repeated rows of an id count once, with their smallest distance (of all rows of the query's id and the candidate's);
components may be of any finite size, and a distance beyond the doubles is infinite;
ties go to the smaller id; only a table of fewer candidates gives fewer rows; an empty table gives none.  Further columns may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from finlake.llm import common, mph
from finlake.session import stored


def perturbations(low: np.ndarray, high: np.ndarray, most: int) -> list[tuple[tuple[int, int], ...]]:
    """The first sets of (projection, step) by the sum of squared distances to the borders crossed; the empty set leads."""
    single = sorted([(float(x * x), k, -1) for k, x in enumerate(low)] + [(float(x * x), k, 1) for k, x in enumerate(high)])
    out, heap = [()], [(single[0][0], (0,))]
    while heap and len(out) < most:
        cost, chosen = heapq.heappop(heap)
        if len({single[k][1] for k in chosen}) == len(chosen):
            out.append(tuple(single[k][1:] for k in chosen))
        last = chosen[-1] + 1
        if last < len(single):
            heapq.heappush(heap, (cost + single[last][0], (*chosen, last)))
            heapq.heappush(heap, (cost + single[last][0] - single[last - 1][0], (*chosen[:-1], last)))
    return out


def bucket(slots: np.ndarray) -> np.ndarray:
    """One number for the slots (last axis) of a vector."""
    out = np.zeros(slots.shape[:-1], np.uint64)
    with np.errstate(over="ignore"):
        for k in range(slots.shape[-1]):
            out = mph.mix(out ^ slots[..., k].astype(np.int64).view(np.uint64), k)
    return out.view(np.int64)


def length(x: np.ndarray) -> np.ndarray:
    """Euclidean length of each row; powers of two keep its squares in the range of doubles and change no digit."""
    power = np.frexp(np.abs(x).max(1))[1]
    return np.ldexp(np.sqrt((np.ldexp(x, -power[:, None]) ** 2).sum(1)), power)


def nearest(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, allowed, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query number, id, distance) of each query's k nearest among the vectors that ``allowed(low, high)`` says it may see."""
    whole_q, whole_v = queries.astype(np.float64), vectors.astype(np.float64)
    scale = -int(np.frexp(max(np.abs(whole_q).max(initial=0), np.abs(whole_v).max(initial=0)))[1])  # so that no square overflows
    q, v = np.ldexp(whole_q, scale), np.ldexp(whole_v, scale)
    square, found = (v * v).sum(1), ([], [], [])
    for low in range(0, len(q), 64):
        part = q[low:low + 64]
        d = (part * part).sum(1)[:, None] + square - 2 * part @ v.T
        d[~allowed(low, low + len(part)) | (own[low:low + 64, None] == ids)] = np.inf
        for i in range(len(part)):
            have = np.isfinite(d[i])
            n = total = int(have.sum())
            if not n:
                continue
            n = min(k, n)
            while True:  # more if some are rows of one id
                edge = np.partition(d[i], n - 1)[n - 1]
                near = np.flatnonzero(d[i] <= edge + 1e-9 * (1 + abs(edge) + square.max()))  # all that rounding may have put behind
                if n == total or len(np.unique(ids[near])) >= k:
                    break
                n = min(4 * n, total)
            exact = length(whole_v[near] - whole_q[low + i])
            best = np.lexsort((ids[near], exact))
            _, first = np.unique(ids[near][best], return_index=True)
            best = best[np.sort(first)][:k]
            for out, x in zip(found, (np.full(len(best), low + i), ids[near][best], exact[best])):
                out.append(x)
    return tuple(np.concatenate(x) if x else np.zeros(0, t) for x, t in zip(found, (np.int64, np.int64, np.float64)))


def search(vectors: DataFrame, is_query: str, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = 8, hashes: int = 6, width: float = 2.0, probes: int = 32,
           part_rows: int = 20_000, part_queries: int = 5_000, sample_rows: int = 5_000, seed: int = 11) -> DataFrame:
    """(query_id, rank int from 1, id, score double): of each row with ``is_query`` (SQL) the k nearest other rows found."""
    kind = "float" if vectors.schema[vector_col].dataType.elementType.simpleString() == "float" else "double"  # floats travel as floats
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"), F.expr(is_query).alias("asks"))
    size = rows.filter("v IS NOT NULL").agg(F.mode(F.size("v"), True)).first()[0] or 1
    rows = rows.filter(f"id IS NOT NULL AND size(v) = {size} AND forall(v, x -> x IS NOT NULL AND abs(x) < CAST('infinity' AS DOUBLE)) AND exists(v, x -> x <> 0)")
    sample = np.array([r.v for r in rows.select("id", "v").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample_rows).collect()], np.float64).reshape(-1, size)
    draw = np.random.default_rng(seed)
    lines = draw.standard_normal((tables, size, hashes))
    peak = np.abs(sample).max(initial=0) or 1.0
    spread = np.array([(sample / peak @ a).std() * peak if len(sample) > 1 else 1.0 for a in lines])
    wide = np.where(spread > 0, spread, 1.0) * width
    shift = draw.random((tables, 1, hashes)) * wide[:, None, None]
    parts = max(1, -(-rows.count() // part_rows))

    def cut(v: np.ndarray) -> np.ndarray:
        return np.stack([(v @ lines[t] + shift[t]) / wide[t] for t in range(tables)])  # tables, rows, hashes

    def matrix(batch: pa.RecordBatch) -> np.ndarray:
        return np.asarray(batch.column(1).flatten(), np.float64).reshape(-1, size)

    def stored_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets = bucket(np.floor(cut(matrix(batch))).astype(np.int64))
            for t in range(tables):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(buckets[t]), batch.column(0), batch.column(1)], names=["t", "bucket", "id", "v"])

    def probed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                place = cut(matrix(part))
                slots = np.floor(place).astype(np.int64)
                for t in range(tables):
                    at, found = [], []
                    for i in range(part.num_rows):
                        inside = place[t, i] - slots[t, i]
                        for change in perturbations(inside, 1 - inside, probes):
                            s = slots[t, i].copy()
                            for d, step in change:
                                s[d] += step
                            at.append(i)
                            found.append(s)
                    take = pa.array(at)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), t, np.int32)), pa.array(bucket(np.array(found))), part.column(0).take(take), part.column(1).take(take)], names=["t", "bucket", "id", "v"])

    schema = f"t int, bucket bigint, id bigint, v array<{kind}>"
    base = rows.select("id", "v").mapInArrow(stored_rows, schema)
    asked = rows.filter("asks").select("id", "v").mapInArrow(probed_rows, schema)
    sizes = base.groupBy("t", "bucket").agg(F.count("*").alias("nb")).join(asked.groupBy("t", "bucket").agg(F.count("*").alias("nq")), ["t", "bucket"], "left").fillna(0)
    hot = sizes.filter(f"nb > {part_rows} OR nq > {part_queries}").select("t", "bucket", F.expr(f"CAST(ceil(nb / {part_rows}) AS INT)").alias("cuts_b"), F.expr(f"CAST(greatest(ceil(nq / {part_queries}), 1) AS INT)").alias("cuts_q"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        """The part of each row; a hot bucket's row goes to one cut of its own kind and to every cut of the other."""
        df = df.join(hot, ["t", "bucket"], "left").withColumns({"mine": F.expr(f"pmod(xxhash64(id), coalesce({own}, 1))"), "theirs": F.explode(F.expr(f"sequence(0, coalesce({other}, 1) - 1)"))})
        b, q = ("mine", "theirs") if own == "cuts_b" else ("theirs", "mine")
        return df.select(F.expr(f"t * {parts}L + pmod(xxhash64(t, bucket, CAST({b} AS BIGINT), CAST({q} AS BIGINT)), {parts})").alias("part"), F.expr(f"xxhash64(t, bucket, CAST({b} AS BIGINT), CAST({q} AS BIGINT))").alias("cell"), "id", "v")

    def ranked(left: pa.Table, right: pa.Table) -> pa.Table:
        common.trim()
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        own, ids, cells = left.column("id").to_numpy(), right.column("id").to_numpy(), right.column("cell").to_numpy()
        q, v = (np.asarray(x.column("v").combine_chunks().flatten()).reshape(-1, size) for x in (left, right))
        asks = np.concatenate([np.ascontiguousarray(x).view(np.uint8).reshape(len(own), -1) for x in (own, q)], 1)  # an id may have several vectors
        _, first, at = np.unique(asks.view(f"V{asks.shape[1]}").ravel(), return_index=True, return_inverse=True)
        query = own[first]
        kinds, kind = np.unique(cells, return_inverse=True)
        place = np.searchsorted(kinds, left.column("cell").to_numpy())
        hits = (place < len(kinds)) & (kinds[np.minimum(place, len(kinds) - 1)] == left.column("cell").to_numpy())
        sees = np.zeros((len(query), len(kinds)), bool)
        sees[at[hits], place[hits]] = True
        n, found, score = nearest(q[first], query, v, ids, lambda low, high: sees[low:high][:, kind], k)
        return pa.table({"query_id": pa.array(query[n]), "id": pa.array(found), "score": pa.array(score)})

    def best(near: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy("score", "id")
        return near.groupBy("query_id", "id").agg(F.min("score").alias("score")).withColumn("rank", F.row_number().over(order)).filter(f"rank <= {k}")

    def everywhere(df: DataFrame, mine: int, others: int, by_query: bool) -> DataFrame:
        """Rows in one cut of their own kind and in every cut of the other; a part is a pair of cuts."""
        df = df.withColumns({"mine": F.expr(f"pmod(xxhash64(id), {mine}L)"), "theirs": F.explode(F.expr(f"sequence(0L, {others - 1}L)"))})
        return df.select(F.expr(f"mine * {others}L + theirs" if by_query else f"theirs * {mine}L + mine").alias("part"), F.lit(0).cast("bigint").alias("cell"), F.col("id").alias("id"), F.col("v").alias("v"))  # names of their own: both sides come from one table

    result = "query_id bigint, id bigint, score double"
    near = dealt(asked, "cuts_q", "cuts_b").groupBy("part").cogroup(dealt(base, "cuts_b", "cuts_q").groupBy("part")).applyInArrow(ranked, result)
    found = stored(best(near))  # few rows: k for each query
    full = found.filter(f"rank = {k}").select(F.col("query_id").alias("id"))
    short = rows.filter("asks").select("id", "v").join(full, "id", "left_anti")
    if n_short := short.count():
        blocks = -(-n_short // part_queries)
        rest = everywhere(short, blocks, parts, True).groupBy("part").cogroup(everywhere(rows.select("id", "v"), parts, blocks, False).groupBy("part")).applyInArrow(ranked, result)
        found = found.join(full.withColumnRenamed("id", "query_id"), "query_id", "left_semi").unionByName(best(rest))
    return found.select("query_id", "rank", F.col("id").alias(id_col), "score")
