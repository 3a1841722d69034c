"""Statistics of pairs of series, as blocked products of masked matrices.

Series fall into blocks of ``SERIES`` and times into spans of ``SPAN`` times ``TIMES``, both by hash.  The values of one block of series
in one span travel as one matrix: a bit for each place and the values that are there.  For a pair of blocks six matrix products are
added up, ``TIMES`` rows after another: with M the mask of present values and X the values (0 where missing), M'M counts common times,
X'M and M'X are the sums over them, X'X the products, (X*X)'M and M'(X*X) the squares.  No row is made for a pair at a time.

Where all times fit into one span, blocks form tiles of as many blocks as ``CELLS`` values fill, whatever places are empty, and a task ends
the pairs of two tiles.  What is shuffled are the matrices, once for each tile that they meet.  Longer series have tiles of one block, and one
result for each pair and span is shuffled and merged.

Values are shifted by a mean of their series first, so that large values with small moves keep their digits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finlake.session import stored

#: Series of a block, times of a product, and products of a span (a matrix of 34 MB if all places have values).
SERIES, TIMES, SPAN = 512, 2048, 4
#: Values of a tile (134 MB with the bits of their places, a task has two tiles), and the tiles that are wanted at least, for parallel work.
CELLS, TILES = 1 << 24, 8
#: The sums of a pair: common times, x, y, x*y, x*x, y*y.
SUMS = 6


def wide(df: DataFrame, key: str, time: str, value: str, series: Sequence[str]) -> DataFrame:
    """One row per time, one column per listed series."""
    d = df.filter(F.col(key).isin(*series))
    return d.groupBy(time).agg(*[F.max(F.when(F.col(key) == s, F.col(value))).alias(f"s{i}")
                                 for i, s in enumerate(series)])


def _instant(df: DataFrame, time: str) -> Column:
    kind = df.schema[time].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(time)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(time).cast("timestamp"))
    return F.col(time).cast("bigint") if isinstance(kind, T.IntegralType) else F.xxhash64(time)


def _masked(series: int, times: pa.Buffer, bits: pa.Buffer, values: pa.Buffer) -> tuple[np.ndarray, ...]:
    """A matrix as times in order, places with a value, values less the mean of their series (0 where missing), and these means."""
    at = np.frombuffer(times, np.int64)
    there = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at) * series).astype(bool).reshape(len(at), series)
    x = np.zeros(there.shape)
    x[there] = np.frombuffer(values, np.float64)
    shift = x.sum(axis=0) / np.maximum(there.sum(axis=0), 1)
    return at, there, np.where(there, x - shift, 0.0), shift


def _factors(there: np.ndarray, x: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Masks, values and squares of ``TIMES`` rows after another."""
    return [(there[k:k + TIMES].astype(np.float64), x[k:k + TIMES], x[k:k + TIMES] ** 2) for k in range(0, len(x), TIMES)]


def _sums(one: list[tuple], other: list[tuple], shape: tuple[int, int]) -> np.ndarray:
    """The six sums of each column of one with each of the other over the rows where both have a value."""
    total, found = np.zeros((SUMS, *shape)), np.empty(shape)
    for (mx, x, xx), (my, y, yy) in zip(one, other):
        for s, (a, b) in zip(total, ((mx, my), (x, my), (mx, y), (x, y), (xx, my), (mx, yy))):
            s += np.matmul(a.T, b, out=found)
    return total


def _moved(s: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """Sums of values that are larger by dx and dy."""
    n, x, y, xy, xx, yy = s
    dx, dy = dx[:, None], dy[None, :]
    return np.stack([n, x + n * dx, y + n * dy, xy + dx * y + dy * x + n * dx * dy, xx + 2 * dx * x + n * dx * dx, yy + 2 * dy * y + n * dy * dy])


def pair_stats(df: DataFrame, key: str, time: str, value: str, series: Sequence[str] | None = None) -> DataFrame:
    """Common observations, covariance and correlation for each a < b; ``series`` limits the keys.

    Of several values of a series at one time the largest counts; NaN counts as missing.  A pair without a common time has no row,
    one without variance (below 1e-12 of the mean square) no correlation.  The plan is the same for any number of series.
    """
    d = df if series is None else df.filter(F.col(key).isin(*series))
    d = d.select(F.col(time).alias("at"), F.col(key).alias("s"), F.col(value).cast("double").alias("x"))
    t = _instant(d, "at").cast("bigint")
    d = d.filter(t.isNotNull() & F.expr("s IS NOT NULL AND x IS NOT NULL AND NOT isnan(x)")).groupBy("s", "at").agg(F.max("x").alias("x"))  # no exchange after a grouping by key and time
    d = stored(d.select(t.alias("t"), "s", "x"))
    *size, values = d.agg(F.approx_count_distinct("s"), F.approx_count_distinct("t"), F.count("x")).first()
    size = [int(n * 1.1) for n in size]
    blocks, spans = (max(1, -(-n // most)) for n, most in zip(size, (SERIES, TIMES * SPAN)))
    filled = values // blocks + SERIES * size[1] // 64 + 1  # of a block, its bits as values
    per = max(1, min(CELLS // filled, -(-blocks // TILES))) if spans == 1 else 1
    tiles = -(-blocks // per)
    kind = d.schema["s"].dataType.simpleString()

    def packed(table: pa.Table) -> pa.Table:
        at, row = np.unique(table.column("t").to_numpy(), return_inverse=True)
        coded = table.column("s").combine_chunks().dictionary_encode()
        x = table.column("x").to_numpy()
        order = np.argsort(x)  # of several values in a place the last, which is the largest, stays
        out = np.full((len(at), len(coded.dictionary)), np.nan)
        out[row[order], coded.indices.to_numpy()[order]] = x[order]
        names = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        there = ~np.isnan(out)
        return pa.table({"span": table.column("span")[:1], "sb": table.column("sb")[:1], "names": names, "times": pa.array([at.tobytes()], pa.binary()),
                         "bits": pa.array([np.packbits(there).tobytes()], pa.binary()), "values": pa.array([out[there].tobytes()], pa.binary())})

    dense = d.select(F.pmod(F.xxhash64("t"), F.lit(spans)).alias("span"), F.pmod(F.xxhash64("s"), F.lit(blocks)).alias("sb"), "t", "s", "x")
    dense = dense.groupBy("span", "sb").applyInArrow(packed, f"span bigint, sb bigint, names array<{kind}>, times binary, bits binary, values binary")
    stats = f"x {kind}, y {kind}, n bigint, covariance double, correlation double"
    result = f"low bigint, high bigint, xs array<{kind}>, ys array<{kind}>, sums binary, at_x binary, at_y binary"

    def block(table: pa.Table, k: int) -> tuple:
        names = table.column("names")[k].as_py()
        return names, *_masked(len(names), *(table.column(c)[k].as_buffer() for c in ("times", "bits", "values")))

    def product(one: tuple, other: tuple, of_x: list[tuple]) -> np.ndarray:
        """``of_x`` are the factors of the first block; the second's rows are laid beside its rows, so that they serve many pairs of blocks."""
        (_, at_x, there_x, x, _), (_, at_y, there_y, y, _) = one, other
        if one is other:
            of_y = of_x
        elif np.array_equal(at_x, at_y):
            of_y = _factors(there_y, y)
        else:
            at, i, j = np.intersect1d(at_x, at_y, assume_unique=True, return_indices=True)
            there_y, y = there_y[j], y[j]
            if 2 * len(at) < len(at_x):
                of_x, of_y = _factors(there_x[i], x[i]), _factors(there_y, y)
            else:
                there, beside = np.zeros((len(at_x), y.shape[1]), bool), np.zeros((len(at_x), y.shape[1]))
                there[i], beside[i] = there_y, y
                of_y = _factors(there, beside)
        return _sums(of_x, of_y, (x.shape[1], y.shape[1]))

    def finished(total: np.ndarray, names: list[list], one_block: bool, kept: pa.DataType) -> pa.Table:
        """A row for each pair with a common time."""
        use = total[0] > 0
        if one_block:
            use &= np.triu(np.ones(use.shape, bool), 1)
        i, j = np.nonzero(use)
        n, x, y, xy, xx, yy = (v[i, j] for v in total)
        cov = xy / n - x / n * (y / n)
        vx, vy = xx / n - (x / n) ** 2, yy / n - (y / n) ** 2
        some = (vx > 1e-12 * xx / n) & (vy > 1e-12 * yy / n)
        corr = np.divide(cov, np.sqrt(np.where(some, vx * vy, 1.0)))
        return pa.table({"x": pa.array(names[0], kept).take(pa.array(i)), "y": pa.array(names[1], kept).take(pa.array(j)), "n": pa.array(n.astype(np.int64)), "covariance": pa.array(cov), "correlation": pa.array(corr, mask=~some)})

    def pairs_of(table: pa.Table) -> Iterator[tuple]:
        """(low, high, first block, second block, sums) of each pair of blocks of two tiles."""
        low_tile, high_tile = (table.column(c)[0].as_py() for c in ("low", "high"))
        row = {b: k for k, b in enumerate(table.column("sb").to_pylist())}
        for low in sorted(b for b in row if b // per == low_tile):
            one = block(table, row[low])
            of_x = _factors(one[2], one[3])
            for high in sorted(b for b in row if b >= low and b // per == high_tile):
                other = one if low == high else block(table, row[high])
                yield low, high, one, other, product(one, other, of_x)

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        for low, high, one, other, total in pairs_of(table):
            yield from finished(total, [one[0], other[0]], low == high, table.schema.field("names").type.value_type).combine_chunks().to_batches()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        kept = table.schema.field("names").type
        for low, high, one, other, total in pairs_of(table):
            yield from pa.table({"low": pa.array([low]), "high": pa.array([high]), "xs": pa.array([one[0]], kept), "ys": pa.array([other[0]], kept), "sums": pa.array([total.tobytes()], pa.binary()),
                                 "at_x": pa.array([one[4].tobytes()], pa.binary()), "at_y": pa.array([other[4].tobytes()], pa.binary())}).to_batches()

    def merged(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        names = [sorted({n for r in rows for n in r[c]}) for c in ("xs", "ys")]
        place = [{n: k for k, n in enumerate(x)} for x in names]
        total, base = np.zeros((SUMS, len(names[0]), len(names[1]))), [np.full(len(x), np.nan) for x in names]
        for r in rows:
            at = [np.array([p[n] for n in r[c]], np.int64) for p, c in zip(place, ("xs", "ys"))]
            own = [np.frombuffer(r[c], np.float64) for c in ("at_x", "at_y")]
            for k in (0, 1):
                base[k][at[k]] = np.where(np.isnan(base[k][at[k]]), own[k], base[k][at[k]])
            s = np.frombuffer(r["sums"], np.float64).reshape(SUMS, len(at[0]), len(at[1]))
            total[np.ix_(range(SUMS), at[0], at[1])] += _moved(s, own[0] - base[0][at[0]], own[1] - base[1][at[1]])
        return finished(total, names, rows[0]["low"] == rows[0]["high"], table.schema.field("xs").type.value_type)

    tile = F.floor(F.col("sb") / per)
    met = dense.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tiles - 1).cast("bigint"))))
    met = met.select(F.least(tile, "other").alias("low"), F.greatest(tile, "other").alias("high"), *dense.columns)
    if spans == 1:
        met = met.repartition(2 * tiles * (tiles + 1), "low", "high", "span")  # a number of its own: small matrices are much work
        pairs = met.groupBy("low", "high", "span").applyInArrow(ended, stats)
    else:
        pairs = met.groupBy("low", "high", "span").applyInArrow(summed, result).groupBy("low", "high").applyInArrow(merged, stats)
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "n", "covariance", "correlation")


def corr_matrix(df: DataFrame, key: str, time: str, value: str, series: Sequence[str] | None = None) -> DataFrame:
    return pair_stats(df, key, time, value, series).select("a", "b", "correlation")
