"""Principal components of every day, each fitted on the days before it, in one plan.

Dates are cut into chunks of ``days``; a chunk also borrows the rows of the days before it that its windows reach into,
so one exchange brings everything together.  Within a chunk the moments of every window are differences of two prefix
sums over its rows: how often two columns are both present, their sums where both are, and their products.  From those
come the covariances with missing values replaced by the window's means, and one batch of eigen-solves for all its days.
Memory is that of a chunk's prefix sums, (days + reach) * columns ** 2, and does not grow with the number of dates.

Columns are shifted and scaled by their chunk's moments before the sums, which components do not depend on, so
differences of prefix sums keep their digits.  A column that does not change within a window has weight 0; that is decided by
counting changes, not by a small variance.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.plans.features import feature_columns


def window_covariances(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means, deviations (1 for a column without any) and covariances of the standardised columns in rows low .. high - 1.

    ``x`` has NaN for missing values; these count as their column's mean in the window.
    """
    here = ~np.isnan(x)
    z, m = np.where(here, x, 0.0), here.astype(np.float64)

    def prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x) + 1, x.shape[1], x.shape[1]))
        np.cumsum(a[:, :, None] * b[:, None, :], axis=0, out=out[1:])
        return out

    def between(total: np.ndarray) -> np.ndarray:
        return total[high] - total[low]

    both, sums, products = (between(prefix(a, b)) for a, b in ((m, m), (z, m), (z, z)))
    each = np.maximum(np.einsum("tii->ti", both), 1.0)
    mean = np.einsum("tii->ti", sums) / each
    n = np.maximum(high - low, 1)[:, None, None]
    turned = sums.transpose(0, 2, 1)
    cov = (products - mean[:, :, None] * turned - mean[:, None, :] * sums + mean[:, :, None] * mean[:, None, :] * both) / n
    sd = np.sqrt(np.maximum(np.einsum("tii->ti", cov), 0.0))
    sd[_constant(x, here, low, high) | (sd == 0)] = 0.0
    scale = np.where(sd > 0, sd, 1.0)
    live = (sd > 0)[:, :, None] & (sd > 0)[:, None, :]
    return mean, scale, np.where(live, cov / scale[:, :, None] / scale[:, None, :], 0.0)


def _constant(x: np.ndarray, here: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Whether a column has one value at most in each window."""
    rows = np.arange(len(x))[:, None]
    last = np.maximum.accumulate(np.where(here, rows, -1), axis=0)
    before = np.vstack([np.full((1, x.shape[1]), -1), last[:-1]])
    changed = here & (before >= 0) & (x != np.take_along_axis(x, np.maximum(before, 0), axis=0))
    total = np.vstack([np.zeros((1, x.shape[1]), np.int64), np.cumsum(changed, axis=0)])
    first = np.minimum.accumulate(np.where(here, rows, len(x))[::-1], axis=0)[::-1]  # first value at or after each row
    first = np.vstack([first, np.full((1, x.shape[1]), len(x))])
    start = np.minimum(first[low] + 1, high[:, None])  # the window's first value changes against nothing in it
    return total[high] - np.take_along_axis(total, start, axis=0) <= 0


def components(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(loadings, eigenvalues) of the first ``k`` components of each matrix; the largest loading of each is positive."""
    values, vectors = np.linalg.eigh(cov)
    values, vectors = np.maximum(values[:, ::-1], 0.0), vectors[:, :, ::-1][:, :, :k]
    at = np.abs(vectors).argmax(axis=1)
    sign = np.where(np.take_along_axis(vectors, at[:, None, :], axis=1) < 0, -1.0, 1.0)
    return vectors * sign, values


def score_all_days(matrix: DataFrame, lookback: int = 252, k: int = 10, min_rows: int = 30, days: int = 512, cols: Sequence[str] | None = None) -> DataFrame:
    """``matrix`` with pc_1 .. pc_k of each of its dates, and explained: the share of the window's variance that they have.

    The fit of a date sees its own row and those of the ``lookback + 30`` calendar days before it, as in ``score_day``; with
    fewer than ``min_rows`` rows before it, and beyond the number of columns or rows, components are NULL.
    """
    cols = list(cols or feature_columns(matrix))
    reach = lookback + 30
    days = max(days, reach)
    named = [f"pc_{i + 1}" for i in range(k)]
    matrix = matrix.drop(*named, "explained")
    day, chunk = F.datediff("date", F.lit("1970-01-01").cast("date")), F.floor(F.datediff("date", F.lit("1970-01-01").cast("date")) / days)
    parts = matrix.select(F.struct("*").alias("row"), day.alias("day"), F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("x"), F.explode(F.array(chunk, chunk + 1)).alias("chunk"))
    own = F.floor(F.col("day") / days) == F.col("chunk")
    parts = parts.filter(own | (F.col("day") >= F.col("chunk") * days - reach)).withColumn("row", F.when(own, F.col("row")))
    carried = matrix.columns

    def scored(table: pa.Table) -> pa.Table:
        day = table.column("day").to_numpy()
        order = np.argsort(day, kind="stable")
        day, table = day[order], table.take(pa.array(order))
        x = table.column("x").combine_chunks().flatten().fill_null(float("nan")).to_numpy().reshape(len(day), len(cols))
        n_here = np.maximum((~np.isnan(x)).sum(axis=0), 1)
        shift = np.nansum(x, axis=0) / n_here
        spread = np.sqrt(np.nansum((x - shift) ** 2, axis=0) / n_here)
        x = (x - shift) / np.where(spread > 0, spread, 1.0)
        mine = np.flatnonzero(table.column("row").combine_chunks().is_valid().to_numpy(zero_copy_only=False))
        low, past, high = (np.searchsorted(day, day[mine] + a, side=s) for a, s in ((-reach, "left"), (0, "left"), (0, "right")))
        mean, scale, cov = window_covariances(x, low, high)
        loadings, values = components(cov, k)
        z = np.where(np.isnan(x[mine]), 0.0, (x[mine] - mean) / scale)
        pc = np.einsum("ti,tij->tj", z, loadings)
        total = values.sum(axis=1)
        enough = past - low >= min_rows
        share = np.divide(values[:, :k].sum(axis=1), total, out=np.zeros(len(mine)), where=total > 0)
        used = np.minimum(len(cols), high - low)
        out = dict(zip(carried, table.column("row").combine_chunks().take(pa.array(mine)).flatten()))
        for i, name in enumerate(named):
            there = enough & (i < used)
            out[name] = pa.array(pc[:, i] if i < pc.shape[1] else np.zeros(len(mine)), mask=~there)
        return pa.table(out | {"explained": pa.array(share, mask=~(enough & (total > 0)))})

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in matrix.schema), *(f"{c} double" for c in [*named, "explained"])])
    return parts.groupBy("chunk").applyInArrow(scored, schema)
