"""Periodic runs of words, found by block convolution.

A run is a stretch of consecutive words with smallest period q that has at least ``max(least, 3 * q)`` words and that no
neighbouring word extends keeping that period.

Scales.  A run of period q in [b, 2b) holds a whole aligned block of b words that comes again q words later, since the
words that equal their q-th next are 2b - 1 or more in a row.  So at each dyadic scale b = 8, 16, 32, ... the text is cut into
aligned blocks, and each block is compared with every place of the window behind it; periods below 8 are found at the
lowest scale, whose window starts at the block itself (a run of ``least`` = 24 words still holds a whole block there).

Convolution.  The squared differences of block and window add up to two prefix sums and a correlation.  The correlation
is a number-theoretic transform modulo PRIME, kept as whole numbers in doubles, never above 2**53, so it is exact.  Each block is
transformed once, padded to 2b; the transform of a window follows from those of the two blocks it lies in, since a shift
by half the length only changes the sign at every other root.  Words enter as fixed random residues; a sum that vanishes is a
seed (start, distance).  A place without mismatch always vanishes, and a chance zero does not survive the extension.

Extension.  Seeds are taken by rising distance and extended by comparing word numbers; those inside a run that already
explains them are passed over, so a period is always the smallest.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; rows are independent, so repeated rows, null ids
and ties give each its own answer; very long texts make a block of rows of their own; an empty table gives an empty table; further
columns are not read and may have any name.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm import common

#: 11 * 2**21 + 1, a generator of its units, and the longest transform; larger scales compare blocks of half that length.
PRIME, GENERATOR, LONGEST = 23068673, 3, 1 << 21
#: The lowest scale, and elements of a transformed matrix that stay in the processor's cache.
BASE, CACHED = 8, 1 << 16


def _mod(x: np.ndarray) -> np.ndarray:
    """Whole numbers below 2**53 reduced to about [-PRIME / 2, PRIME / 2], in place."""
    times = x * (1.0 / PRIME)
    np.rint(times, out=times)
    times *= PRIME
    x -= times
    return x


@functools.lru_cache(maxsize=32)
def _plan(n: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For length n: the factor of each group of each halving and its inverse, and where the inverse of each root stands."""
    root = pow(GENERATOR, (PRIME - 1) // n, PRIME)
    power = np.empty(n, np.int64)
    power[0] = 1
    done = 1
    while done < n:
        step = pow(root, done, PRIME)
        power[done:2 * done] = power[:done] * step % PRIME
        done *= 2
    centred = np.where(power > PRIME // 2, power - PRIME, power).astype(np.float64)
    at, down, up = np.zeros(1, np.int64), [], []
    while len(at) < n:
        half = at // 2
        down.append(centred[half][:, None])
        up.append(centred[-half % n][:, None])
        at = np.stack([half, half + n // 2], axis=1).ravel()
    place = np.empty(n, np.int64)
    place[at] = np.arange(n)
    return down, up, place[-at % n]


def _forward(blocks: np.ndarray) -> np.ndarray:
    """Values at all roots of the columns of ``blocks`` (b x columns), padded to 2b; reduced."""
    b, columns = blocks.shape
    down, _, _ = _plan(2 * b)
    out = np.empty((2 * b, columns))
    out[:b] = out[b:] = blocks  # the upper half is 0: the first halving copies
    h = b
    for c in down[1:]:
        h //= 2
        x = out.reshape(len(c), 2, h * columns)
        v = _mod(x[:, 1] * c)
        np.subtract(x[:, 0], v, out=x[:, 1])
        x[:, 0] += v
    return _mod(out)


def _lower_half(values: np.ndarray) -> np.ndarray:
    """2b times the coefficients 0 .. b - 1 from the values at all roots."""
    n, columns = values.shape
    _, up, _ = _plan(n)
    h = 1
    for level, c in enumerate(reversed(up[1:])):
        x = values.reshape(len(c), 2, h * columns)
        v = _mod((x[:, 0] - x[:, 1]) * c)
        x[:, 0] += x[:, 1]
        x[:, 1] = v
        if level % 3 == 2:
            _mod(values)
        h *= 2
    return values[:n // 2] + values[n // 2:]


def _vanishing(flat: np.ndarray, b: int, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, offset) pairs where block j equals the b values from (j + ahead) * b + offset on, offset < b."""
    blocks = len(flat) // b
    # the energy of the b values from each place on, modulo PRIME
    total = np.concatenate([[0], np.cumsum(_mod(flat * flat)), np.zeros((ahead + 2) * b)])
    total[len(flat) + 1:] = total[len(flat)]
    energy = _mod(total[b:] - total[:-b])
    found_at, found_off = [], []
    width = max(32, CACHED // (2 * b))
    for low in range(0, blocks, width):
        high = min(low + width, blocks)
        held = np.zeros((high - low + ahead + 1) * b)
        part = flat[low * b:(high + ahead + 1) * b]
        held[:len(part)] = part
        values = _forward(np.ascontiguousarray(held.reshape(-1, b).T))
        n = high - low
        window = values[:, ahead:ahead + n].copy()
        window[:b] += values[:b, ahead + 1:ahead + 1 + n]
        window[b:] -= values[b:, ahead + 1:ahead + 1 + n]
        window *= values[:, :n][_plan(2 * b)[2]]
        cross = _lower_half(_mod(window))
        both = energy[(low + ahead) * b:(high + ahead) * b].reshape(n, b).T + energy[low * b:high * b:b]
        both *= 2.0 * b
        both -= 2 * cross
        zero = _mod(both) == 0
        off, at = np.nonzero(zero)
        found_at.append(at + low)
        found_off.append(off)
    return (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found_at, found_off))


def seeds(codes: np.ndarray, counts: np.ndarray, least: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """By scale: (words of a block, text, start in the text, distance), for the texts' words one after the other."""
    residue = np.random.default_rng(13).integers(1, PRIME, int(codes.max(initial=-1)) + 1).astype(np.float64)
    residue[residue > PRIME // 2] -= PRIME
    starts, scale = common.spans(counts)[:-1], BASE
    while True:
        texts = np.flatnonzero(counts >= max(least, 3 * scale))
        if not len(texts):
            return
        b = min(scale, LONGEST // 2)
        blocks = -(-counts[texts] // b)
        first = common.spans(blocks)
        flat = np.zeros(int(first[-1]) * b)
        n = counts[texts]
        at = np.arange(int(n.sum()))
        flat[at + np.repeat(first[:-1] * b - common.spans(n)[:-1], n)] = residue[common.gather(codes, starts, counts, texts)]
        of = np.repeat(np.arange(len(texts)), blocks)
        m = scale // b
        for ahead in ([0, 1] if scale == BASE else range(m, 2 * m)):
            block, off = _vanishing(flat, b, ahead)
            k, s, q = of[block], (block - first[of[block]]) * b, ahead * b + off
            real = (q > 0) & (3 * q <= n[k]) & (s + q + b <= n[k])
            yield b, texts[k[real]], s[real], q[real]
        scale *= 2


def _equal(a: np.ndarray, b: np.ndarray) -> int:
    """How many first elements of two arrays of one length are equal."""
    at, step = 0, 64
    while at < len(a):
        same = a[at:at + step] == b[at:at + step]
        if not same.all():
            return at + int(same.argmin())
        at, step = at + step, 4 * step
    return len(a)


def _extend(x: np.ndarray, b: int, s: np.ndarray, q: np.ndarray, least: int, known: dict[tuple[int, int], int]) -> None:
    """Add the runs that the seeds of one scale of one text belong to: (start, end) -> period."""
    order = np.lexsort((s, q))
    s, q = s[order], q[order]

    def unexplained(start: int, end: int, p: int) -> np.ndarray:
        return ~((s >= start) & (s + b + q <= end) & (q % p == 0))

    for (start, end), p in known.items():
        keep = unexplained(start, end, p)
        s, q = s[keep], q[keep]
    while len(s):
        at, d = int(s[0]), int(q[0])
        low = at - _equal(x[:at][::-1], x[d:at + d][::-1])
        high = at + _equal(x[at:len(x) - d], x[at + d:])
        keep = (q != d) | (s < low) | (s + b > high)
        keep[0] = False
        if high + d - low >= max(least, 3 * d):
            known.setdefault((low, high + d), d)
            keep &= unexplained(low, high + d, known[low, high + d])
        s, q = s[keep], q[keep]


def runs(codes: np.ndarray, counts: np.ndarray, least: int = 24) -> dict[int, list[tuple[int, int, int]]]:
    """(start, length, period) of all runs by text, by start, then period; texts without runs are left out."""
    if least < 3 * BASE:
        raise ValueError(f"runs of fewer than {3 * BASE} words need a lower scale")
    starts, known = common.spans(counts), {}
    for b, texts, s, q in seeds(codes, counts, least):
        order = np.argsort(texts, kind="stable")
        cuts = np.flatnonzero(np.diff(texts[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            k = int(texts[part[0]])
            _extend(codes[starts[k]:starts[k + 1]], b, s[part], q[part], least, known.setdefault(k, {}))
    return {k: sorted((a, e - a, p) for (a, e), p in found.items()) for k, found in known.items() if found}


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` one after the other, and how many each text has."""
    found = pc.ascii_split_whitespace(texts.fill_null(""))
    flat, counts = found.flatten(), pc.list_value_length(found).to_numpy().astype(np.int64)
    real = pc.greater(pc.binary_length(flat), 0)  # blanks at either end leave an empty word
    return flat.filter(real), common.per_run(real.to_numpy(zero_copy_only=False), counts)


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24) -> DataFrame:
    """(id, n_words long, runs: array of start, length and period by start, then period, collapsed string).

    ``collapsed`` has the words that no run contains after that run's first period, joined by one space.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, texts in common.blocks(batches):
            words, counts = words_of(texts)
            codes = words.dictionary_encode().indices.to_numpy()
            starts, keep, out = common.spans(counts), np.ones(len(codes), bool), [[]] * len(counts)
            for k, mine in runs(codes, counts, least).items():
                out[k] = [{"start": a, "length": n, "period": q} for a, n, q in mine]
                for a, n, q in mine:
                    keep[starts[k] + a + q:starts[k] + a + n] = False
            kept = common.spans(common.per_run(keep, counts)).astype(np.int32)
            collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept), words.filter(pa.array(keep))), " ")
            yield pa.record_batch([ids, pa.array(counts), pa.array(out, kind), collapsed], names=["id", "n_words", "runs", "collapsed"])

    schema = f"id {common.id_type(docs, id_col)}, n_words bigint, runs array<{RUN}>, collapsed string"
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(found, schema).withColumnRenamed("id", id_col)
