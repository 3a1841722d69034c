"""Language identification by bit-sliced Bloom filters of character n-grams.

One array holds the filters of all languages, a bit for each (a byte for every eight), so a probe of the few slots of an
n-gram returns all languages that contain it at once.  The number of languages has no limit.  A text's n-grams are looked up, the bits of each language are counted over the text,
each count is corrected for the share of n-grams its filter would contain by chance, and the language with the largest
one is the answer; its part of all corrected counts is the score.

``fit`` learns from at most ``sample_docs`` different rows of each language (a parameter), those whose id and text hash
lowest, counted by Spark: a row that is repeated counts once, so neither an id nor a text in very many rows crowds out others.  An n-gram goes into the filter of
every language that uses it at least ``share`` times as often, of all its n-grams, as the language that uses it most, so
stray passages in another language do not count.  Prediction covers whole texts of any length, without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is every text if nothing was
learnt; a text none of whose n-grams is known takes the language most frequent in learning, with score 0.  Ties go to
the language first by name.  Repeated rows are answered equally; an empty table gives an empty table; further columns may have any name.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SIZES = (3, 4)
UNKNOWN = "und"
#: Code points looked up at once.
PIECE = 1 << 17
#: The bits of each byte.
BITS = np.arange(256)[:, None] >> np.arange(8) & 1


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def codes(text: str) -> np.ndarray:
    """Lower-case letters as code points, all else as a blank, and a blank at both ends."""
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_letters()[np.minimum(c, 0x10FFFF)], c, np.uint32(32))


def grams(code: np.ndarray, n: int) -> np.ndarray:
    """32-bit hashes of all n-grams that hold a letter next to their start."""
    size = len(code) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint32)
    h = np.full(size, n, np.uint32)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ code[k:k + size]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
    return h[(code[:size] != 32) | (code[1:size + 1] != 32)]


def places(h: np.ndarray, probes: int, size: int) -> Iterator[np.ndarray]:
    """The slot of each n-gram at every probe; ``size`` is a power of two."""
    shift = np.uint32(32 - size.bit_length() + 1)
    with np.errstate(over="ignore"):
        for k in range(probes):
            yield (h * np.uint32(2 * k * 0x85EBCA6B + 0xC2B2AE35 & 0xFFFFFFFF)) >> shift


@dataclass
class Filters:
    """Slots with a bit for each language, eight to a plane, and how often each language's filter says yes by chance."""

    langs: list[str]
    slots: np.ndarray
    probes: int
    chance: np.ndarray
    usual: int

    def masks(self, h: np.ndarray) -> np.ndarray:
        """The languages whose filters contain each n-gram: a row of bytes for each plane."""
        out = None
        for at in places(h, self.probes, self.slots.shape[1]):
            found = self.slots[:, at]
            out = found if out is None else out & found
        return out

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """N-grams of the text in each language, and in all."""
        code, total, each = codes(text), 0, np.zeros(8 * len(self.slots), np.int64)
        for low in range(0, len(code), PIECE):
            for n in SIZES:
                h = grams(code[low:low + PIECE + n - 1], n)
                total += len(h)
                for plane, m in enumerate(self.masks(h)):
                    found = np.bincount(m, minlength=256)
                    each[8 * plane:8 * plane + 8] += found @ BITS
        return each[:len(self.langs)], total

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        each, total = self.counts(text)
        true = np.maximum(0, (each - total * self.chance) / np.maximum(1e-9, 1 - self.chance))
        if not true.any():
            return self.langs[self.usual], 0.0
        best = int(true.argmax())
        return self.langs[best], float(true[best] / true.sum())


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", order_by: str = "doc_id", sample_docs: int = 2000, share: float = 0.4, least: int = 3, probes: int = 2, seed: int = 5) -> Filters:
    """Filters of the values of ``lang_col`` in ``docs``; rows without one are left out.

    ``order_by`` only decides, by its hash and the text's, which rows are in the sample.
    """
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.xxhash64(order_by, text_col, F.lit(seed)).alias("order")).filter("lang IS NOT NULL")
    counted = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("order").alias("different")).orderBy("lang").collect()  # a row for each language
    langs = [r["lang"] for r in counted]
    if not langs:
        return Filters([], np.zeros((0, 2), np.uint8), probes, np.zeros(0), 0)
    # About twice the rows that are wanted pass by their hash; of these, the lowest of each language are taken.
    part = F.create_map(*[F.lit(x) for r in counted for x in (r["lang"], min(1.0, 2 * sample_docs / max(1, r["different"])))])
    share_of = F.pmod("order", F.lit(1_000_000_007))
    near = known.filter(share_of <= part[F.col("lang")] * 1_000_000_007).dropDuplicates(["lang", "order"])
    sample = near.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(share_of, "order"))).filter(F.col("place") <= sample_docs)
    number = {x: k for k, x in enumerate(langs)}

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[] for _ in langs]
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    found[number[lang]] += [grams(codes(text), n) for n in SIZES]
            for k, h in enumerate(found):
                if h:
                    gram, n = np.unique(np.concatenate(h), return_counts=True)
                    yield pa.record_batch({"gram": pa.array(gram.astype(np.int64)), "lang": pa.array(np.full(len(gram), k, np.int32)), "n": pa.array(n.astype(np.int64))})

    rows = sample.select("text", "lang").mapInArrow(counts, "gram bigint, lang int, n bigint").groupBy("gram").pivot("lang", [*range(len(langs))]).sum("n")
    found = rows.toArrow()  # n-grams of the bounded sample
    gram = found.column(0).to_numpy().astype(np.uint32)
    n = np.stack([found.column(k + 1).fill_null(0).to_numpy().astype(np.float64) for k in range(len(langs))], 1)
    rate = n / np.maximum(1, n.sum(0))
    belongs = (rate >= share * rate.max(1, keepdims=True)) & (n >= min(least, max(1, n.sum() // (10 * max(1, len(n))))))
    size = 1 << max(10, int(8 * max(1, belongs.any(1).sum())).bit_length())
    out = Filters(langs, np.zeros((-(-len(langs) // 8), size), np.uint8), probes, np.zeros(len(langs)), int(np.argmax([r["n"] for r in counted])))
    for lang in range(len(langs)):
        for at in places(gram[belongs[:, lang]], probes, size):
            out.slots[lang // 8, at] |= np.uint8(1 << lang % 8)
    out.chance = np.array([float((out.slots[k // 8] >> np.uint8(k % 8) & np.uint8(1)).mean()) ** probes for k in range(len(langs))])
    return out


def predict(docs: DataFrame, filters: Filters, text_col: str = "text", lang_as: str = "lang_pred", score_as: str = "score") -> DataFrame:
    """``docs`` with the predicted language (string) and its score (double, 0 to 1), which replace columns so named."""
    docs = docs.drop(lang_as, score_as)
    k, names = docs.columns.index(text_col), [*docs.columns, lang_as, score_as]
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                out = [*map(shared.value.predict, part.column(k).to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.float64())], names=names)

    return docs.mapInArrow(predicted, docs.withColumns({lang_as: F.lit(""), score_as: F.lit(0.0)}).schema)
