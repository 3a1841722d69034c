"""Quality rules: gradient-boosted trees over document statistics, with monotone constraints.

``statistics`` measures every whole text where it is, without a shuffle.  ``fit`` grows trees in numpy on at most
``sample_docs`` labelled rows of each class (a parameter): features are binned by quantiles, each node takes the split of
the best second-order gain, and on constrained features a split that would go the wrong way is not taken while bounds
handed down keep later ones in order.  The trees are flattened into node arrays (feature, threshold, left, right, value), so scoring is a
few gathers per level for all rows of a batch at once.

Defined cases: a null or empty text has no words and fails the base rules; repeated rows are judged equally; with no
labelled row of one class the trees have nothing to say and every text that passes the base rules is kept; an empty table gives an empty
table.  Further columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANK = re.compile("[\x20\x09-\x0d]")
SYMBOL = re.compile(r"[#*$%&|<>]")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the trees see, and the direction in which the chance of good quality may move with it (0: any).
FEATURES = {"n_words": 0, "chars_per_word": 0, "symbols_per_word": -1, "dup_lines_share": -1, "repeat_share": -1, "distinct_share": 0, "letters_share": 0, "words_per_line": 0, "upper_share": 0, "digit_share": 0, "stop_share": 0}


def measure(text: str | None) -> tuple:
    """The five counts, and further measures for the trees: distinct words, letters, lines, upper case, digits, short words."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    found = raw.split()
    n = len(found)
    if not n:
        return (0, 0, len(SYMBOL.findall(text)), 0, 0, 0, 0, 0, 0, 0, 0)
    number: dict[bytes, int] = {}
    at = np.fromiter([number.setdefault(w, len(number)) for w in found], np.int64, n)
    covered = 0
    if n >= 3:
        key = (at[:-2] * len(number) + at[1:-1]) if len(number) < 2_000_000 else None
        if key is None:
            _, key = np.unique(at[:-2] << 32 | at[1:-1], return_inverse=True)
        _, pair = np.unique(key, return_inverse=True)
        _, window, times = np.unique(pair * len(number) + at[2:], return_inverse=True, return_counts=True)
        often = times[window] > 1
        mark = np.zeros(n, bool)
        for k in range(3):
            mark[k:n - 2 + k] |= often
        covered = int(mark.sum())
    lines = [x for x in raw.split(b"\n") if x.split()]
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(np.minimum(code, 128), minlength=129)
    blanks = int(kinds[32] + kinds[9:14].sum())
    upper, lower, digits = int(kinds[65:91].sum()), int(kinds[97:123].sum()), int(kinds[48:58].sum())
    symbols = int(kinds[[ord(c) for c in "#*$%&|<>"]].sum())
    return (n, len(code) - blanks, symbols, len(lines) - len(set(lines)), covered, len(number), upper + lower + int(kinds[128]), len(lines), upper, digits, sum(map((2).__ge__, map(len, found))))


def _columns(rows: list[tuple]) -> dict[str, np.ndarray]:
    """The five counts, and the features of the trees."""
    m = np.array(rows, np.float64).reshape(len(rows), 11)
    n, chars = np.maximum(m[:, 0], 1), np.maximum(m[:, 1], 1)
    return {**{c: m[:, k] for k, c in enumerate(COUNTS)}, "chars_per_word": m[:, 1] / n, "symbols_per_word": m[:, 2] / n, "dup_lines_share": m[:, 3] / np.maximum(m[:, 7], 1), "repeat_share": m[:, 4] / n, "distinct_share": m[:, 5] / n,
            "letters_share": m[:, 6] / chars, "words_per_line": m[:, 0] / np.maximum(m[:, 7], 1), "upper_share": m[:, 8] / chars, "digit_share": m[:, 9] / chars, "stop_share": m[:, 10] / n}


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with the five counts (long) and the features of the trees (double)."""
    docs = docs.drop(*COUNTS, *FEATURES, "score", "base_failed", "kept")
    k = docs.columns.index(text_col)
    kept = [c for c in docs.columns if c != text_col]
    more = [c for c in FEATURES if c not in COUNTS]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _columns([*map(measure, batch.column(k).to_pylist())])
            others = [x for i, x in enumerate(batch.columns) if i != k]
            yield pa.RecordBatch.from_arrays([*others, *[pa.array(m[c].astype(np.int64)) for c in COUNTS], *[pa.array(m[c]) for c in more]], names=[*kept, *COUNTS, *more])

    schema = docs.drop(text_col).withColumns({c: F.lit(0).cast("bigint") for c in COUNTS} | {c: F.lit(0.0) for c in more}).schema
    return docs.mapInArrow(measured, schema)


@dataclass
class Trees:
    """Flattened trees: node arrays, the root of each tree, and the depth. A leaf is its own child."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    depth: int = 0
    base: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1 for rows of features."""
        out, row = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out += self.value[node]
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, monotone: list[int], trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 2.0) -> Trees:
    """Boosted trees for labels 0 and 1 under the logistic loss."""
    if len(set(y.tolist())) < 2:
        return Trees()
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    code = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    mean = y.mean()
    base = float(np.log(mean / (1 - mean)))
    logit, nodes, roots = np.full(len(y), base), [], []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, level: int, low: float, high: float) -> int:
        at = len(nodes)
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + l2), low, high))
        nodes.append([0, np.inf, at, at, value * rate])
        best = (1e-6, None)
        if level < depth:
            for f, cut in enumerate(cuts):
                gs, hs = (np.cumsum(np.bincount(code[rows, f], weights=v[rows], minlength=len(cut) + 1)) for v in (g, h))
                gl, hl, gr, hr = gs[:-1], hs[:-1], gs[-1] - gs[:-1], hs[-1] - hs[:-1]
                vl, vr = np.clip(-gl / (hl + l2), low, high), np.clip(-gr / (hr + l2), low, high)
                gain = -(gl * vl + (hl + l2) * vl * vl / 2) - (gr * vr + (hr + l2) * vr * vr / 2) + (gs[-1] * value + (hs[-1] + l2) * value * value / 2)
                gain = np.where((hl >= least) & (hr >= least) & ((vr - vl) * monotone[f] >= 0), gain, 0)
                if len(gain) and gain.max() > best[0]:
                    k = int(gain.argmax())
                    best = (gain[k], (f, k, (vl[k] + vr[k]) / 2))
        if best[1]:
            f, k, middle = best[1]
            goes = code[rows, f] <= k
            bounds = ((low, high), (low, high)) if not monotone[f] else ((low, middle), (middle, high)) if monotone[f] > 0 else ((middle, high), (low, middle))
            left, right = grow(rows[goes], g, h, level + 1, *bounds[0]), grow(rows[~goes], g, h, level + 1, *bounds[1])
            nodes[at][:4] = [f, cuts[f][k], left, right]
        return at

    model = Trees(depth=depth, base=base)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-6), 0, -np.inf, np.inf))
        columns = [np.array(c) for c in zip(*nodes)]
        model.feature, model.threshold, model.left, model.right, model.value = columns[0].astype(np.int64), columns[1].astype(float), columns[2].astype(np.int64), columns[3].astype(np.int64), columns[4].astype(float)
        one = Trees(model.feature, model.threshold, model.left, model.right, model.value, np.array(roots[-1:]), depth)
        s = one.score(x)
        logit = logit + np.log(s / (1 - s))
    model.roots = np.array(roots)
    return model


def fit(measured: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", sample_docs: int = 4000, seed: int = 3) -> Trees:
    """Trees learnt from the ``statistics`` of at most ``sample_docs`` labelled rows of each class, those with the smallest hash of their id."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    found = measured.select(F.col(id_col).alias("id"), *FEATURES).join(known, "id")
    parts = [found.filter(f"label = {k}").orderBy(F.xxhash64("id", F.lit(seed)), "id", *FEATURES).limit(sample_docs).toArrow() for k in (0, 1)]  # bounded by sample_docs
    rows = pa.concat_tables(parts)
    x = np.stack([rows.column(c).to_numpy().astype(float) for c in FEATURES], 1)
    return train(x, rows.column("label").to_numpy(), [*FEATURES.values()])


def judge(measured: DataFrame, trees: Trees, threshold: float = 0.5) -> DataFrame:
    """``measured`` with base_failed, score (double, chance of good quality) and kept."""
    names = measured.columns
    at = [names.index(c) for c in FEATURES]
    shared = measured.sparkSession.sparkContext.broadcast(trees)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(k).to_numpy().astype(float) for k in at], 1)
            score = shared.value.score(x) if len(shared.value.roots) else np.ones(len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*names, "score"])

    out = measured.mapInArrow(scored, measured.withColumn("score", F.lit(0.0)).schema)
    return out.withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
