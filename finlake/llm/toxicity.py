"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained and applied with numpy.

A word enters as a learned vector of its own (hashed) and the mean of learned vectors of its character n-grams with
their place at the word's ends, so that unseen forms of a known word are recognised.  A text is covered by overlapping
windows of words, all of them are scored, and the text's score is that of its most toxic window.

``fit`` learns from a bounded sample of labelled rows (``sample_docs`` of each class, texts of at most ``sample_chars``;
both are parameters): vectors start from the log-odds of words and n-grams, then all weights are trained by Adam on the
windows of each text that look most toxic, so texts of any length are calibrated as wholes.  Scoring covers whole texts of any length,
and runs block by block where the rows are, without a shuffle.

Defined cases: a null text, or one without words, scores 0; repeated rows score equally; with no labelled row of one
class every text scores that class's end of the scale (0 without any label); an empty table gives an empty table.  Further columns may have any name.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm import common, mph

EDGES = ".,;:!?()[]{}<>\"'`*_-+=#$%&|/\\~^"
WORD_BITS, GRAM_BITS = 18, 17
GRAMS = (3, 4, 5)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, hashes of all n-grams in the order of the words, and their number for each word."""
    clean = [w.lower().strip(EDGES) for w in words]
    word = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) & ((1 << WORD_BITS) - 1) for w in clean), np.int64, len(clean))
    code = np.frombuffer(("\n" + "\n".join(clean) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    edge = code == 10
    of = np.cumsum(edge) - 1  # the word that follows or holds each place
    hashes, owners = [], []
    for n in GRAMS:
        size = len(code) - n + 1
        if size <= 0:
            continue
        h, crosses = np.zeros(size, np.uint64), np.zeros(size, bool)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = h * np.uint64(1000003) + code[k:k + size]
                if 0 < k < n - 1:
                    crosses |= edge[k:k + size]
        keep = ~crosses
        hashes.append(mph.mix(h[keep], n) >> np.uint64(64 - GRAM_BITS))
        owners.append(of[:size][keep])
    if not words or not hashes:
        return word, np.zeros(0, np.int64), np.zeros(len(words), np.int64)
    owner, gram = np.concatenate(owners), np.concatenate(hashes).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return word, gram[order], np.bincount(owner, minlength=len(words))[:len(words)]


def _mean(table: np.ndarray, gram: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Mean vector of each word's n-grams; 0 for none."""
    at = common.spans(n)
    out = np.zeros((len(n), table.shape[1]), np.float32)
    has = np.flatnonzero(n)
    if len(has):
        out[has] = np.add.reduceat(table[gram], at[:-1][has], axis=0) / n[has, None]
    return out


def windows(counts: np.ndarray, width: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word within all words, words) of every overlapping window."""
    n = np.where(counts > 0, 1 + -(-np.maximum(counts - width, 0) // stride), 0)
    text = np.repeat(np.arange(len(counts)), n)
    k = np.arange(len(text)) - np.repeat(common.spans(n)[:-1], n)
    start = np.minimum(k * stride, np.maximum(counts[text] - width, 0))
    return text, common.spans(counts)[:-1][text] + start, np.minimum(width, counts[text])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """Weights by name, and how texts are cut."""

    weights: dict[str, np.ndarray]
    width: int = 48
    stride: int = 32
    constant: float | None = None

    @staticmethod
    def new(dim: int = 6, hidden: int = 8, seed: int = 7) -> "Network":
        r = np.random.default_rng(seed)
        draw = lambda *shape: (r.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)
        return Network({"word": draw(1 << WORD_BITS, dim) * 10, "gram": draw(1 << GRAM_BITS, dim) * 10, "wx": draw(2, 2 * dim, 3 * hidden), "wh": draw(2, hidden, 3 * hidden) / 2, "b": np.zeros((2, 1, 3 * hidden), np.float32),
                        "wa": draw(2 * hidden, hidden), "va": draw(hidden, 1)[:, 0], "out": draw(2 * hidden, 1)[:, 0], "bias": np.full(1, -1, np.float32)})

    def vectors(self, word: np.ndarray, gram: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.concatenate([self.weights["word"][word], _mean(self.weights["gram"], gram, n)], 1)

    def forward(self, gates: np.ndarray, at: np.ndarray, size: np.ndarray, keep: bool = False):
        """Logits of windows: ``gates`` (2, words + 1, 3 hidden) are the input gates of the words, ``at`` (windows, width) word numbers."""
        w = self.weights
        hidden, batch, width = w["wh"].shape[1], *at.shape
        on = np.arange(width) < size[:, None]
        h, states, saved = np.zeros((2, batch, hidden), np.float32), np.zeros((width, 2, batch, hidden), np.float32), []
        for t in range(width):
            x = np.stack([gates[0][at[:, t]], gates[1][at[:, width - 1 - t]]])
            live = np.stack([on[:, t], on[:, width - 1 - t]])[:, :, None]
            u = h @ w["wh"]
            rz = _sigmoid(x[..., :2 * hidden] + u[..., :2 * hidden])
            r, z = rz[..., :hidden], rz[..., hidden:]
            new = np.tanh(x[..., 2 * hidden:] + r * u[..., 2 * hidden:])
            after = np.where(live, new + z * (h - new), h)
            if keep:
                saved.append((h, u[..., 2 * hidden:], r, z, new, live))
            h = states[t] = after
        both = np.concatenate([states[:, 0], states[::-1, 1]], -1).transpose(1, 0, 2)  # windows, width, 2 hidden
        mid = np.tanh(both @ w["wa"])
        score = np.where(on, mid @ w["va"], -1e9)
        weight = np.exp(score - score.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        pooled = np.einsum("bt,bth->bh", weight, both)
        logit = pooled @ w["out"] + w["bias"][0]
        return (logit, (saved, both, mid, weight, pooled, on)) if keep else logit

    def gates(self, vectors: np.ndarray) -> np.ndarray:
        """Input gates of words, and of a padding word at the end."""
        x = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), np.float32)])
        return x @ self.weights["wx"] + self.weights["b"]

    def logits(self, gates: np.ndarray, at: np.ndarray, counts: np.ndarray, batch: int = 1024) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, size, logit) of all windows of texts, given as word numbers one after the other."""
        text, start, size = windows(counts, self.width, self.stride)
        out = np.zeros(len(text), np.float32)
        order = np.argsort(size, kind="stable")  # short windows together, cut to their longest
        for low in range(0, len(text), batch):
            part = order[low:low + batch]
            out[part] = self.forward(gates, self.take(at, start[part], size[part], gates.shape[1] - 1), size[part])
        return text, start, size, out

    @staticmethod
    def take(at: np.ndarray, start: np.ndarray, size: np.ndarray, pad: int) -> np.ndarray:
        place = np.arange(int(size.max()))
        inside = place < size[:, None]
        return np.where(inside, at[np.where(inside, start[:, None] + place, 0)], pad)

    def backward(self, dlogit: np.ndarray, kept) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the weights, and of the input gates at each place (2, windows, width, 3 hidden)."""
        w, (saved, both, mid, weight, pooled, on) = self.weights, kept
        hidden, width = w["wh"].shape[1], both.shape[1]
        g = {"out": pooled.T @ dlogit, "bias": dlogit.sum(keepdims=True)}
        dpool = dlogit[:, None] * w["out"]
        dweight = np.einsum("bh,bth->bt", dpool, both)
        dscore = weight * (dweight - (weight * dweight).sum(1, keepdims=True)) * on
        dmid = dscore[..., None] * w["va"] * (1 - mid * mid)
        g["va"] = np.einsum("bt,bth->h", dscore, mid)
        g["wa"] = np.einsum("btx,bth->xh", both, dmid)
        dboth = weight[..., None] * dpool[:, None] + dmid @ w["wa"].T
        fore, back = dboth[..., :hidden].transpose(1, 0, 2), dboth[..., hidden:].transpose(1, 0, 2)[::-1]
        dh, g["wh"], dgates = np.zeros((2, both.shape[0], hidden), np.float32), np.zeros_like(w["wh"]), np.zeros((2, both.shape[0], width, 3 * hidden), np.float32)
        for t in reversed(range(width)):
            h, un, r, z, new, live = saved[t]
            dh = dh + np.stack([fore[t], back[t]])
            d = dh * live
            dn = d * (1 - z) * (1 - new * new)
            dr, dz = dn * un * r * (1 - r), d * (h - new) * z * (1 - z)
            du = np.concatenate([dr, dz, dn * r], -1)
            g["wh"] += h.transpose(0, 2, 1) @ du
            dgates[0, :, t], dgates[1, :, width - 1 - t] = np.concatenate([dr, dz, dn], -1)
            dh = du @ w["wh"].transpose(0, 2, 1) + d * z + dh * ~live
        return g, dgates


def _log_odds(items: Iterator[np.ndarray], label: np.ndarray, size: int) -> np.ndarray:
    """Log-odds of the positive class by the documents that hold each item, 1.5 standard errors nearer to 0."""
    held = np.zeros((2, size), np.int64)
    for k, item in zip(label, items):
        held[k, np.unique(item)] += 1
    b, a = held
    odds = np.log((a + 0.5) / ((label == 1).sum() + 1)) - np.log((b + 0.5) / ((label == 0).sum() + 1))
    sure = np.maximum(0, np.abs(odds) - 1.5 * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)))
    return (np.sign(odds) * np.where(a + b >= 3, sure, 0)).astype(np.float32)


def train(texts: list[str], label: np.ndarray, steps: int = 240, batch: int = 64, rate: float = 0.01, seed: int = 7) -> Network:
    """A network for texts with labels 0 or 1, in so many steps of Adam.

    Of each text the two windows with the most toxic word by log-odds are shown, of toxic texts the first one only;
    later, of clean texts, those that the network itself scores highest.
    """
    net, number = Network.new(seed=seed), {}
    if len(set(label.tolist())) < 2:
        net.constant = float(label[0]) if len(label) else 0.0
        return net
    at = [np.array([number.setdefault(w, len(number)) for w in t.split()], np.int64) for t in texts]
    counts = np.array([len(x) for x in at])
    listed = list(number)
    if not listed:
        net.constant = 0.0
        return net
    word, gram, n = (np.concatenate(x) for x in zip(*[features(listed[k:k + 20_000]) for k in range(0, len(listed), 20_000)]))
    w, gram_at = net.weights, common.spans(n)[:-1]
    dim = w["word"].shape[1]
    w["word"] *= 0.05
    w["gram"] *= 0.05
    w["word"][:, 0] = _log_odds((word[x] for x in at), label, 1 << WORD_BITS) / 3
    w["gram"][:, 0] = _log_odds((common.gather(gram, gram_at, n, np.unique(x)) for x in at), label, 1 << GRAM_BITS) / 2
    odds, at = w["word"][word, 0] + _mean(w["gram"][:, :1], gram, n)[:, 0], np.concatenate(at)
    text, start, size = windows(counts, net.width, net.stride)
    top = np.array([odds[at[a:a + m]].max() for a, m in zip(start.tolist(), size.tolist())])
    order = np.lexsort((-top, text))
    place = np.arange(len(order)) - np.searchsorted(text[order], text[order])
    shown = order[place < np.where(label[text[order]] == 1, 1, 2)]
    r, first, second, queue = np.random.default_rng(seed), {}, {}, np.zeros(0, np.int64)
    steps = min(steps, max(60, 12 * len(shown) // batch))
    del listed, number, order, place, odds
    common.trim()
    padding = len(word)
    for step in range(1, steps + 1):
        if step in (steps // 3, 2 * steps // 3):  # show clean texts' windows that the network now takes for toxic ones
            score = np.zeros(len(text))
            clean = np.flatnonzero(label[text] == 0)
            gates = net.gates(np.concatenate([net.vectors(word[k:k + 20_000], gram[gram_at[k]:gram_at[k] + int(n[k:k + 20_000].sum())], n[k:k + 20_000]) for k in range(0, len(word), 20_000)]))
            for low in range(0, len(clean), 1024):
                part = clean[low:low + 1024]
                score[part] = net.forward(gates, net.take(at, start[part], size[part], padding), size[part])
            hard = clean[np.lexsort((-score[clean], text[clean]))]
            hard = hard[np.arange(len(hard)) - np.searchsorted(text[hard], text[hard]) < 2]
            shown, queue = np.concatenate([shown[label[text[shown]] == 1], hard, hard[score[hard] > 0]]), queue[:0]
        if len(queue) < batch:
            queue = np.concatenate([queue, r.permutation(shown)])
        now, queue = queue[:batch], queue[batch:]
        taken = net.take(at, start[now], size[now], padding)
        words, local = np.unique(taken, return_inverse=True)
        local = local.reshape(taken.shape)
        words = words[words < padding]  # the padding word is the last
        local = np.where(taken == padding, len(words), local)
        grams = common.gather(gram, gram_at, n, words)
        vectors = net.vectors(word[words], grams, n[words])
        logit, kept = net.forward(net.gates(vectors), local, size[now], keep=True)
        y = label[text[now]]
        g, dgates = net.backward(((_sigmoid(logit) - y) / len(y)).astype(np.float32), kept)
        by = np.argsort(local.ravel(), kind="stable")
        runs = np.searchsorted(local.ravel()[by], np.arange(len(words)))
        dword = np.stack([np.add.reduceat(d.reshape(-1, d.shape[-1])[by], runs, axis=0) for d in dgates])  # the last run ends with the padding, whose gradient is 0
        g["wx"], g["b"] = vectors.T @ dword, dword.sum(1, keepdims=True)
        dvec = (dword @ w["wx"].transpose(0, 2, 1)).sum(0)
        touched = {}
        for k, row, d in (("word", word[words], dvec[:, :dim]), ("gram", grams, np.repeat(dvec[:, dim:] / np.maximum(n[words], 1)[:, None], n[words], axis=0))):
            touched[k], back = np.unique(row, return_inverse=True)
            g[k] = np.zeros((len(touched[k]), dim), np.float32)
            np.add.at(g[k], back, d)
        for k, d in g.items():
            if k not in first:
                first[k], second[k] = np.zeros_like(w[k]), np.zeros_like(w[k])
            at_rows = touched.get(k, slice(None))
            first[k][at_rows] = m = 0.9 * first[k][at_rows] + 0.1 * d
            second[k][at_rows] = v = 0.99 * second[k][at_rows] + 0.01 * d * d
            w[k][at_rows] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def score_texts(net: Network, texts: list[str | None]) -> np.ndarray:
    """Score of each text: its highest window's."""
    if net.constant is not None:
        return np.array([net.constant if t and t.split() else 0.0 for t in texts])
    number: dict[str, int] = {}
    at = [[number.setdefault(w, len(number)) for w in t.split()] if t else [] for t in texts]
    counts, out = np.array([len(x) for x in at], np.int64), np.zeros(len(texts))
    if not number:
        return out
    words, vectors = list(number), []
    for low in range(0, len(words), 20_000):
        vectors.append(net.vectors(*features(words[low:low + 20_000])))
    text, _, _, logit = net.logits(net.gates(np.concatenate(vectors)), np.concatenate([np.array(x, np.int64) for x in at]), counts)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, logit.astype(np.float64))
    return np.where(counts > 0, _sigmoid(top), 0.0)


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", usable: str | None = None, sample_docs: int = 1500, sample_chars: int = 12_000, seed: int = 7) -> Network:
    """Train on at most ``sample_docs`` labelled documents of each class, those with the smallest hash of their id.

    ``usable`` (SQL) says which rows of ``labels`` may be learnt from.  Only ids are compared to choose the sample, whose size is fixed; it is trained on in a task, and the driver gets the weights.
    """
    known = labels.filter(usable) if usable else labels
    known = known.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)")
    short = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.length("text") <= sample_chars)
    found = known.join(short.select("id"), "id").select("id", "label", F.xxhash64("id", F.lit(seed)).alias("order"))
    chosen = [found.filter(f"label = {k}").orderBy("order", "id").limit(sample_docs) for k in (0, 1)]
    ids = chosen[0].union(chosen[1])
    rows = short.join(F.broadcast(ids), "id").orderBy("order", "id", "text").limit(4 * sample_docs).select("text", "label")  # bounded by sample_docs

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [(text, label) for b in batches for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        net = train([text for text, _ in sample], np.array([label for _, label in sample], np.int64), seed=seed)
        common.trim()
        yield pa.record_batch({"net": pa.array([pickle.dumps(net)], pa.binary())})

    found = rows.mapInArrow(learnt, "net binary").collect()  # the sample is one partition, so one network
    return pickle.loads(found[0][0]) if found else train([], np.zeros(0, np.int64))


def score(docs: DataFrame, net: Network, text_col: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with a column ``column`` (double, 0 to 1), which replaces one so named."""
    docs = docs.drop(column)
    k, names = docs.columns.index(text_col), [*docs.columns, column]
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([16 + len(t or "") for t in batch.column(k).to_pylist()]) // (3 << 20)
            low = 0
            for high in np.append(np.flatnonzero(np.diff(sizes)) + 1, batch.num_rows):
                common.trim()
                part = batch.slice(low, int(high) - low)
                low = int(high)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score_texts(shared.value, part.column(k).to_pylist()), pa.float64())], names=names)

    return docs.mapInArrow(scored, docs.withColumn(column, F.lit(0.0)).schema)
