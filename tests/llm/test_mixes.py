"""Filter audit, source mixing and periodic runs against plain versions."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from finlake.llm import mixing, periods, terms
from finlake.llm.queries import QUERIES
from tests.llm import helpers as h


@pytest.fixture(scope="module")
def docs(spark):
    return h.documents(spark, h.awkward())


def plain_runs(x, least=24):
    out = {}
    for q in range(1, len(x) // 3 + 1):
        i = 0
        while i < len(x) - q:
            j = i
            while j < len(x) - q and x[j] == x[j + q]:
                j += 1
            if j - i + q >= max(least, 3 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, e - a, p) for (a, e), p in out.items())


def planted(rng, n, kinds):
    x = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a = rng.randrange(n)
        p, e = rng.randint(1, max(1, (n - a) // 3)), rng.randint(a, n)
        for i in range(a, e):
            x[i] = x[a + (i - a) % p]
    return x


@pytest.mark.parametrize("longest", [1 << 21, 32])
def test_runs_against_brute_force(monkeypatch, longest):
    monkeypatch.setattr(periods, "LONGEST", longest)  # 32: large scales compare blocks of 16 words
    rng = random.Random(longest)
    for _ in range(60):
        texts = [planted(rng, rng.choice([0, 1, 23, 24, 25, 70, 300, 500]), rng.choice([1, 2, 3, 40])) for _ in range(4)]
        got = periods.runs(np.array([w for x in texts for w in x], np.int64), np.array([len(x) for x in texts], np.int64))
        assert [got.get(k, []) for k in range(4)] == [plain_runs(x) for x in texts]


def test_transform_is_exact():
    rng = np.random.default_rng(3)
    for b in (8, 64, 1024):
        flat = rng.integers(-2, 3, 5 * b).astype(float)
        flat[3 * b + 5:4 * b + 5] = flat[b:2 * b]
        want = {(j, o) for j in range(4) for o in range(b) if j * b + b + o + b <= len(flat) and (flat[j * b:(j + 1) * b] == flat[(j + 1) * b + o:(j + 2) * b + o]).all()}
        got = {(j, o) for j, o in zip(*(x.tolist() for x in periods._vanishing(flat, b, 1))) if j * b + b + o + b <= len(flat)}
        assert got == want and (b == 8 or (1, 5 + b) not in got)


def test_a_low_scale_is_asked_for():
    with pytest.raises(ValueError, match="lower scale"):
        periods.runs(np.zeros(30, np.int64), np.array([30]), least=10)


def test_periods_of_awkward_documents(docs, spark):
    texts = [(i, t) for i, t in h.awkward()] + [(50, "so it goes " * 30), (51, " a\tb " * 12 + "x " + "y z " * 50)]
    got = periods.find_runs(h.documents(spark, texts)).collect()
    want = []
    for i, t in texts:
        w = h.words(t)
        found = plain_runs(w) if len(w) < 3000 else [(0, 40000, 9000)]
        gone = {k for a, n, q in found for k in range(a + q, a + n)}
        want.append((i, len(w), found, " ".join(x for k, x in enumerate(w) if k not in gone)))
    assert h.ordered((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got) == h.ordered(want)
    assert periods.find_runs(docs.filter("false")).collect() == []


def test_op13_on_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w = h.words(r.text)
        n, code = len(w), zlib.crc32(str(r.doc_id).encode())
        if code % 10 == 0 and n:
            g = code // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        found = plain_runs(w)
        gone = {k for a, m, q in found for k in range(a + q, a + m)}
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        want.append((r.doc_id, len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                     hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in found).encode()).hexdigest(), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    assert h.ordered(map(tuple, QUERIES["op13_periodic_runs"][0](spark, sf).collect())) == h.ordered(want)


def audited(rows, labels):
    """Plain audit: rows of (id, text, part)."""
    first, fails = {}, []
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, part in rows:
        t = t or ""
        w = h.words(t)
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t), "E": i is not None and first[t] < i}
        fails.append((part or "", {k for k, v in f.items() if v}, any(None is not x == i and q == 1 for x, q, _ in labels), any(None is not x == i and z == 1 for x, _, z in labels)))
    out, shapley = [], Counter()
    for part in {p for p, *_ in fails}:
        for order in map("".join, itertools.permutations("ABCDE")):
            for k, f in enumerate(order):
                mine = [x for x in fails if x[0] == part]
                gone = [x for x in mine if f in x[1] and not x[1] & set(order[:k])]
                shapley[part, f] += len(gone)
                out.append((part, order, k + 1, sum(not x[1] & set(order[:k + 1]) for x in mine), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine),
                            sum(x[2] for x in gone), sum(x[3] for x in gone)))
    return [(*r, shapley[r[0], r[1][r[2] - 1]]) for r in out]


def test_audit_of_awkward_documents(spark, tmp_path):
    rows = [(i, t, [None, "", "web", "a.b `c`"][k % 4]) for k, (i, t) in enumerate(h.awkward())] + [(60, "AB # CD", "web"), (61, "AB # CD", "web")]
    labels = [(10, 1, None), (10, None, 1), (11, 0, 1), (None, 1, 1), (999, 1, 1), (61, 1, 0), (30, 1, 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumn("block", F.lit("x")).withColumn("row", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = QUERIES["op11_filter_audit"][0](spark, str(tmp_path))
    assert h.ordered(map(tuple, got.collect())) == h.ordered(audited(rows, labels))


def test_matrix_counts_every_word_once(docs):
    shards = terms.document_terms(docs, carried=["id", "block"]).collect()
    cells, columns = [], defaultdict(set)
    for s in shards:
        ptr, term, n = (np.frombuffer(getattr(s, c), t) for c, t in (("indptr", np.int64), ("terms", np.int64), ("counts", np.uint32)))
        for k, r in enumerate(s.rows):
            cells.append((r.id, r.row.id, r.row.block, sorted(n[ptr[k]:ptr[k + 1]].tolist())))
            columns[r.id].update(term[ptr[k]:ptr[k + 1]].tolist())
    assert h.ordered(cells) == h.ordered((i, "x", "b", sorted(Counter(h.words(t)).values())) for i, t in h.awkward())
    assert columns[10] == columns[11] and len(columns[10]) == 60 and len(columns[10] & columns[20]) == 59  # one id for a word, wherever it stands


def test_nothing_to_audit(docs, spark):
    none = docs.filter("false").withColumn("part", F.col("source"))
    figures = terms.figures(terms.document_terms(none, carried=["part"]))
    assert terms.audit(figures, {"A": F.expr("n_words < 50")}, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect() == []


def level(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by the rule as it is told: stop at the cap, share the excess, until none is above."""
    budget, target, free = share * sum(sizes), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        total = sum(weights[k % len(weights)] for k in free)
        aim = {k: budget * weights[k % len(weights)] / total for k in free}
        above = {k for k in free if aim[k] > most * sizes[k]}
        for k in above or free:
            target[k] = most * sizes[k] if above else aim[k]
            budget -= target[k]
        free -= above or free
    return target


@pytest.mark.parametrize("sizes", [[5], [10, 0, 7], [1000, 1, 1, 1], [1, 1000, 3, 999, 5], [0, 0], [7, 100, 20, 13, 8, 900, 4]])
def test_targets(spark, sizes):
    names = [f"s{k}" for k in range(len(sizes) - 1)] + [None]
    rows = mixing.targets(spark.createDataFrame(list(zip(names, sizes)), "source string, source_size bigint")).collect()
    assert {r.source: r.target for r in rows} == pytest.approx(dict(zip(names, level(sizes))))


def test_mix_of_awkward_documents(docs, spark, monkeypatch):
    mixed = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b"))
    quality = spark.createDataFrame([(10, 4.0), (10, 2.0), (11, None), (12, -1.0), (None, 3.0)], "doc_id bigint, quality double")
    got = [r.asDict() for r in mixing.mix(mixed, quality).collect()]
    assert sorted(r["size"] for r in got) == sorted(len(h.words(t)) for _, t in h.awkward())
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    aims = level([sum(r["size"] for r in by[s]) for s in ("a", "b", None)])
    for s, aim in zip(("a", "b", None), aims):
        size = sum(r["size"] for r in by[s])
        assert all(r["source_size"] == size and r["target"] == pytest.approx(aim) and r["size"] * int(aim // size) <= r["taken"] <= 2 * r["size"] for r in by[s])
        assert aim - 1 < sum(r["taken"] for r in by[s]) <= aim
        ordered = sorted((r for r in by[s] if r["size"]), key=lambda r: r["key"])
        more = [r["taken"] - r["size"] * int(aim // size) for r in ordered]
        assert sum(0 < m < r["size"] for m, r in zip(more, ordered)) <= 1 and more == sorted(more, key=lambda m: not m) or len({r["key"] for r in ordered}) < len(ordered)
    plain = h.ordered((r["doc_id"], r["size"], r["taken"]) for r in got)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert h.ordered((r.doc_id, r.size, r.taken) for r in mixing.mix(mixed, quality).collect()) == plain
    whole = mixing.mix(mixed, quality, cut=False).collect()
    assert all(r.size == 0 or r.taken % r.size == 0 for r in whole)
    assert mixing.mix(mixed.filter("false"), quality).collect() == []


def test_better_documents_come_first_more_often(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 2000, "x").otherwise("y").alias("source"))
    quality = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("quality"))
    got = mixing.mix(docs, quality, share=0.4).groupBy("source", F.expr("doc_id % 2")).agg(F.sum("taken"), F.first("target")).collect()
    taken = {(r[0], r[1]): r[2] for r in got}
    assert taken["x", 0] > 1.3 * taken["x", 1] and taken["y", 0] > 1.8 * taken["y", 1]  # x is taken by nine tenths, y by three
