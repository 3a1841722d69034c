"""Vectors, archives, the perfect hash, components, the registered queries and the pipeline."""

import base64
import gzip
import hashlib
import os

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from finlake.llm import ann, mph, warc
from finlake.llm.components import components
from finlake.session import scratch_path, stored
from tests.llm import helpers as h
from tools.compare import canon, key

SF = "/root/testdata/sf0.001"


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_numbers_its_keys(keys):
    keys = np.array(sorted(keys), np.uint64)
    assert sorted(mph.probe(*mph.build(keys), keys)) == list(range(len(keys)))


@pytest.mark.parametrize("links", [[], [(1, 2)], [(k, k + 1) for k in range(40)], [(5, 5)], [(0, k) for k in range(1, 30)] + [(50, 51), (51, 29)]])
def test_components(spark, links):
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {}
    for a, b in links:
        if a != b:
            x, y = want.get(a, {a}), want.get(b, {b})
            for n in x | y:
                want[n] = x | y
    assert got == {n: min(s) for n, s in want.items()}
    assert got == {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint").repartition(3), block=4).collect()}


def vectors(spark, rows):
    return stored(spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], "vec_id bigint, embedding array<float>, rank int, id int, bucket string"))


def nearest(rows, k):
    use = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and v is not None and len(v) == 6 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q in sorted({i for i, _ in use if i % 10 == 0}):
        best = {}
        for _, a in (x for x in use if x[0] == q):
            for i, v in use:
                if i != q:
                    d = float(np.sqrt(((v - a) ** 2).sum()))
                    best[i] = min(best.get(i, np.inf), d)
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(sorted((d, i) for i, d in best.items())[:k])]
    return out


def test_neighbours_when_all_buckets_are_probed(spark):
    r = np.random.default_rng(0)
    rows = [(k, r.standard_normal(6).round(2).tolist()) for k in range(120)]
    rows += [(200 + k, rows[3][1]) for k in range(15)] + [(10, rows[10][1])]  # copies tie, a repeated row
    rows += [(300, None), (310, [0.0] * 6), (320, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (330, [float("nan")] * 6), (340, [float("inf")] * 6), (350, [1.0] * 5), (None, [1.0] * 6)]
    got = ann.search(vectors(spark, rows), "vec_id % 10 = 0", k=5, tables=2, hashes=2, width=4.0, probes=25, part_rows=40, part_queries=10)
    want = nearest(rows, 5)
    got = sorted(tuple(x) for x in got.collect())
    assert [x[:3] for x in got] == [x[:3] for x in want]
    assert np.allclose([x[3] for x in got], [x[3] for x in want], atol=1e-12)


def test_fewer_candidates_and_none(spark):
    two = vectors(spark, [(0, [1.0] * 6), (1, [2.0] * 6)])
    assert [(r.query_id, r.rank, r.vec_id) for r in ann.search(two, "vec_id % 100 = 0").collect()] == [(0, 1, 1)]
    assert ann.search(two.filter("false"), "vec_id % 100 = 0").count() == 0


@pytest.mark.parametrize("n", [5, 9, 11])
def test_small_tables_give_all_candidates(spark, n):
    rows = [(k, v.tolist()) for k, v in enumerate(np.random.default_rng(n).standard_normal((n, 64)))]
    got = {}
    for r in ann.search(vectors(spark, rows), "vec_id >= 0").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    x = np.array([v for _, v in rows], np.float32).astype(float)
    assert got == {q: sorted(set(range(n)) - {q}, key=lambda k: ((x[k] - x[q]) ** 2).sum())[:10] for q in range(n)}


def test_queries_of_one_id_with_two_vectors(spark):
    draw = np.random.default_rng(4)
    rows = [(k, draw.standard_normal(6).tolist()) for k in range(300)] + [(10, draw.standard_normal(6).tolist()), (20, [9.0] * 6)]
    for order in (rows, rows[::-1]):
        got = ann.search(vectors(spark, order).repartition(3), "vec_id % 10 = 0", k=5, tables=2, hashes=2, width=4.0, probes=25, part_rows=40, part_queries=10).collect()
        assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [x[:3] for x in nearest(rows, 5)]


def test_components_of_any_finite_size(spark):
    rows = [(k, [s * (k + 1), s * 2.0, -s]) for k, s in enumerate([1e200] * 5)] + [(10 + k, [1e-200 * (k + 1), 0.0, 0.0]) for k in range(3)]
    df = stored(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.search(df, "vec_id IN (0, 10)", k=7).collect()}
    assert len(got) == 14 and [got[0, k][0] for k in range(1, 8)] == [1, 2, 10, 11, 12, 3, 4] and got[0, 1][1] == pytest.approx(1e200)
    assert got[10, 1] == (11, pytest.approx(1e-200)) and got[10, 2] == (12, pytest.approx(2e-200))


def test_of_two_lengths_as_frequent_the_shorter_counts(spark):
    df = spark.createDataFrame([(k, [1.0 + k] * (2 + k % 2)) for k in range(8)], "vec_id bigint, embedding array<double>")
    assert {r.vec_id for r in ann.search(df, "vec_id = 0").collect()} == {2, 4, 6}


def test_outliers_have_neighbours(spark):
    """A tight cluster and scattered vectors of five times its norm, whose buckets hold too few others."""
    r = np.random.default_rng(8)
    x = np.concatenate([r.standard_normal(64) / 8 + 0.02 * r.standard_normal((3000, 64)), 5 / 8 * r.standard_normal((60, 64))]).astype(np.float32)
    found = ann.search(vectors(spark, [(k, v.tolist()) for k, v in enumerate(x)]), "vec_id >= 3000 AND vec_id % 4 = 0 OR vec_id = 7", part_rows=700, part_queries=4)
    got = {}
    for row in found.orderBy("query_id", "rank").collect():
        got.setdefault(row.query_id, []).append(row.vec_id)
    assert sorted(got) == [7, *range(3000, 3060, 4)] and {len(v) for v in got.values()} == {10}
    hit = []
    for q, ids in got.items():
        d = ((x.astype(float) - x[q]) ** 2).sum(1)
        d[q] = np.inf
        assert len(set(ids)) == 10 and q not in ids
        hit.append(len(set(ids) & set(np.argsort(d)[:10].tolist())))
    assert np.mean(hit[1:]) > 8


def test_perturbations_come_in_the_order_of_their_cost():
    low = np.array([0.1, 0.4, 0.7])
    found = ann.perturbations(low, 1 - low, 27)
    cost = [sum((low[d] if s < 0 else 1 - low[d]) ** 2 for d, s in p) for p in found]
    assert len(set(found)) == len(found) == 27 and cost == sorted(cost)


def test_recall_on_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    x = np.array([v for _, v in rows])
    got = {}
    for r in entry.queries()["op3_nearest_neighbours"](spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = []
    for q, s in got.items():
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit.append(len(s & set(np.argsort(d)[:10])) / 10)
    assert np.mean(hit) >= 0.9


def test_archives(spark):
    big = "x" * (3 * warc.CHUNK + 17) + "ü"
    rows = [(1, "http://a/ b", "<p>ü</p>"), (2, None, "<p>ü</p>"), (3, "u", None), (4, "u", ""), (5, "u", big), (6, "u", "WARC/1.1\r\n\r\n"), (7, "u", big), (7, "u", big), (None, "u", "only"), (9, "u", "x\r\n")]
    pages = stored(spark.createDataFrame([(*r, 1, "d") for r in rows], "page_id bigint, url string, html string, chunk int, digest string"))
    got = warc.round_trip(pages)
    want = []
    for i, _, t in rows:
        b = (t or "").encode()
        same = [j for j, _, x in rows if (x or "") == (t or "") and j is not None]
        holder = max(same) if same else None
        again = i != holder
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if again else "response", holder if again else None))
    assert h.ordered(tuple(r) for r in got.collect()) == h.ordered(want)


def test_archives_are_streamed_by_chunks_and_readable(spark, tmp_path):
    big = "y" * (2 * warc.CHUNK + 5)
    pages = spark.createDataFrame([(1, "u", big), (2, "u", "z")], "page_id bigint, url string, html string")
    folder = f"file://{tmp_path}/arc"
    manifest = warc.write(pages, folder)
    chunks = warc.read(manifest, folder).orderBy("record_id", "chunk").collect()
    assert [(r.record_id, r.chunk, len(r.data), r.last) for r in chunks] == [(1, 0, warc.CHUNK, False), (1, 1, warc.CHUNK, False), (1, 2, 5, True), (2, 0, 1, True)]
    assert chunks[1].digest == base64.b32encode(hashlib.sha1(b"y" * 2 * warc.CHUNK).digest()).decode()
    text = b"".join(gzip.open(tmp_path / "arc" / f).read() for f in os.listdir(tmp_path / "arc") if f.endswith(".gz"))
    assert text.count(b"WARC-Type: response\r\n") == 2 and big.encode() + b"\r\n\r\n" in text


def test_long_payloads_travel_as_chunks_and_archives_are_read_by_a_task_each(spark, tmp_path):
    pages = stored(spark.range(40).selectExpr("id AS page_id", "'u' AS url", "CASE WHEN id = 7 THEN repeat('0123456789abcdef', 4 << 20) WHEN id % 3 = 0 THEN 'the same' ELSE concat('page ', id) END AS html"))
    chunks = warc.chunked(pages)
    assert chunks.filter("id = 7").count() == 64 and chunks.selectExpr("max(length(data)) AS n").first().n == warc.CHUNK
    folder = f"file://{tmp_path}/arc"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = warc.write(pages.repartition(20), folder)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    archives = manifest.count()
    rows = warc.read(manifest, folder, with_data=False)
    assert archives > 1 and rows.rdd.getNumPartitions() == archives and rows.filter("data IS NOT NULL").count() == 0
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.payloads(rows).collect()}
    assert len(got) == 40 and got[7] == (64 << 20, "response", None) and got[39][1] == "response" and got[3] == (8, "revisit", 39)
    whole = warc.read(manifest, folder).filter("record_id = 7").selectExpr("count(*) AS n", "sum(length(data)) AS size", "max(IF(last, digest, NULL)) AS digest").first()
    assert (whole.n, whole.size, whole.digest) == (64, 64 << 20, base64.b32encode(hashlib.sha1(b"0123456789abcdef" * (4 << 20)).digest()).decode())


def test_small_payloads_are_never_revisits(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id bigint, url string, html string")
    assert {r.page_id: r.record_type for r in warc.round_trip(pages, least_bytes=3).collect()} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(canon(r[c]) for c in cols) for r in df.collect()), key=key)
    rel = con.sql(entry.oracle_sql()[name])
    at = {c: k for k, c in enumerate(rel.columns)}
    assert got == sorted((tuple(canon(r[at[c]]) for c in cols) for r in rel.fetchall()), key=key)


def test_pipeline_stage_by_stage(spark, tmp_path):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()] + h.awkward()
    docs = h.documents(spark, [(i if i is None or i > 99 else 10_000 + i, t) for i, t in rows])
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    stages, held = dict(corpus_pipeline.STAGES), {}
    for name, fn in corpus_pipeline.STAGES:
        held[name] = docs
        out = stored(fn(spark, docs, str(tmp_path)))
        assert name == "packing" or out.columns == docs.columns
        docs = out
    assert list(stages) == ["language_id", "toxicity", "line_dedup", "ngram_jaccard_join", "packing"]
    pairs = {n: h.ordered((r.doc_id, r.text) for r in d.select("doc_id", "text").collect()) for n, d in held.items()}
    assert pairs["toxicity"] == [r for r in pairs["language_id"] if r[1] and any(map(str.isalpha, r[1]))]
    assert len(pairs["line_dedup"]) > 0.8 * len(pairs["toxicity"])
    want = h.line_dedup(pairs["line_dedup"])
    got = [(i, hashlib.sha256(t.encode()).hexdigest()) for i, t in pairs["ngram_jaccard_join"]]
    assert h.ordered(got) == h.ordered((x[0], x[3]) for x in want)
    before = pairs["ngram_jaccard_join"]
    at = h.components([h.shingles(t) for _, t in before])
    least = {}
    for (i, _), k in zip(before, at):
        if i is not None:
            least[k] = min(i, least.get(k, i))
    assert {i for i, _ in pairs["packing"] if i is not None} == {i for (i, t), k in zip(before, at) if i is not None and least[k if h.shingles(t) else k] == i}
    assert {r.doc_id for r in docs.collect()} == {i for i, _ in pairs["packing"]}


def test_pipeline_rejects_texts_in_no_learnt_language(spark):
    rows = [(k, " ".join(f"{a}{b}{c}" for a in "bdf" for b in "aei" for c in s)) for k, s in enumerate(["nm", "xq"] * 40)]
    docs = h.documents(spark, [*rows, (100, None), (101, "1 2"), (102, "日本語 の 文書 です")]).withColumn("lang", F.expr("IF(doc_id < 100, lang, NULL)"))
    assert sorted(r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()) == [k for k, _ in rows]


def test_pipeline_on_nothing(spark, tmp_path):
    h.documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_scratch_is_one_folder_for_the_session(spark):
    assert os.path.dirname(scratch_path(spark, "a")) == os.path.dirname(scratch_path(spark, "b"))
