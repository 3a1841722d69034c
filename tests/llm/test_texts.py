"""Operators on texts against plain versions, over awkward documents."""

import hashlib
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from finlake.llm import bpe, jaccard, langid, licenses, lines, packing, quality, toxicity
from tests.llm import helpers as h

SF = "/root/testdata/sf0.01"

RANKS, WORD_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return h.documents(spark, h.awkward())


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def test_byte_bpe_is_the_librarys_and_comes_back(docs):
    got = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    one = bpe.encoder(RANKS, public_tokenizers.PATTERN).encode_ordinary
    want = [(i, len(x), np.array(x, "<u4").tobytes(), (t or "").encode()) for i, t in h.awkward() for x in [one(t or "")]]
    assert h.ordered((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in got) == h.ordered(want)


def test_unknown_id_is_an_error(spark):
    bad = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x00"))], "doc_id bigint, ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, RANKS).collect()


def test_packing_places_every_id_once(docs):
    got = packing.pack(docs, WORD_BPE, size=256).collect()
    t = packing.tokenizer(WORD_BPE)
    want = Counter(tuple([*t.encode(x or "", add_special_tokens=False).ids, 2]) for _, x in h.awkward())
    by, used = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length <= 256
        used[r.sequence_id].append((r.offset, r.length))
        by[r.doc_id, r.doc_tokens].append((r.start, tuple(ids.tolist())))
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    assert sum(n for x in by.values() for _, p in x for n in [len(p)]) == sum(len(x) * n for x, n in want.items())
    whole = {(i, len(x)): x for i, t_ in h.awkward() for x in [tuple([*t.encode(t_ or "", add_special_tokens=False).ids, 2])]}
    for k, parts in by.items():
        assert all(p == whole[k][s:s + len(p)] for s, p in parts)


def test_first_fit_decreasing_is_first_fit():
    lengths = np.random.default_rng(0).integers(1, 101, 500)
    sequence, offset = packing.first_fit_decreasing(lengths, 100)
    room, want = [], np.zeros(500, int)
    for k in np.argsort(-lengths, kind="stable"):
        at = next((b for b, r in enumerate(room) if r >= lengths[k]), len(room))
        if at == len(room):
            room.append(100)
        room[at] -= lengths[k]
        want[k] = at
    assert (sequence == want).all()
    assert all(sorted(zip(offset[sequence == b], lengths[sequence == b]))[0][0] == 0 for b in set(sequence))


def test_line_dedup(docs):
    got = lines.dedup(docs)
    assert got.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    rows = got.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect()
    assert h.ordered(tuple(r) for r in rows) == h.ordered(h.line_dedup(h.awkward()))
    assert sum(r[2] for r in rows) > 10


def test_similarity_join(docs):
    rows = h.awkward()
    sets = [h.shingles(t) for _, t in rows]
    at = h.components(sets)
    least = {}
    for (i, _), k in zip(rows, at):
        least[k] = min(x for x in (least.get(k), i) if x is not None) if (least.get(k), i) != (None, None) else None
    want = [(i, len(s), least[k] if s else i) for (i, _), s, k in zip(rows, sets, at)]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()]
    assert h.ordered(got) == h.ordered(want)


def test_similarity_join_of_a_large_group(spark):
    """A base with many copies of one to nine edits each, so that some link, some do not, in lists longer than a short one."""
    r = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = [(0, " ".join(base))]
    for k in range(1, 160):
        words = list(base)
        for at in r.choice(120, 1 + k % 9, replace=False):
            words[at] = f"x{r.integers(0, 60)}"
        rows.append((k, " ".join(words)))
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(h.documents(spark, rows)).collect()}
    assert [got[k] for k in range(160)] == h.components([h.shingles(t) for _, t in rows])
    assert 1 < len(set(got.values())) < 150


def test_similarity_join_of_short_documents(spark):
    """Near copies of 5 to 16 words in small lists: a pair shares fewer shingles than the largest k of a prefix."""
    r, rows = np.random.default_rng(4), [(0, "a b c d e f g"), (1, "a b c d e f g h")]
    for k in range(120):
        words = [f"b{k}x{j}" for j in range(5 + k % 12)]
        for j in range(1 + k % 3):
            rows.append((10 * (k + 1) + j, " ".join([words, [*words, f"end{k}"], [f"start{k}", *words], words[1:]][r.integers(4)])))
    got = {x.doc_id: x.component_id for x in jaccard.near_duplicates(h.documents(spark, rows)).collect()}
    want = h.components([h.shingles(t) for _, t in rows])
    assert got == {i: rows[k][0] for (i, _), k in zip(rows, want)}
    assert got[1] == 0


@pytest.mark.parametrize("percent", [1, 50, 75, 100])
def test_no_prefix_asks_for_more_than_a_partner_shares(percent):
    for n in range(1, 30):
        c = -(-n * percent // 100)
        for size in range(c, n + 1):
            for often in (2.0, 50.0):
                k, length = jaccard._choose(n, np.full(size, often), percent)
                assert 1 <= k <= c and length == size - c + k


def test_languages(docs):
    f = langid.fit(docs, sample_docs=50)
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in langid.predict(docs, f).collect()}
    for (_, text), (lang, score) in got.items():
        assert 0 <= score <= 1
        assert (lang == "und") == (not text or not any(map(str.isalpha, text)))
        assert lang in ("und", *f.langs)


def test_filters_hold_what_went_in(spark):
    rows = [(k, " ".join(f"{a}{b}{c}" for a in "bdf" for b in "aei" for c in s)) for k, s in enumerate(["nm", "xq"] * 20)]
    docs = h.documents(spark, rows)
    f = langid.fit(docs)
    assert set(f.langs) == {"de", "en"}
    for k, (_, text) in enumerate(rows[:2]):
        each, total = f.counts(text)
        assert each[k] > 0.5 * total
        assert f.predict(text)[0] == ("de", "en")[k]


def test_seventy_languages(spark):
    rows = [(k, f"l{k:02d}", " ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{a}{b}" for a in "aeiou" for b in "ptkl")) for k in range(70)]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    f = langid.fit(docs)
    assert f.langs == [lang for _, lang, _ in rows]
    assert {r.lang: r.lang_pred for r in langid.predict(docs, f).collect()} == {x: x for x in f.langs}


def test_repeated_rows_do_not_crowd_out_other_languages(spark):
    copies = spark.range(20_000).selectExpr("7L AS doc_id", "'aa' AS lang", "'zuzu zozo' AS text")
    few = spark.createDataFrame([(k, "bb", f"kiri mira sela {k}") for k in range(60)] + [(7, "aa", f"zuma zora {k}") for k in range(40)], "doc_id bigint, lang string, text string")
    both = copies.unionByName(few)
    fits = [langid.fit(d, sample_docs=30) for d in (both, both.repartition(5), both.coalesce(1))]
    assert all((f.slots == fits[0].slots).all() for f in fits)
    assert [fits[0].predict(x)[0] for x in ("kiri sela", "zora zuma", "zuzu")] == ["bb", "aa", "aa"]


def test_languages_of_held_out_documents(spark):
    got = entry.queries()["op5_language_id"](spark, SF).filter("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("lang IS NOT NULL AND lang_pred <> 'und'")
    right, n = got.selectExpr("count_if(lang = lang_pred)", "count(*)").first()
    assert n > 50 and right >= 0.95 * n


def test_quality_statistics(docs):
    got = quality.statistics(docs).select("doc_id", *quality.COUNTS).collect()
    want = []
    for i, text in h.awkward():
        w, seen, dup, mark = h.words(text), set(), 0, set()
        n = Counter(zip(w, w[1:], w[2:]))
        for k in range(len(w) - 2):
            if n[tuple(w[k:k + 3])] > 1:
                mark |= {k, k + 1, k + 2}
        for line in (text or "").split("\n"):
            if h.words(line):
                dup += line in seen
                seen.add(line)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(mark)))
    assert h.ordered(tuple(r) for r in got) == h.ordered(want)


def test_trees_keep_their_directions_and_learn():
    r = np.random.default_rng(2)
    x = r.random((800, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * r.random(800) > 0.6).astype(int)
    t = quality.train(x, y, [1, 0, -1], trees=20)
    assert ((t.score(x) > 0.5) == y).mean() > 0.9
    for f, way in ((0, 1), (2, -1)):
        line = np.repeat(r.random((50, 1, 3)), 30, 1)
        line[:, :, f] = np.linspace(0, 1, 30)
        assert (way * np.diff(t.score(line.reshape(-1, 3)).reshape(50, 30), axis=1) >= -1e-12).all()


def test_quality_without_labels_keeps_what_passes_the_rules(docs, spark):
    m = quality.statistics(docs)
    trees = quality.fit(m, spark.createDataFrame([], "doc_id bigint, quality int, toxic int"))
    got = quality.judge(m, trees).collect()
    assert all(r.kept != r.base_failed and r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) for r in got)


def test_network_gradients():
    net, r = toxicity.Network.new(), np.random.default_rng(0)
    net.weights = {k: v.astype(float) for k, v in net.weights.items()}
    v, at, size, y = r.standard_normal((10, 12)), r.integers(0, 10, (3, 5)), np.array([5, 3, 1]), np.array([1, 0, 1.0])
    at = np.where(np.arange(5) < size[:, None], at, 10)

    def loss():
        p = 1 / (1 + np.exp(-net.forward(net.gates(v), at, size)))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    logit, kept = net.forward(net.gates(v), at, size, keep=True)
    g, _ = net.backward((1 / (1 + np.exp(-logit)) - y) / 3, kept)
    for name in ("wh", "wa", "va", "out", "bias"):
        w = net.weights[name]
        k = tuple(s // 2 for s in w.shape)
        w[k] += 1e-4
        up = loss()
        w[k] -= 2e-4
        assert abs((up - loss()) / 2e-4 - g[name][k]) < 1e-4
        w[k] += 1e-4


def test_windows_cover_every_word():
    text, start, size = toxicity.windows(np.array([0, 1, 48, 49, 500]), 48, 32)
    for k, n in enumerate([0, 1, 48, 49, 500]):
        base = [0, 0, 1, 49, 98][k]
        assert {w for a, m in zip(start[text == k], size[text == k]) for w in range(a, a + m)} == set(range(base, base + n))


def test_toxic_words_are_learnt_and_found_deep_in_long_texts(spark):
    r = np.random.default_rng(1)
    word = lambda: "".join(r.choice(list("abdeilnorst"), 5))
    plain = lambda n: [word() for _ in range(n)]
    rows, labels = [], []
    for k in range(240):
        w = plain(40)
        if k % 2:
            w[int(r.integers(40))] = r.choice(["vileword", "nastyword"])
        rows.append((k, " ".join(w)))
        labels.append((k, k % 2))
    long = [w for k, t in rows if k % 2 == 0 for w in t.split()]
    rows += [(900, " ".join([*long[:3000], "Vileword!", *long[3000:]])), (901, " ".join(long)), (902, None), (903, " \n")]
    docs = h.documents(spark, rows)
    net = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    got = {x.doc_id: x.score for x in toxicity.score(docs, net).collect()}
    assert got[900] > 10 * got[901] and got[902] == got[903] == 0
    assert np.mean([(got[k] >= 0.5) == k % 2 for k in range(240)]) > 0.95


def test_toxicity_without_labels(docs, spark):
    net = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r.score for r in toxicity.score(docs, net).collect()} == {0.0}


def test_license_rules(spark):
    s = licenses.SENTENCES
    rows = [(1, f"Intro.\nReleased under the MIT License.\nx"), (2, f"{s[15].upper()}:\n{s[16]}!\n{s[26]}\n{s[17]}. {s[18]}"), (3, f"{s[17]}\n{s[16]}\n{s[15]}"), (4, "Licensed under the Apache License, Version 2.0."), (5, None), (6, "")]
    got = {r.doc_id: list(r.licenses) for r in licenses.scan(h.documents(spark, rows)).collect()}
    assert got == {1: ["MIT"], 2: ["BSD-2-Clause", "BSD-3-Clause", "all-rights-reserved"], 3: [], 4: ["Apache-2.0"], 5: [], 6: []}


def test_wrapped_licenses(spark):
    mit = """The MIT License (MIT)

    Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
    apache = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

    Unless required by applicable law"""
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed"
    bsd = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
    texts = [(mit.split("\n\n", 1)[1], "MIT"), (apache, "Apache-2.0"), (gpl, "GPL-2.0-or-later"), (mpl, "MPL-2.0"), (bsd, "BSD-2-Clause"), (licenses.SENTENCES[19], "ISC")]
    rows, want = [], {}
    for text, name in texts:
        for first in ("", " * ", "# ", "// ", "dnl ", "    "):
            for width in (9, 40, 72, 10_000):
                lines_ = [x for p in text.split("\n\n") for x in [*textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False), ""]]
                want[len(rows)] = [name]
                rows.append((len(rows), "\n".join(["int x;"] * (first != "dnl ") + [first + x for x in lines_] + ["int y;"])))
    rows += [(1000, "Permission is hereby granted, free of charge, to any person\nobtaining"), (1001, "Licensed under the Apache License, Version 2.0\n(the"), (1002, "all rights\nreserved today"), (1003, "Licensed under\nCC BY 4.0")]
    want |= {1000: [], 1001: ["Apache-2.0"], 1002: [], 1003: ["CC-BY-4.0"]}
    assert {r.doc_id: list(r.licenses) for r in licenses.scan(h.documents(spark, rows)).collect()} == want


def test_license_scan_is_native_and_without_shuffle(docs):
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_empty_tables(none, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert bpe.decode(bpe.encode(none, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0
    assert packing.pack(none, WORD_BPE).count() == 0
    assert lines.dedup(none).count() == 0
    assert jaccard.near_duplicates(none).count() == 0
    assert langid.predict(none, langid.fit(none)).count() == 0
    m = quality.statistics(none)
    assert quality.judge(m, quality.fit(m, labels)).count() == 0
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    assert licenses.scan(none).count() == 0


def test_crc_of_pieces(docs):
    rows = packing.pack(docs, WORD_BPE).select("ids", F.crc32("ids").alias("c")).collect()
    assert all(r.c == zlib.crc32(r.ids) for r in rows)
    assert hashlib.sha256(b"").hexdigest() == docs.filter("doc_id = 2").select(F.sha2("text", 256)).first()[0]
