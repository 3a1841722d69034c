"""Registered queries of this subpackage: name -> (query over a folder of tables, oracle SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import ann, bpe, jaccard, langid, licenses, lines, mixing, packing, periods, quality, terms, toxicity, warc
from finlake.session import stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Query, str | None]] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = (fn, sql)
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_ngram_jaccard_join", r"""
    WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
    l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 75 * (x.n + y.n - m)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(c) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op2_packing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op3_nearest_neighbours")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


@query("op4_warc_chunks", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS holder FROM pages)
    SELECT page_id, strlen(h) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             CAST(1 + ((CAST('0x' || substr(sha1(h), CAST(1 + 10 * (k // 8) AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (k % 8) AS INT)) & 31) AS BIGINT), 1)), '') AS payload_digest,
           CASE WHEN holder IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN holder IS DISTINCT FROM page_id THEN holder END AS refers_to FROM p""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


#: Rows that op5 keeps for measuring.
LANG_HELD_OUT = "crc32(CAST(doc_id AS STRING)) % 4 = 2"


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = langid.fit(docs.filter(f"NOT {LANG_HELD_OUT}"))
    return langid.predict(docs.select("doc_id", "text"), filters).select("doc_id", F.expr(f"coalesce({LANG_HELD_OUT}, false)").alias("held_out"), "lang_pred", "score")


@query("op6_quality_rules")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = stored(quality.statistics(table(spark, sf_dir, "documents").select("doc_id", "text")))
    trees = quality.fit(measured, table(spark, sf_dir, "labels"))
    return quality.judge(measured, trees).select("doc_id", *quality.COUNTS, "base_failed", "kept", "score")


@query("op7_line_dedup", r"""
    WITH line AS (
      SELECT doc_id, pos, l,
             translate(regexp_replace(l, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
      FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)),
    often AS (SELECT key, max(doc_id) AS holder FROM line WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    marked AS (SELECT line.*, coalesce(often.holder <> line.doc_id, FALSE) AS gone FROM line LEFT JOIN often USING (key))
    SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
           sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op8_license_scan", licenses.oracle("documents", "doc_id"))
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("licenses", F.array_join("licenses", ", "))


#: Rows whose labels op9 keeps for measuring.
TOXIC_HELD_OUT = "crc32(CAST(doc_id AS STRING)) % 5 = 0"


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"), usable=f"NOT {TOXIC_HELD_OUT}")
    return toxicity.score(docs, net).select("doc_id", F.expr(f"coalesce({TOXIC_HELD_OUT}, false)").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(tokens, path).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op11_filter_audit", r"""
    WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    g AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
    f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                 CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
                 + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                 + CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 16 ELSE 0 END AS m FROM d LEFT JOIN g USING (doc_id)),
    c AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
    l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
          FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
    s AS (SELECT filter_order, step, bits[step] AS bit, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS past FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
    r AS (SELECT part, filter_order, step, bit, sum(CASE WHEN m & (past + bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN m & bit > 0 AND m & past = 0 THEN n ELSE 0 END) AS removed,
                 sum(CASE WHEN m & bit > 0 AND m & past > 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN m = bit THEN n ELSE 0 END) AS unique_fails,
                 sum(CASE WHEN m & bit > 0 AND m & past = 0 THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN m & bit > 0 AND m & past = 0 THEN toxic ELSE 0 END) AS toxic_lost
          FROM c, s GROUP BY part, filter_order, step, bit)
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce("source", F.lit("")).alias("part"),
        (100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 5 * F.length(text)).alias("capitals"), text.rlike("[#$%&*|]").alias("symbols"))
    figures = terms.figures(terms.document_terms(docs, carried=["part", "capitals", "symbols"]))
    fails = {"A": F.expr("n_words < 50"), "B": F.expr("100 * n_distinct < 65 * n_words"), "C": F.col("capitals"), "D": F.col("symbols"), "E": F.expr("first_id < doc_id")}
    return terms.audit(figures, fails, table(spark, sf_dir, "labels"))


#: Weights of documents in op12 by their label: good ones come first twice as often as those without a label, others half as often.
GOOD, OTHER = 2.0, 0.5


@query("op12_source_mixing", rf"""
    WITH q AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN {GOOD} ELSE {OTHER} END) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
    d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                 -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 12) AS BIGINT) + 0.5) / 281474976710656.0) / coalesce(quality, 1.0) AS key
          FROM documents LEFT JOIN q USING (doc_id)),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    w AS (SELECT source, source_size, 2.0 * source_size AS cap, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST)) % 3 WHEN 1 THEN 3.0 WHEN 2 THEN 1.0 ELSE 2.0 END AS w FROM s),
    ranked AS (SELECT *, row_number() OVER (ORDER BY cap / w, w, source ASC NULLS LAST) AS k FROM w),
    levels AS (SELECT r.*, (SELECT (1.5 * sum(source_size) - coalesce(sum(cap) FILTER (x.k < r.k), 0)) / sum(w) FILTER (x.k >= r.k) FROM ranked x) AS level FROM ranked r),
    t AS (SELECT source, source_size, least(cap, coalesce(w * (SELECT max(level) FROM levels WHERE cap > w * level), cap)) AS target FROM levels),
    e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
    p AS (SELECT doc_id, size, source_size, target, epochs, CAST(floor(target - epochs * source_size) AS BIGINT)
                 - sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) + size AS room
          FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
    SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(size * epochs + greatest(0, least(size, room)) AS BIGINT) AS taken FROM p""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter("quality IS NOT NULL").select("doc_id", F.when(F.col("quality") == 1, GOOD).otherwise(OTHER).alias("quality"))
    return mixing.mix(table(spark, sf_dir, "documents"), labels).select("doc_id", "size", "source_size", "target", "taken")


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the contract's planted tails: from word a = g % n on, the text repeats its next p words
    tail = """h % 10 = 0 AND size(w) > 0, array_join(transform(w, (x, i) -> CASE WHEN i < a THEN x ELSE w[a + (i - a) % (1 + floor((size(w) - a) / (3 + g % 8)))] END), ' '), text"""
    planted = docs.withColumn("h", F.expr("crc32(CAST(doc_id AS STRING))")).filter("h % 10 = 0").withColumn("g", F.expr("CAST(floor(h / 10) AS BIGINT)"))
    planted = planted.withColumn("w", F.expr(r"regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0)")).withColumn("a", F.expr("CAST(if(size(w) > 0, g % size(w), 0) AS INT)"))
    planted = planted.select("doc_id", F.expr(f"if({tail})").alias("text"))
    texts = docs.filter("coalesce(crc32(CAST(doc_id AS STRING)) % 10 <> 0, true)").unionByName(planted)
    found = periods.find_runs(texts)
    top = F.expr("""reduce(runs, CAST(NULL AS STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>),
        (top, r) -> CASE WHEN top IS NULL OR r.length * top.period > top.length * r.period THEN r ELSE top END)""")
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.withColumn("top", top).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period", F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
