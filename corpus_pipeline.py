"""The corpus pipeline over ``documents``: STAGES in order, each (name, function of (spark, docs, sf_dir)).

Every stage works on all that its predecessor kept, and all but the last return the columns of the documents.

Defined cases: documents with a null or empty text, without a letter, or with no more known n-grams than by chance in
any language (score 0: another script, say) are rejected by the first stage.  Rows that
share an id count as one document from the near-duplicate stage on, which keeps one of them; rows without an id are
never rejected as copies.  An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finlake.llm import jaccard, langid, lines, packing, toxicity
from finlake.llm.queries import LANG_HELD_OUT, TOXIC_HELD_OUT
from finlake.session import stored

#: The statement that gives run()'s rows; the trained stages cannot be put in SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; learns from those of them that op5 learns from."""
    filters = langid.fit(docs.filter(f"NOT {LANG_HELD_OUT}"))
    return langid.predict(docs, filters, lang_as="_lang", score_as="_score").filter((F.col("_lang") != langid.UNKNOWN) & (F.col("_score") > 0)).select(*docs.columns)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; learns from the labels that op9 learns from."""
    net = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), usable=f"NOT {TOXIC_HELD_OUT}")
    return toxicity.score(docs, net, column="_toxic").filter("_toxic < 0.5").select(*docs.columns)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are in many others; n_chars follows the text."""
    kept = lines.dedup(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    keep = jaccard.near_duplicates(docs).filter("doc_id = component_id").select("doc_id")
    return docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns).unionByName(docs.filter("doc_id IS NULL"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language), ("toxicity", clean), ("line_dedup", fresh_lines), ("ngram_jaccard_join", distinct_documents), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each but the last stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
