"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

Encoding.  Texts are exploded into pre-tokens and positions, each distinct pre-token of the corpus is encoded once, and
the ids are joined back and put together in the order of the positions (see ``words``).

Decoding joins ids with the token-byte table, which has a row for each id of the vocabulary and so a proven bound; every
task looks the bytes up in it.

Defined cases: a null or empty text has no tokens and decodes to no bytes; repeated rows are encoded row by row; a null
id column is carried as null; an empty table gives an empty table; only the id and text columns are read, so further columns may have
any name.  Very long texts make a block of their own.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm import common, words


@functools.lru_cache(maxsize=2)
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from a rank file: base64 of the bytes, blank, rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks(path), special_tokens={})


@functools.lru_cache(maxsize=2)
def splitter(pattern: str):
    import regex

    return regex.compile(pattern)


@functools.lru_cache(maxsize=2)
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token-byte table: all bytes, and start and length by id."""
    by_id = {i: b for b, i in ranks(path).items()}
    table = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
    lengths = np.array([len(b) for b in table], np.int64)
    return np.frombuffer(b"".join(table), np.uint8), common.spans(lengths)[:-1], lengths


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens long, ids binary): the ids of each text as little-endian unsigned 32-bit integers.

    ``docs`` is read twice and has to give the same rows in the same order, as a stored table does.
    """
    def find(texts: pa.Array) -> pa.ListArray:
        return pa.array(map(splitter(pattern).findall, texts.to_pylist()), pa.list_(pa.string()))

    def each(found: list[str]) -> list[list[int]]:
        return [*map(encoder(rank_path, pattern).encode_ordinary, found)]

    def shape(doc: pa.Array, n: np.ndarray, ids: np.ndarray) -> pa.Table:
        return pa.table([doc, pa.array(n), common.as_binary(ids, n, 4)], names=[id_col, "n_tokens", "ids"])

    return words.encode_words(docs, find, each, shape, f"{id_col} {common.id_type(docs, id_col)}, n_tokens bigint, ids binary", id_col, text_col)


def decode(tokens: DataFrame, rank_path: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with a column decoded binary: the bytes of the ids; null ids decode to no bytes.

    An id outside the vocabulary has no row in the token-byte table and raises an error.
    """
    tokens = tokens.drop("decoded")
    names = tokens.columns
    k = names.index(ids_col)

    def looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, starts, lengths = token_bytes(rank_path)
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                part = batch.slice(low, 1000)
                raw = part.column(k).to_pylist()
                ids = np.frombuffer(b"".join(x or b"" for x in raw), "<u4")
                n = np.array([len(x or b"") // 4 for x in raw], np.int64)
                if len(ids) and ids.max() >= len(lengths):
                    raise ValueError(f"id {ids.max()} is not in the vocabulary")
                out = common.as_binary(common.gather(data, starts, lengths, ids), common.per_run(lengths[ids], n), 1)
                yield pa.RecordBatch.from_arrays([*part.columns, out], names=[*names, "decoded"])

    return tokens.mapInArrow(looked_up, tokens.withColumn("decoded", F.lit(None).cast("binary")).schema)
