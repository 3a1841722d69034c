"""Distinct-word encoding: each distinct word of the corpus is encoded once, and the ids are joined back by position.

Each block of documents (see ``common``) explodes its texts into distinct words and positions.  Only the distinct words
of the block travel to the shards of the word space; a shard encodes each word that it holds once, however many blocks
ask for it, and sends the ids back.  They are joined to the block's positions and put together again in their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm import common

#: Lists of each text's words
Find = Callable[[pa.Array], pa.ListArray]
Encode = Callable[[list[str]], list[list[int]]]
#: (rows of the documents, ids of each document, all ids one after the other) -> the rows to return
Shape = Callable[[pa.Array, np.ndarray, np.ndarray], pa.Table]


#: Random numbers for each byte at each of a word's first places, which spread words over shards.
PLACES = np.random.default_rng(1).integers(0, 1 << 63, (64, 256), dtype=np.uint64).ravel()


def _words(texts: pa.Array, find: Find, n_shards: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words in the order of their first use, the shard of each, all positions as word numbers, words of each text."""
    found = find(texts.fill_null(""))
    counts, coded = pc.list_value_length(found).to_numpy().astype(np.int64), found.flatten().dictionary_encode()
    lengths, data = common.runs(coded.dictionary)
    start = common.spans(lengths)[:-1]
    place = np.minimum(np.arange(len(data)) - np.repeat(start, lengths), 63)
    spread = np.add.reduceat(np.append(PLACES[place * 256 + data], np.uint64(0)), start) if len(start) else np.zeros(0, np.uint64)
    shard = (np.where(lengths > 0, spread, 0) % np.uint64(n_shards)).astype(np.uint32)
    return coded.dictionary, shard, coded.indices.to_numpy().astype(np.uint32), counts


def encode_words(docs: DataFrame, find: Find, encode: Encode, shape: Shape, schema: str, id_col: str, text_col: str, shard_bytes: int = 24 << 20) -> DataFrame:
    """``shape`` of the documents' ids.  ``find`` splits texts into words, ``encode`` encodes each of some distinct words.

    ``docs`` is read twice and has to give the same rows in the same order, as a stored table does.
    """
    n_shards = common.shards(docs, text_col, shard_bytes)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = common.id_type(docs, "id")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in common.blocks(batches):
            words, shard, _, _ = _words(texts, find, n_shards)
            order = np.argsort(shard, kind="stable")
            words, shard = words.take(pa.array(order)), shard[order]
            ends = np.append(np.flatnonzero(np.diff(shard)) + 1, len(shard)) if len(shard) else []
            for low, high in zip([0, *ends[:-1]], ends):
                lengths, data = common.runs(words.slice(low, high - low))
                yield pa.record_batch({"shard": pa.array([shard[low]], pa.int32()), "block": pa.array([name]),
                                       "lengths": pa.array([common.pack_ints(lengths.astype(np.uint32))], pa.binary()), "words": pa.array([common.squeeze(data.tobytes())], pa.binary())})

    def answered(table: pa.Table) -> pa.Table:
        common.trim()
        each = [common.from_runs(common.unpack_ints(n, np.uint32), common.expand(data)) for n, data in zip(table.column("lengths").to_pylist(), table.column("words").to_pylist())]
        coded = pa.concat_arrays(each).dictionary_encode()
        asked_at = np.split(coded.indices.to_numpy(), np.cumsum([len(x) for x in each])[:-1])
        ids = encode(coded.dictionary.to_pylist())
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat, starts = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum())), common.spans(lengths)[:-1]
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "lens": pa.array([common.pack_ints(lengths[at].astype(np.uint32)) for at in asked_at], pa.binary()),
                         "ids": pa.array([common.pack_ints(common.gather(flat, starts, lengths, at)) for at in asked_at], pa.binary())})

    def positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, texts in common.blocks(batches):
            _, shard, at, counts = _words(texts, find, n_shards)
            yield pa.record_batch({"block": pa.array([name]), "doc": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                                   "counts": pa.array([common.pack_ints(counts)], pa.binary()), "shard": pa.array([common.pack_ints(shard)], pa.binary()),
                                   "at": pa.array([common.pack_ints(at)], pa.binary())})

    def joined(left: pa.Table, right: pa.Table) -> pa.Table:
        common.trim()
        parts = [shape(pa.array([], left.schema.field("doc").type.value_type), np.zeros(0, np.int64), np.zeros(0, np.uint32))]
        answers = {s: (n, i) for s, n, i in zip(right.column("shard").to_pylist(), right.column("lens").to_pylist(), right.column("ids").to_pylist())}
        for row in range(left.num_rows):
            doc = left.column("doc").combine_chunks().slice(row, 1).flatten()
            counts, shard, at = (common.unpack_ints(left.column(c)[row].as_py(), t) for c, t in (("counts", np.int64), ("shard", np.uint32), ("at", np.uint32)))
            got = [common.unpack_ints(answers[s][0], np.uint32) for s in sorted(answers)]
            order = np.argsort(shard, kind="stable")
            if sorted(answers) != np.unique(shard).tolist() or sum(map(len, got)) != len(shard):
                raise RuntimeError("a block has other words than in the first pass: the input changes between reads; store it first")
            lens, starts = np.zeros(len(shard), np.int64), np.zeros(len(shard), np.int64)
            values = np.zeros(0, np.uint32)
            if got:
                lens[order] = np.concatenate(got)
                values = np.concatenate([common.unpack_ints(answers[s][1], np.uint32) for s in sorted(answers)])
            starts[order] = common.spans(lens[order])[:-1]
            parts.append(shape(doc, common.per_run(lens[at], counts), common.gather(values, starts, lens, at)))
        return pa.concat_tables(parts)

    found = docs.mapInArrow(asked, "shard int, block string, lengths binary, words binary").groupBy("shard").applyInArrow(answered, "block string, shard int, lens binary, ids binary")
    at = docs.mapInArrow(positions, f"block string, doc array<{kind}>, counts binary, shard binary, at binary")
    return at.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(joined, schema)
