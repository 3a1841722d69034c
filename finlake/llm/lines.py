"""Corpus-wide line dedup: documents probe a sharded minimal perfect hash instead of joining lines.

``build`` hashes the key of every long line, counts each distinct line's documents per block and then per shard of the
hash space, and makes one index row for a shard: a minimal perfect hash over the shard's distinct line hashes, and the
arrays it points into (fingerprint, number of documents, largest document id).  ``dedup`` sends each block's distinct
line hashes to the shards, looks them up there, and drops lines of the block's documents by the answers.  A line in
every document costs one entry for each block, whatever its number of documents.

Lines are told apart by 128 hash bits (64 as the key of the perfect hash, 64 as the fingerprint).

Defined cases: each row is a document; rows sharing the largest id of a line all keep it.  A null id is smaller than
any.  A null or empty text is one empty line; a text whose lines all go becomes empty.  Lines repeated within a document
count it once, and all go or all stay.  An empty table gives an empty table; further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm import common, mph

BLANK = b" \t\n\x0b\x0c\r"
NO_ID = np.iinfo(np.int64).min


def _keys(texts: list[str | None], min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (low, high) of the block's distinct keys, the key number of each line (-1: short), lines of each text."""
    number: dict[bytes, int] = {}
    at, counts = [], np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
        counts[k] = len(lines)
        for line in lines:
            key = line.strip(BLANK)
            if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "surrogatepass")) < min_chars):
                at.append(-1)
            else:
                at.append(number.setdefault(key.lower(), len(number)))
    raw = b"".join(xxhash.xxh3_128_digest(k) for k in number)
    both = np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)
    return both, np.array(at, np.int64), counts


def _by_shard(both: np.ndarray, n_shards: int) -> list[np.ndarray]:
    """Numbers of the keys, in their order, for each shard that has any."""
    shard = both[:, 1] % np.uint64(n_shards)
    order = np.argsort(shard, kind="stable")
    return [p for p in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(p)]


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, shard_bytes: int = 48 << 20) -> DataFrame:
    """The index: a row for each shard (shard, shards, sizes, bits, fingerprints, counts, holders)."""
    n_shards = common.shards(docs, text_col, shard_bytes)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, texts in common.blocks(batches):
            both, at, counts = _keys(texts.to_pylist(), min_chars)
            doc = np.repeat(np.arange(len(texts)), counts)[at >= 0]
            pairs = np.unique(at[at >= 0] * len(texts) + doc)
            key, doc = pairs // max(len(texts), 1), pairs % max(len(texts), 1)
            held = np.full(len(both), NO_ID)
            np.maximum.at(held, key, np.array([NO_ID if i is None else i for i in ids.to_pylist()], np.int64)[doc])
            docs_of = np.bincount(key, minlength=len(both)).astype(np.uint64)
            for part in _by_shard(both, n_shards):
                yield pa.record_batch({"shard": pa.array([int(both[part[0], 1] % np.uint64(n_shards))], pa.int32()), "hashes": pa.array([both[part].tobytes()], pa.binary()),
                                       "counts": pa.array([common.pack_ints(docs_of[part])], pa.binary()), "holders": pa.array([common.pack_ints(held[part])], pa.binary())})

    def indexed(table: pa.Table) -> pa.Table:
        common.trim()
        both = np.frombuffer(b"".join(table.column("hashes").to_pylist()), np.uint64).reshape(-1, 2)
        counts, holders = (np.concatenate([common.unpack_ints(x, t) for x in table.column(c).to_pylist()]) for c, t in (("counts", np.uint64), ("holders", np.int64)))
        order = np.lexsort((both[:, 0], both[:, 1]))
        first = np.flatnonzero(np.concatenate([[True], np.any(np.diff(both[order], axis=0) != 0, axis=1)]))
        distinct, total, most = both[order[first]], np.add.reduceat(counts[order], first), np.maximum.reduceat(holders[order], first)
        # lines that differ but share the key of the perfect hash (one in 2**64 pairs) take the key from both halves
        mixed = len(np.unique(distinct[:, 0])) != len(distinct)
        keys = mph.mix(distinct[:, 0], 7) ^ distinct[:, 1] if mixed else distinct[:, 0]
        sizes, bits = mph.build(keys)
        at = mph.probe(sizes, bits, keys)
        fingerprints, n, holder = np.empty(len(keys), np.uint64), np.empty(len(keys), np.uint64), np.empty(len(keys), np.int64)
        fingerprints[at], n[at], holder[at] = distinct[:, 1], total, np.where(total > 1, most, 0)
        return pa.table({"shard": table.column("shard")[:1], "mixed": pa.array([mixed]), "sizes": pa.array([sizes.tobytes()], pa.binary()), "bits": pa.array([bits], pa.binary()),
                         "fingerprints": pa.array([fingerprints.tobytes()], pa.binary()), "counts": pa.array([common.pack_ints(n)], pa.binary()), "holders": pa.array([common.pack_ints(holder)], pa.binary())})

    lines = docs.select(F.col(id_col).cast("bigint").alias("id"), text_col).mapInArrow(counted, "shard int, hashes binary, counts binary, holders binary")
    schema = "shard int, mixed boolean, sizes binary, bits binary, fingerprints binary, counts binary, holders binary"
    return lines.groupBy("shard").applyInArrow(indexed, schema).select("shard", F.lit(n_shards).alias("shards"), *[c.split()[0] for c in schema.split(", ")[1:]])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 5, min_chars: int = 40, shard_bytes: int = 48 << 20) -> DataFrame:
    """``docs`` without its repeated lines: its columns, with the kept lines as text, and n_lines, n_dropped (long).

    A line goes if its key has at least ``min_chars`` code points and is in at least ``min_docs`` documents, and the
    document is not the one with the largest id among them.  The key is the line without blanks at both ends, A-Z in
    lower case.  ``docs`` is read three times and has to give the same rows in the same order, as a stored table does.
    """
    docs = docs.drop("n_lines", "n_dropped")
    n_shards = common.shards(docs, text_col, shard_bytes)
    index = build(docs, id_col, text_col, min_chars, shard_bytes)
    carried = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(F.col(id_col).cast("bigint").alias("id"), F.struct(*carried).alias("row")).alias("row"), text_col)
    row_type = rows.schema["row"].dataType.simpleString()

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in common.blocks(batches):
            both, _, _ = _keys(texts.to_pylist(), min_chars)
            for part in _by_shard(both, n_shards):
                yield pa.record_batch({"shard": pa.array([int(both[part[0], 1] % np.uint64(n_shards))], pa.int32()), "block": pa.array([name]), "hashes": pa.array([both[part].tobytes()], pa.binary())})

    def probed(questions: pa.Table, index: pa.Table) -> pa.Table:
        common.trim()
        out = {"block": [], "shard": [], "drop": [], "holders": []}
        if index.num_rows and questions.num_rows:
            sizes, fingerprints = (np.frombuffer(index.column(c)[0].as_py(), t) for c, t in (("sizes", np.int64), ("fingerprints", np.uint64)))
            n, holder = (common.unpack_ints(index.column(c)[0].as_py(), t) for c, t in (("counts", np.uint64), ("holders", np.int64)))
            bits, mixed = index.column("bits")[0].as_py(), index.column("mixed")[0].as_py()
            both = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in questions.column("hashes").to_pylist()]
            ends, both = np.cumsum([len(b) for b in both])[:-1], np.concatenate(both)
            at = mph.probe(sizes, bits, mph.mix(both[:, 0], 7) ^ both[:, 1] if mixed else both[:, 0])
            drop = (at >= 0) & (fingerprints[at] == both[:, 1]) & (n[at] >= min_docs)
            out["drop"] = [common.squeeze(np.packbits(x).tobytes()) for x in np.split(drop, ends)]
            out["holders"] = [common.squeeze(x.tobytes()) for x in np.split(np.where(drop, holder[at], 0), ends)]
            out["block"], out["shard"] = questions.column("block").to_pylist(), questions.column("shard").to_pylist()
        return pa.table({"block": pa.array(out["block"], pa.string()), "shard": pa.array(out["shard"], pa.int32()), "drop": pa.array(out["drop"], pa.binary()), "holders": pa.array(out["holders"], pa.binary())})

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows, texts in common.blocks(batches):
            yield pa.record_batch({"block": pa.array([name]), "rows": pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows), "texts": pa.array([common.pack_words([t or "" for t in texts.to_pylist()])], pa.binary())})

    def dropped(left: pa.Table, right: pa.Table) -> pa.Table:
        common.trim()
        kind = left.schema.field("rows").type.value_type
        out, parts = {"n_lines": [], "n_dropped": [], "text": []}, [pa.array([], kind)]
        answers = {s: (np.unpackbits(np.frombuffer(common.expand(d), np.uint8)).astype(bool), np.frombuffer(common.expand(h), np.int64))
                   for s, d, h in zip(*(right.column(c).to_pylist() for c in ("shard", "drop", "holders")))}
        for row in range(left.num_rows):
            rows = left.column("rows").combine_chunks().slice(row, 1).flatten()
            parts.append(rows)
            texts = common.unpack_words(left.column("texts")[row].as_py(), len(rows))
            both, at, counts = _keys(texts, min_chars)
            drop, holder = np.zeros(len(both) + 1, bool), np.zeros(len(both) + 1, np.int64)  # the last is for short lines
            for part in _by_shard(both, n_shards):
                d, h = answers[int(both[part[0], 1] % np.uint64(n_shards))]
                if len(h) != len(part):
                    raise RuntimeError("a block has other lines than in the first pass: the input changes between reads; store it first")
                drop[part], holder[part] = d[:len(part)], h
            ids = np.array([NO_ID if i is None else i for i in rows.field("id").to_pylist()], np.int64)
            goes = drop[at] & (holder[at] != np.repeat(ids, counts))
            ends = common.spans(counts)
            for k, text in enumerate(texts):
                mine = goes[ends[k]:ends[k + 1]]
                n = int(mine.sum())
                out["n_lines"].append(len(mine))
                out["n_dropped"].append(n)
                out["text"].append("\n".join(line for line, gone in zip(text.split("\n"), mine) if not gone) if n else text)
        return pa.table({"row": pa.chunked_array(parts).combine_chunks(), **{c: pa.array(out[c], pa.string() if c == "text" else pa.int64()) for c in out}})

    asked_rows = rows.mapInArrow(asked, "shard int, block string, hashes binary")
    found = asked_rows.groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(probed, "block string, shard int, drop binary, holders binary")
    texts = rows.mapInArrow(held, f"block string, rows array<{row_type}>, texts binary")
    kept = texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(dropped, f"row {row_type}, n_lines bigint, n_dropped bigint, text string")
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.row.{c}") if "." not in c and "`" not in c else F.col(f"row.row.`{c}`") for c in docs.columns], "n_lines", "n_dropped")
