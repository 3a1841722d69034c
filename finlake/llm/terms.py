"""Sparse document-term matrix, and the audit of how filters interact that reads it.

Matrix.  Each block of documents (see ``common``) finds the distinct words of its texts and, for each text, which of them it
holds how often.  The block's distinct words go to the shards of the word space; a shard numbers the words that it holds in their order, so
a term id (shard + shards * number) is the same in every run; the ids come back to the block, which becomes a CSR shard: row
pointers, term ids, counts.  Digests of whole texts travel with the words, each once for a block with its smallest id, and
come back with the smallest id of the whole table; so equal texts never meet as rows, however many there are.

Audit.  Row sums are numbers of words, lengths of rows are numbers of distinct words.  With the flags of the texts, documents are
counted by part, set of failed filters and labels; a part has at most 2**filters * 4 such counts, from which every order
and step follows by a product with one fixed 0/1 matrix.

Defined cases: a null or empty text is a row without terms and equals other empty texts; a row without an id has no labels, is never a copy
and makes no other row one; rows that repeat are documents of their own and, having the same id, no copies of each other; an id with several
labels has a label if one of its rows says so; a null part is the empty string; an empty table gives an empty table.  Ids have
to be whole numbers.  Columns named in ``carried`` may have any name.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.llm import common
from finlake.llm.periods import words_of
from finlake.llm.words import PLACES
from finlake.session import stored

#: Stands for a row without an id.
NO_ID = np.iinfo(np.int64).max
ASKED = "array<struct<shard:int,lengths:binary,words:binary,digests:binary,ids:binary>>"


def packed(values: np.ndarray) -> bytes:
    return common.pack_ints(values) if len(values) else b""


def unpacked(data: bytes, dtype) -> np.ndarray:
    return common.unpack_ints(data, dtype) if data else np.zeros(0, dtype)


def _shards(lengths: np.ndarray, data: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of each word."""
    start = common.spans(lengths)[:-1]
    place = np.minimum(np.arange(len(data)) - np.repeat(start, lengths), 63)
    return (np.add.reduceat(PLACES[place * 256 + data], start) % np.uint64(n_shards)).astype(np.int64) if len(start) else np.zeros(0, np.int64)


def _cuts(shard: np.ndarray) -> dict[int, slice]:
    """Where each shard's items are in an array that is ordered by shard."""
    ends = [*(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)] if len(shard) else []
    return {int(shard[low]): slice(low, high) for low, high in zip([0, *ends[:-1]], ends)}


def document_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carried: list[str] | None = None, shard_bytes: int = 24 << 20) -> DataFrame:
    """CSR shards: (block, rows: array of (id, the carried columns), indptr, terms, counts, first_ids), the last four as little-endian binaries.

    ``indptr`` has 64-bit row pointers, ``terms`` 64-bit term ids (rising in the numbers of the block, not in the ids), ``counts`` 32-bit
    counts, and ``first_ids`` the 64-bit smallest id with the same text, for each row.
    """
    n_shards = common.shards(docs, text_col, shard_bytes)
    rows = docs.select(F.struct(F.col(id_col).cast("bigint").alias("id"), F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in carried or []]).alias("row")).alias("row"), F.col(text_col).alias("text"))
    row_type = rows.schema["row"].dataType.simpleString()
    ask_type = pa.struct([("shard", pa.int32()), ("lengths", pa.binary()), ("words", pa.binary()), ("digests", pa.binary()), ("ids", pa.binary())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, row, texts in common.blocks(batches):
            words, n = words_of(texts)
            coded = words.dictionary_encode()
            lengths, data = common.runs(coded.dictionary)
            shard = _shards(lengths, data, n_shards)
            order = np.argsort(shard, kind="stable")
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            cells, times = np.unique(np.repeat(np.arange(len(n)), n) * max(len(order), 1) + number[coded.indices.to_numpy()], return_counts=True)
            per_row = np.bincount(cells // max(len(order), 1), minlength=len(n))
            ordered, shard = coded.dictionary.take(pa.array(order)), shard[order]

            size, raw = common.runs(texts.fill_null(""))
            ends, raw = common.spans(size).tolist(), memoryview(np.ascontiguousarray(raw))
            digests = np.frombuffer(b"".join(common.digest(raw[a:b]) for a, b in zip(ends, ends[1:])), np.uint64).reshape(-1, 2)
            ids = row.field("id").fill_null(NO_ID).to_numpy()
            place = digests[:, 0] % np.uint64(n_shards)
            by = np.lexsort((digests[:, 1], digests[:, 0], place))
            new = np.concatenate([[True], np.any(np.diff(digests[by], axis=0) != 0, axis=1)]) if len(by) else np.zeros(0, bool)
            which = np.empty(len(by), np.int64)
            which[by] = np.cumsum(new) - 1
            distinct, at = digests[by[new]], place[by[new]].astype(np.int64)
            least = np.full(len(distinct), NO_ID)
            np.minimum.at(least, which, ids)

            words_at, texts_at, asks = _cuts(shard), _cuts(at), []
            for s in sorted({*words_at, *texts_at}):
                w, t = words_at.get(s, slice(0, 0)), texts_at.get(s, slice(0, 0))
                lengths, data = common.runs(ordered[w.start:w.stop])
                asks.append({"shard": s, "lengths": packed(lengths.astype(np.uint32)), "words": common.squeeze(data.tobytes()), "digests": distinct[t].tobytes(), "ids": packed(least[t])})
            yield pa.record_batch({"block": pa.array([name]), "rows": pa.ListArray.from_arrays(pa.array([0, len(row)], pa.int32()), row), "per_row": pa.array([packed(per_row)], pa.binary()),
                                   "at": pa.array([packed((cells % max(len(order), 1)).astype(np.uint32))], pa.binary()), "times": pa.array([packed(times.astype(np.uint32))], pa.binary()),
                                   "which": pa.array([packed(which.astype(np.uint32))], pa.binary()), "asks": pa.ListArray.from_arrays(pa.array([0, len(asks)], pa.int32()), pa.array(asks, ask_type))})

    def answered(table: pa.Table) -> pa.Table:
        common.trim()
        each = [common.from_runs(unpacked(n, np.uint32), common.expand(data)) for n, data in zip(table.column("lengths").to_pylist(), table.column("words").to_pylist())]
        coded = pa.concat_arrays(each).dictionary_encode()
        rank = np.empty(len(coded.dictionary), np.int64)
        rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
        terms = table.column("shard")[0].as_py() + n_shards * rank[coded.indices.to_numpy()]
        digests = [np.frombuffer(x, np.uint64).reshape(-1, 2) for x in table.column("digests").to_pylist()]
        ids = np.concatenate([unpacked(x, np.int64) for x in table.column("ids").to_pylist()])
        _, text = np.unique(np.concatenate(digests), axis=0, return_inverse=True)
        text = text.ravel()
        least = np.full(int(text.max(initial=-1)) + 1, NO_ID)
        np.minimum.at(least, text, ids)
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "terms": pa.array([packed(x) for x in np.split(terms, np.cumsum([len(x) for x in each])[:-1])], pa.binary()),
                         "ids": pa.array([packed(x) for x in np.split(least[text], np.cumsum([len(x) for x in digests])[:-1])], pa.binary())})

    def assembled(left: pa.Table, right: pa.Table) -> pa.Table:
        common.trim()
        out = {"block": left.column("block"), "rows": left.column("rows")}
        got = {s: (t, i) for s, t, i in zip(*(right.column(c).to_pylist() for c in ("shard", "terms", "ids")))}
        ids = [np.concatenate([np.zeros(0, np.int64), *(unpacked(got[s][k], np.int64) for s in sorted(got))]) for k in (0, 1)]
        csr = {"indptr": [], "terms": [], "counts": [], "first_ids": []}
        for per_row, at, times, which in zip(*(left.column(c).to_pylist() for c in ("per_row", "at", "times", "which"))):
            csr["indptr"].append(common.spans(unpacked(per_row, np.int64)).tobytes())
            csr["terms"].append(ids[0][unpacked(at, np.uint32)].tobytes())
            csr["counts"].append(unpacked(times, np.uint32).tobytes())
            csr["first_ids"].append(ids[1][unpacked(which, np.uint32)].tobytes())
        return pa.table(out | {k: pa.array(v, pa.binary()) for k, v in csr.items()})

    parts = stored(rows.mapInArrow(counted, f"block string, rows array<{row_type}>, per_row binary, at binary, times binary, which binary, asks {ASKED}"))
    asked = parts.select("block", F.explode("asks").alias("ask")).select("block", "ask.*")
    found = asked.groupBy("shard").applyInArrow(answered, "block string, shard int, terms binary, ids binary")
    csr = parts.drop("asks").groupBy("block").cogroup(found.groupBy("block")).applyInArrow(assembled, f"block string, rows array<{row_type}>, indptr binary, terms binary, counts binary, first_ids binary")
    return csr


def figures(matrix: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, the carried columns, n_words, n_distinct, first_id): row sums and nonzero counts of CSR shards; a null ``first_id`` has no id."""
    row = matrix.schema["rows"].dataType.elementType
    schema = f"row {row.simpleString()}, n_words bigint, n_distinct bigint, first_id bigint"

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = batch.column("rows").slice(k, 1).flatten()
                ptr, counts, first = (np.frombuffer(batch.column(c)[k].as_py(), t) for c, t in (("indptr", np.int64), ("counts", np.uint32), ("first_ids", np.int64)))
                yield pa.record_batch([rows, pa.array(common.per_run(counts, np.diff(ptr))), pa.array(np.diff(ptr)), pa.array(first, mask=first == NO_ID)], names=["row", "n_words", "n_distinct", "first_id"])

    flat = matrix.select("rows", "indptr", "counts", "first_ids").mapInArrow(summed, schema)
    carried = [f.name for f in row["row"].dataType.fields if f.name != "none"]
    return flat.select(F.col("row.id").alias(id_col), *[F.col(f"row.row.`{c}`").alias(c) for c in carried], "n_words", "n_distinct", "first_id")


COUNTED = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def steps(letters: str) -> tuple[list[tuple[str, int]], np.ndarray, dict[str, np.ndarray]]:
    """(order, step) of all orders of the filters, the filter of each, and 0/1 matrices over the sets of failed filters."""
    named = [(order, k) for order in itertools.permutations(range(len(letters))) for k in range(len(order))]
    bit = np.array([1 << order[k] for order, k in named])[:, None]
    past = np.array([sum(1 << f for f in order[:k]) for order, k in named])[:, None]
    fails = np.arange(1 << len(letters))[None, :]
    now, earlier = fails & bit > 0, fails & past > 0
    return ([("".join(letters[f] for f in order), k + 1) for order, k in named], np.array([order[k] for order, k in named]),
            {"kept": (fails & (past | bit)) == 0, "removed": now & ~earlier, "redundant": now & earlier, "unique_fails": fails == bit})


def audit(figures: DataFrame, fails: dict[str, Column], labels: DataFrame, id_col: str = "doc_id", part_col: str = "part") -> DataFrame:
    """(part, filter_order, step, then COUNTED, all long): what each filter does at each step of each order, by part.

    ``fails`` names filters by one letter and says which documents fail them (null: they pass); ``labels`` has the id, quality and toxic.
    """
    letters = "".join(fails)
    failed = sum((F.coalesce(f, F.lit(False)).cast("int") * (1 << k) for k, f in enumerate(fails.values())), F.lit(0))
    # counted by id first: rows that repeat an id never meet in one task of the join
    counts = figures.select(F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.col(id_col).alias("id"), failed.alias("failed")).groupBy("part", "id", "failed").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    counts = counts.join(marks, "id", "left").groupBy("part", "failed", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(F.sum("n").alias("n"))

    def expanded(table: pa.Table) -> pa.Table:
        named, which, matrices = steps(letters)
        failed, good, toxic, n = (table.column(c).to_numpy() for c in ("failed", "good", "toxic", "n"))
        of = {name: np.bincount(failed, weights=n * x, minlength=1 << len(letters)).astype(np.int64) for name, x in (("all", 1), ("good", good), ("toxic", toxic))}
        out = {name: m.astype(np.int64) @ of["all"] for name, m in matrices.items()}
        out |= {f"{name}_lost": matrices["removed"].astype(np.int64) @ of[name] for name in ("good", "toxic")}
        out["shapley"] = np.array([out["removed"][which == f].sum() for f in range(len(letters))])[which]
        part = table.column("part")[0].as_py()
        return pa.table({"part": pa.array([part] * len(named)), "filter_order": pa.array([o for o, _ in named]), "step": pa.array([k for _, k in named], pa.int32()), **{c: pa.array(out[c]) for c in COUNTED}})

    return counts.groupBy("part").applyInArrow(expanded, "part string, filter_order string, step int, " + ", ".join(f"{c} bigint" for c in COUNTED))
