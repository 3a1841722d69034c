"""Packing of token ids into sequences: first-fit decreasing over a tournament tree, in randomised groups.

Texts are encoded word by word (see ``words``; the tokenizer drops white space and never merges across it), the end id is appended, and each document is cut into pieces of at most
one sequence.  Every piece draws a group at random (seeded by its block's name, so a task that runs again draws the
same); groups have about ``group_docs`` documents' pieces whatever the input's size, and are packed independently:
pieces from long to short, each into the first sequence with room, found by descending a tournament tree that holds
the most room of the sequences below each node.  Pieces of equal length go by a fixed order of their place, so that results are repeatable.

Defined cases: a null or empty text is the end id alone; repeated rows are packed row by row, and a hot id spreads over
groups as any other; an empty table gives an empty table; further columns may have any name.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm import common, words


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: A special token stands between words that are encoded in one call.
BETWEEN, BETWEEN_ID = "<|endoftext|>", 49407


def encode_all(path: str, found: list[str], at_once: int = 500) -> list[list[int]]:
    """The ids of each word; many words to a call, apart from those that hold a special token's marks."""
    t, out = tokenizer(path), [None] * len(found)
    plain = [k for k, w in enumerate(found) if "<|" not in w and "|>" not in w]
    for low in range(0, len(plain), at_once):
        part = plain[low:low + at_once]
        ids = np.array(t.encode(BETWEEN.join(found[k] for k in part), add_special_tokens=False).ids, np.int64)
        cut = np.flatnonzero(ids == BETWEEN_ID)
        ids, ends = ids.tolist(), [-1, *cut.tolist(), len(ids)]
        for n, k in enumerate(part):
            out[k] = ids[ends[n] + 1:ends[n + 1]]
    for k, w in enumerate(found):
        if out[k] is None:
            out[k] = t.encode(w, add_special_tokens=False).ids
    return out


class Rooms:
    """Room left in sequences 0, 1, ...; a tournament tree over them."""

    def __init__(self, most: int, size: int):
        self.leaves = 1 << max(0, most - 1).bit_length()
        self.size, self.used, self.tree = size, 0, [0] * (2 * self.leaves)

    def first(self, need: int) -> int:
        """The first sequence with so much room, opened if there is none; the room is taken."""
        tree, node = self.tree, 1
        if tree[1] < need:
            node = self.leaves + self.used
            self.used += 1
            tree[node] = self.size
        else:
            while node < self.leaves:
                node *= 2
                node += tree[node] < need
        sequence = node - self.leaves
        tree[node] -= need
        node >>= 1
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node >>= 1
        return sequence


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece."""
    rooms, order = Rooms(len(lengths), size), np.argsort(-lengths, kind="stable")
    sequence = np.zeros(len(lengths), np.int64)
    for k, n in zip(order.tolist(), lengths[order].tolist()):
        sequence[k] = rooms.first(n)
    by = order[np.argsort(sequence[order], kind="stable")]
    ends = np.cumsum(lengths[by])
    starts = ends - lengths[by]
    offset = np.zeros(len(lengths), np.int64)
    new = np.concatenate([[True], np.diff(sequence[by]) != 0]) if len(by) else np.zeros(0, bool)
    offset[by] = starts - np.repeat(starts[new], np.diff(np.append(np.flatnonzero(new), len(by))))
    return sequence, offset


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, size: int = 4096, id_col: str = "doc_id", text_col: str = "text", group_docs: int = 2048, group_bytes: int = 16 << 20) -> DataFrame:
    """A row for each piece: id, start, length, doc_tokens, sequence_id, offset (long), ids (binary, little-endian unsigned 32-bit).

    ``start`` counts the document's ids before the piece, ``offset`` those before it in its sequence.  ``docs`` is read
    twice and has to give the same rows in the same order, as a stored table does.
    """
    groups = max(1, -(-docs.count() // group_docs), -(-common.text_bytes(docs, text_col) // group_bytes))
    kind = common.id_type(docs, id_col)

    def shape(doc: pa.Array, n: np.ndarray, ids: np.ndarray) -> pa.Table:
        whole = n + 1
        all_ids = np.full(int(whole.sum()), end_id, np.uint32)
        first = common.spans(whole)[:-1]
        keep = np.ones(len(all_ids), bool)
        keep[first + n] = False
        all_ids[keep] = ids
        pieces = -(-whole // size)
        of = np.repeat(np.arange(len(n)), pieces)
        start = (np.arange(len(of)) - np.repeat(common.spans(pieces)[:-1], pieces)) * size
        length = np.minimum(size, whole[of] - start)
        seed = np.frombuffer(common.digest(all_ids.tobytes() + repr(doc.to_pylist()).encode()), np.uint64)
        group = np.random.default_rng(seed).integers(0, groups, len(of))
        at = first[of] + start
        return pa.table({"group": pa.array(group), "id": doc.take(pa.array(of)), "start": pa.array(start), "length": pa.array(length), "doc_tokens": pa.array(whole[of]),
                         "ids": pa.array([common.pack_ints(all_ids[a:a + m]) for a, m in zip(at.tolist(), length.tolist())], pa.binary())})

    def packed(table: pa.Table) -> pa.Table:
        common.trim()
        table = table.sort_by([("id", "ascending"), ("start", "ascending"), ("ids", "ascending")])
        sequence, offset = first_fit_decreasing(table.column("length").to_numpy(), size)
        group = table.column("group")[0].as_py() if table.num_rows else 0
        return pa.table({"id": table.column("id"), "start": table.column("start"), "length": table.column("length"), "doc_tokens": table.column("doc_tokens"),
                         "sequence_id": pa.array(sequence + (group << 32)), "offset": pa.array(offset),
                         "ids": pa.array([common.unpack_ints(x, np.uint32).tobytes() for x in table.column("ids").to_pylist()], pa.binary())})

    pieces = words.encode_words(docs, pc.ascii_split_whitespace, functools.partial(encode_all, tokenizer_path), shape, f"group bigint, id {kind}, start bigint, length bigint, doc_tokens bigint, ids binary", id_col, text_col)
    out = pieces.groupBy("group").applyInArrow(packed, f"id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary")
    return out.withColumnRenamed("id", id_col)
