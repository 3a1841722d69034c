"""What several operators share: block codecs, sizes, hashing.

Several operators ask something about every distinct item of the corpus (a word, a line, a shingle) and bring the
answer back to the documents.  They do it by *blocks*: a scan task cuts its rows into blocks of a few MB of text, sends
each block's distinct items, packed, to the shards of the item space, and the shards send packed answers back to the
block.  Items are so pre-aggregated per block before any shuffle: an item that is in every document costs one entry for
each block.  A block is named by its contents, so a task that runs again after a lost executor names it the same.
"""

from __future__ import annotations

import ctypes
import ctypes.util
import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text in a block, about.
BLOCK_BYTES = 8 << 20


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts: one number, for the number of shards."""
    return int(docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0)


def shards(docs: DataFrame, text_col: str, bytes_each: int) -> int:
    """How many shards keep one shard's items within ``bytes_each`` of text, and twice the shuffle partitions at least."""
    least = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-text_bytes(docs, text_col) // bytes_each))


def blocks(batches: Iterator[pa.RecordBatch], size: int = BLOCK_BYTES) -> Iterator[tuple[str, pa.Array, pa.Array]]:
    """(block name, ids, texts) from batches of (id, text) in the order of the rows."""
    held: list[pa.RecordBatch] = []
    full = 0
    for batch in batches:
        at, lengths = 0, np.asarray(pc.fill_null(pc.binary_length(batch.column(1)), 0))
        ends = np.cumsum(lengths.astype(np.int64) + 16)
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + size - full, side="right")))
            held.append(batch.slice(at, to - at))
            full += int(ends[to - 1] - base)
            at = to
            if full >= size * 0.9:
                yield _block(held)
                held, full = [], 0
                trim()
    if held:
        yield _block(held)
        held = []
    trim()


def trim() -> None:
    """Give freed memory back to the system: workers stay alive, and idle ones should not hold what busy ones need."""
    pa.default_memory_pool().release_unused()
    if libc := _libc():
        libc.malloc_trim(0)


@functools.lru_cache(maxsize=1)
def _libc():
    found = ctypes.util.find_library("c")
    libc = ctypes.CDLL(found) if found else None
    return libc if hasattr(libc, "malloc_trim") else None


def _block(held: list[pa.RecordBatch]) -> tuple[str, pa.Array, pa.Array]:
    ids, texts = (pa.concat_arrays([b.column(k) for b in held]) for k in (0, 1))
    h = xxhash.xxh3_128()
    h.update(repr(ids.to_pylist()).encode())
    lengths, data = runs(texts.fill_null(""))
    h.update(np.where(texts.is_null().to_numpy(zero_copy_only=False), -1, lengths).tobytes())
    h.update(data)
    return h.hexdigest(), ids, texts


def runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Length in bytes of each text (none null), and all bytes."""
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    return np.diff(at), (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8))[at[0]:at[-1]]


def from_runs(lengths: np.ndarray, data: bytes) -> pa.Array:
    """Texts from their lengths in bytes and all bytes."""
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(spans(lengths).astype(np.int32).tobytes()), pa.py_buffer(data))


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def squeeze(data: bytes) -> bytes:
    return zstandard.compress(data, 1)


def expand(data: bytes) -> bytes:
    return zstandard.decompress(data)


#: Joins words: a lone surrogate is in no text that Spark hands over.
SEP = "\ud800"


def pack_words(words: list[str]) -> bytes:
    return squeeze(SEP.join(words).encode("utf-8", "surrogatepass"))


def unpack_words(data: bytes, n: int) -> list[str]:
    return expand(data).decode("utf-8", "surrogatepass").split(SEP) if n else []


def pack_ints(values: np.ndarray) -> bytes:
    """Whole numbers as byte planes, so that small ones and small steps compress well."""
    values = np.ascontiguousarray(values)
    return squeeze(values.view(np.uint8).reshape(len(values), -1).T.tobytes())


def unpack_ints(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(expand(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def spans(lengths: np.ndarray) -> np.ndarray:
    """Starts of consecutive runs, and the end."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The runs ``values[starts[i]:starts[i] + lengths[i]]`` for each chosen i, one after the other."""
    n = lengths[chosen].astype(np.int64)
    to = np.cumsum(n)
    return values[np.arange(to[-1] if len(to) else 0) + np.repeat(starts[chosen].astype(np.int64) - (to - n), n)]


def per_run(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given lengths, empty ones 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    at = spans(lengths)
    return total[at[1:]] - total[at[:-1]]


def as_binary(values: np.ndarray, lengths: np.ndarray, item: int) -> pa.Array:
    """A binary column of consecutive runs of ``values``, whose items have ``item`` bytes."""
    at = spans(lengths) * item
    offsets = pa.py_buffer(at.astype(np.int64).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, offsets, pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(pa.binary())


def id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()
