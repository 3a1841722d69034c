"""Similarity join of documents on word shingles, by adaptive multi-match prefixes.

1. *Frequencies.*  Blocks of documents send each distinct shingle once, with its number of documents in the block, to the
   shards of the shingle space, and get back in how many documents it is (see ``common``).
2. *Sets.*  Two documents have in common only shingles found in two documents or more, so the rest need not be kept, and a
   document with too few of them can have no partner at all.  Equal sets become one class, whatever their number.
3. *Prefixes.*  Shingles are in a global order, rare ones first.  A set of n shingles that needs c = ceil(t n) in common
   with any partner meets it in its first n - c + k shingles at least k times, for k up to c.  Each class takes the k of the least
   estimated cost: the entries of its longer prefix to go through, against the candidates left to verify when k of them
   have to be shared.  A pair is verified if it shares min(k, k') prefix shingles.
4. *Stars.*  Entries of a shingle are first compared with one member of its list only, the same for similar lists.
   What links is merged, which settles large groups of near copies in rows instead of pairs.
5. *The rest.*  A link inside a component changes no component, so from here on only lists whose members are in several
   components count, and only pairs of different components.  Short lists give these pairs.  A long list would give the
   square of its length; its members are held against its pivot instead, see ``_by_pivot``.
6. Verification is exact, over the whole sets.

Shingles are 64-bit hashes; in step 1 only, ``shard`` and 32 more bits stand for one, and shingles that agree there
only count as more frequent than they are.

Defined cases: a text of fewer than ``width`` words is one shingle; one without words (or null) is an empty set, linked
with nothing.  Rows are the documents; rows sharing an id are compared as others.  A null id is compared too but can
name no component: the component is the smallest id that is not null.  An empty table gives an empty table.
Only id and text are read, so further columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finlake.llm import common, mph
from finlake.llm.components import components
from finlake.session import stored

#: Bytes of text in a block; shingles take many times the memory of their text.
BLOCK_BYTES = 4 << 20
#: Largest k of a prefix, and the cost of verifying a candidate against that of an entry of a list.
MOST_MATCHES, VERIFY_COST = 8, 4.0


def shingles(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, ascending, one text after the other, and their number."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded, of = found.flatten().dictionary_encode(), pc.list_parent_indices(found).to_numpy()
    word = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    at = coded.indices.to_numpy()
    full = common.runs(coded.dictionary)[0][at] > 0  # blanks at the ends give empty words
    word, counts = word[at[full]], np.bincount(of[full], minlength=len(texts))
    pad = np.concatenate([word, np.zeros(width - 1, np.uint64)])
    starts, out = common.spans(counts)[:-1], np.zeros(len(word), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = out * np.uint64(0x9E3779B97F4A7C15) + mph.mix(pad[k:k + len(word)], k)
        out = mph.mix(out, 31)
        for k in np.flatnonzero((counts > 0) & (counts < width)):
            part = np.uint64(counts[k])
            for x in word[starts[k]:starts[k] + counts[k]]:
                part = (part * np.uint64(0x9E3779B97F4A7C15)) ^ mph.mix(np.array([x]), 63)[0]
            out[starts[k]] = part
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(texts)), n)
    out = common.gather(out, starts, n, np.arange(len(texts)))
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[keep], np.bincount(doc[keep], minlength=len(texts))


def _distinct(values: np.ndarray, n_shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (shard, 32 more bits) keys of the block, ascending, the key number of each value, and how many have it."""
    key = (values % np.uint64(n_shards)) << np.uint64(32) | (values >> np.uint64(32))
    return np.unique(key, return_inverse=True, return_counts=True)


def sets(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str, shard_bytes: int = 6 << 20) -> DataFrame:
    """(id, n, sig, common, df): each document's number of shingles, a digest of the set, and if it may have partners,
    the shingles found elsewhere too, rare ones first, with their document counts (packed)."""
    n_shards = common.shards(docs, text_col, shard_bytes)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = common.id_type(docs, "id")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in common.blocks(batches, BLOCK_BYTES):
            keys, _, counts = _distinct(shingles(texts, width)[0], n_shards)
            shard = keys >> np.uint64(32)
            ends = np.append(np.flatnonzero(np.diff(shard)) + 1, len(keys)) if len(keys) else []
            low = 0
            for high in ends:
                part = keys[low:high].astype(np.uint32)
                yield pa.record_batch({"shard": pa.array([int(shard[low])], pa.int32()), "block": pa.array([name]), "keys": pa.array([common.pack_ints(np.diff(part, prepend=np.uint32(0)))], pa.binary()),
                                       "counts": pa.array([common.pack_ints(counts[low:high].astype(np.uint32))], pa.binary())})
                low = high

    def counted(table: pa.Table) -> pa.Table:
        common.trim()
        keys = [np.cumsum(common.unpack_ints(x, np.uint32), dtype=np.uint32) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([common.unpack_ints(x, np.uint32) for x in table.column("counts").to_pylist()])
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=counts)[at].astype(np.uint64)
        ends = np.cumsum([len(k) for k in keys])[:-1]
        return pa.table({"block": table.column("block"), "shard": table.column("shard"), "df": pa.array([common.pack_ints(x) for x in np.split(total, ends)], pa.binary())})

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, ids, texts in common.blocks(batches, BLOCK_BYTES):
            lengths, data = common.runs(texts.fill_null(""))
            yield pa.record_batch({"block": pa.array([name]), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), "lengths": pa.array([common.pack_ints(lengths.astype(np.uint32))], pa.binary()), "texts": pa.array([common.squeeze(data.tobytes())], pa.binary())})

    def shared(left: pa.Table, right: pa.Table) -> pa.Table:
        common.trim()
        parts = [pa.table([pa.array([], left.schema.field("ids").type.value_type), pa.array([], pa.int64()), *[pa.array([], pa.binary())] * 3], names=["id", "n", "sig", "common", "df"])]
        answers = dict(zip(right.column("shard").to_pylist(), right.column("df").to_pylist()))
        for row in range(left.num_rows):
            ids = left.column("ids").combine_chunks().slice(row, 1).flatten()
            values, n = shingles(common.from_runs(common.unpack_ints(left.column("lengths")[row].as_py(), np.uint32), common.expand(left.column("texts")[row].as_py())), width)
            keys, at, _ = _distinct(values, n_shards)
            df = np.concatenate([common.unpack_ints(answers[s], np.uint64) for s in sorted(answers)]) if answers else np.zeros(0, np.uint64)
            if len(df) != len(keys):
                raise RuntimeError("a block has other shingles than in the first pass: the input changes between reads; store it first")
            df = df[at]
            doc, often = np.repeat(np.arange(len(n)), n), df > 1
            may = (np.bincount(doc[often], minlength=len(n)) * 100 >= n * percent) & (n > 0)
            ends, sig, tokens, dfs = common.spans(n), [], [], []
            for k in range(len(n)):
                mine = slice(ends[k], ends[k + 1])
                sig.append(common.digest(values[mine].tobytes()))
                if may[k]:
                    v, d = values[mine][often[mine]], df[mine][often[mine]]
                    order = np.lexsort((v, d))
                    tokens.append(v[order].tobytes())
                    dfs.append(common.pack_ints(d[order]))
                else:
                    tokens.append(None)
                    dfs.append(None)
            parts.append(pa.table({"id": ids, "n": pa.array(n, pa.int64()), "sig": pa.array(sig, pa.binary()), "common": pa.array(tokens, pa.binary()), "df": pa.array(dfs, pa.binary())}))
        return pa.concat_tables(parts)

    df = docs.mapInArrow(asked, "shard int, block string, keys binary, counts binary").groupBy("shard").applyInArrow(counted, "block string, shard int, df binary")
    texts = docs.mapInArrow(held, f"block string, ids array<{kind}>, lengths binary, texts binary")
    return texts.groupBy("block").cogroup(df.groupBy("block")).applyInArrow(shared, f"id {kind}, n bigint, sig binary, common binary, df binary")


def _choose(n: int, df: np.ndarray, percent: int) -> tuple[int, int]:
    """(k, length of the prefix within the common shingles) of the least estimated cost; no partner need share more than c."""
    c = -(-n * percent // 100)
    base = n - c - (n - len(df))  # shingles found nowhere else come first in the order
    best = (float("inf"), 1, 0)
    entries = np.concatenate([[0.0], np.cumsum(df - 1.0)])
    for k in range(1, max(1, min(MOST_MATCHES, c)) + 1):
        length = min(max(0, base + k), len(df))
        met = entries[length]
        best = min(best, (met + VERIFY_COST * met / k, k, length))
    return best[1:]


def prefixes(classes: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, k, s): the prefix of each class, as rows; s shingles of the class are found elsewhere too."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500).to_pydict()
                token, node, size, ks, elsewhere = [], [], [], [], []
                for i, n, tokens, df in zip(part["node"], part["n"], part["common"], part["df"]):
                    k, length = _choose(n, common.unpack_ints(df, np.uint64).astype(np.float64), percent)
                    token.append(np.frombuffer(tokens, np.int64)[:length])
                    node.append(np.full(length, i))
                    size.append(np.full(length, n))
                    ks.append(np.full(length, k))
                    elsewhere.append(np.full(length, len(tokens) // 8))
                yield pa.record_batch({c: pa.array(np.concatenate(x).astype(np.int64)) for c, x in (("token", token), ("node", node), ("n", size), ("k", ks), ("s", elsewhere))})

    return classes.select("node", "n", "common", "df").mapInArrow(cut, "token bigint, node bigint, n bigint, k bigint, s bigint")


def verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose sets are as similar as asked."""
    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pydict()
            keep = []
            for m, n, s, t in zip(x["na"], x["nb"], x["sa"], x["sb"]):
                both = len(np.intersect1d(np.frombuffer(s, np.int64), np.frombuffer(t, np.int64), assume_unique=True))
                keep.append(100 * both >= percent * (m + n - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    one = classes.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("common").alias("sa"))
    two = classes.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("common").alias("sb"))
    return pairs.select("a", "b").join(two, "b").join(one, "a").select("a", "b", "na", "nb", "sa", "sb").mapInArrow(alike, "a bigint, b bigint")


def _heads(entries: DataFrame, first: str) -> DataFrame:
    """One member of each list: the first by ``first`` (SQL), then by hash."""
    member = F.struct(F.expr(first).alias("first"), F.xxhash64("node").alias("hash"), F.col("node").alias("b"), F.col("n").alias("n2"), F.col("s").alias("s2"), F.col("k").alias("k2"), F.col("component").alias("c2"))
    return entries.groupBy("token").agg(F.min(member).alias("h")).select("token", "h.b", "h.n2", "h.s2", "h.k2", "h.c2")


def _fits(percent: int) -> str:
    """What two sets need by their sizes n and their numbers s of shingles found elsewhere, which bound the intersection."""
    return f"100 * least(s, s2) >= {percent} * (n + n2 - least(s, s2))"


def _candidates(met: DataFrame, spare: str = "0") -> DataFrame:
    """Pairs that share enough prefix shingles; ``spare`` (SQL) of them may have been met elsewhere."""
    shared = met.groupBy(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).agg(F.count("*").alias("m"), F.first(F.least("k", "k2")).alias("k"), F.first(F.expr(spare)).alias("spare"))
    return shared.filter("m + spare >= k").select("a", "b")


def _by_pivot(entries: DataFrame, classes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links, candidates) among the members of long lists, without going through their pairs.

    The pivot p of a list is a member with the fewest shingles of its own.  For members x, y let S be the symmetric
    difference with p.  The sets x and y differ by the symmetric difference of their S, so with c = (100 - percent) /
    (100 + percent) they link if and only if |S(x)| + |S(y)| - 2 |S(x) & S(y)| <= c (|x| + |y|).  Those within that reach of p link with p and
    are in its component.  A pair of different components so has a member x out of p's reach; then S(x) and S(y) must share
    more than half of S(y), all but exactly, and prefixes of the S, rare shingles first, must meet.  Shingles that only x has
    are in S(x) and shared by nobody; those that only p has (u0) are shared by all: both enter the bounds as numbers.
    """
    c, head = f"({100 - percent} / {100 + percent})", _heads(entries, "n - s")
    share = (100 - percent) / (100 + percent)
    members = entries.join(head.select("token", F.col("b").alias("p")), "token").filter("node <> p").select("p", "node", "component").distinct()
    own = classes.select("node", "n", "common", "df")
    pivot = classes.select(F.col("node").alias("p"), F.col("n").alias("n0"), F.col("common").alias("common0"), F.col("df").alias("df0"))

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            out = {"near": [], "probe": [], "index": [], "size": [], "own": [], "own0": []}
            for n, data, df, n0, data0, df0 in zip(*(rows[x] for x in ("n", "common", "df", "n0", "common0", "df0"))):
                mine, base = np.frombuffer(data, np.int64), np.frombuffer(data0, np.int64)
                token = np.concatenate([mine, base])
                often = np.concatenate([common.unpack_ints(df, np.uint64), common.unpack_ints(df0, np.uint64)])
                token, first, times = np.unique(token, return_index=True, return_counts=True)
                token, often = token[times == 1], often[first[times == 1]]
                token = token[np.lexsort((token, often))]
                u, u0, size = n - len(mine), n0 - len(base), len(token)
                near = (100 + percent) * (size + u + u0) <= (100 - percent) * (n + n0)
                # S(x) of a member out of reach shares at least so much with any other; S(y) with any out of reach
                least_x = (size + u - share * (n + n0)) / 2
                least_y = (size + u - u0 + share * (n0 - n)) / 2
                cut = lambda least: token[:max(0, size - max(1, int(np.ceil(least - 1e-9))) + 1)].tolist()  # noqa: E731, B023
                out["near"].append(near)
                out["probe"].append([] if near else cut(least_x))
                out["index"].append(cut(least_y))
                out["size"].append(size)
                out["own"].append(u)
                out["own0"].append(u0)
            yield pa.RecordBatch.from_arrays([*(batch.column(x) for x in ("p", "node", "component", "n")), pa.array(out["near"], pa.bool_()), *(pa.array(out[x], pa.list_(pa.int64())) for x in ("probe", "index")), *(pa.array(out[x], pa.int64()) for x in ("size", "own", "own0"))],
                                             names=["p", "node", "component", "n", "near", "probe", "index", "size", "own", "own0"])

    schema = "p bigint, node bigint, component bigint, n bigint, near boolean, probe array<bigint>, index array<bigint>, size bigint, own bigint, own0 bigint"
    diff = stored(members.join(own, "node").join(pivot, "p").select("p", "node", "component", "n", "common", "df", "n0", "common0", "df0").mapInArrow(differ, schema))
    far = diff.filter("NOT near").select("p", "node", "component", "n", "size", "own", "own0", F.explode("probe").alias("token"))
    near = diff.select("p", F.col("node").alias("b"), F.col("component").alias("c2"), F.col("n").alias("n2"), F.col("size").alias("size2"), F.col("own").alias("own2"), F.explode("index").alias("token"))
    # shared shingles of S, besides those that only p has, that the pair needs; it cannot have more than the smaller S
    needs = f"(size + own + size2 + own2 - {c} * (n + n2)) / 2 - 1e-9 <= least(size, size2)"
    pairs = far.join(near, ["p", "token"]).filter(f"component <> c2 AND {needs}").select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    return diff.filter("near").select(F.col("p").alias("a"), F.col("node").alias("b")), pairs


def link(classes: DataFrame, percent: int, long_list: int = 64) -> DataFrame:
    """(node, component) of the classes that link with another; lists of more than ``long_list`` members go by pivots."""
    entries = prefixes(classes, percent)
    lists = entries.groupBy("token").agg(F.count("*").alias("m")).filter("m > 1").select("token")
    entries = stored(entries.join(lists, "token").withColumn("component", F.col("node")))
    star = entries.join(_heads(entries, "n - s"), "token").filter(f"node <> b AND {_fits(percent)}")
    links = stored(verified(_candidates(star), classes, percent))
    known = components(links)
    entries = entries.drop("component").join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = entries.groupBy("token").agg(F.count("*").alias("m"), F.min("component").alias("x"), F.max("component").alias("y")).filter("x < y").select("token", "m")
    entries = stored(entries.join(mixed, "token"))
    long = entries.filter(f"m > {long_list}").drop("m")
    spare = long.groupBy("node").agg(F.count("*").alias("spare"))
    short = entries.filter(f"m <= {long_list}").drop("m").join(spare, "node", "left").fillna(0, ["spare"])
    other = short.select("token", F.col("node").alias("b"), F.col("n").alias("n2"), F.col("s").alias("s2"), F.col("k").alias("k2"), F.col("component").alias("c2"), F.col("spare").alias("spare2"))
    met = short.join(other, "token").filter(f"node < b AND component <> c2 AND {_fits(percent)}")
    near, pairs = _by_pivot(long, classes, percent)
    found = stored(verified(_candidates(met, "least(spare, spare2)").union(pairs).distinct(), classes, percent))
    return components(links.union(near).union(found))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, class_id): a row for each document.

    ``component_id`` is the smallest id reached by links, the document's own included; ``class_id`` the smallest id of
    those with the same set of shingles.  Links join documents whose sets have 100 * intersection >= percent * union.
    ``docs`` is read twice and has to give the same rows in the same order, as a stored table does.
    """
    rows = stored(sets(docs, width, percent, id_col, text_col))
    # copies have the same shingles, so any row of a class tells which of them are found elsewhere
    classes = stored(rows.filter("n > 0").groupBy("n", "sig").agg(F.min("id").alias("class_id"), F.first("common").alias("common"), F.first("df").alias("df")).withColumn("node", F.monotonically_increasing_id()))
    linked = stored(classes.select("node", "n", "sig", "class_id").join(link(classes.filter("common IS NOT NULL"), percent), "node", "left"))
    least = linked.filter("component IS NOT NULL").groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = linked.join(least, "component", "left").select("n", "sig", "class_id", "component_id")
    whole = rows.filter("n > 0").select("id", "n", "sig").join(named, ["n", "sig"])
    out = whole.select("id", "n", "class_id", "component_id").union(rows.filter("n = 0").select("id", "n", F.lit(None), F.lit(None)))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component_id", "class_id", "id").alias("component_id"), F.coalesce("class_id", "id").alias("class_id"))
