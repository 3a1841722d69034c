"""Awkward tables, and plain versions of the operators to hold results against."""

import hashlib
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")
LINE = "this line of more than forty characters is in many documents"
BASE = " ".join(f"word{k}" for k in range(60))


def awkward():
    """(doc_id, text): nulls, empty and very long texts, ties, repeated rows, copies."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "a b c"), (6, "A  B\nC"), (None, BASE + " of nobody"), (None, None)]
    rows += [(10 + k, BASE) for k in range(4)] + [(10, BASE)]
    rows += [(20 + k, BASE.replace(f"word{7 * k}", f"other{k}")) for k in range(4)]
    rows += [(30 + k, f"{LINE}\n  {LINE.upper()} \nown line number {k} of a document that is not short\n") for k in range(7)] + [(36, f"{LINE}\nlast")]
    rows += [(40, "naïve Größe ١٢٣ 日本語   x \x1c y 'll don't\r\n\r\n  z"), (41, " ".join(f"w{k % 9000}" for k in range(40_000))), (42, "<|endoftext|> and <|start"), (43, "�\x00end")]
    return rows


def documents(spark, rows):
    """The rows with further columns whose names the operators use themselves."""
    schema = "doc_id bigint, text string, block string, shard int, id string, row int, score string, n_lines string, ids string, lang string, source string, n_chars bigint, decoded string, sig string"
    df = spark.createDataFrame([(i, t, "b", 1, "x", 2, "s", "n", "i", "en" if k % 2 else "de", "src", len(t or ""), "d", "g") for k, (i, t) in enumerate(rows)], schema)
    from finlake.session import stored
    return stored(df.coalesce(2))


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def shingles(text, width=5):
    w = words(lowered(text))
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def components(sets, percent=75):
    """Component of each of some sets by all pairs: the lowest position."""
    at = list(range(len(sets)))

    def top(k):
        while at[k] != k:
            k = at[k]
        return k

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                x, y = sorted((top(i), top(j)))
                at[y] = x
    return [top(k) for k in range(len(sets))]


def line_dedup(rows, min_docs=5, min_chars=40):
    def key(line):
        return lowered(line.strip(" \t\n\x0b\x0c\r"))

    n, holder = Counter(), {}
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            n[k] += 1
            holder[k] = max(holder.get(k, float("-inf")), float("-inf") if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and n[key(x)] >= min_docs and holder[key(x)] != i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def ordered(rows):
    return sorted(rows, key=repr)
