"""Licence scans by sentence rules, in DataFrame functions only.

A text is cut into pieces at line ends and at punctuation before a blank, which are normalised (A-Z in lower case, punctuation
and blanks as one blank, so comment marks and indents vanish).  Known licence sentences are found wherever they begin with a
piece and end with one, however many pieces they are wrapped or cut into; what is left is a short sequence of their
identifiers, by first piece, shorter ones first.  A licence is recognised if the sequence holds the identifiers of one of its
rules in their order, other sentences in between allowed.  Everything happens in the row of the document: there is no
shuffle, and the table of sentences is a fixed one.

``n_sentences`` counts sentences that end at a line end or at [.;!?] before a blank.

Defined cases: a null or empty text has no sentences and no licences; repeated rows are scanned row by row; an empty
table gives an empty table; further columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences, normalised, and the rules made of them.
SENTENCES = [
    "released under the mit license",
    "the mit license mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "licensed under the apache license version 2 0",
    "licensed under the apache license version 2 0 the license",
    "you may not use this file except in compliance with the license",
    "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "this work is licensed under the gnu general public license version 3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "see the gnu general public license for more details",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "licensed under cc by nc 4 0",
    "licensed under cc by 4 0",
    "this work is licensed under a creative commons attribution 4 0 international license",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "this is free and unencumbered software released into the public domain",
    "this source code form is subject to the terms of the mozilla public license v 2 0",
    "all rights reserved",
]
RULES = [
    ("Apache-2.0", (5,)), ("Apache-2.0", (6, 7, 8)), ("Apache-2.0", (6, 9)),
    ("BSD-2-Clause", (15, 16, 17)), ("BSD-3-Clause", (15, 16, 17, 18)),
    ("CC-BY-4.0", (21,)), ("CC-BY-4.0", (22,)), ("CC-BY-NC-4.0", (20,)), ("CC-BY-NC-4.0", (23,)),
    ("GPL-2.0-or-later", (12, 13)), ("GPL-3.0", (10,)), ("GPL-3.0-or-later", (11, 13)),
    ("ISC", (19,)), ("MIT", (0,)), ("MIT", (1,)), ("MIT", (2, 3)), ("MPL-2.0", (25,)),
    ("Unlicense", (24,)), ("all-rights-reserved", (26,)),
]

END = r"[.;!?]+[\x20\x09-\x0D]+|\n"
#: Ends of pieces, with the comment words of line starts.
CUT = r"(?:[.:;!?]+[\x20\x09-\x0D]+|[\x0A-\x0D])(?:[\x20\x09]*(?:dnl|rem|DNL|REM)(?![A-Za-z0-9]))?"
FIRST_MARK = r"^[\x20\x09]*(?:dnl|rem|DNL|REM)(?![A-Za-z0-9])"
NOISE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def mark(number: int) -> str:
    """A sentence's identifier as it stands in a sequence."""
    return f"s{number:03d};"


def sentences(text: Column, end: str = END) -> Column:
    """Normalised sentences that are not empty."""
    clean = F.transform(F.split(F.coalesce(text, F.lit("")), end), lambda s: F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), NOISE, " ")))
    return F.filter(clean, lambda s: s != "")


def begins(piece: Column) -> Column:
    """Whether a known sentence begins with the piece."""
    words = F.concat(piece, F.lit(" "))
    return F.substring_index(piece, " ", 1).isin(sorted({s.split()[0] for s in SENTENCES})) & F.exists(F.array(*[F.lit(f"{s} ") for s in SENTENCES]), lambda s: s.startswith(words))


def marks(pieces: Column, start: Column) -> Column:
    """Identifiers of the known sentences that begin with the piece number ``start`` (from 1) and end with a piece."""
    most = max(len(s.split()) for s in SENTENCES)  # a piece has a word at least, so no sentence has more pieces
    known = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(mark(k)).alias("mark")) for k, s in sorted(enumerate(SENTENCES), key=lambda x: len(x[1]))])
    joined = lambda n: F.array_join(F.slice(pieces, start, n), " ")
    text = F.array(F.concat(F.substring(joined(F.lit(most)), 1, max(map(len, SENTENCES)) + 1), F.lit(" ")))
    found = F.flatten(F.transform(text, lambda t: F.filter(known, lambda x: t.startswith(F.concat(x["s"], F.lit(" "))))))
    return F.array_join(F.transform(F.filter(found, lambda x: F.exists(F.sequence(F.lit(1), F.lit(most)), lambda n: joined(n) == x["s"])), lambda x: x["mark"]), "")


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with n_sentences (long), sentence_ids (their sequence) and licenses (names, sorted)."""
    docs = docs.drop("n_sentences", "sentence_ids", "licenses")
    kept = [c for c in docs.columns if c != text_col]
    text = F.col(text_col)
    found = docs.select(F.struct(*kept).alias("row"), F.size(sentences(text)).cast("bigint").alias("n_sentences"), sentences(F.regexp_replace(text, FIRST_MARK, ""), CUT).alias("all"))
    starts = F.filter(F.transform("all", lambda s, k: F.when(begins(s), k + 1)), lambda k: k.isNotNull())
    found = found.select("row", "n_sentences", "all", starts.alias("starts"))
    found = found.select("row", "n_sentences", F.array_join(F.transform("starts", lambda k: marks(F.col("all"), k)), "").alias("ids"))
    names = F.array(*[F.when(F.col("ids").like("%" + "%".join(map(mark, ids)) + "%"), name) for name, ids in RULES])
    return found.select(*[F.col("row").getField(c).alias(c) for c in kept], "n_sentences", F.col("ids").alias("sentence_ids"), F.array_sort(F.array_distinct(F.filter(names, lambda x: x.isNotNull()))).alias("licenses"))


def oracle(table: str, id_col: str) -> str:
    """The same in DuckDB's SQL, joined by ``, ``, for texts whose known sentences are sentences by ``END`` (not wrapped)."""
    values = ", ".join(f"('{s}', '{mark(k)}')" for k, s in enumerate(SENTENCES))
    tests = ", ".join(f"CASE WHEN ids LIKE '%{'%'.join(map(mark, i))}%' THEN '{name}' END" for name, i in RULES)
    return f"""
    WITH known(sentence, mark) AS (VALUES {values}),
    part AS (SELECT {id_col}, unnest(regexp_split_to_array(coalesce(text, ''), '{END}')) AS s, generate_subscripts(regexp_split_to_array(coalesce(text, ''), '{END}'), 1) AS pos FROM {table}),
    clean AS (SELECT {id_col}, pos, trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '{NOISE}', ' ', 'g')) AS sentence FROM part),
    found AS (SELECT {id_col}, count(*) FILTER (sentence <> '') AS n_sentences, coalesce(string_agg(mark, '' ORDER BY pos), '') AS ids FROM clean LEFT JOIN known USING (sentence) GROUP BY {id_col})
    SELECT {id_col}, n_sentences, ids AS sentence_ids, coalesce(array_to_string(list_sort(list_distinct(list_filter([{tests}], lambda x: x IS NOT NULL))), ', '), '') AS licenses FROM found"""
