"""Licence scans by a positional index of rare words, in DataFrame operations only.

The index is made from licence notices: of each it holds the words of the highest inverse
document frequency among the notices (its anchors) and where they stand. A file's words are
looked up there; each anchor found says where its notice would have to begin; the postings of
two anchors are intersected by that place; and where two agree, the notice's mandatory key
phrases are verified word by word, each at its own place in the notice. So a notice is found
although words between its key phrases differ. Everything happens within a row: no shuffle,
and the work is linear in the length of the text.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BETWEEN_WORDS, fold_ascii

#: Fixed values of the query contract: phrases whose every place counts.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: (label, notice, mandatory key phrases within it), in folded words.
NOTICES = [
    *((label, phrase, (phrase,)) for phrase, label in BASE.items()),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "licensed under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("hereby granted free of charge", "obtaining a copy", "associated documentation files")),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", ("provided as is without warranty of any kind", "warranties of merchantability")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ("except in compliance with the license", "apache org licenses license 2 0")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("in source and binary forms", "with or without modification", "following conditions are met")),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", ("nor the names of its contributors", "endorse or promote products")),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("lgpl", "under the terms of the gnu lesser general public license", ("lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license", ("affero general public license",)),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("general public license version 3",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("general public license version 2",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("redistribute it and or modify it", "gnu general public license", "free software foundation")),
    ("cc-by-nc", "cc by nc", ("cc by nc",)),
    ("cc-by-sa", "cc by sa", ("cc by sa",)),
    ("cc-by-nd", "cc by nd", ("cc by nd",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    ("public-domain", "this is free and unencumbered software released into the public domain", ("released into the public domain",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("use copy modify and or distribute this software", "with or without fee")),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("spdx", "spdx license identifier", ("spdx license identifier",)),
]
#: Anchors of a notice, and how many of them must agree on its place.
ANCHORS, AGREE = 3, 2


@dataclass(frozen=True)
class Entry:
    label: str
    notice: str
    anchors: tuple[tuple[str, int], ...]
    phrases: tuple[tuple[str, int], ...]
    weight: float
    base: bool


def index(notices: list[tuple[str, str, tuple[str, ...]]] | None = None) -> list[Entry]:
    """An entry for each notice: its rarest words and its key phrases, each with its place in the notice.

    Rarest are the words of the highest inverse document frequency among the notices; of equal
    ones the longer, then the later in the alphabet. A word that stands twice in a notice has no single place and is no anchor.
    The weight, 0 to 1, grows with the summed frequency of the key phrases' words.
    """
    notices = notices or NOTICES
    seen = Counter(w for _, notice, _ in notices for w in set(notice.split()))
    idf = {w: math.log((1 + len(notices)) / n) for w, n in seen.items()}
    out = []
    for label, notice, phrases in notices:
        words = notice.split()
        rare = sorted(sorted((w for w in set(words) if words.count(w) == 1), reverse=True), key=lambda w: (-idf[w], -len(w)))[:ANCHORS]
        places = tuple((p, next(k for k in range(len(words)) if words[k : k + len(p.split())] == p.split())) for p in phrases)
        mass = sum(idf[w] for p in phrases for w in p.split())
        out.append(Entry(label, notice, tuple((w, words.index(w)) for w in rare), places, round(1 - 2 ** (-mass / 2), 6), notice in BASE))
    return out


def _starts(words: Column, hits: Column, entry: Entry) -> Column:
    """Word positions at which the notice begins."""

    def implied(word: str, position: int) -> Column:
        return F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: h["p"] - F.lit(position))

    agreed = [F.array_intersect(implied(*a), implied(*b)) for a, b in combinations(entry.anchors, AGREE)]
    candidates = agreed[0]
    for more in agreed[1:]:
        candidates = F.array_union(candidates, more)

    def verified(s: Column) -> Column:
        good = s >= 0
        for phrase, at in entry.phrases:
            good = good & (F.array_join(F.slice(words, F.greatest(s, F.lit(0)) + (at + 1), len(phrase.split())), " ") == phrase)
        return good

    return F.filter(candidates, verified)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: list[tuple[str, str, tuple[str, ...]]] | None = None) -> DataFrame:
    """One row per input row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    A null or empty text has no words, places or labels ('' each), and a score of 0.
    ``places`` lists (label, start) of every verified notice. The score is the largest weight
    of a verified notice. Base phrases have all their places counted, overlapping ones too.
    Null ids and repeated rows are scanned each on its own, other columns, whatever their names,
    aren't read, and an empty table gives none.
    """
    table = index(notices)
    vocabulary = F.array(*[F.lit(w) for w in sorted({w for e in table for w, _ in e.anchors})])
    split = docs.select(F.col(id_col).alias("id"), F.array_remove(F.split(fold_ascii(F.coalesce(F.col(text_col), F.lit(""))), BETWEEN_WORDS), "").alias("words"))
    marked = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("p"))), lambda h: F.array_contains(vocabulary, h["w"]))
    # Of a notice's anchors so many must be there that one at least of these is: texts without any, nearly all, are done.
    telling = F.array(*[F.lit(w) for w in sorted({w for e in table for w, _ in e.anchors[: len(e.anchors) - AGREE + 1]})])
    # A row number, always zero or more, keeps the optimiser from working this step out anew at each of its many uses,
    # as it would to push a filter on the result below it.
    hits = F.when(F.arrays_overlap("words", telling) & (F.monotonically_increasing_id() >= 0), marked)
    looked = split.select("id", "words", F.size("words").cast("long").alias("n_words"), hits.alias("hits"))
    none = F.array().cast("array<int>")
    found = looked.select("id", "n_words", *[F.when(F.col("hits").isNotNull(), _starts(F.col("words"), F.col("hits"), e)).otherwise(none).alias(f"s{k}") for k, e in enumerate(table)])
    base = [k for k, e in enumerate(table) if e.base]
    has = lambda k: F.size(f"s{k}") > 0
    named = lambda ks: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(has(k), F.lit(table[k].label)) for k in ks])))), ",")
    at = F.flatten(F.array(*[F.col(f"s{k}") for k in base]))
    placed = lambda k: F.transform(f"s{k}", lambda s: F.struct(F.lit(table[k].label).alias("label"), s.alias("start")))
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"),
        F.array_max(at).cast("long").alias("last_word"),
        named(base).alias("base_labels"),
        named(range(len(table))).alias("labels"),
        F.greatest(F.lit(0.0), F.lit(0.0), *[F.when(has(k), F.lit(e.weight)).otherwise(0.0) for k, e in enumerate(table)]).alias("score"),
        F.flatten(F.array(*[placed(k) for k in range(len(table))])).alias("places"),
    )


def scan_sql(notices: list[tuple[str, str, tuple[str, ...]]] | None = None) -> str:
    """The digest of ``license_scan`` as a test of every place, for DuckDB."""
    table = index(notices)

    def starts(e: Entry) -> str:
        votes = " + ".join(f"coalesce(w[i + {k + 1}] = '{x}', false)::INT" for x, k in e.anchors)
        exact = [f"w[i + {at + k + 1}] = '{x}'" for phrase, at in e.phrases for k, x in enumerate(phrase.split())]
        return f"list_filter(range(n), lambda i: {' AND '.join(exact)} AND {votes} >= {AGREE})"

    columns = ", ".join(f"{starts(e)} AS s{k}" for k, e in enumerate(table))
    base = [k for k, e in enumerate(table) if e.base]
    named = lambda ks: "coalesce(array_to_string(list_sort(list_distinct(list_filter([" + ", ".join(f"CASE WHEN len(s{k}) > 0 THEN '{table[k].label}' END" for k in ks) + "], lambda x: x IS NOT NULL))), ','), '')"
    at = "flatten([" + ", ".join(f"s{k}" for k in base) + "])"
    score = "greatest(0.0::DOUBLE, " + ", ".join(f"CASE WHEN len(s{k}) > 0 THEN {e.weight}::DOUBLE ELSE 0 END" for k, e in enumerate(table)) + ")"
    return rf"""
WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT doc_id, w, len(w) AS n FROM t),
s AS (SELECT doc_id, n, {columns} FROM u)
SELECT doc_id, n::BIGINT AS n_words, len({at})::BIGINT AS n_base, list_min({at})::BIGINT AS first_word, list_max({at})::BIGINT AS last_word,
  {named(base)} AS base_labels, {named(range(len(table)))} AS labels, {score} AS score
FROM s"""
