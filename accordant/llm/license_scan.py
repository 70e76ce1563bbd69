"""License scan: exact containment join of text blocks with notice templates, and fixed phrases."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm.text import PLAIN, map_rows

# Phrases with their labels, and the notices that blocks are compared with.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "cc-by": "This work is licensed under a Creative Commons Attribution License",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "gpl": "This work is licensed under the GNU General Public License, version 3",
    "gpl-notice": "under the terms of the GNU General Public License as published by the Free Software Foundation",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "mit-short": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "reserved": "All rights reserved by the copyright holder",
}


def tokens(text: str) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return text.encode().translate(PLAIN).split()


#: Templates of fewer distinct tokens are only found whole: most of a short notice may be in any sentence.
SHORT = 10


def token_frequency(docs: DataFrame, text_col: str, templates: dict[str, str]) -> dict[bytes, int]:
    """In how many documents each template token occurs, which orders them; as many entries as the templates have tokens."""
    vocabulary = frozenset(t for x in templates.values() for t in tokens(x))

    def make():
        seen = Counter()

        def step(texts):
            for text in texts:
                seen.update(vocabulary.intersection(tokens(text or "")))
            return [], []

        step.last = lambda: (list(seen.keys()), list(seen.values()))
        return step

    partial = map_rows(docs.select(F.col(text_col).cast("string")), make, "token binary, n long")
    counted = {bytes(r.token): r.n for r in partial.groupBy("token").agg(F.sum("n").alias("n")).collect()}
    return {t: counted.get(t, 0) for t in vocabulary}


class ContainmentIndex:
    """Templates indexed by the prefix of their tokens, rarest token of the corpus first."""

    def __init__(self, templates: dict[str, str], frequency: dict[bytes, int], numerator: int, denominator: int, short: int = 0):
        self.rank = {t: i for i, t in enumerate(sorted(frequency, key=lambda t: (frequency[t], t)))}
        self.sets, self.need, self.prefix, self.span = {}, {}, {}, {}
        for label, text in templates.items():
            ordered = sorted({self.rank[t] for t in tokens(text)})
            need = len(ordered) if len(ordered) < short else -(-numerator * len(ordered) // denominator)
            self.sets[label], self.need[label] = frozenset(ordered), need
            self.span[label] = -(-denominator * len(tokens(text)) // numerator)
            for at, token in enumerate(ordered[: len(ordered) - need + 1]):
                self.prefix.setdefault(token, []).append((label, at))

    def contained(self, held: set[int]) -> dict[str, float]:
        """Every template contained to the threshold in a block, given the ranks of its tokens, with its containment."""
        ranked = sorted(held)
        found, checked = {}, set()
        for at, token in enumerate(ranked):
            for label, position in self.prefix.get(token, ()):
                size, need = len(self.sets[label]), self.need[label]
                # length filter, then positional filter: this is the first shared token of the pair, so no
                # more can be shared than what follows it on either side
                if label in checked or len(ranked) < need:
                    continue
                checked.add(label)
                if min(size - position, len(ranked) - at) < need:
                    continue
                shared = len(self.sets[label].intersection(ranked))
                if shared >= need:
                    found[label] = shared / size
        return found

    def matches(self, block: set[bytes]) -> dict[str, float]:
        """``contained`` for a block given by its words."""
        return self.contained({self.rank[w] for w in block if w in self.rank})

    def matches_across_lines(self, words: list[bytes]) -> dict[str, float]:
        """Every template contained to the threshold in ``span`` consecutive words, wherever lines break.

        A template's span is its number of words divided by the threshold: as many words may stand in
        between (comment marks, say) as may be missing. A window that holds enough of a template holds a
        token of its prefix, so only the surroundings of those are compared.
        """
        at = [p for p, w in enumerate(words) if w in self.rank]
        ranks = [self.rank[words[p]] for p in at]
        longest = max(self.span.values(), default=0)
        found = {}
        for k, rank in enumerate(ranks):
            if rank not in self.prefix:
                continue
            around = ranks[bisect_right(at, at[k] - longest) : bisect_left(at, at[k] + longest)]
            for label in self.contained(set(around)):
                span, wanted = self.span[label], self.sets[label]
                for first in range(bisect_right(at, at[k] - span), k + 1):
                    shared = len(wanted.intersection(ranks[first : bisect_left(at, at[first] + span)]))
                    if shared >= self.need[label]:
                        found[label] = max(shared / len(wanted), found.get(label, 0.0))
        return found


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(start, label) of every place where a phrase's words stand consecutively."""
    line = b" " + b" ".join(words) + b" "
    places = []
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = line.find(wanted)
        while at >= 0:
            places.append((line.count(b" ", 0, at), label))
            at = line.find(wanted, at + 1)
    return places


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None,
                  phrases: dict[str, str] | None = None, containment: tuple[int, int] = (4, 5)) -> DataFrame:
    """One row per row of ``docs`` with its phrase places and all labels.

    A block has a template's label when it holds at least the fraction ``containment`` of the template's
    distinct tokens, or all of them if they are fewer than ``SHORT``. Blocks are all windows of consecutive words that
    are as long as the template and its share of foreign words, so that a notice may be wrapped anywhere, and
    words strewn over a long line are none. ``score`` is 1 with a phrase, else the best such containment, else 0.
    Null and empty texts have no words, empty label strings, null places and score 0. Corpus counts cover
    every document; only counts of template tokens reach the driver.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    index = ContainmentIndex(templates, token_frequency(docs, text_col, templates), *containment, SHORT)

    def make():
        prefix = frozenset(t for t, r in index.rank.items() if r in index.prefix)

        def one(text):
            words = tokens(text or "")
            places = phrase_places(words, phrases)
            base = {label for _, label in places}
            found = {} if prefix.isdisjoint(words) else index.matches_across_lines(words)
            starts = [at for at, _ in places]
            return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | found.keys())), 1.0 if base else max(found.values(), default=0.0))

        return lambda ids, texts: (ids, *map(list, zip(*map(one, texts)))) if ids else ([],) * 8

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), make,
                    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def _values() -> str:
    rows = []
    for label, text in TEMPLATES.items():
        distinct = sorted({t.decode() for t in tokens(text)})
        need = len(distinct) if len(distinct) < SHORT else math.ceil(len(distinct) * 4 / 5)
        rows.append(f"('{label}', {distinct!r}, {need}, {math.ceil(len(tokens(text)) * 5 / 4)})")
    return ", ".join(rows)


#: Same rows by comparing every window that starts with a token of a template with that template.
ORACLE_SQL = f"""
WITH t AS (SELECT * FROM (VALUES {_values()}) AS v(label, toks, need, span)),
d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
w AS (SELECT doc_id, low, regexp_extract_all(low, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM d),
p AS (SELECT doc_id, low, w, list_filter(range(1, len(w) + 1), lambda i: w[i] = 'cc' AND w[i+1] = 'by') AS a,
             list_filter(range(1, len(w) + 1), lambda i: w[i] = 'general' AND w[i+1] = 'public' AND w[i+2] = 'license') AS b,
             list_filter(range(1, len(w) + 1), lambda i: w[i] = 'all' AND w[i+1] = 'rights' AND w[i+2] = 'reserved') AS c FROM w),
x AS (SELECT doc_id, label, need, toks, list_distinct(w[p:p + span - 1]) AS held FROM (SELECT doc_id, w, t.*, unnest(list_filter(range(1, len(w) + 1), lambda i: list_contains(t.toks, w[i]))) AS p FROM w, t)),
m AS (SELECT doc_id, label, max(len(list_intersect(toks, held)) / len(toks)) AS share FROM x WHERE len(list_intersect(toks, held)) >= need GROUP BY ALL),
g AS (SELECT doc_id, list(label) AS found, max(share) AS share FROM m GROUP BY doc_id),
q AS (SELECT *, list_concat(CASE WHEN len(a) > 0 THEN ['cc-by'] ELSE []::VARCHAR[] END, CASE WHEN len(b) > 0 THEN ['gpl'] ELSE []::VARCHAR[] END,
             CASE WHEN len(c) > 0 THEN ['reserved'] ELSE []::VARCHAR[] END) AS base, list_concat(a, b, c) AS places FROM p)
SELECT q.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(places) AS BIGINT) AS n_base, CAST(list_min(places) - 1 AS BIGINT) AS first_word,
       CAST(list_max(places) - 1 AS BIGINT) AS last_word, coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(base, coalesce(g.found, []::VARCHAR[])))), ','), '') AS labels,
       CAST(CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(g.share, 0.0) END AS DOUBLE) AS score
FROM q LEFT JOIN g USING (doc_id)
"""
