"""Text operators against plain Python on small tables with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from accordant.llm import (bpe, components, decontamination, fm_index, jaccard_join, language_id, license_scan, line_dedup, packing,
                           quality_rules, substring_dedup, token_counts, toxicity)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, anchor string, row string, node string, score string"
WORDS = "the of and model data Spark joins, rows. skew salted key hash über naïve 12 scan".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def rows_of(texts):
    return [(i, t, "en", "s", len(t or ""), "x", "x", "x", "x") for i, t in texts]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    base = [sentence(rng, rng.randrange(1, 120)) for _ in range(40)]
    texts = list(base)
    texts += [base[3], base[3], base[7] + " more", "x " + base[9], "\n".join(base[:5]), "\n".join(base[2:6])]
    long = sentence(rng, 6000)
    texts += [None, "", "   ", "one", "one two", long, long.replace("skew", "even", 1), "\n\n\n\n", "<|endoftext|> a<|endoftext|>", "a  b \n c"]
    found = list(enumerate(texts))
    found += [(3, base[3]), (None, base[3]), (None, None)]  # repeated row, null ids
    return found


@pytest.fixture(scope="module")
def docs(spark, corpus):
    return spark.createDataFrame(rows_of(corpus), SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def same(got, expected):
    assert Counter(got) == Counter(expected)


def test_token_counts(docs, corpus, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.default_path())
    expected = [(i, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in corpus]
    for chunk in (token_counts.CHUNK, 37):
        same([tuple(r) for r in token_counts.count_tokens(docs, chunk=chunk).collect()], expected)
    assert token_counts.count_tokens(empty).count() == 0


def test_state_maps_compose_in_any_grouping():
    fst = bpe.Transducer(bpe.default_path(), bpe.count_of)
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(["a", " ", "\n", "é", "'s", "12", " the", "!"]) for _ in range(rng.randrange(1, 40)))
        cuts = sorted(rng.sample(range(len(text) + 1), min(3, len(text))))
        parts = [p for a, b in zip([0, *cuts], [*cuts, len(text)]) if (p := text[a:b])]
        maps = token_counts.prefix_scan([token_counts.state_map(p, fst) for p in parts], fst.__getitem__)
        assert token_counts.total(maps[-1], fst.start, fst.__getitem__) == len(fst.encode(text)), (text, parts)


def test_line_dedup(docs, corpus, empty):
    text_of = dict(x for x in corpus if x[0] is not None)
    seen, gone = {}, defaultdict(set)
    for i in sorted(text_of):
        lines = (text_of[i] or "").split("\n")
        for p in range(len(lines) - 2):
            first = seen.setdefault(tuple(lines[p : p + 3]), (i, p))
            if first != (i, p):
                gone[i] |= {p, p + 1, p + 2}
    expected = []
    for i, t in corpus:
        lines = t.split("\n") if t is not None else []
        kept = [x for p, x in enumerate(lines) if i is None or p not in gone[i]]
        expected.append((i, t if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = line_dedup.dedup_lines(docs)
    assert set(got.columns) == {*docs.columns, "n_lines", "n_removed"}
    same([tuple(r) for r in got.select("doc_id", "text", "n_lines", "n_removed").collect()], expected)
    assert line_dedup.dedup_lines(empty).count() == 0
    assert any(e[3] for e in expected)


def test_jaccard_components(spark, docs, corpus, empty):
    rng = random.Random(11)
    long = [rng.choice(WORDS) + str(rng.randrange(900)) for _ in range(160)]
    family = []
    for k in range(60):  # a chain and a star of near copies
        w = list(long)
        for _ in range(k % 3):
            w[rng.randrange(len(w))] = f"edit{k}"
        family.append((1000 + k, " ".join(w).upper() if k % 7 == 0 else " ".join(w)))
    everything = corpus + family
    table = docs.unionByName(spark.createDataFrame(rows_of(family), SCHEMA))
    for size, num in ((3, 90), (5, 80)):
        sets = [jaccard_join.shingles(jaccard_join.words_of(t), size) for _, t in everything]
        root = list(range(len(sets)))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a in range(len(sets)):
            for b in range(a):
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                    root[find(a)] = find(b)
        low = defaultdict(lambda: None)
        for k, (i, _) in enumerate(everything):
            r = find(k)
            low[r] = i if low[r] is None else low[r] if i is None else min(low[r], i)
        expected = [(i, len(sets[k]), low[find(k)]) for k, (i, _) in enumerate(everything)]
        same([tuple(r) for r in jaccard_join.link_documents(table, size=size, numerator=num).collect()], expected)
    assert jaccard_join.link_documents(empty).count() == 0


def test_prefixes_share_enough():
    rng = np.random.default_rng(1)
    sketch = rng.integers(0, 60, jaccard_join.CELLS).astype(np.uint8)
    need = lambda n: -(-90 * n // 100)
    for _ in range(200):
        pool = rng.integers(0, 2**63, 80).astype(np.uint64)
        a = np.unique(pool[: rng.integers(1, 80)])
        b = np.unique(np.append(a[rng.random(len(a)) < 0.97], rng.integers(0, 2**63, rng.integers(0, 4)).astype(np.uint64)))
        if len(b) and 100 * len(np.intersect1d(a, b)) >= 90 * len(np.union1d(a, b)):
            (p, x, last), (q, y, other) = jaccard_join.prefix(a, sketch, need), jaccard_join.prefix(b, sketch, need)
            shared = len(np.intersect1d(p, q))
            assert shared >= min(x, y)
            rest = len(a) - len(p) if last < other else len(b) - len(q) if other < last else max(len(a) - len(p), len(b) - len(q))
            assert shared + rest >= len(np.intersect1d(a, b))


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)], "a long, b long")
    got = {r.node: r.root for r in components.connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


@pytest.mark.parametrize("busy", [substring_dedup.BUSY, 2])
def test_substring_dedup(docs, corpus, empty, busy):
    first = {}
    for i, t in corpus:
        w = words(t)
        for p in range(len(w) - 12):
            key = tuple(w[p : p + 13])
            order = i if i is not None else substring_dedup.NO_ID
            first[key] = min(first.get(key, order), order)
    expected = []
    for i, t in corpus:
        w, gone = words(t), set()
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < (i if i is not None else substring_dedup.NO_ID):
                gone |= set(range(p, p + 13))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        expected.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = substring_dedup.dedup_substrings(docs, busy=busy, shard_words=500)
    same([tuple(r) for r in got.drop("kept").collect()], expected)
    assert any(e[2] for e in expected) and substring_dedup.dedup_substrings(empty).count() == 0


def test_fm_index_finds_every_occurrence():
    rng = np.random.default_rng(4)
    text = rng.integers(1, 5, 400)
    text[::37] = 0
    text[-1] = 0
    owner = rng.integers(0, 50, 400)
    fm = fm_index.FMIndex(text, owner)
    at = np.array([p for p in range(396) if 0 not in text[p : p + 4]])
    patterns = text[at[:, None] + np.arange(4)]
    lo, hi = fm.search(patterns)
    for pattern, a, b, low in zip(patterns, lo, hi, fm.smallest_owner(lo, hi), strict=True):
        places = [p for p in range(397) if (text[p : p + 4] == pattern).all()]
        assert b - a == len(places) and low == owner[places].min()


def test_packing(docs, corpus, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(bpe.default_path())
    expected = []
    for i, t in corpus:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        edges = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        expected += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]
    got = packing.pack_documents(docs).collect()
    same([tuple(r)[:5] for r in got], expected)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(placed)])]
        assert [o for o, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 2048
    assert len(sequences) <= -(-sum(r.length for r in got) // 2048) + 1
    assert packing.pack_documents(empty).count() == 0


def test_packing_over_many_demes_and_levels(spark):
    rng = random.Random(8)
    lengths = [(k, rng.randrange(1, 2049)) for k in range(900)]
    items = spark.createDataFrame(lengths, "uid long, length long")
    got = packing.pack(items, deme=100).collect()
    assert sorted(r.uid for r in got) == list(range(900))
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, dict(lengths)[r.uid]))
    assert all(sum(n for _, n in x) <= 2048 for x in by.values())
    best = len(packing.best_fit_decreasing(sorted(range(900), key=lambda i: -lengths[i][1]), [n for _, n in lengths], 2048))
    assert len(by) <= best + 12


def test_genetic_search_improves_or_keeps():
    rng = random.Random(3)
    lengths = [rng.choice([350, 500, 680, 700, 1000, 1020]) for _ in range(120)]
    start = packing.best_fit_decreasing(sorted(range(120), key=lambda i: -lengths[i]), lengths, 2048)
    best = packing.evolve(lengths, [start], 2048, rng, population=4, generations=8)
    assert sorted(i for b in best for i in b) == list(range(120)) and len(best) <= len(start)


def test_license_scan(docs, spark, empty):
    rows = [(1, "Licensed under the APACHE license, version 2.0."), (2, "cc by cc by\nAll rights reserved, (c)"), (3, None), (4, ""),
            (5, "the license is\nunder apache"), (6, "GNU General Public License; cc-by"), (6, "GNU General Public License; cc-by")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(spark.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert got[1].labels == "apache-2.0" and got[1].base_labels == "" and got[1].first_word is None and got[1].score == 1.0
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].base_labels) == (3, 0, 4, "cc-by,reserved")
    assert (got[3].n_words, got[3].labels, got[3].score) == (0, "", 0.0) and got[4].n_words == 0
    assert got[5].labels == "" and got[6].base_labels == "cc-by,gpl"
    assert license_scan.scan_licenses(empty).count() == 0


def test_license_notices_wrapped_over_lines(spark):
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that"
    isc = "# Permission to use, copy, modify, and/or distribute this software for any\n# purpose with or without fee is hereby granted, provided"
    mpl = " * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not"
    gpl = "dnl it under the terms of the GNU General Public License as published\ndnl by the Free Software Foundation, either version 3"
    apart = bsd.replace("\n", "\n" + "other words of the text stand here\n" * 5)
    rows = [(1, bsd), (2, isc), (3, mpl), (4, gpl), (5, "intro\n" * 50 + bsd.replace(" ", "\n") + "\nend" * 50), (6, apart), (7, bsd + "\n\n" + isc)]
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan_licenses(spark.createDataFrame(rows_of(rows), SCHEMA)).collect()}
    assert got == {1: ("bsd", 1.0), 2: ("isc", 1.0), 3: ("mpl-2.0", 1.0), 4: ("gpl,gpl-notice", 1.0), 5: ("bsd", 1.0), 6: ("", 0.0), 7: ("bsd,isc", 1.0)}


def test_windows_across_lines_are_exact():
    rng = random.Random(7)
    names = [f"t{i}" for i in range(30)]
    templates = {f"L{k}": " ".join(rng.sample(names, rng.randrange(2, 9))) for k in range(12)}
    vocabulary = {n.encode() for t in templates.values() for n in t.split()}
    index = license_scan.ContainmentIndex(templates, {n: rng.randrange(100) for n in vocabulary}, 3, 4)
    some = 0
    for _ in range(300):
        words = [rng.choice(names + ["x"] * 20).encode() for _ in range(rng.randrange(60))]
        expected = {}
        for k, t in templates.items():
            own, span = set(license_scan.tokens(t)), -(-4 * len(t.split()) // 3)
            share = max((len(own & set(words[a : a + span])) / len(own) for a in range(len(words))), default=0)
            if share >= 0.75:
                expected[k] = share
        some += len(expected)
        assert index.matches_across_lines(words) == expected
    assert some


def test_containment_index_is_exact():
    rng = random.Random(6)
    names = [f"t{i}" for i in range(30)]
    templates = {f"L{k}": " ".join(rng.sample(names, rng.randrange(2, 9))) for k in range(12)}
    frequency = {n.encode(): rng.randrange(100) for n in names if any(n in t.split() for t in templates.values())}
    index = license_scan.ContainmentIndex(templates, frequency, 3, 4)
    for _ in range(500):
        block = {n.encode() for n in rng.sample(names, rng.randrange(0, 20))}
        expected = {k: share for k, t in templates.items() if (share := len(block & set(license_scan.tokens(t))) / len(set(t.split()))) >= 0.75}
        assert index.matches(block) == expected


def test_greedy_tiles_cover_reordered_passages():
    item = [f"w{i}" for i in range(24)]
    doc = ["x"] * 7 + item[12:] + ["y"] * 3 + item[:12] + ["z"]
    assert sorted(decontamination.greedy_tiles(item, doc, 5)) == [(0, 22, 12), (12, 7, 12)]
    assert decontamination.greedy_tiles(item, ["x"] * 30, 5) == []
    rng = random.Random(1)
    for _ in range(100):
        a, b = [rng.choice("abc") for _ in range(30)], [rng.choice("abc") for _ in range(40)]
        tiles = decontamination.greedy_tiles(a, b, 3)
        assert all(a[p : p + n] == b[t : t + n] and n >= 3 for p, t, n in tiles)
        used = [i for p, _, n in tiles for i in range(p, p + n)]
        assert len(used) == len(set(used))


def test_decontamination(spark, docs, empty):
    rng = random.Random(9)
    passage = [f"q{i}" for i in range(30)]
    bench = spark.createDataFrame([(7, " ".join(passage)), (8, "too short"), (9, None), (None, "a b c d e f g"), (3, " ".join(passage))], "item_id long, text string")
    rows = [(1, "intro " + " ".join(passage[15:]).upper() + "; then " + " ".join(passage[:15])), (2, sentence(rng, 80)), (3, None), (4, ""),
            (5, " ".join(passage[:10])), (6, "too short"), (1, "clean")]
    table = spark.createDataFrame(rows_of(rows), SCHEMA)
    for index_words in (decontamination.INDEX_WORDS, 10):
        got = {r.doc_id: r for r in decontamination.decontaminate(table, bench, index_words=index_words).collect()}
        assert {i for i, r in got.items() if r.contaminated} == {1, 6}  # 6 equals a short item
        assert (got[1].item_id, got[1].coverage, got[1].n_items) == (3, 1.0, 2)
    assert decontamination.decontaminate(table, bench.limit(0)).filter("contaminated").count() == 0
    assert decontamination.decontaminate(empty, bench).count() == 0


def test_quality_base_columns(docs, corpus):
    expected = []
    for i, t in corpus:
        w = words(t)
        c = Counter(zip(w, w[1:], w[2:]))
        covered = {p + k for p, g in enumerate(zip(w, w[1:], w[2:])) if c[g] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        expected.append((i, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), len(lines) - len(set(lines)), len(covered),
                         len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    base = quality_rules.base_columns(docs)
    same([tuple(r) for r in base.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()], expected)


def test_allowed_rejections_is_the_binomial_bound(spark):
    from math import comb

    for n in (0, 1, 50, 400, 2000):
        got = spark.range(1).select(quality_rules.allowed_rejections(f"{n}L", 0.02, "0.01D").alias("k")).first().k
        cdf, best = 0.0, -1
        for k in range(n + 1):
            cdf += comb(n, k) * 0.02**k * 0.98 ** (n - k)
            if cdf > 0.01:
                break
            best = k
        assert got == best, n


def test_quality_rules_bound_false_rejections(spark, empty):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(1200):
        good = i % 4 != 0
        w = [f"word{rng.randrange(10**6)}" + ("" if good or rng.random() < 0.5 else "***") for _ in range(60)]
        rows.append((i, " ".join(w)))
        labels.append((i, int(good)))
    table = spark.createDataFrame(rows_of(rows), SCHEMA)
    marks = spark.createDataFrame([*labels, (None, 1), (5, None)], "doc_id long, quality int")
    got = {r.doc_id: r.kept for r in quality_rules.apply_rules(table, marks).collect()}
    good = [k for i, k in got.items() if i % 4]
    assert sum(not k for k in good) <= quality_rules.ALPHA * len(good)
    assert sum(k for i, k in got.items() if i % 4 == 0) == 0
    one_sided = quality_rules.apply_rules(table, marks.filter("quality = 1"))
    assert one_sided.filter("kept <> (NOT base_failed)").count() == 0
    assert quality_rules.apply_rules(table, marks.filter("quality = 0")).count() == 1200
    unlabelled = quality_rules.apply_rules(table, marks.limit(0))
    assert unlabelled.filter("kept <> (NOT base_failed)").count() == 0
    assert quality_rules.apply_rules(empty, marks).count() == 0


def test_toxicity(spark, empty):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        bad = rng.random() < 0.3
        w = sentence(rng, 30).split()
        if bad:
            w[rng.randrange(30)] = rng.choice(["blorky", "blorkest", "blorkish"])
        if rng.random() < (0.5 if bad else 0.2):  # a group is named more often in bad texts
            w.append("muslim")
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    table = spark.createDataFrame(rows_of([*rows, (5000, None), (5001, ""), (None, "muslim"), (5002, "a muslim"), (5003, "a christian")]), SCHEMA)
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    scored = toxicity.score_documents(table, marks)
    got = {r.doc_id: r for r in scored.collect()}
    truth = {i: t for i, _, t in labels}
    held = [r for r in got.values() if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items() if i is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert abs(got[5002].score - got[5003].score) < 0.05 and got[5002].predicted == 0
    assert got[5000].score == got[5001].score and 0 <= got[5000].score <= 1
    assert scored.count() == 905
    assert toxicity.score_documents(table, marks.limit(0)).filter("predicted = 1").count() == 0
    assert toxicity.score_documents(empty, marks).count() == 0


def test_toxic_run_in_a_long_text_without_spaces(spark):
    rng = random.Random(14)
    signs = [chr(0x4E00 + k) for k in range(300)]
    rows, labels = [], []
    for i in range(600):
        text = "".join(rng.choice(signs) for _ in range(400))
        bad = i % 3 == 0
        if bad:
            at = rng.randrange(60, 340)
            text = text[:at] + "\u6bd2\u866b\u5783\u573e\u6eda" + text[at:]
        rows.append((i, text))
        labels.append((i, 1, int(bad)))
    rows.append((5000, "\u3002".join(t for _, t in rows[1:3]) * 20 + rows[0][1] + rows[1][1] * 20))
    table = spark.createDataFrame(rows_of(rows), SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_documents(table, marks).collect()}
    held = [r for r in got.values() if r.held_out and r.doc_id < 600]
    assert len(held) > 80 and all(r.predicted == (r.doc_id % 3 == 0) for r in held)
    assert got[5000].predicted == 1


def test_features_of_short_and_long_words():
    feature = toxicity.Features()
    for n in (1, 4, 62, 63, 500):
        word = "".join(chr(97 + i * i % 26) for i in range(n))
        w = "^" + word + "$"
        parts = {w, w[:4], w[:5], w[:6], w[:7], *(word[i : i + k] for k in (4, 5) for i in range(n - k + 1))}
        assert set(feature[word.encode()]) == {zlib.crc32(p.encode()) % toxicity.BUCKETS for p in parts}
        assert (word.encode() in feature) == (n <= 62)


def test_language_id(spark):
    docs = spark.createDataFrame([(i, "the house and the garden with them", "en") for i in range(20)] + [(50 + i, "das haus und der garten mit ihnen", "de") for i in range(20)]
                                 + [(99, None, "de"), (98, "x", None)], "doc_id long, text string, lang string")
    pages = [(i, f"http://a.example.org/{i}", f"<html lang='en'><body><p>the house and them {i}</p></body></html>") for i in range(12)]
    pages += [(100 + i, "http://b.beispiel.de/", "<HTML lang=\"de\"><script>the the the</script>das haus und der garten") for i in range(12)]
    pages += [(200, "http://b.beispiel.de/x", None), (201, None, "the garden and the house"), (202, "not an address", ""), (None, None, None), (0, pages[0][1], pages[0][2])]
    table = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({})
    got = language_id.identify(table, docs).collect()
    assert len(got) == len(pages)
    by = {r.page_id: r for r in got}
    assert by[0].language == "en" and by[105].language == "de" and by[200].language == "de" and by[201].language == "en"
    assert by[200].text_language is None and by[105].declared == "de" and by[105].host == "b.beispiel.de"
    assert all(0 < r.probability <= 1 + 1e-9 for r in got)
    assert language_id.identify(table.limit(0), docs).count() == 0
    assert language_id.identify(table, docs.limit(0)).filter("language IS NOT NULL").count() == 0
