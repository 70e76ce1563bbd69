"""Operators without SQL against their definitions in plain Python."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from accordant.llm import decontamination, language_id, license_scan, packing, quality_rules, toxicity
from accordant.llm.text import hashed_words


def plain_tiles(item, doc, shortest):
    """Greedy string tiling: the longest common run of unmarked words is marked, again and again."""
    free_i, free_d, covered = [True] * len(item), [True] * len(doc), 0
    while True:
        best = (0, 0, 0)
        for p in range(len(item)):
            for t in range(len(doc)):
                n = 0
                while p + n < len(item) and t + n < len(doc) and free_i[p + n] and free_d[t + n] and item[p + n] == doc[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, p, t)
        n, p, t = best
        if n < shortest:
            return covered
        free_i[p : p + n] = [False] * n
        free_d[t : t + n] = [False] * n
        covered += n


def test_tiles_cover_what_plain_tiling_covers():
    rng = random.Random(1)
    for trial in range(1500):
        item = [rng.choice("abcd") for _ in range(rng.randrange(5, 30))]
        doc = [rng.choice("abcd") for _ in range(rng.randrange(0, 40))]
        for _ in range(rng.randrange(4)):
            a = rng.randrange(len(item))
            at = rng.randrange(len(doc) + 1)
            doc[at:at] = item[a : a + rng.randrange(3, 15)]
        tiles = decontamination.greedy_tiles(item, doc, 5)
        used_i, used_d = Counter(), Counter()
        for p, t, n in tiles:
            assert n >= 5 and item[p : p + n] == doc[t : t + n]
            used_i.update(range(p, p + n))
            used_d.update(range(t, t + n))
        assert max([0, *used_i.values(), *used_d.values()]) <= 1
        left_i = [None if i in used_i else w for i, w in enumerate(item)]
        left_d = [0 if i in used_d else w for i, w in enumerate(doc)]
        assert plain_tiles(left_i, left_d, 5) == 0, "a common run was left"
        covered = sum(n for _, _, n in tiles)
        assert covered == plain_tiles(item, doc, 5), (item, doc)


def test_decontamination_by_definition(spark):
    rng = random.Random(2)
    say = lambda n: [rng.choice("abcdefgh") for _ in range(n)]
    items = [(k, " ".join(say(rng.randrange(6, 25)))) for k in range(6)] + [(None, " ".join(say(12))), (20, "what is two"), (21, "東京は日本の首都"), (22, None), (23, "")]
    rows = []
    for i in range(150):
        doc = say(rng.randrange(0, 40))
        for _ in range(rng.randrange(3)):
            words = (rng.choice(items)[1] or "").split()
            a = rng.randrange(len(words) + 1)
            at = rng.randrange(len(doc) + 1)
            doc[at:at] = words[a:] + words[:a]
        rows.append((i, " ".join(doc)))
    rows += [(200, "What is TWO?"), (201, "what is two and more"), (202, "東京は、日本の首都。"), (203, None), (204, ""), (None, items[0][1]), (None, "q r s t u"), (205, "w " * 60_000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id long, text string, item_id string, coverage string")
    expected = Counter()
    for i, t in rows:
        words, hits = decontamination.words_of(t), []
        for k, it in items:
            own = decontamination.words_of(it)
            if 0 < len(own) < 5:
                covered = len(own) if words == own else 0
            else:
                covered = plain_tiles(own, words, 5) if own and len(words) < 1000 else 0
            if own and 2 * covered >= len(own) and covered:
                hits.append((covered / len(own), k))
        best = min(hits, key=lambda h: (-h[0], h[1] is None, h[1] or 0), default=(0.0, None))
        expected[(i, bool(hits), len(hits), best[1], round(best[0], 9))] += 1
    for size in (decontamination.INDEX_WORDS, 30):
        got = decontamination.decontaminate(docs, bench, index_words=size).collect()
        assert Counter((r.doc_id, r.contaminated, r.n_items, r.item_id, round(r.coverage, 9)) for r in got) == expected
    assert sum(k[1] for k in expected) > 30


def test_languages_by_definition(spark):
    rng = random.Random(3)
    words = {"en": "the house and garden with them".split(), "de": "das haus und der garten mit ihnen".split(), "fr": "la maison et le jardin avec".split()}
    docs = [(k, " ".join(rng.choices(words[lang], k=30)), lang) for k, lang in enumerate(["en", "de", "fr"] * 10)] + [(90, None, "de"), (91, "x", None), (92, "", "fr")]
    pages = []
    for k in range(120):
        lang = rng.choice(list(words))
        host = rng.choice(["a.org", "www.a.org", "b.de", "x.b.de", "c.fr", "shop.c.fr"])
        html = f"<html lang='{rng.choice([lang, 'en'])}'><p>{' '.join(rng.choices(words[lang] + words['en'], k=rng.randrange(0, 12)))}</p>"
        pages.append((k, rng.choice([f"https://{host}/{k}", f"http://{host}:80/x", None, "nowhere"]), rng.choice([html, html, "", None])))
    pages += [(300, "http://new.example.de/", ""), (301, "http://lone.zz/", ""), (302, None, None), (5, pages[5][1], pages[5][2])]
    found, log_p = language_id.trigram_model(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    n = len(found)
    table = spark.createDataFrame([(*p, "h", "s") for p in pages], "page_id long, url string, html string, host string, score string")
    evidence = language_id.page_evidence(table).collect()
    scores = [log_p[:, language_id.trigram_classes(language_id._plain(e.text))].sum(1, dtype=np.float64) for e in evidence]
    votes = [int(np.argmax(s)) if s.max() != s.min() else None for s in scores]
    counts = {key: defaultdict(lambda: np.zeros(n)) for key in ("suffix", "domain", "host", "declared")}
    whole = np.zeros(n)
    for e, v in zip(evidence, votes):
        if v is not None:
            whole[v] += 1
            for key, c in counts.items():
                c[e[key]][v] += 1
        else:
            for key, c in counts.items():
                c[e[key]]
    kinds = max(1, sum(d != "" for d in counts["declared"]))
    expected = []
    for e, s, v in zip(evidence, scores, votes):
        own = np.eye(n)[v] if v is not None else np.zeros(n)
        prior = (whole - own + 1) / (whole.sum() - own.sum() + n)
        for key in ("suffix", "domain", "host"):
            c = counts[key][e[key]] - own
            prior = (c + language_id.STRENGTH * prior) / (c.sum() + language_id.STRENGTH)
        total = s / language_id.TEMPERATURE + np.log(prior)
        if e.declared:
            total = total + np.log((counts["declared"][e.declared] - own + 1) / (whole - own + kinds))
        p = np.exp(total - total.max())
        p /= p.sum()
        expected.append((e.page_id, found[int(np.argmax(p))], round(float(p.max()), 6), None if v is None else found[v], e.declared, e.host))
    got = language_id.identify(table, spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()
    assert Counter((r.page_id, r.language, round(r.probability, 6), r.text_language, r.declared, r.host) for r in got) == Counter(expected)


def test_labels_need_whole_short_notices(spark):
    rows = [(1, "Released under the Apache License"), (2, "Licensed under CC BY 4.0"), (3, "The license fee was released by the board under pressure"),
            (4, "released " + "x " * 2000 + "under " + "y " * 500 + "the mit license"), (5, "Released\nunder the // MIT License."), (6, "it is licensed under cc\nBY-NC 4.0"),
            (7, " ".join("Redistribution and use in source and binary forms with or without modification are permitted".split()[:-2]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_scan.scan_licenses(docs).collect()}
    assert got == {1: "", 2: "cc-by", 3: "", 4: "", 5: "mit-short", 6: "cc-by,cc-by-nc", 7: "bsd"}


@pytest.mark.parametrize("deme", [40, 100])
def test_packing_goes_on_while_it_saves(spark, deme):
    rng = random.Random(deme)
    lengths = {k: rng.randrange(300, 1500) for k in range(700)}
    got = packing.pack(spark.createDataFrame(list(lengths.items()), "uid long, length long"), deme=deme).collect()
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, lengths[r.uid]))
    assert sorted(r.uid for r in got) == list(range(700)) and all(sum(n for _, n in x) <= 2048 for x in by.values())
    for x in by.values():
        assert [o for o, _ in sorted(x)] == [0, *np.cumsum([n for _, n in sorted(x)])[:-1].tolist()]
    one = packing.best_fit_decreasing(sorted(lengths, key=lambda i: -lengths[i]), [lengths[i] for i in range(700)], 2048)
    assert math.ceil(sum(lengths.values()) / 2048) <= len(by) <= len(one) + round(700 / deme)  # at most one more for each deme


def test_words_hashed_together():
    rng = random.Random(0)
    texts = [bytes(rng.choice(b"ab \t\n\x0b\x0c\rz\xc3\xa9") for _ in range(rng.randrange(0, 60))) for _ in range(500)]
    texts += [b"", b"x" * 700, b"y" * 513 + b" " + b"x" * 700, b" " * 5]
    h, n = hashed_words(texts)
    words = [w for t in texts for w in t.split()]
    assert n.tolist() == [len(t.split()) for t in texts] and len(h) == len(words)
    of = {}
    assert all(of.setdefault(w, v) == v for w, v in zip(words, h.tolist())) and len(set(of.values())) == len(of)
    assert hashed_words([])[0].size == 0


def test_penalty_spares_neutral_mentions(spark):
    """Some groups are named mostly in toxic texts. Held-out neutral texts that name them: far fewer are called toxic with the penalty."""
    rng = random.Random(6)
    plain = [f"w{k}" for k in range(300)]
    rows, labels, neutral = [], [], set()
    for i in range(3000):
        bad = rng.random() < 0.35
        w = rng.choices(plain, k=25)
        if bad:
            w[3] = rng.choice(["blorky", "grunkish", "snarfel"]) if rng.random() < 0.8 else rng.choice(plain)  # not every toxic text gives itself away
        if rng.random() < (0.7 if bad else 0.06):
            w.append(rng.choice(["muslims", "musulmanes", "juifs", "frauen"]))
            if not bad:
                neutral.add(i)
        elif rng.random() < 0.2:
            w.append(rng.choice(["christians", "cristianos", "bouddhistes", "männer"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    wrong, accuracy = {}, {}
    for weight in (0.0, toxicity.COUNTERFACTUAL):
        held = [r for r in toxicity.score_documents(docs, marks, counterfactual=weight).collect() if r.held_out]
        wrong[weight] = sum(r.predicted for r in held if r.doc_id in neutral)
        accuracy[weight] = sum(r.predicted == labels[r.doc_id][1] for r in held) / len(held)
    assert wrong[0.0] >= 10 and wrong[toxicity.COUNTERFACTUAL] <= wrong[0.0] / 3, wrong
    assert accuracy[toxicity.COUNTERFACTUAL] > 0.85, accuracy


def test_verdicts_of_quality_rules_by_definition(spark):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(2600):
        lang = "en" if i % 4 else ("de" if i % 8 else None)
        bad = rng.random() < 0.4
        w = [f"word{rng.randrange(3000)}" for _ in range(rng.randrange(40, 90))]
        if bad and rng.random() < 0.7:
            w = [x + "#*$" if rng.random() < 0.5 else x for x in w]
        if bad and rng.random() < 0.3:
            w = [x * 4 for x in w]
        text = " ".join(w) if rng.random() < 0.5 else "\n".join([" ".join(w[k : k + 8]) for k in range(0, len(w), 8)] + ["same line"] * (5 * bad))
        rows.append((i, text, lang, "x", "x"))
        labels.append((i, rng.choice([None, 2]) if i % 97 == 0 else int(not bad)))
    rows += [(9000, None, "en", "x", "x"), (None, rows[1][1], "en", "x", "x"), (1, rows[1][1], "en", "x", "x")]
    labels += [(1, labels[1][1]), (None, 1), (77_777, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string, stratum string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    base = [r.asDict() for r in quality_rules.base_columns(docs).collect()]

    def statistics(r):
        n = r["n_words"]
        per = lambda x, y, z=1000: x * z // y if y else 0
        return {k: min(v, quality_rules.TOP) for k, v in {
            "symbols": per(r["n_symbols"], n), "dup_lines": per(r["n_dup_lines"], r["n_lines"]), "repeats": per(r["n_repeat_words"], n),
            "long_words": per(r["word_chars"], n, 100), "short_words": max(quality_rules.TOP - per(r["word_chars"], n, 100), 0)}.items()}

    marked = {(i, q) for i, q in labels if q in (0, 1) and i is not None}
    of = defaultdict(list)
    for r in base:
        if not r["base_failed"]:
            for i, q in marked:
                if i == r["doc_id"]:
                    for rule, v in statistics(r).items():
                        of[(r["stratum"], rule)].append((v, q))
    level, share = quality_rules.DELTA / len(of), quality_rules.ALPHA / len(quality_rules.RULES)
    cutoffs = {}
    for family, seen in of.items():
        good, bad = sum(q for _, q in seen), sum(1 - q for _, q in seen)
        allowed, cdf = -1, 0.0
        for k in range(good + 1):
            cdf += math.exp(math.lgamma(good + 1) - math.lgamma(k + 1) - math.lgamma(good - k + 1) + k * math.log(share) + (good - k) * math.log(1 - share))
            if cdf > level:
                break
            allowed = k
        best = None
        for cut in {v for v, _ in seen}:
            g, b = sum(q for v, q in seen if v > cut), sum(1 - q for v, q in seen if v > cut)
            gain = (b / bad if bad else 0.0) - quality_rules.COST * (g / good if good else 0.0)
            if g <= allowed and gain > 0:
                best = max(best or (gain, cut), (gain, cut))
        if best:
            cutoffs[family] = best[1]
    assert {f[1] for f in cutoffs} >= {"symbols", "dup_lines"}
    expected = Counter()
    for r in base:
        rejected = any(v > cutoffs.get((r["stratum"], rule), quality_rules.TOP) for rule, v in statistics(r).items())
        expected[(r["doc_id"], r["base_failed"], not r["base_failed"] and not rejected)] += 1
    got = Counter((r.doc_id, r.base_failed, r.kept) for r in quality_rules.apply_rules(docs, marks).collect())
    assert got == expected and sum(not k[1] and not k[2] for k in got) > 300
