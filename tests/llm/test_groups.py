"""Spelling variants, whitening and SimHash groups against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from accordant.llm import queries, simhash_balls, spelling_variants, whitening

SCHEMA = "doc_id long, text string, word string, n long, key string, fingerprint string, component_id string"


def table(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1, "x", "x", "x") for i, t in texts], SCHEMA).repartition(5)


def near(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def forms_by_hand(texts, slips):
    counts = Counter()
    for i, text in texts:
        run = ""
        for ch in (text or "") + " ":
            if "A" <= ch <= "Z" or "a" <= ch <= "z" or "À" <= ch <= "ÿ":
                run += ch.lower() if ch < "\x80" else ch
            elif run:
                h = zlib.crc32(f"{i}:{run}".encode())
                if slips and i is not None and h % slips == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
                run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    form, close = {}, {}
    for w in words:
        others = [o for o in words if near(w, o)]
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
        close[w] = len(others)
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], close[w], words.get(form[w])))
    return rows


def variants_of(spark, texts, **more):
    got = spelling_variants.group_variants(table(spark, texts), **more)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_spelling_variants(spark):
    rng = random.Random(3)
    letters = "abcèÿ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 10))) for _ in range(60)] + ["aaaaaaa", "aaaaaaaa", "aaaaaabaaaaa"]
    words = list(base)
    for w in base:  # chains of edits, each some times rarer
        for _ in range(3):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])
            words.append(w)
    texts = []
    for i in range(400):
        chosen = rng.choices(words, weights=[1 + 300 // (k + 1) for k in range(len(words))], k=80)
        texts.append((i, rng.choice([" ", "-", "7", "Ā"]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in chosen)))
    texts += [(880, "hgfedcba " * 900 + "hgfedcb " * 150 + "hgfedc " * 25 + "hgfedx " * 5)]  # a chain
    texts += [(7, "aaaaaaa aaaaaaa"), (7, "aaaaaaa aaaaaaa"), (None, "aaaaaab " * 9), (900, None), (901, ""), (902, "漢字 ★"), (903, "abcabc×abc " * 6),
              (904, "z" * 3000 + " "), *((910 + k, "y" * 2000) for k in range(5)), *((920 + k, "y" * 2001) for k in range(5))]
    for slips in (199, 3, None):
        expected = forms_by_hand(texts, slips)
        assert sum(r[1] is not None for r in expected) > 5
        assert variants_of(spark, texts, slips=slips) == expected
    assert any(r[2] not in (r[0], r[1]) for r in expected)  # a chain of forms
    assert variants_of(spark, []) == set()
    assert variants_of(spark, [(1, None), (2, "short")]) == set()


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(4)
    for _ in range(500):
        word = "".join(rng.choice("abcd") for _ in range(rng.randrange(6, 14)))
        cost = defaultdict(lambda: 1, {x + y: rng.randrange(1, 50) for x in "abcd" for y in "abcd"})
        rank = {g: k for k, g in enumerate(sorted(cost, key=lambda g: (cost[g], g)))}
        prefix, last = spelling_variants.prefix_of(word, rank)
        assert prefix == [p for p in range(len(word) - 1) if rank[word[p : p + 2]] <= last] and len(prefix) >= 3
        left, right = spelling_variants.pivots_of(word, prefix, cost)
        assert {left, right} <= set(prefix) and right - left >= 2
        pairs = [(p, q) for p in prefix for q in prefix if q - p >= 2]
        assert cost[word[left : left + 2]] + cost[word[right : right + 2]] == min(cost[word[p : p + 2]] + cost[word[q : q + 2]] for p, q in pairs)


VECTORS = "vec_id long, embedding array<float>, x string, n string, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], VECTORS).repartition(6)


def check_whitening(got, rows, d, k):
    fit = [tuple(int(np.floor(256 * float(np.float32(c)))) for c in v) for _, v in rows]
    distinct = sorted(set(fit))
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in distinct])
    cov = centred.T @ centred / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append(r)
    assert len(got) == len(rows) * k and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and 0 <= got[0].identity_error < 1e-9
    signs = {}
    for (i, _), x in zip(rows, fit):
        far = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        own = (np.array([n * c - s for c, s in zip(x, sums)], float) / n) @ v
        for r in by[i]:
            j = r.component - 1
            assert r.deviation == far and abs(r.explained / (e[j] / np.trace(cov)) - 1) < 1e-10
            z = own[j] / np.sqrt(e[j])
            sign = signs.setdefault(j, 1 if z * r.whitened >= 0 else -1) if abs(z) > 1e-3 else signs.get(j)
            if sign:
                assert abs(r.whitened - sign * z) < 1e-8


def test_whitening(spark):
    rng = np.random.default_rng(2)
    turn = np.linalg.qr(rng.standard_normal((9, 9)))[0]
    base = (rng.standard_normal((700, 9)) * [5, 3, 2, 1.5, 1, 0.5, 0.2, 0.1, 0.05]) @ turn + 3
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base.astype(np.float32))]
    rows += [(700 + i, rows[5][1]) for i in range(300)]  # one very common vector
    unsound = [(2000, None), (2001, [1.0] * 8 + [None]), (2002, [float("nan")] * 9), (2003, [float("-inf")] + [0.0] * 8), (2004, []), (2005, [1.0, 2.0])]
    got = whitening.whiten(vectors(spark, rows + unsound)).collect()
    check_whitening(got, rows, 9, 4)
    small = [(1, [0.0, 1.0, 5.0]), (2, [2.0, -1.0, 5.0]), (3, [0.5, 0.25, 5.0])]  # a dimension without variance
    check_whitening(whitening.whiten(vectors(spark, small)).collect(), small, 3, 2)
    repeated = whitening.whiten(vectors(spark, [*small, small[0], (None, small[1][1])])).collect()
    assert Counter(r.vec_id for r in repeated) == {1: 4, 2: 2, 3: 2, None: 2}
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # nothing varies
    assert whitening.whiten(vectors(spark, [])).count() == 0 and whitening.whiten(vectors(spark, unsound[:1])).count() == 0
    huge = [(i, [float(c) * 2.0**44 for c in v]) for i, v in enumerate(rng.standard_normal((40, 3)).astype(np.float32))]
    far = whitening.whiten(vectors(spark, huge)).collect()
    assert len(far) == 120 and {r.deviation for r in far} == {None} and far[0].identity_error < 1e-6


@pytest.mark.parametrize("case", ["random", "rank", "graded", "close", "equal", "zero"])
def test_directions_of_small_matrices(case):
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.standard_normal((24, 24)))[0]
    values = {"random": rng.random(24) + 0.1, "rank": np.r_[np.linspace(3, 1, 6), np.zeros(18)], "graded": np.logspace(0, -12, 24),
              "close": np.r_[5, 5 - 1e-9, 5 - 1e-5, 4, np.linspace(3, 0.1, 20)], "equal": np.r_[5, 2, 2, 2, 2, 2, np.linspace(1, 0.1, 18)], "zero": np.zeros(24)}[case]
    r = np.linalg.qr(np.diag(values) @ q, mode="r") if case != "zero" else np.zeros((24, 24))
    squares, v = whitening.leading_directions(r, 4)
    expected = np.sort(values)[::-1][:4] ** 2
    assert len(squares) == (0 if case == "zero" else 4)
    if len(squares):
        assert np.allclose(squares, expected, rtol=1e-12) and np.allclose(v.T @ v, np.eye(4), atol=1e-13)
        assert np.max(np.abs(r.T @ (r @ v) - v * squares)) < 1e-13 * expected[0]
        a, b, turn = whitening.bidiagonalise(r)
        assert np.allclose(turn @ turn.T, np.eye(24), atol=1e-13)
        if case == "graded":  # small values of a bidiagonal matrix to high relative accuracy
            a = np.logspace(0, -8, 12)
            exact = np.linalg.svd(np.diag(a))[1] ** 2
            assert np.allclose(whitening.dqds(a, np.zeros(11)), exact, rtol=1e-14)


def fingerprint_by_hand(text, size=4):
    words = [w.decode() for w in bytes(b + 32 if 65 <= b < 91 else b for b in (text or "").encode()).split()]
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest_linked(fps: dict[int, int], reach: int = 4) -> dict[int, int]:
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    every = list(fps)
    for i, a in enumerate(every):
        for b in every[:i]:
            if (a ^ b).bit_count() <= reach:
                root[find(a)] = find(b)
    low = {}
    for f, i in fps.items():
        low[find(f)] = min(low.get(find(f), i), i)
    return {f: low[find(f)] for f in fps}


def test_simhash_groups(spark):
    rng = random.Random(8)
    words = "the Of and modèle data join rows hash key scan".split()
    texts = []
    for i in range(120):
        w = [rng.choice(words) + str(rng.randrange(300)) for _ in range(rng.randrange(20, 260))]
        texts.append((3 * i, " ".join(w)))
        for k in range(rng.randrange(4)):  # near copies
            w[rng.randrange(len(w))] = f"edit{k}"
            texts.append((3 * i + 1 + k % 2, "\n".join(w).upper()))
    texts += [(-4, None), (5000, ""), (5001, " \t"), (5002, "one"), (5003, "ONE"), (5004, "one two three"), (5005, "word " * 90_000), (5006, "word " * 4),
              (None, texts[0][1]), (None, "alone with no id at all"), texts[1], texts[1]]
    fps = {}
    prints = [fingerprint_by_hand(t) for _, t in texts]
    for (i, _), f in zip(texts, prints):
        fps[f] = min(fps.get(f, 1 << 40), 1 << 40 if i is None else i)
    low = smallest_linked(fps)
    expected = Counter((i, f"{f:016x}", None if low[f] == 1 << 40 else low[f]) for (i, _), f in zip(texts, prints))
    got = simhash_balls.group_documents(table(spark, texts))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == expected
    assert len(set(low.values())) < len(fps)
    assert simhash_balls.group_documents(table(spark, [])).count() == 0


@pytest.mark.parametrize("held", [simhash_balls.HELD, 30_000, 2_500])
def test_balls_reach_every_link(spark, held):
    rng = random.Random(9)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(rng.randrange(6)):  # paths of steps of up to five bits
            for _ in range(rng.randrange(1, 6)):
                f ^= 1 << rng.randrange(64)
            fps.add(f)
    centre = rng.getrandbits(64)
    fps |= {centre ^ 1 << a ^ 1 << b for a in range(20) for b in range(a)}  # one busy place
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    links = simhash_balls.near_fingerprints(spark.createDataFrame(signed, "fingerprint long"), held=held).collect()
    assert all(r.a != r.b and ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in links)
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for r in links:
        root[find(r.a % (1 << 64))] = find(r.b % (1 << 64))
    order = {f: k for k, f in enumerate(sorted(fps))}
    groups = defaultdict(list)
    for f in fps:
        groups[find(f)].append(order[f])
    expected = smallest_linked(order)
    for members in groups.values():
        assert {expected[f] for f in fps if order[f] in members} == {min(members)}


def test_registered_queries(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert {tuple(r) for r in queries.QUERIES["op11_spelling_variants"](spark, sf).collect()} == forms_by_hand(docs, 199)
    prints = {i: fingerprint_by_hand(t) for i, t in docs}
    fps = {}
    for i, f in prints.items():
        fps[f] = min(fps.get(f, i), i)
    low = smallest_linked(fps)
    assert {tuple(r) for r in queries.QUERIES["op13_simhash_dedup"](spark, sf).collect()} == {(i, f"{f:016x}", low[f]) for i, f in prints.items()}
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check_whitening(queries.QUERIES["op12_embedding_whitening"](spark, sf).collect(), rows, 64, 4)
