"""The pipeline stage by stage, against plain Python on each stage's own input."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from accordant.llm import decontamination, jaccard_join, packing
from accordant.llm.text import stored

WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(12)
    root = str(tmp_path_factory.mktemp("sf"))
    sentence = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    item = sentence(30)
    rows, labels = [], []
    for i in range(600):
        bad = i % 5 == 0
        text = "\n".join(sentence(12) for _ in range(6))
        rows.append((i, text + (" " + rng.choice(["blorky", "blorkest"]) if bad else "")))
        labels.append((i, 1, int(bad)))
    clean = [t for i, t in rows if i % 5]
    block = "\n".join(sentence(9) for _ in range(4))
    w = clean[7].split(" ")
    w[20], w[21] = "edit", "edit2"
    rows += [(1000, clean[3]), (1001, " ".join(w).replace("\n", " ")), (1002, item + "\n" + sentence(5)), (1003, sentence(20) + "\n" + block),
             (1004, block + "\n" + sentence(20)), (1005, None), (1006, ""), (1007, "blorky blorky"), (1008, sentence(40)), (1008, rows[1][1])]
    spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item), (2, sentence(25))], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_stages_on_their_own_inputs(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.collect()]
        columns = docs.columns
        docs = stored(stage(spark, docs, tables), f"test-{name}")
        seen[name] = (before, [tuple(r) for r in docs.collect()])
        if name != "packing":
            assert docs.columns == columns

    before, after = seen["toxicity"]
    gone = {r[0] for r in before} - {r[0] for r in after}
    truth = {r[0] for r in before if "blork" in (r[1] or "")}
    assert gone == truth

    before, after = seen["line_dedup"]
    first, expected = {}, []
    for i, t, *rest in sorted(before, key=lambda r: (r[0], r[1] or "")):
        lines = (t or "").split("\n") if t is not None else []
        cut = set()
        for p in range(len(lines) - 2):
            if first.setdefault(tuple(lines[p : p + 3]), (i, p)) != (i, p):
                cut |= {p, p + 1, p + 2}
        if not lines or len(cut) < len(lines):
            new = t if not cut else "\n".join(x for p, x in enumerate(lines) if p not in cut)
            expected.append((i, new, rest[0], rest[1], len(new or "")))
    assert Counter(after) == Counter(expected) and 1000 not in {r[0] for r in after}

    before, after = seen["jaccard_join"]
    sets = {r: jaccard_join.shingles(jaccard_join.words_of(r[1]), 5) for r in before}
    kept = Counter(after)
    assert not kept - Counter(before)
    place = lambda r: (r[0] is None, r[0] or 0)
    for r in before:
        twins = [s for s in before if place(s) < place(r) and sets[r] and 5 * len(sets[r] & sets[s]) >= 4 * len(sets[r] | sets[s])]
        assert (kept[r] > 0) == (not twins)
    assert 1001 not in {r[0] for r in after}

    before, after = seen["decontamination"]
    item = decontamination.words_of(spark.read.parquet(f"{tables}/benchmark.parquet").filter("item_id = 1").first()["text"])
    leaked = {r[0] for r in before if sum(n for _, _, n in decontamination.greedy_tiles(item, decontamination.words_of(r[1]))) * 2 >= len(item)}
    assert {r[0] for r in before} - {r[0] for r in after} == leaked == {1002}

    before, after = seen["packing"]
    assert {r[0] for r in after} == {r[0] for r in before}
    used = defaultdict(int)
    for r in after:
        used[r[5]] += r[3]
    assert max(used.values()) <= packing.CAPACITY


def test_run_gives_the_last_stage(spark, tables):
    got = corpus_pipeline.run(spark, tables)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 300


ODD = "doc_id long, text string, score double, predicted string, held_out string, n_lines string, n_removed string, n_chars long, component_id string, coverage string"


def odd(spark, rows):
    return spark.createDataFrame([(i, t, 0.25, "p", "h", "l", "r", 7, "c", "v") for i, t in rows], ODD)


def test_rows_that_share_an_id_or_have_none(spark, tables):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    item = spark.read.parquet(f"{tables}/benchmark.parquet").filter("item_id = 1").first()["text"]
    one, two, three = say(60), say(60), say(60)
    rows = [(1, one), (5, one + " more"), (5, two), (5, two), (None, three), (None, three + " x"), (None, one), (7, item + " " + say(9)), (7, say(40)), (None, item), (9, None), (9, ""), (9, None)]
    docs = odd(spark, rows)
    stages = dict(corpus_pipeline.STAGES)
    got = stages["jaccard_join"](spark, docs, tables)
    assert got.columns == docs.columns
    texts = Counter((r.doc_id, r.text) for r in got.collect())
    assert texts[(1, one)] == 1 and texts[(5, two)] == 1 and (5, one + " more") not in texts and (None, one) not in texts
    assert texts[(None, three)] + texts[(None, three + " x")] == 1 and texts[(9, None)] == 1 and texts[(9, "")] == 1
    clean = stages["decontamination"](spark, docs, tables)
    assert Counter((r.doc_id, r.text) for r in clean.collect()) == Counter(r for r in rows if not (r[1] or "").startswith(item))


def test_columns_of_the_input_come_back(spark, tables):
    block = "\n".join(f"line {i} of a block" for i in range(4))
    docs = odd(spark, [(1, block), (2, block + "\nand more"), (3, "blorky blorky"), (None, block), (4, None)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, tables)
        assert got.columns == docs.columns and got.dtypes == docs.dtypes, name
        for r in got.collect():
            assert (r.score, r.predicted, r.held_out, r.n_lines, r.n_removed, r.component_id, r.coverage) == (0.25, "p", "h", "l", "r", "c", "v")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), tables).count() == 0
