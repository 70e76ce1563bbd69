"""Toxicity scores from a logistic model that is held still under swaps of identity terms."""

from __future__ import annotations

import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm.text import PLAIN, map_rows

#: Labelled rows that the model is fitted on at most, the smallest digests of their ids.
FIT_ROWS = 20_000
#: Hashed features of which the most telling ones are selected.
BUCKETS, SELECTED = 1 << 20, 4_096
#: Least likelihood-ratio statistic of a selected feature, and least number of documents.
LEAST_G2, LEAST_DOCS = 12.0, 4
#: Characters up to which the features of a word are remembered.
LONG = 64
STEPS, RATE, L2 = 400, 0.2, 1e-4
#: Weight of the squared change of a score when identity terms are swapped.
COUNTERFACTUAL = 1.0

# Groups of identity terms; within a group, each term stands for the others.
IDENTITY_TERMS = (
    ("men", "women"), ("man", "woman"), ("boys", "girls"), ("he", "she"), ("his", "her"), ("male", "female"),
    ("black", "white", "asian", "latino"), ("african", "european", "american", "mexican", "chinese", "indian"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"), ("immigrants", "refugees", "natives", "foreigners"),
    ("young", "old"), ("blind", "deaf", "disabled"),
    # German
    ("männer", "frauen"), ("mann", "frau"), ("jungen", "mädchen"), ("männlich", "weiblich"),
    ("christen", "muslime", "juden", "buddhisten", "atheisten"), ("christlich", "muslimisch", "jüdisch", "buddhistisch"),
    ("schwarze", "weiße"), ("schwul", "lesbisch", "bisexuell"), ("flüchtlinge", "einwanderer", "ausländer", "einheimische"),
    # French
    ("hommes", "femmes"), ("homme", "femme"), ("garçons", "filles"), ("masculin", "féminin"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"), ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"),
    ("noirs", "blancs"), ("homosexuels", "lesbiennes", "bisexuels"), ("immigrés", "réfugiés", "étrangers"),
    # Spanish
    ("hombres", "mujeres"), ("hombre", "mujer"), ("niños", "niñas"), ("masculino", "femenino"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"), ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo"),
    ("negros", "blancos"), ("homosexuales", "lesbianas", "bisexuales"), ("inmigrantes", "refugiados", "extranjeros"),
)


def swaps(groups=IDENTITY_TERMS) -> dict[bytes, bytes]:
    """Each identity term and the next of its group."""
    return {a.encode(): b.encode() for g in groups for a, b in zip(g, (*g[1:], g[0]), strict=True)}


def words_of(text: str | None) -> set[bytes]:
    return set((text or "").lower().encode().translate(PLAIN).split())


class Features(dict):
    """Hashed features of a word: the word, its beginnings and its runs of four and five characters.

    Text without ASCII separators is one word and is taken whole; words of over ``LONG`` characters aren't remembered.
    """

    def __init__(self, keep: dict[int, int] | None = None, limit: int = 300_000):
        super().__init__()
        self.keep, self.limit = keep, limit

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        w = "^" + word.decode() + "$"
        parts = chain((w,), (w[:k] for k in (4, 5, 6, 7)), (w[i : i + k] for k in (4, 5) for i in range(1, len(w) - k)))
        found = {zlib.crc32(p.encode()) % BUCKETS for p in parts}
        value = tuple(found) if self.keep is None else tuple(self.keep[f] for f in found if f in self.keep)
        if len(w) <= LONG:
            if len(self) >= self.limit:
                self.clear()
            self[word] = value
        return value

    def of(self, words: set[bytes]) -> set[int]:
        return set().union(*filter(None, map(self.__getitem__, words)))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int) -> DataFrame:
    """(``text``, ``label``) of the rows to learn from: labelled, and crc32(id as text) mod 5 not 0."""
    known = (labels.filter(f"{label_col} IN (0, 1)").select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0)
             .groupBy("_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(fit_rows))
    return docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text")).join(known, "_id").select("text", "label")


def select_features(rows: DataFrame) -> tuple[np.ndarray, int]:
    """The features that tell labels apart best by G², strongest first; and the number of rows."""
    def make():
        counts, feature = np.zeros((2, BUCKETS), np.int32), Features()
        size = np.zeros(2, np.int32)

        def step(texts, labels):
            for text, y in zip(texts, labels, strict=True):
                size[y] += 1
                counts[y, list(feature.of(words_of(text)))] += 1
            return [], [], []

        def last():
            at = np.flatnonzero(counts.sum(0))
            n = 1 << 16  # pieces of a bounded size
            return ([size.tobytes()] + [at[i : i + n].astype(np.int32).tobytes() for i in range(0, len(at), n)],
                    [b""] + [counts[0, at[i : i + n]].tobytes() for i in range(0, len(at), n)],
                    [b""] + [counts[1, at[i : i + n]].tobytes() for i in range(0, len(at), n)])

        step.last = last
        return step

    total, size = np.zeros((2, BUCKETS)), np.zeros(2)
    # partial counts of a bounded sample: at most 8 tasks of at most BUCKETS entries each
    for r in map_rows(rows.coalesce(8), make, "at binary, n0 binary, n1 binary").toLocalIterator():
        at = np.frombuffer(r.at, np.int32)
        if not r.n0:
            size += at
        else:
            total[0, at] += np.frombuffer(r.n0, np.int32)
            total[1, at] += np.frombuffer(r.n1, np.int32)
    if not size.all():
        return np.empty(0, np.int64), int(size.sum())
    with np.errstate(divide="ignore", invalid="ignore"):
        n, k = size.sum(), total.sum(0)
        g2 = sum(np.nan_to_num(o * np.log(o * n / (m * s))) for y, s in enumerate(size)
                 for o, m in ((total[y], k), (s - total[y], n - k)))
    g2[k < LEAST_DOCS] = 0
    order = np.lexsort((np.arange(BUCKETS), -g2))[:SELECTED]
    return order[g2[order] >= LEAST_G2], int(size.sum())


def fit(rows: DataFrame, groups=IDENTITY_TERMS, counterfactual: float = COUNTERFACTUAL) -> tuple[dict[int, int], np.ndarray]:
    """Selected features (bucket to place) and weights, the last of which is the constant.

    Minimises mean logistic loss + L2 + ``counterfactual`` times the mean squared change of the logit
    between a text and its counterfactual, over the texts with identity terms.
    """
    rows = rows.persist()
    selected, n_rows = select_features(rows)
    keep = {int(b): i for i, b in enumerate(selected)}
    swap = swaps(groups)

    def make():
        feature = Features(keep)

        def pack(words):
            return np.array(sorted(feature.of(words)), np.int32).tobytes()

        def step(texts, labels):
            sets = [words_of(t) for t in texts]
            return labels, [pack(w) for w in sets], [pack({swap.get(x, x) for x in w}) if not swap.keys().isdisjoint(w) else None for w in sets]

        return step

    got = map_rows(rows, make, "label int, own binary, swapped binary").collect() if n_rows else []  # at most FIT_ROWS rows of selected features
    rows.unpersist()
    y = np.array([r.label for r in got], float)
    weights = np.zeros(len(keep) + 1)
    if not len(y) or not 0 < y.sum() < len(y):
        weights[-1] = -4.0 if not len(y) or not y.sum() else 4.0  # nothing to tell apart
        return keep, weights
    own, at = _flat([r.own for r in got])
    pairs = [r for r in got if r.swapped is not None and r.swapped != r.own]
    left, left_at = _flat([r.own for r in pairs])
    right, right_at = _flat([r.swapped for r in pairs])
    step_sizes = np.full(len(weights), 1e-8)
    for _ in range(STEPS):
        w = weights[:-1]
        z = np.bincount(at, w[own], len(y)) + weights[-1]
        e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.append(np.bincount(own, e[at], len(w)) + L2 * w, e.sum())
        if pairs:
            gap = (np.bincount(left_at, w[left], len(pairs)) - np.bincount(right_at, w[right], len(pairs))) * 2 * counterfactual / len(pairs)
            g[:-1] += np.bincount(left, gap[left_at], len(w)) - np.bincount(right, gap[right_at], len(w))
        step_sizes += g * g
        weights -= RATE * g / np.sqrt(step_sizes)
    return keep, weights


def _flat(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(p, np.int32) for p in packed]
    return (np.concatenate(parts) if parts else np.empty(0, np.int32)), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                    keep_columns: bool = False, fit_rows: int = FIT_ROWS, counterfactual: float = COUNTERFACTUAL) -> DataFrame:
    """``held_out``, ``score`` (0 to 1) and ``predicted`` of every row of ``docs``, by its text alone.

    The model sees at most ``fit_rows`` labelled rows, none of them held out. Null and empty texts get the
    score of a text without telling features; without labels of both kinds every row gets the same score.
    A null id is never held out. With ``keep_columns``, the columns of ``docs`` come along.
    """
    known = training_rows(docs, labels, id_col, text_col, label_col, fit_rows)
    keep, weights = fit(known, counterfactual=counterfactual)
    model = docs.sparkSession.sparkContext.broadcast((keep, weights))  # at most SELECTED features

    def make():
        keep, weights = model.value
        feature = Features(keep)

        def step(*columns):
            texts = columns[text_at]
            z = np.array([weights[-1] + weights[list(feature.of(words_of(t)))].sum() for t in texts])
            score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return *columns, score

        return step

    if keep_columns:
        frame = docs.select([c for c in docs.columns if c not in ("held_out", "score", "predicted")])
    else:
        frame = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        id_col, text_col = "doc_id", "text"
    text_at = frame.columns.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields) + ", score double"
    held = F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    scored = map_rows(frame, make, schema).withColumns({"held_out": held, "predicted": (F.col("score") >= 0.5).cast("int")})
    return scored if keep_columns else scored.select("doc_id", "held_out", "score", "predicted")
