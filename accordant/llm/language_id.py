"""Language of web pages by fusing text likelihoods with markup, address and host evidence.

log P(l | page) = log P(text | l) / temperature + log P(declared | l) + log P(suffix | l) + log P(l | host),
up to a constant. Text likelihoods come from byte trigrams counted per language over labelled documents.
The tables of declared languages and suffixes per language are counted over all pages by the language
that the text alone suggests. The host prior is smoothed from the whole table to the suffix, to the
domain, to the host; at each step, a page's own vote is left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant.llm.text import map_rows, stored

#: Hash classes of trigrams, divisor of the text's log likelihood, and pseudo-counts of each prior.
CLASSES, TEMPERATURE, STRENGTH = 1 << 13, 8.0, 8.0
#: Languages that the model tells apart at most; more raise an error.
MOST_LANGUAGES = 512


def trigram_classes(data: bytes) -> np.ndarray:
    """Hash class of every three consecutive bytes."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.int64)
    return (((b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(19)).astype(np.int64)


def _plain(text: str | None) -> bytes:
    return (text or "").lower().encode()


def trigram_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and the log probability of each trigram class in each, over all documents with a language."""
    def make():
        counts: dict[str, np.ndarray] = {}

        def step(texts, langs):
            for text, lang in zip(texts, langs, strict=True):
                if lang not in counts:
                    counts[lang] = np.zeros(CLASSES, np.int64)
                counts[lang] += np.bincount(trigram_classes(_plain(text)), minlength=CLASSES)
            return [], [], []

        def last():
            rows = [(lang, int(k), int(c[k])) for lang, c in counts.items() for k in np.flatnonzero(c)]
            return tuple(map(list, zip(*rows))) if rows else ([],) * 3

        step.last = last
        return step

    partial = map_rows(docs.filter(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string"), F.col(lang_col).cast("string")), make,
                       "lang string, class int, n long")
    total = partial.groupBy("lang", "class").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.collect_list(F.struct("class", "n")).alias("of"))
    rows = total.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()  # at most CLASSES entries for each language
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.full((len(rows), CLASSES), 0.5)
    for k, r in enumerate(rows):
        for c, n in r["of"]:
            counts[k, c] += n
    return [r["lang"] for r in rows], np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def page_evidence(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, visible ``text``, ``declared`` language, ``host``, ``domain`` and ``suffix``; missing ones are empty."""
    html, url = F.coalesce(F.col(html_col).cast("string"), F.lit("")), F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    visible = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return pages.select(F.col(page_col).cast("long").alias("page_id"), visible.alias("text"),
                        F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1)).alias("declared"),
                        host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"), F.regexp_extract(host, r"([^.]+)$", 1).alias("suffix"))


def _log_normal(values: Column) -> Column:
    """Probabilities of unnormalised logarithms."""
    top = F.array_max(values)
    powers = F.transform(values, lambda v: F.exp(v - top))
    return F.transform(powers, lambda p: p / F.aggregate(powers, F.lit(0.0), lambda a, x: a + x))


def _counts(votes: DataFrame, key: str, n_languages: int) -> DataFrame:
    """Votes for each language, by ``key``: (``key``, ``n_key`` array)."""
    one = [F.sum((F.col("vote") == k).cast("double")) for k in range(n_languages)]
    return votes.groupBy(key).agg(F.array(*one).alias(f"n_{key}"))


def identify(pages: DataFrame, docs: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             text_col: str = "text", lang_col: str = "lang", temperature: float = TEMPERATURE, strength: float = STRENGTH) -> DataFrame:
    """(``page_id``, ``language``, ``probability``, ``text_language``, ``declared``, ``host``) for every row of ``pages``.

    Null and empty pages are judged by address and host alone (their text fits every language alike and
    gives no vote). Pages without a host share one. Ties go to the alphabetically first language; without
    labelled documents, language, probability and text language are null.
    """
    languages, log_p = trigram_model(docs, text_col, lang_col)
    evidence = page_evidence(pages, page_col, url_col, html_col)
    n = len(languages)
    if not n:
        none = F.lit(None)
        return evidence.select("page_id", none.cast("string").alias("language"), none.cast("double").alias("probability"),
                               none.cast("string").alias("text_language"), "declared", "host")
    model = pages.sparkSession.sparkContext.broadcast(log_p)  # MOST_LANGUAGES x CLASSES at most

    def make():
        log_p = model.value

        def step(ids, texts, *others):
            scores = [log_p[:, trigram_classes(_plain(t))].sum(1, dtype=np.float64) for t in texts]
            return ids, [s.tolist() for s in scores], *others

        return step

    scored = map_rows(evidence, make, "page_id long, score array<double>, declared string, host string, domain string, suffix string")
    best = F.array_position("score", F.array_max("score")).cast("int") - 1
    votes = stored(scored.withColumn("vote", F.when(F.array_max("score") != F.array_min("score"), best)), "language-votes")

    joined = votes
    for key in ("suffix", "domain", "host"):
        joined = joined.join(_counts(votes, key, n), key, "left")
    everywhere = votes.agg(*[F.sum((F.col("vote") == k).cast("double")) for k in range(n)]).first()
    whole = [x or 0.0 for x in everywhere]
    mine = F.array(*[F.when(F.col("vote") == k, 1.0).otherwise(0.0) for k in range(n)])  # a page's own vote counts nowhere
    others = F.array(*[F.lit(x) for x in whole])
    cast = F.col("vote").isNotNull().cast("double")
    prior = F.zip_with(others, mine, lambda x, m: (x - m + 1.0) / (sum(whole) - cast + n))
    for key in ("suffix", "domain", "host"):
        own = F.transform(F.col(f"n_{key}"), lambda x, k: F.coalesce(x, F.lit(0.0)) - F.when(F.col("vote") == k, 1.0).otherwise(0.0))
        joined = joined.withColumn("prior", prior).withColumn("own", own).withColumn("size", F.aggregate("own", F.lit(0.0), lambda a, x: a + x))
        prior = F.zip_with("own", "prior", lambda x, p: (x + strength * p) / (F.col("size") + strength))
    joined = joined.withColumn("prior", prior)

    # P(declared | l), with one pseudo-count for each value seen; the suffix is a level of the prior and counts there
    table = _counts(votes, "declared", n).filter(F.col("declared") != "")
    kinds = max(table.count(), 1)
    joined = joined.join(table, "declared", "left")
    declared = F.array(*[F.when(F.col("n_declared").isNull(), 0.0).otherwise(F.log(
        (F.coalesce(F.get("n_declared", F.lit(k)), F.lit(0.0)) - F.get(mine, F.lit(k)) + 1.0) / (whole[k] - F.get(mine, F.lit(k)) + kinds))) for k in range(n)])
    total = F.transform("score", lambda s, k: s / temperature + F.get(F.col("said"), k) + F.log(F.get("prior", k)))
    joined = joined.withColumn("said", declared)
    names = F.array(*map(F.lit, languages))
    posterior = joined.withColumn("total", total).withColumn("posterior", _log_normal(F.col("total")))
    return posterior.select("page_id", F.get(names, F.array_position("posterior", F.array_max("posterior")).cast("int") - 1).alias("language"),
                            F.array_max("posterior").alias("probability"), F.get(names, F.col("vote")).alias("text_language"), "declared", "host")
