"""Spelling variants of a corpus' vocabulary, found with pivotal grams.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. Bigrams are put
in one order, rarest in the vocabulary first. The prefix of a word is its three rarest bigrams (with all
others equal to the last of them); its pivots are two disjoint bigrams of the prefix that are in the fewest
words, chosen by dynamic programming. One edit destroys at most one of two disjoint bigrams, so of two near
words the one whose prefix ends earlier has a pivot that stands in the prefix of the other. Positions limit
this further: an edit right of the left pivot leaves everything up to that pivot in place, and any other
edit is left of the right pivot and leaves everything from that one on. So the left pivot is looked up with
all that precedes it and the right one with all that follows, for lengths that differ by one at most.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.llm.text import map_rows, stored

#: Bytes of Latin-1 text to lower-cased A-Z, a-z and C0-FF; all others to a space.
LETTERS = bytes(b + 32 if 65 <= b < 91 else b if 97 <= b < 123 or b >= 0xC0 else 32 for b in range(256))
#: Words that a task counts before it hands on what it has.
HELD = 300_000
#: Edits between near words, and characters of a gram.
EDITS, GRAM = 1, 2
_BASE, _MOD = 1_000_003, (1 << 61) - 1


def runs_of(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z only, a byte for a code point."""
    return (text or "").encode("latin-1", "replace").translate(LETTERS).split()


def slipped(doc_id: int, run: bytes, slips: int) -> bytes:
    """``run`` without one letter if ``slips`` divides the crc32 of ``<doc_id>:<run>``, else as it is."""
    h = zlib.crc32(b"%d:" % doc_id + (run if run.isascii() else run.decode("latin-1").encode()))
    return run if h % slips else run[: h % len(run)] + run[h % len(run) + 1 :]


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5,
               slips: int | None = None) -> DataFrame:
    """(``word``, ``n``): words of at least ``min_length`` letters that occur at least ``min_count`` times in all texts.

    With ``slips``, one letter is left out of a run wherever the crc32 of its document and itself is a multiple
    of ``slips``. Null texts have no words, repeated rows count each, rows without an id have no slips. A task
    counts up to ``HELD`` words at a time, so a frequent word reaches the shuffle as a few rows.
    """
    def make():
        counts = Counter()

        def flush():
            words, n = [w.decode("latin-1") for w in counts], list(counts.values())
            counts.clear()
            return words, n

        def step(ids, texts):
            for i, text in zip(ids, texts):
                for run, n in Counter(runs_of(text)).items():
                    word = run if slips is None or i is None else slipped(i, run, slips)
                    if len(word) >= min_length:
                        counts[word] += n
            return flush() if len(counts) > HELD else ([], [])

        step.last = flush
        return step

    parts = map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), make, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def gram_counts(words: DataFrame) -> dict[str, int]:
    """Words that each bigram is in. The alphabet has 90 letters, so there are at most 8,100 of them."""
    grams = words.filter(F.length("word") >= GRAM).select(F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda i: F.substring("word", i, F.lit(GRAM))))).alias("gram"))
    return {r.gram: r["count"] for r in grams.groupBy("gram").count().collect()}


def prefix_of(word: str, rank: dict[str, int]) -> tuple[list[int], int]:
    """Positions of the prefix's bigrams in rising order, and the rank of its last bigram."""
    grams = sorted((rank[word[p : p + GRAM]], p) for p in range(len(word) - GRAM + 1))
    last = grams[min(GRAM * EDITS, len(grams) - 1)][0]
    return sorted(p for r, p in grams if r <= last), last


def pivots_of(word: str, prefix: list[int], cost: dict[str, int]) -> list[int]:
    """``EDITS`` + 1 disjoint positions of the prefix with the least total cost, by dynamic programming.

    ``best[k]`` holds, over the positions seen so far, the cheapest choice of k disjoint ones; a position may
    follow only choices that end ``GRAM`` before it, so those of the last positions wait in ``ends``.
    """
    best: list = [(0, ())] + [None] * (EDITS + 1)
    ends: list = []
    for p in prefix:
        while ends and ends[0][0] <= p - GRAM:
            for k, choice in ends.pop(0)[1]:
                if best[k] is None or choice < best[k]:
                    best[k] = choice
        c = cost[word[p : p + GRAM]]
        ends.append((p, [(k + 1, (best[k][0] + c, (*best[k][1], p))) for k in range(EDITS + 1) if best[k] is not None]))
    for _, choices in ends:
        for k, choice in choices:
            if best[k] is None or choice < best[k]:
                best[k] = choice
    return list(best[EDITS + 1][1])


def _affixes(word: str) -> tuple:
    """Functions to hashes of the beginning up to, and of the rest from, a position, each in constant time."""
    sums, power = [0], [1]
    for ch in word:
        sums.append((sums[-1] * _BASE + ord(ch)) % _MOD)
        power.append(power[-1] * _BASE % _MOD)
    n = len(word)
    return (lambda p: sums[p]), (lambda p: (sums[n] - sums[p] * power[n - p]) % _MOD)


def _postings(words: DataFrame, counts: dict[str, int], pivotal: bool) -> DataFrame:
    """(``key``, ``len``, ``word``, ``n``, ``last``): the pivots of each word, or the prefix to be met by them.

    The sign of a key tells beginnings from ends; a pivot is posted for each length that a near word may have.
    """
    rank = {g: k for k, (_, g) in enumerate(sorted((c, g) for g, c in counts.items()))}

    def make():
        def step(words, numbers):
            out = []
            for word, n in zip(words, numbers):
                prefix, last = prefix_of(word, rank)
                head, tail = _affixes(word)
                if pivotal:
                    left, right = pivots_of(word, prefix, counts)
                    keys, lengths = [head(left + GRAM) + 1, -tail(right) - 1], range(len(word) - EDITS, len(word) + EDITS + 1)
                else:
                    keys, lengths = [k for p in prefix for k in (head(p + GRAM) + 1, -tail(p) - 1)], [len(word)]
                out += [(k, size, word, n, last) for k in keys for size in lengths]
            return [list(c) for c in zip(*out)] if out else [[]] * 5

        return step

    return map_rows(words.select("word", "n"), make, "key long, len int, word string, n long, last int", rows=2048)


def near_words(words: DataFrame) -> DataFrame:
    """(``word``, ``n``, ``other``, ``other_n``) for every ordered pair of near words of (``word``, ``n``).

    Words of fewer than four letters (no three bigrams) are not paired. Candidates are verified with the edit
    distance inside the join, so only near pairs leave it.
    """
    words = words.filter(F.length("word") >= GRAM * (EDITS + 1))
    counts = gram_counts(words)
    pivots = _postings(words, counts, True).select(*[F.col(c).alias(f"x_{c}") for c in ("key", "len", "word", "n", "last")])
    prefixes = _postings(words, counts, False)
    met = pivots.join(prefixes, (F.col("x_key") == F.col("key")) & (F.col("x_len") == F.col("len")) & (F.col("x_last") <= F.col("last"))
                      & (F.col("x_word") != F.col("word")) & (F.levenshtein("x_word", "word", EDITS) == EDITS))
    ends = [F.struct(F.col(f"{side}word").alias("word"), F.col(f"{side}n").alias("n")) for side in ("x_", "")]
    pairs = met.select(F.array_sort(F.array(*ends)).alias("p")).distinct()
    return pairs.select(F.explode(F.array(F.col("p"), F.reverse("p"))).alias("p")).select(
        F.col("p")[0]["word"].alias("word"), F.col("p")[0]["n"].alias("n"), F.col("p")[1]["word"].alias("other"), F.col("p")[1]["n"].alias("other_n"))


def roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(``word``, ``root``) for (``word``, ``form``): the last form that following forms reaches, by pointer jumping.

    Chains of at most 2 ** ``rounds`` forms are followed to their end.
    """
    jumps = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumps = stored(jumps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    return jumps


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6, min_count: int = 5,
                   ratio: int = 5, slips: int | None = None) -> DataFrame:
    """(``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``): a row for each word of ``vocabulary``.

    ``form`` is the near word that occurs most (of several, the first in code-point order) if it occurs at least
    ``ratio`` (2 or more) times as often as the word itself, else null, as is ``form_n`` then; ``root`` is where
    following forms ends, the word itself without a form. Empty tables and texts give no rows, columns other
    than the two named are not read.
    """
    words = stored(vocabulary(docs, id_col, text_col, min_length, min_count, slips), "spelling-words")
    near = (near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("k"), "other")).alias("best"))
            .select("word", "n_near", F.col("best.other").alias("other"), (-F.col("best.k")).alias("other_n")))
    formed = F.col("other_n") >= ratio * F.col("n")
    found = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("other")).alias("form"),
        F.when(formed, F.col("other_n")).alias("form_n")), "spelling-forms")
    # along a chain of forms counts grow by the ratio each time, which bounds its length
    most = found.agg(F.max("n")).first()[0] or 1
    chain = max(2, math.ceil(math.log(most, ratio)) + 1)
    ends = roots(found.filter("form IS NOT NULL"), math.ceil(math.log2(chain)))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
