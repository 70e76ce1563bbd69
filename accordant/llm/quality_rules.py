"""Quality rules whose cutoffs are certified on labelled rows, with DataFrame functions only.

For every stratum (language) and rule, the labelled good documents give the number rejected by each
possible cutoff. A cutoff is certified when the exact binomial (Clopper-Pearson) upper bound of its false
rejection rate stays within the rule's share of ``alpha`` at confidence 1 - ``delta``: with the largest k
for which P(Bin(n, a) <= k) is at most the corrected level, at most k good documents may be rejected.
Cutoffs of one rule are tested from the loosest on, in fixed order, which needs no correction; the level
is divided by the number of (stratum, rule) families (Bonferroni). Shares of ``alpha`` add up over the
rules, so the whole rejects at most ``alpha`` of a stratum's good documents, with probability 1 - ``delta``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordant.llm.text import stored, word_array

ALPHA, DELTA = 0.05, 0.05
#: A certified cutoff is used when it rejects this many times the share of bad documents than of good ones.
COST = 5
#: Statistics are whole per mille (mean word length: hundredths of a character), cut at this value.
TOP = 10_000

#: Rule: (statistic, by the base columns); a document with a statistic above the cutoff is rejected.
RULES = {
    "symbols": "1000 * n_symbols div nullif(n_words, 0)",
    "dup_lines": "1000 * n_dup_lines div nullif(n_lines, 0)",
    "repeats": "1000 * n_repeat_words div nullif(n_words, 0)",
    "long_words": "100 * word_chars div nullif(n_words, 0)",
    "short_words": f"greatest({TOP} - 100 * word_chars div nullif(n_words, 0), 0)",
}


def _covered(positions: Column) -> Column:
    """Words covered by three-word windows that start at the sorted ``positions``."""
    steps = F.transform(positions, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(positions, j + 1), p + 3) - p))
    return F.aggregate(steps, F.lit(0), lambda a, x: a + x)


def base_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """``doc_id``, ``stratum`` and the counts of the whole text, one row per row of ``docs``.

    Windows of three words are compared by 64-bit hash inside one text. A null text counts as empty, a
    null stratum as the empty string.

    To find windows that come again, each hash gives up as many low bits as positions need, the position
    takes their place, and the plain longs are sorted: equal windows are neighbours, and neighbours are
    compared by their whole hashes.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    split = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(stratum_col).cast("string"), F.lit("")).alias("stratum"),
                        text.alias("text"), word_array(text).alias("w"))
    hashed = split.select(
        "doc_id", "stratum", F.size("w").cast("long").alias("n_words"), F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("lines"),
        F.transform(F.when(F.size("w") > 2, F.slice("w", 1, F.size("w") - 2)).otherwise(F.array().cast("array<string>")),
                    lambda x, i: F.xxhash64(x, F.get("w", i + 1), F.get("w", i + 2))).alias("h"),
        F.length(F.bin(F.size("w"))).alias("bits"))
    again = hashed.select("*", (F.size(F.array_distinct("h")) < F.size("h")).alias("again"))
    packed = again.select("*", F.expr("shiftleft(1L, bits) - 1").alias("low"), F.when(F.col("again"), F.sort_array(F.transform(
        "h", lambda x, i: F.call_function("shiftleft", F.call_function("shiftright", x, F.col("bits")), F.col("bits")).bitwiseOR(i.cast("long"))))).alias("p"))

    def place(e):
        return e.bitwiseAND(F.col("low")).cast("int")

    found = packed.select("*", F.sort_array(F.transform(F.filter("p", lambda e, i: (
        F.get("h", place(e)) == F.get("h", place(F.get("p", i - 1)))) | (F.get("h", place(e)) == F.get("h", place(F.get("p", i + 1))))), place)).alias("at"))
    return found.select(
        "doc_id", "stratum", "n_words", "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("again"), _covered(F.col("at"))).otherwise(0).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))


def _statistics(base: DataFrame, *keep: str) -> DataFrame:
    """A row for each rule of each document that passes the base rules: ``rule``, ``value`` (long)."""
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.least(F.coalesce(F.expr(sql), F.lit(0)), F.lit(TOP)).cast("long").alias("value"))
                      for name, sql in RULES.items()])
    return base.filter("NOT base_failed").select(*keep, F.inline(rules))


def allowed_rejections(n: str, alpha: float, level: str) -> Column:
    """The largest k with P(Bin(n, alpha) <= k) <= level, or -1; terms are built up in logarithms."""
    odds = f"ln({alpha!r} / (1 - {alpha!r}))"
    return F.expr(f"""aggregate(sequence(0, cast(ceil({n} * {alpha!r}) AS int)),
        named_struct('term', {n} * ln(1 - {alpha!r}), 'cdf', cast(0 AS double), 'k', -1),
        (a, j) -> named_struct('term', a.term + ln(({n} - j) / (j + 1.0D)) + {odds}, 'cdf', a.cdf + exp(a.term),
                               'k', if(a.cdf + exp(a.term) <= {level}, j, a.k)), a -> a.k)""")


def certified_cutoffs(base: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, cost: float = COST) -> DataFrame:
    """(``stratum``, ``rule``, ``cutoff``): the certified cutoff of best gain, where there is one.

    ``labels`` has ``doc_id`` and ``quality`` (1 good, 0 bad, others and null are not used). The gain is
    the share of bad documents rejected less ``cost`` times that of good ones; it must be positive, and
    the loosest of the best is taken. Sizes after the first aggregation depend on rules, strata and
    possible values only.
    """
    label = labels.filter("quality IN (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), "quality").distinct()
    bins = (_statistics(base, "doc_id", "stratum").join(label, "doc_id").groupBy("stratum", "rule", "value")
            .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")))
    share = alpha / len(RULES)
    family = Window.partitionBy("stratum", "rule")
    upto = family.orderBy(F.col("value").desc())
    above = bins.select("*", *[(F.sum(c).over(upto) - F.col(c)).alias(f"{c}_above") for c in ("good", "bad")], *[F.sum(c).over(family).alias(f"n_{c}") for c in ("good", "bad")])
    level = delta / max(1, bins.select("stratum", "rule").distinct().count())
    sizes = above.select("stratum", "rule", "n_good").distinct()
    allowed = sizes.select("stratum", "rule", allowed_rejections("n_good", share, f"{level!r}D").alias("allowed"))
    gain = F.expr(f"coalesce(try_divide(bad_above, n_bad), 0) - {float(cost)!r}D * coalesce(try_divide(good_above, n_good), 0)")
    return (above.join(allowed, ["stratum", "rule"]).filter("good_above <= allowed").withColumn("gain", gain).filter("gain > 0")
            .groupBy("stratum", "rule").agg(F.max(F.struct("gain", "value")).alias("best"))
            .select("stratum", "rule", F.col("best.value").alias("cutoff")))


def apply_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
                alpha: float = ALPHA, delta: float = DELTA, cost: float = COST) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` of every row of ``docs``.

    ``kept`` is false when a base rule fails or a statistic lies above a certified cutoff of the row's
    stratum. Strata with too few labelled good documents have no cutoff and reject nothing by it. Without
    labels, ``kept`` is the negation of ``base_failed``.
    """
    base = stored(base_columns(docs, id_col, text_col, stratum_col), "quality-base")
    cutoffs = certified_cutoffs(base, labels, alpha, delta, cost)
    by_stratum = cutoffs.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    failed = [F.coalesce(F.expr(f"coalesce({sql}, 0)") > F.element_at("cutoffs", F.lit(name)), F.lit(False)) for name, sql in RULES.items()]
    rejected = failed[0]
    for f in failed[1:]:
        rejected = rejected | f
    return base.join(by_stratum, "stratum", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~rejected).alias("kept"))
