"""Similarity features of record pairs and of labelled text pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.numbers import abs_difference
from accordant.functions.similarity import jaro_winkler
from accordant.functions.text import choose_column, flag, normalize_match, same_text, unigrams_and_bigrams, words

FIELDS = list(policy.FEATURE_COLUMNS)
#: Bytes of text whose terms are counted by one task.
TEXT_PART = 2 << 20


def fold_records(records: DataFrame, fields: list[str] = FIELDS) -> DataFrame:
    """One row for each record id with the first record (by ``ord``) of every source, as a struct of ``fields`` or null."""
    payload = F.struct(*fields)
    return records.where(F.col("record_id").isNotNull()).groupBy("record_id").agg(
        *[F.min_by(payload, F.when(F.col("source_system") == s, F.col("ord"))).alias(s) for s in policy.SOURCES])


def normalized_records(records: DataFrame) -> DataFrame:
    """Records with their fields in matching form, each brought there once."""
    texts = [f for f in FIELDS if f != "system_size_kw"]
    size = F.nanvl(F.col("system_size_kw").cast("double"), F.lit(None).cast("double")).alias("system_size_kw")
    return records.select("source_system", "record_id", *[normalize_match(f).alias(f) for f in texts], size, "ord")


def folded_records(records: DataFrame) -> DataFrame:
    """``fold_records`` in matching form; missing texts travel as nulls, which take no room in a shuffle."""
    texts = [f for f in FIELDS if f != "system_size_kw"]
    folded = fold_records(normalized_records(records).withColumns({f: F.nullif(f, F.lit("")) for f in texts}))
    return folded.withColumns({s: F.when(F.col(s).isNotNull(), F.struct(*[
        F.coalesce(F.col(f"{s}.{f}"), F.lit("")).alias(f) if f in texts else F.col(f"{s}.{f}") for f in FIELDS])) for s in policy.SOURCES})


def attach_records(pairs: DataFrame, folded: DataFrame) -> DataFrame:
    """Pairs with the structs ``_a`` and ``_b`` of their two records; pairs with a missing record are dropped.

    A pair whose two records share an id (every true pair of a consistent export does) needs one lookup;
    only pairs of different ids are moved a second time.
    """
    def of_source(name: str) -> Column:
        return choose_column(F.col(name), {s: F.col(f"_{s}") for s in policy.SOURCES})

    renamed = folded.select(F.col("record_id").alias("_id"), *[F.col(s).alias(f"_{s}") for s in policy.SOURCES])
    same_id = F.col("record_a_id").eqNullSafe(F.col("record_b_id"))
    by_a = renamed.withColumnRenamed("_id", "record_a_id")
    near = pairs.where(same_id).join(by_a, "record_a_id").select(
        *pairs.columns, of_source("source_a").alias("_a"), of_source("source_b").alias("_b"))
    half = pairs.where(~same_id).join(by_a, "record_a_id").select(*pairs.columns, of_source("source_a").alias("_a"))
    far = half.where(F.col("_a").isNotNull()).join(renamed.withColumnRenamed("_id", "record_b_id"), "record_b_id").select(
        *pairs.columns, "_a", of_source("source_b").alias("_b"))
    return near.unionByName(far).where(F.col("_a").isNotNull() & F.col("_b").isNotNull())


def pair_records(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Pairs with the fields of both source records; pairs with a missing record are dropped."""
    both = attach_records(pairs, fold_records(records))
    return both.select(*pairs.columns, *[F.col(f"_{side}.{f}").alias(f"{f}_{side}") for side in "ab" for f in FIELDS])


SIMILAR = {"customer_similarity": "customer_name", "installer_similarity": "installer", "address_similarity": "address"}


def features_of(attached: DataFrame, keep: list[str] = (), mostly_equal: bool = True) -> DataFrame:
    """The seven matching features of pairs with ``_a`` and ``_b`` in matching form.

    Texts that differ are compared in Arrow batches. With ``mostly_equal``, pairs whose three texts are equal or
    missing on either side never leave the JVM; ``attached`` is then evaluated for both kinds, so it should be cheap.
    """
    def side(field: str, of: str) -> Column:
        return F.col(f"_{of}.{field}")

    def equal(field: str) -> Column:
        return (side(field, "a") == side(field, "b")) | (side(field, "a") == "") | (side(field, "b") == "")

    def same(field: str) -> Column:
        return flag(side(field, "a") == side(field, "b")).alias(f"{field}_match")

    def rows(part: DataFrame, similarity) -> DataFrame:
        return part.select(
            "pair_id", *keep, *[similarity(f).alias(name) for name, f in SIMILAR.items()], same("city"), same("state"),
            F.coalesce(F.abs(side("system_size_kw", "a") - side("system_size_kw", "b")), F.lit(0.0)).alias("capacity_diff"), same("status"), "label")

    settled = equal("customer_name") & equal("installer") & equal("address")
    def compared(f: str) -> Column:
        return jaro_winkler(side(f, "a"), side(f, "b"), normalized=True)

    if not mostly_equal:
        return rows(attached, compared)
    plain = rows(attached.where(settled), lambda f: F.when((side(f, "a") == side(f, "b")) & (side(f, "a") != ""), 1.0).otherwise(0.0))
    return plain.unionByName(rows(attached.where(~settled), compared))


def pairwise_features(pairs: DataFrame, records: DataFrame, keep: list[str] = ()) -> DataFrame:
    """The seven matching features per pair; ``keep`` names pair columns to carry along."""
    return features_of(attach_records(pairs, fold_records(normalized_records(records))), keep, mostly_equal=False)


def baseline_prediction(features: DataFrame) -> DataFrame:
    """Deterministic baseline: mean of five features of at least 0.8."""
    names = ["customer_similarity", "installer_similarity", "address_similarity", "city_match", "state_match"]
    score = sum((F.col(n) for n in names[1:]), F.col(names[0])) / 5
    return features.withColumn("baseline_score", score).withColumn("prediction", (score >= 0.8).cast("int"))


def _by_text(df: DataFrame, id_column: str, *texts: str) -> DataFrame:
    """``df`` partitioned by id, with a part for each ``TEXT_PART`` bytes of its texts: a task counts the terms of so many.

    The number is given, as adaptive execution would join parts by their compressed bytes, of which terms take a hundred times.
    """
    size = sum((F.coalesce(F.octet_length(F.col(t).cast("string")), F.lit(0)) for t in texts), F.lit(0).cast("long"))
    held = df.agg(F.sum(size).alias("n")).first()["n"] or 0
    return df.repartition(max(1, -(-held // TEXT_PART)), id_column)


def title_terms(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, term, tf): counts of one- and two-word terms per text."""
    # Partitioned by text while it is still one row: the exploded terms then stay where they are.
    terms = _by_text(df, id_column, text_column).select(id_column, F.explode(unigrams_and_bigrams(words(text_column))).alias("term"))
    return terms.groupBy(id_column, "term").agg(F.count("*").alias("tf"))


def fit_tfidf(corpus: DataFrame, id_column: str, text_column: str, max_features: int = 5000) -> DataFrame:
    """Vocabulary (term, df, idf) of the ``max_features`` most frequent terms.

    Ties at the cut are resolved by term. idf is ln((1+n)/(1+df)) + 1.
    """
    counts = title_terms(corpus, id_column, text_column)
    terms = counts.groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
    top = terms.orderBy(F.desc("total"), "term").limit(max_features)
    n = corpus.agg(F.count("*").alias("n")).scalar()
    return top.select("term", "df", (F.log((1 + n) / (1 + F.col("df"))) + 1).alias("idf"))


def tfidf_cosine(pairs: DataFrame, vocabulary: DataFrame, id_column: str, left: str, right: str) -> DataFrame:
    """TF-IDF cosine of two texts per pair, 0.0 when either has no known term.

    Texts are partitioned by pair before they are cut into terms; both aggregations reuse that
    partitioning. Spark broadcasts a small vocabulary and shuffles by term for one of any size.
    """
    sides = _by_text(pairs, id_column, left, right).select(id_column, F.explode(F.array(
        F.struct(F.lit("l").alias("side"), F.col(left).alias("t")),
        F.struct(F.lit("r").alias("side"), F.col(right).alias("t")))).alias("s")).select(id_column, "s.*")
    terms = sides.select(id_column, "side", F.explode(unigrams_and_bigrams(words("t"))).alias("term"))
    known = terms.join(vocabulary.select("term", "idf"), "term")
    per_term = (known.groupBy(id_column, "term")
                .agg((F.count_if(F.col("side") == "l") * F.first("idf")).alias("l"),
                     (F.count_if(F.col("side") == "r") * F.first("idf")).alias("r")))
    sums = per_term.groupBy(id_column).agg(
        F.sum(F.col("l") * F.col("r")).alias("dot"), F.sum(F.col("l") * F.col("l")).alias("ll"),
        F.sum(F.col("r") * F.col("r")).alias("rr"))
    cosine = F.try_divide(F.col("dot"), F.sqrt("ll") * F.sqrt("rr"))
    return (pairs.select(id_column).join(sums, id_column, "left")
            .select(id_column, F.coalesce(cosine, F.lit(0.0)).alias("title_tfidf_cosine")))


def text_pair_features(pairs: DataFrame, vocabulary: DataFrame, id_column: str = "id") -> DataFrame:
    """Features of labelled pairs: cosine, exact title, brand and category equality, price difference."""

    def lowered(c: str):
        return F.lower(F.coalesce(F.col(c).cast("string"), F.lit("")))

    def equal(name: str):
        return (lowered(f"left_{name}") == lowered(f"right_{name}")).cast("int")

    plain = pairs.select(
        id_column, equal("title").alias("title_exact"), equal("brand").alias("brand_match"),
        equal("category").alias("category_match"),
        abs_difference(F.col("left_price"), F.col("right_price")).alias("price_diff"), "label")
    return tfidf_cosine(pairs, vocabulary, id_column, "left_title", "right_title").join(plain, id_column)


def exact_title_prediction(pairs: DataFrame) -> DataFrame:
    """Baseline on labelled pairs: titles equal after normalisation."""
    return pairs.withColumn("prediction", same_text("left_title", "right_title").cast("int"))
