"""A corpus from raw documents to packed sequences: each stage reads what its predecessor wrote.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordant.llm import decontamination, jaccard_join, line_dedup, packing, toxicity
from accordant.llm.text import stored
from accordant.session import prepare


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _aside(docs: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns that an operator's own output would replace under other names, and the way back."""
    taken = {c: f"_input_{c}" for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed(taken), {v: k for k, v in taken.items()}


def _with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_row``, a number for each id and text: tells rows apart that share an id or have none."""
    return docs.withColumn("_row", F.xxhash64("doc_id", "text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic.

    Every row is judged by its own text, whatever its id; null and empty texts stay, an empty table stays empty,
    repeated rows stay or go together. Columns of the input come back as they were, also ones named like the scores.
    """
    own, back = _aside(docs, ("held_out", "score", "predicted"))
    scored = toxicity.score_documents(own, _table(spark, sf_dir, "labels"), keep_columns=True)
    return scored.filter("predicted = 0").drop("held_out", "score", "predicted").withColumnsRenamed(back).select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of repeated three-line windows; those of which no line is left go.

    Null and empty texts stay. Rows without an id take no part and stay as they are, rows that repeat an id with the
    same text keep or lose the same lines. ``n_chars`` follows the new text where lines went.
    """
    prepare(spark)
    own, back = _aside(docs, ("n_lines", "n_removed"))
    kept = line_dedup.dedup_lines(own).filter("n_removed = 0 OR n_removed < n_lines")
    changed = {"n_chars": F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}
    return kept.withColumns(changed).drop("n_lines", "n_removed").withColumnsRenamed(back).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id, rows without an id last.

    Rows are told apart by id and text, so of two rows with one id each is judged by its own text, and rows
    without an id take part. Rows that are equal in both count as one and one of them stays. Null, empty and blank texts
    have no near copies.
    """
    prepare(spark)
    keyed = _with_key(docs)
    found = jaccard_join.link_documents(keyed, id_col="_row").select(F.col("doc_id").alias("_row"), F.col("component_id").alias("group")).distinct()
    shared = found.join(found.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "group").select("_row", "group")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    members = stored(shared.join(keyed.select("_row", "doc_id"), "_row").select("group", "_row", order.alias("o")), "pipeline-copies")
    first = members.groupBy("group").agg(F.min("o").alias("first"))
    copies = members.join(first, "group").filter(F.col("o") != F.col("first")).select("_row").distinct()
    return keyed.join(copies, "_row", "left_anti").dropDuplicates(["doc_id", "text"]).select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Each row is judged by its own text, also if it repeats an id or has none; null and empty texts stay.
    """
    keyed = _with_key(docs)
    pairs = decontamination.contaminated_pairs(keyed, _table(spark, sf_dir, "benchmark"), id_col="_row")
    return keyed.join(pairs.select(F.col("doc_id").alias("_row")).distinct(), "_row", "left_anti").select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their sequences and offsets; a null text is packed like an empty one."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: A fitted classifier and a genetic search have no SQL form; stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
