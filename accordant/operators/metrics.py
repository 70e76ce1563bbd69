"""Classification metrics, threshold sweeps, ranking quality and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordant.functions.ids import hash_int, shuffle_hash
from accordant.functions.numbers import ratio
from accordant.operators.ranking import join_on, ordered_rank
from accordant.session import durable


#: Hex digits of a digest by which a split counts rows before it numbers any.
SPLIT_HEAD = 4


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(ratio(part, whole), F.lit(0.0))


def confusion(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """tp, fp, fn, tn per group in one aggregation."""
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def classification_report(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    """Confusion counts with precision, recall and F1; a metric without support is 0."""
    counts = confusion(df, label, prediction, by)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return (counts.withColumn("precision", _or_zero(tp, tp + fp)).withColumn("recall", _or_zero(tp, tp + fn))
            .withColumn("f1", _or_zero(2 * tp, 2 * tp + fp + fn)))


def error_rates(df: DataFrame, label: str, prediction: str, by: list[str] = ()) -> DataFrame:
    counts = confusion(df, label, prediction, by)
    return (counts.withColumn("false_positive_rate", ratio(F.col("fp"), F.col("fp") + F.col("tn")))
            .withColumn("false_negative_rate", ratio(F.col("fn"), F.col("fn") + F.col("tp"))))


def error_rows(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Misclassified rows with their kind."""
    kind = F.when(F.col(label) == 0, "FP").otherwise("FN")
    return df.where(F.col(label) != F.col(prediction)).withColumn("error", kind)


def threshold_sweep(df: DataFrame, label: str, score: str, thresholds: list[float], by: list[str] = ()) -> DataFrame:
    """Report per threshold. Rows are first counted per number of thresholds they reach, so the
    sweep costs one small aggregation instead of one copy of the data per threshold."""
    cuts = sorted(thresholds)
    reached = sum(((F.col(score) >= t).cast("int") for t in cuts[1:]), (F.col(score) >= cuts[0]).cast("int"))
    counted = df.groupBy(*by, F.col(label).alias("_y"), reached.alias("_k")).agg(F.count("*").alias("_n"))
    grid = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(float(t)).alias("threshold")) for i, t in enumerate(cuts)])
    spread = counted.withColumn("_t", F.explode(grid)).select("*", "_t.*")
    hit, y, n = F.col("_k") >= F.col("i"), F.col("_y"), F.col("_n")

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    sums = spread.groupBy(*by, "threshold").agg(
        total((y == 1) & hit).alias("tp"), total((y == 0) & hit).alias("fp"), total((y == 1) & ~hit).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return sums.select(*by, "threshold", _or_zero(tp, tp + fp).alias("precision"),
                       _or_zero(tp, tp + fn).alias("recall"), _or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"))


def average_ranks(df: DataFrame, score: str, by: list[str] = (), extra: dict[str, Column] | None = None) -> DataFrame:
    """Average 1-based rank of every distinct score, with its row count."""
    by = list(by)
    extras = [c.alias(n) for n, c in (extra or {}).items()]
    counted = df.groupBy(*by, F.col(score).alias("score")).agg(F.count("*").alias("rows"), *extras)
    ranked = ordered_rank(counted, by, ["score"], "rows", "_upto")
    return ranked.withColumn("average_rank", F.col("_upto") - (F.col("rows") - 1) / 2).drop("_upto")


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] = ()) -> DataFrame:
    """Exact area under the ROC curve from rank sums; ties share their average rank."""
    ranks = average_ranks(df, score, by, {"_pos": F.count_if(F.col(label) == 1)})
    p, rows = F.sum("_pos").cast("double"), F.sum("rows").cast("double")
    rank_sum = F.sum(F.col("_pos") * F.col("average_rank"))
    auc = F.try_divide(rank_sum - p * (p + 1) / 2, F.nullif(p * (rows - p), F.lit(0.0)))
    return ranks.groupBy(*by).agg(F.sum("_pos").alias("positives"), F.sum("rows").alias("rows"), auc.alias("roc_auc"))


def stratified_split(df: DataFrame, label: str, id_column: str, train_share: float = 0.7, seed: int = 42) -> DataFrame:
    """Exact split per label: the first ``floor(share * n)`` rows in hashed order are the training side.

    Rows are counted by the head of their digest, and those under the one head in which the cut falls are numbered to
    find the last training row of each label; every other row is compared with that one and stays where it is.
    ``df`` is read three times.
    """
    digest = F.coalesce(shuffle_hash(F.col(id_column), seed), F.lit(""))
    head = F.substring(digest, 1, SPLIT_HEAD)
    place = F.struct(digest.alias("h"), F.col(id_column).alias("id"))
    counts = df.groupBy(label, head.alias("_head")).agg(F.count("*").alias("_n"))  # at most 16 ** SPLIT_HEAD + 1 for each label
    along = Window.partitionBy(label).orderBy("_head")
    counts = counts.withColumns({"_upto": F.sum("_n").over(along), "_size": F.sum("_n").over(Window.partitionBy(label))})
    take = F.floor(F.col("_size") * F.lit(train_share))
    border = durable(counts.where((F.col("_upto") >= take) & (F.col("_upto") - F.col("_n") < take)).select(
        label, "_head", (take - (F.col("_upto") - F.col("_n"))).alias("_take")))
    inside = join_on(df.select(label, id_column, head.alias("_head"), place.alias("_place")), F.broadcast(border), [label, "_head"])
    numbered = inside.withColumn("_n", F.row_number().over(Window.partitionBy(label).orderBy("_place")))
    last = join_on(numbered, F.broadcast(numbered.where(F.col("_n") == F.col("_take")).select(label, F.col("_place").alias("_cut"))), [label])
    cuts = durable(last.where(F.col("_place") == F.col("_cut")).groupBy(label, "_cut").agg(
        F.count_if(F.col("_n") <= F.col("_take")).alias("_equal"), F.count("*").alias("_all")))
    placed = join_on(df.withColumn("_at", place), F.broadcast(cuts), [label], "left")
    if not cuts.where("_equal < _all").isEmpty():  # the cut falls among rows of one id: as many of them as are left to take
        tied = F.col("_at") == F.col("_cut")
        number = F.row_number().over(Window.partitionBy(label).orderBy("_at"))
        placed = placed.where(~F.coalesce(tied, F.lit(False))).unionByName(
            placed.where(tied).withColumn("_number", number).withColumn("_cut", F.when(F.col("_number") <= F.col("_equal"), F.col("_cut"))).drop("_number"))
    is_train = F.coalesce(F.col("_at") <= F.col("_cut"), F.lit(False))
    return placed.withColumn("split", F.when(is_train, "train").otherwise("test")).drop("_at", "_cut", "_equal", "_all")


def entity_split(pairs: DataFrame, train_share: float = 0.7, seed: int = 42) -> DataFrame:
    """Pairs whose two entities fall on the same side; pairs across the cut are dropped.

    The side of an entity is a function of its id, so no membership table has to be joined.
    """
    cut = int(round(train_share * 1000))
    a = hash_int(F.col("master_id_a"), seed, 1000) < cut
    b = hash_int(F.col("master_id_b"), seed, 1000) < cut
    return pairs.where(a == b).withColumn("split", F.when(a, "train").otherwise("test"))


def training_pairs(pairs: DataFrame, train_share: float = 0.7, seed: int = 42) -> DataFrame:
    """The training side of ``entity_split``; an entity on both sides of its pair is hashed once."""
    cut = int(round(train_share * 1000))
    a = hash_int(F.col("master_id_a"), seed, 1000) < cut
    b = hash_int(F.col("master_id_b"), seed, 1000) < cut
    return pairs.where(a).where((F.col("master_id_a") == F.col("master_id_b")) | b).withColumn("split", F.lit("train"))
