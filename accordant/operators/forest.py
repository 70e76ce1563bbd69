"""Random forest as a node table: grown level by level by aggregation, scored by following nodes.

Features are cut into a fixed number of equal bins, and training rows with the same bins are one row with a
count for each label, so that a level costs what there are of those for each tree. Draws (which rows a tree
sees, which features a node may split) are digests of (seed, tree, node), so a fit can be repeated anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, factorial, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.ids import hash_mod
from accordant.operators.outliers import DRAWS
from accordant.session import durable

BINS = 256
#: How often a tree draws a row: numbers at whose shares of all draws one more is drawn (Poisson with mean 1).
DRAW_STEPS = [sum(exp(-1) / factorial(i) for i in range(k + 1)) for k in range(7)]


@dataclass(frozen=True)
class Forest:
    """``nodes``: (tree, node, feature, bin, threshold, weight, p); a leaf has feature -1, its children are 2 n and 2 n + 1.

    A row goes left if its bin of the feature is at most ``bin``, that is, if its value is below ``threshold``.
    """

    features: list[str]
    trees: int
    low: list[float]
    width: list[float]
    nodes: DataFrame


def _value(name: str) -> Column:
    return F.coalesce(F.nanvl(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0))


def bins_of(features: list[str], low: list[float], width: list[float]) -> list[Column]:
    """Bin of each feature, 0 to ``BINS`` - 1; values outside the range of the fit are in the bins at its ends."""
    return [F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((_value(f) - a) / w))).cast("int") for f, a, w in zip(features, low, width, strict=True)]


def _score(zero: Column, one: Column) -> Column:
    """Sum of the squared label weights over the weight: the more, the purer."""
    return (zero * zero + one * one) / (zero + one)


def fit_forest(train: DataFrame, features: list[str] = policy.FEATURES, trees: int = 100, depth: int = 8, seed: int = 42) -> Forest:
    """Forest of ``trees`` trees of at most ``depth`` splits from root to leaf, over rows with ``label`` 0 or 1.

    A tree draws rows with replacement, those with the same bins and label together. Each node chooses among
    the square root of the number of features the cut that leaves the purest sides; of equal cuts, the first feature's
    lowest. Missing values count as 0. Without rows of both labels there is nothing to learn, which is an error.
    """
    ends = train.agg(*[f(_value(c)).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("low", F.min), ("high", F.max))],
                     F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros")).first()
    if not (ends["ones"] and ends["zeros"]):
        raise ValueError("a forest needs rows of both labels")
    low = [ends[f"low{i}"] for i in range(len(features))]
    width = [((ends[f"high{i}"] - a) / BINS) or 1.0 for i, a in enumerate(low)]
    bins = bins_of(features, low, width)
    counted = train.select(F.array(*bins).alias("x"), F.col("label").cast("int").alias("y")).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    drawn = hash_mod(F.concat_ws("|", F.array_join("x", ","), "y"), seed, DRAWS)
    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))
    rows = counted.withColumn("row", drawn).select("x", "y", "n", "row", tree.alias("tree"))
    place = (F.col("row") * ((F.col("tree").cast("long") * 7_919 + (seed * 104_729 + 1_299_709)) % DRAWS) + F.col("tree").cast("long") * 15_485_863) % DRAWS
    times = sum((F.when(place / float(DRAWS) >= s, 1).otherwise(0) for s in DRAW_STEPS[1:]), F.when(place / float(DRAWS) >= DRAW_STEPS[0], 1).otherwise(0))
    rows = rows.withColumn("w", F.col("n") * times).where("w > 0").groupBy("tree", "x").agg(
        F.sum(F.when(F.col("y") == 0, F.col("w")).otherwise(0)).alias("w0"), F.sum(F.when(F.col("y") == 1, F.col("w")).otherwise(0)).alias("w1"))
    rows = durable(rows.withColumn("node", F.lit(1).cast("long")))

    each = isqrt(len(features))
    found: DataFrame | None = None
    for level in range(depth + 1):
        sums = rows.groupBy("tree", "node").agg(F.sum("w0").alias("t0"), F.sum("w1").alias("t1"))
        splits = None
        if level < depth:
            order = [F.struct(F.md5(F.concat(F.lit(f"{seed}|"), F.concat_ws("|", "tree", "node"), F.lit(f"|{i}"))).alias("o"), F.lit(i).alias("feature")) for i in range(len(features))]
            choice = F.slice(F.array_sort(F.array(*order)), 1, each)
            asked = rows.select("tree", "node", "x", "w0", "w1", F.explode(choice).alias("c")).select(
                "tree", "node", F.col("c.feature").alias("feature"), F.get("x", F.col("c.feature")).alias("bin"), "w0", "w1")
            by_bin = asked.groupBy("tree", "node", "feature", "bin").agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1"))  # at most BINS each
            upto = Window.partitionBy("tree", "node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
            cuts = by_bin.withColumns({"l0": F.sum("w0").over(upto), "l1": F.sum("w1").over(upto)}).join(sums, ["tree", "node"])
            cuts = cuts.where(F.col("l0") + F.col("l1") < F.col("t0") + F.col("t1"))
            gain = _score(F.col("l0"), F.col("l1")) + _score(F.col("t0") - F.col("l0"), F.col("t1") - F.col("l1"))
            cuts = cuts.withColumn("gain", gain).where(F.col("gain") > _score(F.col("t0"), F.col("t1")) * (1 + 1e-12))
            splits = durable(cuts.groupBy("tree", "node").agg(F.min(F.struct((-F.col("gain")).alias("g"), "feature", "bin")).alias("s"))
                             .select("tree", "node", "s.feature", "s.bin"))
            level_nodes = sums.join(splits, ["tree", "node"], "left")
        else:
            level_nodes = sums.withColumns({"feature": F.lit(None).cast("int"), "bin": F.lit(None).cast("int")})
        level_nodes = level_nodes.select("tree", "node", F.coalesce("feature", F.lit(-1)).alias("feature"), F.coalesce("bin", F.lit(-1)).alias("bin"),
                                         (F.col("t0") + F.col("t1")).alias("weight"), (F.col("t1") / (F.col("t0") + F.col("t1"))).alias("p"))
        found = level_nodes if found is None else found.unionByName(level_nodes)
        if splits is None or splits.isEmpty():
            break
        rows = durable(rows.join(splits, ["tree", "node"]).select("tree", (2 * F.col("node") + F.when(F.get("x", F.col("feature")) <= F.col("bin"), 0).otherwise(1)).alias("node"), "x", "w0", "w1"))
    ends_at = F.get(F.array(*[F.lit(float(a)) for a in low]), F.col("feature")) + (F.col("bin") + 1) * F.get(F.array(*[F.lit(float(w)) for w in width]), F.col("feature"))
    nodes = durable(found.withColumn("threshold", F.when(F.col("feature") >= 0, ends_at)))
    return Forest(list(features), trees, [float(a) for a in low], [float(w) for w in width], nodes)


def score(df: DataFrame, forest: Forest) -> DataFrame:
    """Rows with ``probability`` (mean of the leaves, to eight decimals) and ``prediction``.

    The nodes travel as a broadcast variable: at most ``trees`` * 2 ** (``depth`` + 1) of them.
    """
    table = forest.nodes.select("tree", "node", "feature", "bin", "p").toPandas()
    shape = (forest.trees, int(table["node"].max()) + 1)
    arrays = {c: np.full(shape, -1 if c == "feature" else 0, dtype=float if c == "p" else np.int32) for c in ("feature", "bin", "p")}
    for c, a in arrays.items():
        a[table["tree"], table["node"]] = table[c]
    shared = df.sparkSession.sparkContext.broadcast(arrays)

    @F.pandas_udf("double")
    def mean_leaf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        feature, cut, p = (shared.value[c] for c in ("feature", "bin", "p"))
        for batch in batches:
            if not len(batch):
                yield pd.Series([], dtype=float)
                continue
            x, back = np.unique(np.array(batch.tolist(), dtype=np.int32), axis=0, return_inverse=True)
            total, rows = np.zeros(len(x)), np.arange(len(x))
            for t in range(len(feature)):
                at = np.ones(len(x), dtype=np.int64)
                while (inner := feature[t][at] >= 0).any():
                    right = x[rows, np.maximum(feature[t][at], 0)] > cut[t][at]
                    at = np.where(inner, 2 * at + right, at)
                total += p[t][at]
            yield pd.Series((total / len(feature))[back.reshape(-1)])

    scored = df.withColumn("probability", F.round(mean_leaf(F.array(*bins_of(forest.features, forest.low, forest.width))), 8))
    return scored.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))
