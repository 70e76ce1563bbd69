"""Isolation Forest and one-dimensional Local Outlier Factor as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordant.functions.ids import hash_mod
from accordant.operators.ranking import exact_quantiles, halo_buckets, join_on, ordered_rank, quantiles_of_counts
from accordant.session import durable

TREES = 100
SAMPLE = 256
NEIGHBOURS = 20
#: Prime modulus of the draws.
DRAWS = (1 << 31) - 1


def _expected_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = 2.0 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2.0 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _draw(row: Column, tree: Column, seed: int) -> Column:
    """Place of a row, given by a number below ``DRAWS``, in the draw of a tree: one linear map for each tree."""
    factor = (tree * 7_919 + (seed * 104_729 + 1_299_709)) % DRAWS
    return (row * factor + tree * 15_485_863) % DRAWS


def tree_samples(df: DataFrame, columns: list[str], id_column: str, total: int, trees: int, sample: int, seed: int) -> DataFrame:
    """(tree, columns) with ``sample`` rows per tree, drawn without replacement by hash.

    Every tree draws on its own: a row competes in the trees for which its number lies below one cut,
    set for about twice the sample, and the smallest numbers win. Only competing rows are shuffled.
    """
    cut = int(min(1.0, 2.0 * sample / max(total, 1)) * DRAWS)
    drawn = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(
        t.cast("int").alias("tree"), _draw(F.col("_row"), t.cast("long"), seed).alias("_draw")))
    numbered = df.withColumn("_row", hash_mod(F.col(id_column).cast("string"), seed, DRAWS))
    rows = numbered.select(id_column, *columns, F.inline(F.filter(drawn, lambda d: d["_draw"] <= cut)))
    order = Window.partitionBy("tree").orderBy("_draw", id_column)
    return rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= sample).drop("_n", "_draw", id_column)


def _path_length(n: Column) -> Column:
    """``_expected_path`` as an expression."""
    m = n.cast("double")
    return F.when(n > 2, 2.0 * (F.log(m - 1) + float(np.euler_gamma)) - 2.0 * (m - 1) / m).when(n == 2, 1.0).otherwise(0.0)


def grow_trees(samples: DataFrame, columns: list[str], size: int, seed: int) -> DataFrame:
    """Node table (tree, node, feature, threshold, depth) of the isolation trees over ``samples``.

    Node 1 is the root, 2 n and 2 n + 1 are the children of n, left for values up to the threshold. The column of a
    split is that of the smallest digest of (tree, node, column) among those that vary, the threshold a digest's share
    of the way from the least to the largest value. All trees grow level by level with window aggregates; rows are
    dealt by tree once. Leaves have no feature, and the expected depth of what they hold.
    """
    levels = int(np.ceil(np.log2(max(size, 2))))
    seed_of = F.concat_ws("|", "tree", "node")
    here = Window.partitionBy("tree", "node")
    rows = samples.repartition("tree").withColumns({"node": F.lit(1).cast("long"), "trail": F.array().cast(
        "array<struct<node:bigint,feature:int,threshold:double,depth:double>>"), "open": F.lit(True)})
    for level in range(levels + 1):
        spans = [F.struct(F.md5(F.concat(F.lit(f"{seed}|"), seed_of, F.lit(f"|{c}"))).alias("order"), F.lit(i).alias("feature"),
                          F.min(c).over(here).alias("low"), F.max(c).over(here).alias("high")) for i, c in enumerate(columns)]
        rows = rows.withColumns({"n": F.count(F.lit(1)).over(here), "span": F.array_min(F.filter(F.array(*spans), lambda x: x["high"] > x["low"]))})
        splits = F.col("span").isNotNull() & F.lit(level < levels)
        share = hash_mod(seed_of, seed + 1, 1 << 28) / float(1 << 28)
        cut = F.col("span.low") + share * (F.col("span.high") - F.col("span.low"))
        entry = F.struct("node", F.when(splits, F.col("span.feature")).otherwise(-1).alias("feature"), F.when(splits, cut).otherwise(0.0).alias("threshold"),
                         F.when(splits, 0.0).otherwise(level + _path_length(F.col("n"))).alias("depth"))
        value = F.get(F.array(*columns), F.col("span.feature"))
        rows = rows.withColumns({"trail": F.when(F.col("open"), F.concat("trail", F.array(entry))).otherwise(F.col("trail")),
                                 "node": F.when(F.col("open") & splits, 2 * F.col("node") + F.when(value <= cut, 0).otherwise(1)).otherwise(F.col("node")),
                                 "open": F.col("open") & splits}).drop("n", "span")
    return rows.select("tree", F.explode("trail").alias("t")).select("tree", "t.*").distinct()


def fit_isolation_forest(df: DataFrame, columns: list[str], id_column: str, trees: int = TREES, sample: int = SAMPLE,
                         seed: int = 42) -> dict:
    """Forest as dense node arrays. At most ``trees * (2*sample - 1)`` nodes reach the driver."""
    filled = df.select(id_column, *[F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(c) for c in columns])
    total = filled.count()
    size = min(sample, total)
    nodes = grow_trees(tree_samples(filled, columns, id_column, total, trees, sample, seed), columns, size, seed).toPandas()
    forest = {"columns": columns, "size": size}
    for name, kind in (("feature", np.int32), ("threshold", float), ("depth", float)):
        array = np.full((trees, int(nodes["node"].max()) + 1), -1 if name == "feature" else 0, dtype=kind)
        array[nodes["tree"], nodes["node"]] = nodes[name]
        forest[name] = array
    return forest


def _scores(forest: dict, x: np.ndarray) -> np.ndarray:
    """Anomaly score 2^(-mean depth / c) of every row."""
    depth = np.zeros(len(x))
    rows = np.arange(len(x))
    for t in range(len(forest["feature"])):
        feature, cut = forest["feature"][t], forest["threshold"][t]
        at = np.ones(len(x), dtype=np.int64)
        inner = feature[at] >= 0
        while inner.any():
            value = x[rows, np.maximum(feature[at], 0)]
            at = np.where(inner, 2 * at + (value > cut[at]), at)
            inner = feature[at] >= 0
        depth += forest["depth"][t][at]
    return 2.0 ** (-(depth / len(forest["feature"])) / max(float(_expected_path(forest["size"])), 1e-12))


def isolation_scores(df: DataFrame, forest: dict) -> DataFrame:
    """Rows with their ``anomaly_score`` (to ten decimals); the forest travels as a broadcast variable."""
    shared = df.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        model = shared.value
        for batch in batches:
            batch = (batch,) if isinstance(batch, pd.Series) else batch
            x = np.column_stack([c.fillna(0.0).to_numpy(dtype=float) for c in batch])
            distinct, back = np.unique(x, axis=0, return_inverse=True) if x.shape[1] > 1 else (
                lambda u: (u[0][:, None], u[1]))(np.unique(x[:, 0], return_inverse=True))
            yield pd.Series(_scores(model, distinct)[back.reshape(-1)])

    inputs = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for c in forest["columns"]]
    return df.withColumn("anomaly_score", F.round(score(*inputs), 10))


def flag_top_share(scored: DataFrame, keys: list[str], score: str, contamination: float | DataFrame, flag: str) -> DataFrame:
    """Flag scores above the (1 - contamination) quantile of their group.

    ``contamination`` is one share for all groups, or a table (keys, share) with one per group.
    """
    if isinstance(contamination, DataFrame):
        counted = scored.groupBy(*keys, score).agg(F.count("*").alias("_n"))
        shared = join_on(counted, contamination, keys)
        limit = quantiles_of_counts(shared, keys, score, "_n", {"_limit": 1 - F.col("share")})
    else:
        limit = exact_quantiles(scored, keys, score, {"_limit": 1 - contamination})
    if keys:
        joined = join_on(scored, limit, keys, "left")
    else:
        joined = scored.withColumn("_limit", limit.select("_limit").scalar())
    return joined.withColumn(flag, F.coalesce(F.col(score) > F.col("_limit"), F.lit(False))).drop("_limit")


def isolation_forest(df: DataFrame, columns: list[str], id_column: str, contamination: float = 0.05, seed: int = 42) -> DataFrame:
    """Rows with ``anomaly_score`` and the flag ``isolation_forest``."""
    forest = fit_isolation_forest(df, columns, id_column, seed=seed)
    scored = durable(isolation_scores(df, forest))  # scored once, for the limit and for the rows
    return flag_top_share(scored, [], "anomaly_score", contamination, "isolation_forest")


def lof_of_sorted(x: np.ndarray, k: int) -> np.ndarray:
    """LOF of ascending values; a value's neighbours lie within k positions on either side."""
    n = len(x)
    k = max(1, min(k, n - 1))
    if n < 2:
        return np.ones(n)
    offsets = np.concatenate([np.arange(-k, 0), np.arange(1, k + 1)])
    at = np.arange(n)[:, None] + offsets[None, :]
    inside = (at >= 0) & (at < n)
    at = np.clip(at, 0, n - 1)
    gap = np.where(inside, np.abs(x[at] - x[:, None]), np.inf)
    nearest = np.argsort(gap, axis=1, kind="stable")[:, :k]
    who = np.take_along_axis(at, nearest, axis=1)
    far = np.take_along_axis(gap, nearest, axis=1)
    reach = np.maximum(far[:, -1][who], far)
    density = 1.0 / (reach.mean(axis=1) + 1e-10)
    return density[who].mean(axis=1) / density


def local_outlier_factor(df: DataFrame, keys: list[str], column: str, id_column: str, neighbours: int = NEIGHBOURS,
                         contamination: float = 0.05, bucket: int = 20000) -> DataFrame:
    """Rows with ``lof`` (to six decimals) and the flag ``local_outlier_factor`` over one column.

    Rows are ranked by value across tasks. The factor of a row depends on rows at most three
    neighbourhoods away, so runs with that halo give the factor over the whole group.
    """
    halo = 3 * neighbours
    filled = df.withColumn("_x", F.coalesce(F.col(column).cast("double"), F.lit(0.0)))
    ranked = ordered_rank(filled, keys, ["_x", id_column], name="_rank")
    runs = halo_buckets(ranked, "_rank", bucket, halo, halo)
    names = [*df.columns, "lof"]
    schema = runs.select(*df.columns, F.lit(0.0).alias("lof")).schema

    def factor(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("_rank", ignore_index=True)
        run["lof"] = np.round(lof_of_sorted(run["_x"].to_numpy(dtype=float), neighbours), 6)
        return run.loc[run["_owned"], names]

    scored = durable(runs.groupBy(*keys, "_bucket").applyInPandas(factor, schema))
    return flag_top_share(scored, keys, "lof", contamination, "local_outlier_factor")
