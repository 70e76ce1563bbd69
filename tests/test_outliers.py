"""Neighbours over several columns against brute force, and isolation trees by their definition."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from accordant.operators import neighbours, outliers


def factors_by_hand(x, k):
    """Each row's neighbours: its copies, then the others by distance and coordinates."""
    u, back, copies = np.unique(x, axis=0, return_inverse=True, return_counts=True)
    k = min(k, len(x) - 1)
    gap = np.sqrt(((u[:, None] - u[None]) ** 2).sum(2))
    near = []
    for i in range(len(u)):
        left, mine = k, []
        for g, j, n in [(-1.0, i, copies[i] - 1), *sorted((gap[i, j], j, copies[j]) for j in range(len(u)) if j != i)]:
            if (w := min(n, left)) > 0:
                mine.append((max(g, 0.0), j, w))
                left -= w
        near.append(mine)
    radius = np.array([max(g for g, _, _ in m) for m in near])
    density = np.array([1 / (sum(max(g, radius[j]) * w for g, j, w in m) / k + 1e-10) for m in near])
    return np.array([sum(density[j] * w for _, j, w in m) / k / density[i] for i, m in enumerate(near)])[back.reshape(-1)]


@pytest.mark.parametrize("n, d, k, pivots, block", [(1200, 3, 20, 32, 50), (700, 2, 5, 1024, 2000), (40, 3, 20, 8, 10), (4, 3, 20, 1024, 2000)])
def test_factors_over_columns(spark, n, d, k, pivots, block):
    rng = np.random.default_rng(n)
    x = np.round(np.vstack([rng.standard_normal((n // 2, d)), rng.standard_normal((n - n // 2, d)) * 0.05 + 3]), d)
    x[: n // 4] = x[0]  # a quarter of the rows are copies
    names = [f"c{i}" for i in range(d)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=np.arange(n), cell="x", point="x"))
    got = neighbours.local_outlier_factors(df, names, k, pivots=pivots, block=block).toPandas().sort_values("id")
    assert list(got.columns) == [*df.columns, "lof", "local_outlier_factor"]
    expected = np.round(factors_by_hand(x, k), 6)
    assert np.allclose(got["lof"], expected, rtol=1e-9, atol=2e-6)
    assert (got["local_outlier_factor"] == (got["lof"] > np.quantile(got["lof"], 0.95))).all()


def test_nearest_copies_of_many_rows_at_once():
    rng = np.random.default_rng(5)
    far, order, copies = rng.integers(0, 6, (50, 30)).astype(float), rng.permutation(30), rng.integers(1, 4, 30)
    far[far == 5] = np.inf
    need = rng.integers(-1, 12, 50)
    row, column = neighbours._nearest(far, order, copies, need, neighbours._within(far, 12))
    for i in range(50):
        expected, held = [], 0
        for j in sorted(np.flatnonzero(np.isfinite(far[i])), key=lambda j: (far[i, j], order[j])):
            if held >= need[i]:
                break
            expected, held = [*expected, j], held + copies[j]
        assert list(column[row == i]) == expected


def test_blocks_are_dealt_to_tasks_by_points(spark):
    x = pd.DataFrame(np.random.default_rng(2).standard_normal((900, 2)), columns=["a", "b"])
    points = neighbours.distinct_points(spark.createDataFrame(x), ["a", "b"])
    seen = []
    plain = neighbours.durable
    try:
        neighbours.durable = lambda df: seen.append(plain(df)) or seen[-1]
        neighbours.nearest_neighbours(points, 5, pivots=8, block=50)
    finally:
        neighbours.durable = plain
    assert seen[-1].rdd.getNumPartitions() == 18  # few bytes, but a task for each 50 points


def test_factors_of_few_rows_and_missing_values(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), 2.0)], "id int, a double, b double")
    assert [r.lof for r in neighbours.local_outlier_factors(df, ["a", "b"]).collect()] == [1.0, 1.0]
    assert neighbours.local_outlier_factors(df.limit(0), ["a", "b"]).count() == 0
    five = spark.createDataFrame([(i, None if i == 0 else float(i), 0.0) for i in range(5)], "id int, a double, b double")
    got = neighbours.local_outlier_factors(five, ["a", "b"], 2).toPandas().sort_values("id")
    assert np.allclose(got["lof"], np.round(factors_by_hand(np.array([[i, 0.0] for i in range(5)]), 2), 6), atol=2e-6)


def test_isolation_trees_hold_their_samples(spark):
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({"id": np.arange(900), "a": rng.standard_normal(900), "b": rng.integers(0, 4, 900).astype(float), "c": 1.0})
    df, names = spark.createDataFrame(frame), ["a", "b", "c"]
    samples = outliers.tree_samples(df, names, "id", 900, 12, 64, 42).cache()
    nodes = outliers.grow_trees(samples, names, 64, 42).toPandas()
    assert set(nodes["feature"]) == {-1, 0, 1}  # a column without variation never splits
    held = samples.toPandas()
    assert sorted(held.groupby("tree").size()) == [64] * 12
    for tree, rows in held.groupby("tree"):
        own = nodes[nodes["tree"] == tree].set_index("node")
        assert own.index.is_unique
        at = {1: rows[names].to_numpy()}
        while at:
            node, x = at.popitem()
            row = own.loc[node]
            if row["feature"] < 0:
                level = int(node).bit_length() - 1
                assert level == 6 or len(x) < 2 or (x.max(0) == x.min(0)).all()
                assert np.isclose(row["depth"], level + float(outliers._expected_path(len(x))))
                continue
            value = x[:, int(row["feature"])]
            assert value.min() <= row["threshold"] < value.max()
            at[2 * node], at[2 * node + 1] = x[value <= row["threshold"]], x[value > row["threshold"]]
    forest = outliers.fit_isolation_forest(df.withColumn("a", F.when(F.col("id") == 5, 40.0).otherwise(F.col("a"))), ["a", "b"], "id", 50, 64)
    scored = outliers.isolation_scores(df.withColumn("a", F.when(F.col("id") == 5, 40.0).otherwise(F.col("a"))), forest).toPandas()
    assert scored.set_index("id")["anomaly_score"].idxmax() == 5
