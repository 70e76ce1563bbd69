"""Distributed ranks and quantiles against single-machine results, with a hot key."""

import hashlib
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from accordant.operators import metrics, outliers
from accordant.operators.anomaly import label_points, rolling_mad
from accordant.operators.ranking import exact_quantiles, hash_neighbours, hash_rank, ordered_rank


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame({"id": range(n), "k": np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n)),
                        "v": np.round(rng.normal(size=n), 1)})
    pdf.loc[pdf["id"] % 50 == 0, "k"] = None
    return pdf, spark.createDataFrame(pdf).withColumn("k", F.when(F.col("k") != "NaN", F.col("k"))).repartition(8).cache()


def test_ordered_rank(frame):
    pdf, df = frame
    got = ordered_rank(df, ["k"], ["v", "id"]).toPandas().sort_values("id")
    key = pdf["k"].fillna("none")
    want = pdf.assign(key=key).sort_values(["v", "id"]).groupby("key").cumcount().sort_index() + 1
    assert got["row_rank"].tolist() == want.tolist()


def test_hash_rank_is_a_permutation(frame):
    pdf, df = frame
    got = hash_rank(df, ["k"], "id", 7).toPandas()
    for _, group in got.groupby(got["k"].fillna("none")):
        assert sorted(group["hash_rank"]) == list(range(1, len(group) + 1))


def test_neighbours_form_one_chain_per_group(frame):
    pdf, df = frame
    got = hash_neighbours(df.drop("v"), ["k"], "id", 7).select("id", F.col("next.id").alias("nxt")).toPandas()
    assert len(got) == len(pdf) - 5
    assert got["id"].is_unique and got["nxt"].is_unique


def test_neighbours_of_one_group(spark):
    """Every row meets the next one in digest order, across parts as well, and moves once."""
    ids = [f"PRJ-{i:05d}" for i in range(2000)]
    paired = hash_neighbours(spark.createDataFrame([(i, i[-1]) for i in ids], "id string, v string").repartition(5), [], "id", 42)
    order = sorted(ids, key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
    got = {r["id"]: (r["next"]["id"], r["next"]["v"]) for r in paired.collect()}
    assert got == {a: (b, b[-1]) for a, b in zip(order, order[1:])}
    plan = paired._jdf.queryExecution().sparkPlan().toString()
    assert "LogicalRDD" not in plan and "FileScan" not in plan  # nothing is stored on the way
    one = hash_neighbours(spark.createDataFrame([("a", "x")], "id string, v string"), [], "id", 42)
    assert one.count() == 0


def test_exact_quantiles(frame):
    pdf, df = frame
    got = exact_quantiles(df.where("k is not null"), ["k"], "v", {"a": 0.01, "b": 0.5, "c": 0.99}).toPandas().set_index("k")
    want = pdf.dropna().groupby("k")["v"].quantile([0.01, 0.5, 0.99]).unstack()
    assert np.allclose(got.loc[want.index, ["a", "b", "c"]].to_numpy(), want.to_numpy())


def test_rolling_mad_runs_equal_the_whole_series(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=1500)
    x[rng.integers(0, 1500, 30)] += 20
    pdf = pd.DataFrame({"s": "one", "t": range(1500), "x": x})
    got = rolling_mad(spark.createDataFrame(pdf), ["s"], ["t"], "x", bucket=200).toPandas().sort_values("t")
    s = pd.Series(x)
    mid = s.rolling(96, center=True, min_periods=1).median()
    mad = (s - mid).abs().rolling(96, center=True, min_periods=1).median()
    want = 0.6745 * (s - mid) / (mad + 1e-10)
    assert np.allclose(got["score"], want)
    assert (got["rolling_mad"].to_numpy() == (want.abs() > 3.5).to_numpy()).all()


def plain_lof(x, k):
    n = len(x)
    distance = np.abs(x[:, None] - x[None, :])
    np.fill_diagonal(distance, np.inf)
    near = np.argsort(distance, axis=1, kind="stable")[:, :k]
    kth = np.take_along_axis(distance, near, axis=1)[:, -1]
    reach = np.maximum(kth[near], np.take_along_axis(distance, near, axis=1))
    density = 1 / (reach.mean(axis=1) + 1e-10)
    return density[near].mean(axis=1) / density[np.arange(n)]


def test_local_outlier_factor(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": "all", "id": range(900), "x": np.concatenate([rng.normal(size=880), rng.uniform(8, 30, 20)])})
    got = outliers.local_outlier_factor(spark.createDataFrame(pdf), ["g"], "x", "id", bucket=150).toPandas().sort_values("id")
    assert np.allclose(got["lof"], plain_lof(pdf["x"].to_numpy(), 20))
    assert got["local_outlier_factor"].sum() == 45


def test_isolation_forest_finds_far_points(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": range(2000), "x": rng.normal(size=2000), "y": rng.normal(size=2000)})
    pdf.loc[:19, ["x", "y"]] = 15.0 + rng.normal(size=(20, 2))
    got = outliers.isolation_forest(spark.createDataFrame(pdf), ["x", "y"], "id", 0.02).toPandas()
    flagged = set(got.loc[got["isolation_forest"], "id"])
    assert len(flagged) == 40 and set(range(20)) <= flagged


def test_tree_samples_of_a_large_table_are_disjoint(spark):
    df = spark.range(60000).select("id", F.col("id").cast("double").alias("x"))
    sizes = outliers.tree_samples(df, ["x"], "id", 60000, 20, 64, 1).groupBy("tree").count().collect()
    assert len(sizes) == 20 and all(r["count"] == 64 for r in sizes)


def test_roc_auc_with_ties(spark):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 500), np.round(rng.random(500), 1)
    got = metrics.roc_auc(spark.createDataFrame(pd.DataFrame({"y": y, "s": s})), "y", "s").first()["roc_auc"]
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_threshold_sweep_equals_one_report_per_threshold(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame(pd.DataFrame({"label": rng.integers(0, 2, 300), "s": rng.random(300)}))
    sweep = {round(r["threshold"], 2): r for r in metrics.threshold_sweep(df, "label", "s", [0.3, 0.5, 0.7]).collect()}
    for t in (0.3, 0.5, 0.7):
        one = metrics.classification_report(df.withColumn("p", (F.col("s") >= t).cast("int")), "label", "p").first()
        assert abs(one["precision"] - sweep[t]["precision"]) < 1e-12 and abs(one["f1"] - sweep[t]["f1"]) < 1e-12


def test_overlapping_windows_do_not_multiply_points(spark):
    points = spark.sql("SELECT id, 's' AS series, timestamp_seconds(id * 3600) AS ts FROM range(100)")
    windows = spark.sql("SELECT 's' AS series, timestamp_seconds(a * 3600) AS start, timestamp_seconds(b * 3600) AS end "
                        "FROM VALUES (5, 30), (20, 60), (20, 25), (80, 80) AS t(a, b)")
    got = label_points(points, windows, "series", "ts").orderBy("id").toPandas()
    assert got["id"].tolist() == list(range(100))
    assert got.loc[got["label"] == 1, "id"].tolist() == [*range(5, 61), 80]


@pytest.mark.parametrize("share", [0.0, 0.3, 0.7, 1.0])
def test_split_without_moving_rows(spark, share):
    rng = np.random.default_rng(3)
    ids = [None if rng.random() < 0.02 else f"p{rng.integers(900) if rng.random() < 0.9 else 7}" for _ in range(3000)]
    labels = [None if rng.random() < 0.1 else int(rng.random() < 0.8) for _ in ids]
    rows = list(zip(ids, labels, range(3000)))
    df = spark.createDataFrame(rows, "id string, y int, n int").cache()
    split = metrics.stratified_split(df, "y", "id", share)
    got = split.collect()
    assert sorted(r.n for r in got) == list(range(3000))
    for label in (None, 0, 1):
        def place(i):
            return "" if i is None else hashlib.md5(f"42|{i}".encode()).hexdigest()

        inside = sorted((place(i) for i, y, _ in rows if y == label))
        train = sorted(place(r.id) for r in got if r.y == label and r.split == "train")
        assert train == inside[:int(len(inside) * share + 1e-9)]
    # nothing but counts, and the rows under the border digests, is shuffled
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan


def test_stored_tables_are_compressed(spark):
    from accordant.session import stored

    df = spark.range(0, 200_000, 1, 4).select("id", F.lit("the same text in every row").alias("t"), F.struct("id", F.lit(None).cast("double").alias("x")).alias("s"))
    kept = stored(df)
    assert kept.schema.simpleString() == df.schema.simpleString() and kept.count() == 200_000
    path = kept.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://").removeprefix("file:")
    assert sum(f.stat().st_size for f in Path(path).glob("*.parquet")) < 200_000 * 26 / 2


def test_pairs_and_ids_are_not_broadcast(spark):
    """However small they look: by compressed files and columns in use, Spark takes millions of pairs for a few MB."""
    from accordant.operators import pairs
    from accordant.session import stored

    master = stored(spark.createDataFrame([(f"P{i}", "x" if i % 3 else None) for i in range(9)], "project_id string, block_key string"))
    records = master.select(F.col("project_id").alias("record_id"), F.explode(F.array(F.lit("crm"), F.lit("erp"))).alias("source_system"))
    positives = pairs.positive_pairs(master.select("project_id"), records)
    found = pairs.candidate_recall(positives, pairs.block_filter(positives, master.withColumnRenamed("project_id", "record_id")))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 5 and plan.count("BroadcastHashJoin") == 0
    assert found.collect() == [(9, 6, 0.666667)]


def test_packed_ids_are_the_ids(spark):
    from accordant.functions.ids import packed_id, unpacked_id

    digest = "0123456789ABCDEF0123456789ABCDEF"
    ids = [f"PAIR-{digest}", f"PAIR-{digest.lower()}", f"PAIR-{digest}0", f"pair-{digest}", "PAIR-000001", "PAIR-", "", "ä", "\x01#Eg\x01#Eg\x01#Eg\x01#Eg", None]
    rows = spark.createDataFrame([(i,) for i in ids], "pair_id string").select("pair_id", packed_id(F.col("pair_id")).alias("p")).withColumn("back", unpacked_id(F.col("p"))).collect()
    assert all(r.back == r.pair_id for r in rows) and len({r.p and bytes(r.p) for r in rows}) == len(ids) and len(rows[0].p) == 16


def test_joined_pairs(spark):
    from accordant.operators import pairs

    left = spark.createDataFrame([("PAIR-000001", 1), ("x", 2), (None, 3)], "pair_id string, a int")
    right = spark.createDataFrame([("PAIR-000001", 4), (None, 5)], "pair_id string, b int")
    assert pairs.join_pairs(left, right).collect() == [("PAIR-000001", 1, 4)]
    assert sorted(map(str, pairs.join_pairs(left, right, "left").collect())) == sorted(map(str, left.join(right, "pair_id", "left").collect()))


def test_records_keep_all_fields_on_the_way_to_their_neighbour(spark):
    from accordant import policy
    from accordant.operators import features, pairs, ranking

    fields = ", ".join(f"{f} {'double' if f == 'system_size_kw' else 'string'}" for f in features.FIELDS)
    texts = ["", "a", "b", None]
    rows = [(s, f"P{i % 17}" if i % 9 else None, i, *[(None, 1.5, 2.0, float("nan"))[(i + j) % 4] if f == "system_size_kw" else texts[(i // 3 + j * i) % 4] for j, f in enumerate(features.FIELDS)])
            for i in range(120) for s in policy.SOURCES[i % 3:]]
    records = spark.createDataFrame(rows, f"source_system string, record_id string, ord long, {fields}")
    plain = features.fold_records(features.normalized_records(records))
    folded = features.folded_records(records)
    assert sorted(map(str, folded.collect())) == sorted(map(str, plain.collect()))
    paired = pairs.neighbours_of(folded.cache())
    expected = ranking.hash_neighbours(plain.cache(), [], "record_id", 42)
    assert sorted(map(str, paired.collect())) == sorted(map(str, expected.collect()))
    plans = paired._jdf.queryExecution().optimizedPlan().toString()
    moved = next(line for line in plans.splitlines() if "RepartitionByExpression" in line)
    assert "_part" in moved  # rows are moved before digests and the structs of rows are made


def test_sizes_of_hash_orders(spark, monkeypatch):
    from accordant.operators import ranking

    seen = []
    monkeypatch.setattr(ranking, "stored", lambda df: seen.append(df) or df.localCheckpoint())
    df = spark.range(50).select((F.col("id") % 3).alias("g"), F.concat(F.lit("p"), "id").alias("k"))
    assert ranking.hash_neighbours(df, ["g"], "k", 42).count() == 47
    assert dict(seen[0].dtypes)["_hash"] == "binary"
