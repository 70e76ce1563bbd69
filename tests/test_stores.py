"""Stored queue under changes, warehouse versions, sketches, models by their definition."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from accordant import policy
from accordant.operators import explain, features, forest, metrics, models, pairs, queue, queue_store, ranking
from accordant.plans.domain import Domain
from accordant.session import CLEANUP, stored
from accordant.sources import warehouse

SF = "/root/testdata/sf0.001"
MODEL = models.LinearModel(policy.FEATURES, -2.5, [2.0, 2.0, 1.5, 0.5, 0.5, -0.5, 1.0])


@pytest.fixture(scope="module")
def records(spark):
    return Domain(spark, SF).records.where("ord % 3 = 0").cache()


def rows_of(df):
    columns = sorted(df.columns)
    return sorted(map(str, df.select(*columns).collect()))


def test_stored_queue_equals_a_rebuild(spark, records, tmp_path):
    root, steps = str(tmp_path / "queue"), [
        records,
        records.withColumn("customer_name", F.when(F.col("ord") % 100 == 30, F.lit("somebody else")).otherwise(F.col("customer_name"))),
        records.where("ord % 150 <> 60").withColumn("address", F.when(F.col("ord") % 200 == 90, None).otherwise(F.col("address"))),
        records]
    queue_store.build(steps[0], MODEL, root)
    assert queue_store.update(steps[0], MODEL, root) == {"changed": 0, "owners": 0, "pairs": 0}
    total = queue_store.read(spark, root).count()
    for i, step in enumerate(steps[1:]):
        done = queue_store.update(step, MODEL, root)
        assert 0 < done["changed"] <= done["owners"] <= 3 * done["changed"] and done["pairs"] < total / 8
        queue_store.build(step, MODEL, str(tmp_path / f"whole{i}"))
        assert rows_of(queue_store.read(spark, root)) == rows_of(queue_store.read(spark, str(tmp_path / f"whole{i}")))
    # a change of everything is a new build
    done = queue_store.update(records.withColumn("status", F.lit("odd")), MODEL, root)
    assert done["owners"] == done["changed"] and queue_store.read(spark, root).where("status_match = 0").count() < total


def test_update_takes_what_is_folded_and_moves_one_record_of_a_neighbour(spark, records, tmp_path, monkeypatch):
    root, changed = str(tmp_path / "queue"), records.withColumn("city", F.when(F.col("ord") % 100 == 30, F.lit("elsewhere")).otherwise(F.col("city")))
    queue_store.build(records, MODEL, root)
    assert "owner" not in spark.read.parquet(f"{root}/rows").columns  # it is the first record's id
    folded = features.folded_records(changed).cache()
    draws = pairs.draws_of(pairs.neighbours_of(folded))
    assert draws.count() == folded.count() - 1 and set(draws.columns) == {*pairs.DRAWN, "_a", "_b"}
    assert rows_of(pairs.negatives_of_draws(draws)) == rows_of(pairs.negatives_of(pairs.neighbours_of(folded)))
    monkeypatch.setattr(features, "folded_records", lambda _: pytest.fail("folded again"))
    assert queue_store.update(changed, MODEL, root, folded)["changed"] > 0
    monkeypatch.undo()
    queue_store.build(changed, MODEL, str(tmp_path / "whole"))
    assert rows_of(queue_store.read(spark, root)) == rows_of(queue_store.read(spark, str(tmp_path / "whole")))


def test_training_pairs_are_the_training_side(spark):
    rows = [(a, b) for a in [None, *map(str, range(12))] for b in [None, *map(str, range(12))]]
    df = spark.createDataFrame(rows, "master_id_a string, master_id_b string")
    assert rows_of(metrics.training_pairs(df)) == rows_of(metrics.entity_split(df).where("split = 'train'"))


def test_methods_that_would_be_interpreted_are_not_joined(spark):
    contract.queries()["c1_c12_unique_keys"](spark, SF)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_queue_frame_moves_pairs_once(spark):
    df = spark.range(5).select(F.concat(F.lit("PAIR-"), F.upper(F.md5(F.col("id").cast("string")))).alias("pair_id"), F.lit(1).alias("label"))
    extra = df.select("pair_id", *[F.lit(1.0).alias(f) for f in policy.FEATURES], "label")
    notes = df.select("pair_id", *[F.lit("x").alias(c) for c in ("classification", "summary", "clarification")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        frame = queue.queue_frame(df, extra, notes, MODEL.match_probability())
        assert frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert frame.where("classification = 'x' AND route IS NOT NULL").count() == 5


def test_features_and_what_is_explained_of_them_move_once(spark):
    df = spark.range(5).select(F.concat(F.lit("PAIR-"), F.upper(F.md5(F.col("id").cast("string")))).alias("pair_id"), F.lit(1).alias("label"))
    moved = pairs.moved_by_pair(df.limit(4).select("pair_id", *[F.lit(0.0 if f == "capacity_diff" else 1.0).alias(f) for f in policy.FEATURES]), policy.FEATURES)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = queue.queue_frame(df, moved, explain.explain_pairs(moved), MODEL.match_probability())
        plan = frame.select("pair_id", "classification", "match_probability")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("ReusedExchange") == 1
    assert sorted(r.classification or "" for r in frame.collect()) == ["", *["OTHER"] * 4]


def test_stored_features_keep_no_ids(spark):
    d = Domain(spark, SF)
    assert rows_of(d.staged_features) == rows_of(d.pair_features)
    kept = spark.read.parquet(d.staged_features.inputFiles()[0])
    assert "pair_id" not in kept.columns and "record_a_id" in kept.columns


def test_stored_tables_leave_no_shuffle_files(spark):
    def files():
        return {str(f) for f in blocks.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}

    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before, kept = files(), stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(3, "count"))
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and kept.count() == 7
    assert spark.conf.get(CLEANUP, "false") == "false"


def test_refresh_is_all_or_none(spark, tmp_path):
    root = str(tmp_path)
    one = spark.createDataFrame([("P1", "Ann")], "project_id string, customer_name string")
    two = spark.createDataFrame([("P2", "Bo")], "project_id string, customer_name string")
    letters = spark.createDataFrame([("E1", "P1")], "envelope_reference string, project_reference string")
    assert warehouse.refresh({"projects": one, "documents": letters}, root) == 0
    failing = letters.withColumn("document_name", F.raise_error(F.lit("no more disk")))
    with pytest.raises(Exception, match="no more disk"):
        warehouse.refresh({"projects": two, "source_records": two, "entity_matches": two, "documents": failing}, root)
    assert [r.project_id for r in warehouse.read(spark, root, "projects").collect()] == ["P1"]
    assert warehouse.refresh({"projects": two}, root) == 1
    assert [r.project_id for r in warehouse.read(spark, root, "projects").collect()] == ["P2"]
    assert warehouse.read(spark, root, "documents").count() == 1


def test_sketches_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 7).alias("day"), F.when(F.col("id") % 11 != 0, F.col("id").cast("double")).otherwise(float("nan")).alias("v"))
    whole = ranking.merge_sketches(ranking.quantile_sketches(df, ["day"], "v"), [])
    got = ranking.sketch_quantiles(whole, [], {"a": 0.1, "b": 0.5, "c": 0.9}).first()
    for name, p in (("a", 0.1), ("b", 0.5), ("c", 0.9)):
        rank = df.where(F.col("v") <= got[name]).where("not isnan(v)").count() / df.where("not isnan(v)").count()
        assert abs(rank - p) < 0.01


def test_block_pairs_of_very_many_records(spark):
    n = 5_000_000_000
    df = spark.createDataFrame([(n,), (n + 1,), (1,), (0,)], "records long")
    assert [int(r[0]) for r in df.select(pairs._pairs_among(F.col("records"))).collect()] == [n * (n - 1) // 2, (n + 1) * n // 2, 0, 0]
    few = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "block_key string")
    row = pairs.blocking_statistics(few).first()
    assert (row.blocks, row.records, int(row.candidates_before), int(row.candidates_after)) == (2, 3, 3, 1)


def labelled(n=800):
    rng = np.random.default_rng(1)
    x = pd.DataFrame(np.round(rng.random((n, len(policy.FEATURES))), 2), columns=policy.FEATURES)
    x["label"] = (x["customer_similarity"] + 0.6 * x["address_similarity"] + 0.4 * rng.standard_normal(n) > 0.8).astype(int)
    x.loc[5, "city_match"] = np.nan
    return x


def test_newton_reaches_the_optimum(spark):
    frame = labelled()
    model = models.fit_newton(spark.createDataFrame(frame), c=2.0)
    x = np.column_stack([np.ones(len(frame)), frame[policy.FEATURES].fillna(0.0)])
    w = np.array([model.intercept, *model.weights])
    p = 1 / (1 + np.exp(-x @ w))
    gradient = x.T @ (frame["label"] - p) - np.r_[0, w[1:]] / 2.0
    assert np.max(np.abs(gradient)) < 1e-4 and model.gradient < 1e-8 and model.steps < 15
    scored = models.score(spark.createDataFrame(frame), model).toPandas()
    assert np.allclose(np.sort(scored["probability"]), np.sort(np.round(p, 8)), atol=1e-7)
    assert models.fit_newton(spark.createDataFrame(frame).limit(0)).weights == [0.0] * 7


def test_forest_follows_its_nodes(spark):
    frame = labelled()
    fitted = forest.fit_forest(spark.createDataFrame(frame), trees=12, depth=4)
    nodes = fitted.nodes.toPandas().set_index(["tree", "node"])
    assert nodes.index.is_unique and nodes.index.get_level_values("node").max() < 32 and set(nodes["p"].between(0, 1)) == {True}
    scored = forest.score(spark.createDataFrame(frame.reset_index()), fitted).toPandas().sort_values("index")
    x = frame[policy.FEATURES].fillna(0.0).to_numpy()
    for i in range(0, len(frame), 37):
        total = 0.0
        for t in range(12):
            node = 1
            while nodes.loc[(t, node), "feature"] >= 0:
                f = int(nodes.loc[(t, node), "feature"])
                bin_ = min(max(int(np.floor((x[i, f] - fitted.low[f]) / fitted.width[f])), 0), forest.BINS - 1)
                node = 2 * node + (bin_ > nodes.loc[(t, node), "bin"])
            total += nodes.loc[(t, node), "p"]
        assert abs(scored["probability"].iloc[i] - total / 12) < 1e-7
    majority = max(frame["label"].mean(), 1 - frame["label"].mean())
    assert (scored["prediction"] == frame["label"].to_numpy()).mean() > majority + 0.1  # labels are noisy by design
    with pytest.raises(ValueError):
        forest.fit_forest(spark.createDataFrame(frame).where("label = 1"))


def test_features_take_few_exchanges(spark):
    plan = contract.queries()["m1_pairwise_features"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 6


def test_one_file_is_written_from_what_its_lines_are_made_of(spark, monkeypatch):
    from accordant.sources import files

    seen = []

    def stop(df, path):
        seen.append(df)
        raise InterruptedError

    monkeypatch.setattr(files, "write_csv", stop)
    with pytest.raises(InterruptedError):
        contract.QUERIES["g1_watched_folder"](spark, SF)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index('"Dear"') < plan.index("Repartition 1") and seen[0].rdd.getNumPartitions() == 1
