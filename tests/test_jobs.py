"""Contract, sources, models and plan shape."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from accordant import policy, schemas
from accordant.operators import features, models
from accordant.plans.domain import Domain
from accordant.sources import files, warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def domain(spark):
    return Domain(spark, SF)


def test_contract(spark):
    queries, oracle = contract.queries(), contract.oracle_sql()
    assert set(oracle) <= set(queries) and len(queries) > 150
    assert contract.entry(spark).count() > 0


def test_inventory_is_covered():
    names = "_".join(contract.queries())
    tokens = set(names.split("_"))
    expected = ([f"s{i}" for i in range(1, 15)] + [f"j{i}" for i in range(1, 17)] + [f"e{i}" for i in range(1, 13)]
                + [f"g{i}" for i in range(1, 7)] + [f"n{i}" for i in range(1, 12)] + [f"x{i}" for i in range(1, 4)]
                + [f"m{i}" for i in range(1, 16)] + [f"r{i}" for i in range(1, 19)] + [f"c{i}" for i in range(1, 15)])
    assert [e for e in expected if e not in tokens] == []


def test_aligned_records_equal_the_exports(domain):
    from accordant.operators.align import align

    a, b = align(domain.sources), domain.records
    assert a.exceptAll(b.select(a.columns)).count() == 0 and a.count() == b.count()


def test_file_validation(spark, tmp_path):
    path = f"{tmp_path}/crm.csv"
    files.write_csv(spark.createDataFrame([("P1", "c")], "project_id string, customer_name string"), path)
    assert files.validate_file(spark, path, ["project_id"]) == []
    assert "installer" in files.validate_file(spark, path, ["project_id", "installer"])[0]
    assert files.validate_file(spark, f"{tmp_path}/none.csv", [])[0].startswith("File not found")
    assert files.validate_file(spark, f"{tmp_path}/a.pdf", [])[0].startswith("Unsupported")


def test_latest_line_wins(spark, tmp_path):
    path = f"{tmp_path}/cases.jsonl"
    (tmp_path / "cases.jsonl").write_text('{"case_id": "a", "status": "NEW", "n": 1}\n\n{"case_id": "a", "status": "RESOLVED", "n": 2}\n')
    got = files.read_latest_jsonl(spark, path, "case_id string, status string, n int", "case_id", "n").collect()
    assert [(r["case_id"], r["status"]) for r in got] == [("a", "RESOLVED")]


def test_warehouse_types(spark, domain, tmp_path):
    warehouse.refresh({"projects": domain.master, "documents": domain.document}, str(tmp_path))
    stored = warehouse.read(spark, str(tmp_path), "projects")
    assert dict(stored.dtypes)["system_size_kw"] == "decimal(10,2)" and stored.count() == domain.master.count()
    assert len(schemas.WAREHOUSE) == 13 and len(schemas.columns("entity_matches")) == 11


def test_model_roundtrip_and_schema_check(spark, domain, tmp_path):
    train = domain.features.cache()
    model = models.fit_logistic(train)
    models.save_model(spark, model, str(tmp_path / "m"), train.count(), "2024-01-01", {"f1": 0.5})
    loaded, meta = models.load_model(spark, str(tmp_path / "m"))
    assert meta.first()["features"] == policy.FEATURES
    gap = models.score(train, loaded).select(F.max(F.abs(F.col("match_probability") - models.probability_of(loaded)))).first()[0]
    assert gap <= 1e-4
    with pytest.raises(ValueError):
        models.load_model(spark, str(tmp_path / "m"), policy.FEATURES[:3])
    with pytest.raises(Exception):
        models.load_or_fit(spark, str(tmp_path / "none"), train)
    assert models.load_or_fit(spark, str(tmp_path / "none"), train, fallback=True)[1]


@pytest.mark.parametrize("name", ["e4_field_records", "m1_pairwise_features", "j7_hard_negatives", "r8_case_states", "n4_w1_w2_rolling_mad",
                                  "j10_point_labels", "a14_m14_threshold_sweep", "m5_text_pair_features"])
def test_plans_have_no_cross_joins(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_terms_are_counted_in_parts_by_bytes_of_text(spark):
    """Texts that compress well are not joined to one task, however few bytes they take in a shuffle."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    text = " ".join(f"w{i}" for i in range(20_000))
    corpus = spark.range(60).select(F.col("id").cast("string").alias("doc"), F.lit(text).alias("title"))
    counts = features.title_terms(corpus, "doc", "title")
    try:
        found = counts.groupBy(F.spark_partition_id().alias("part")).agg(F.sum("tf").alias("terms"), F.countDistinct("doc").alias("docs")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    assert sum(r["terms"] for r in found) == 60 * (2 * 20_000 - 1)
    assert len(found) >= 3 and max(r["docs"] for r in found) * len(text) <= 3 * features.TEXT_PART


def test_tasks_take_bounded_shares_of_shuffles_and_files(spark, tmp_path):
    from accordant.session import size_shuffles

    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        size_shuffles(spark, str(tmp_path))
        assert int(spark.conf.get(names[0])) <= 8 << 20 and int(spark.conf.get(names[1])) <= 16 << 20
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
