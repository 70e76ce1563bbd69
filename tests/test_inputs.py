"""Inputs that the test tables do not hold: NaN, suffixed numbers, reordered and malformed files, busy kinds."""

import math

import pytest
from pyspark.sql import functions as F

from accordant import schemas
from accordant.functions import numbers
from accordant.functions.ids import pair_key
from accordant.operators import anomaly, outliers, pairs, perturb, profile, quality
from accordant.sources import files


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(i, "s", float(i % 7)) for i in range(50)] + [(99, "s", math.nan)], "id int, series string, value double")
    flagged = anomaly.fence_flags(df, anomaly.fences(df, ["series"], "value"), ["series"], "value")
    assert flagged.where("iqr OR zscore OR percentile").count() == 0
    row = profile.describe(df, ["series"], "value").first()
    assert row["count"] == 50 and row["max"] == 6.0
    assert profile.missing_cells(df, ["value"]).first()["missing"] == 1
    rules = [quality.not_null("value"), quality.in_range("value", 0, 6)]
    assert [r.rule_name for r in quality.check_rows(df, "x", "id", rules).collect()] == ["value_not_null"]


def test_suffixed_text_is_no_number(spark):
    df = spark.createDataFrame([("1.5d",), ("12F",), ("1,200.5",), (" 7 ",), ("-.5e2",), ("nan",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(numbers.parse_number(F.col("t"))).collect()]
    assert got == [None, None, 1200.5, 7.0, -50.0, None, None, None]


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    path = tmp_path / "crm.csv"
    path.write_text("status,project_id,extra,system_size_kw,updated_at\nDone,P1,x,4.5,2024-01-01 00:00:00\nDone,P2,x,abc,2024-01-01 00:00:00\n"
                    "Done,P3,x,5,notatime\n")
    df = files.read_csv(spark, str(path), schemas.SOURCE_FILES["crm"])
    rows = {r.project_id: r for r in df.collect()}
    assert rows["P1"].status == "Done" and rows["P1"].system_size_kw == 4.5 and rows["P1"].customer_name is None
    assert rows["P1"]._corrupt_record is None and rows["P2"]._corrupt_record and rows["P3"]._corrupt_record
    runs = files.ingestion_runs(files.canonical(df, "crm", "project_id", "crm.csv"), "r", F.current_timestamp(), F.current_timestamp()).first()
    assert (runs.rows_processed, runs.rows_successful, runs.rows_failed) == (3, 1, 2)


def test_folder_with_two_headers_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("project_id,status\nP1,Done\n")
    (tmp_path / "b.csv").write_text("status,project_id\nDone,P2\n")
    with pytest.raises(Exception):
        files.read_csv(spark, str(tmp_path), "project_id string, status string").collect()


def test_pair_numbers_never_meet(spark, monkeypatch):
    monkeypatch.setattr(pairs, "RANGE", 4)
    monkeypatch.setattr(pairs, "NUMBER_OFFSET", {"positive": 0, "negative": 4, "hard": 8})
    row = ("crm", "erp", "m", "m", 1)
    frame = spark.createDataFrame([("x", f"a{i}", f"b{i}", *row) for i in range(11)],
                                  "pair_id string, record_a_id string, record_b_id string, source_a string, source_b string, master_id_a string, master_id_b string, label int")
    ids = [r.pair_id for kind in pairs.NUMBER_OFFSET for r in pairs.numbered(frame, kind, ["record_a_id"]).collect()]
    assert len(ids) == len(set(ids)) == 33


def test_pair_keys_keep_the_whole_digest(spark):
    key = spark.range(1).select(pair_key(F.lit("crm"), F.lit("a"), F.lit("erp"), F.lit("b"))).first()[0]
    assert len(key) == len("PAIR-") + 32


def test_block_pairs_are_counted_exactly(spark):
    n = spark.createDataFrame([(300_000_002,)], "records long").select(pairs._pairs_among(F.col("records"))).first()[0]
    assert n == 300_000_002 * 300_000_001 // 2


def test_corruption_of_more_than_eight_columns(spark):
    names = [f"c{i}" for i in range(11)]
    df = spark.range(3000).select(F.concat(F.lit("P"), "id").alias("id"), *[F.lit("Pending").alias(c) for c in names])
    log = perturb.corruption_log(perturb.corruption_plan(df, "id", names, rate=1.0), "crm", "id", names)
    assert {r.field for r in log.select("field").distinct().collect()} == set(names)


def test_trees_draw_apart_at_any_size(spark):
    for total in (300, 4000):
        df = spark.range(total).select(F.col("id"), F.rand(3).alias("x"))
        got = outliers.tree_samples(df, ["x"], "id", total, 5, 128, 1).groupBy("tree").count().collect()
        assert sorted(r["count"] for r in got) == [128] * 5


def test_watched_folder_by_name_and_once(spark, tmp_path):
    from accordant.streaming import jobs

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("project_reference,customer_ref,customer,installed_capacity,region,record_status\nP1,C1,Ann,4.5,N,Done\nP2,C2,Bo,abc,N,Done\n,C3,Cy,1,N,Done\n")
    run = lambda: jobs.watch_exports(spark, str(folder), "erp", str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    run()
    (folder / "b.csv").write_text("customer_ref,project_reference,customer,installed_capacity,region,record_status\nC1,P1,Ann,4.5,N,Done\nC4,P4,Di,2,N,Done\n")
    (folder / "c.csv").write_text("customer_ref,customer\nC1,Ann\n")
    run()
    records = spark.read.parquet(str(tmp_path / "out/records"))
    assert sorted((r.source_record_id, r.raw_file_reference) for r in records.collect()) == [("P1", "a.csv"), ("P4", "b.csv")]
    assert spark.read.parquet(str(tmp_path / "out/quarantine")).count() == 2
    ledger = {r.file_name: r for r in spark.read.parquet(str(tmp_path / "out/ledger")).collect()}
    assert (ledger["a.csv"].rows_processed, ledger["a.csv"].rows_failed) == (3, 2) and ledger["c.csv"].status.startswith("FAILED")
