"""Field verdicts, lifecycle, QA and KPIs on the published unit vectors."""

import random

import pytest
from pyspark.sql import functions as F

from accordant import policy
from accordant.operators import cases, evidence, kpi, pairs, profile, qa, quality
from accordant.plans.domain import Domain

SOURCES = ["signed_document", "crm", "erp", "partner"]


def judged(spark, field, **values):
    row = (field, *[values.get(s) for s in SOURCES])
    df = spark.createDataFrame([row], "field string, " + ", ".join(f"{s} string" for s in SOURCES))
    return evidence.judge(df).first()


@pytest.mark.parametrize("partner,verdict", [("250.5", "MATCH"), ("255", "CONFLICT"), ("251.5", "REVIEW"), (None, "MISSING"), ("n/a", "MISSING")])
def test_numeric_verdicts(spark, partner, verdict):
    assert judged(spark, "system_size_kw", crm="250", partner=partner)["verdict"] == verdict


def test_numeric_record(spark):
    row = judged(spark, "system_size_kw", crm="250", partner="255")
    assert (row["severity"], row["category"]) == ("HIGH", "NUMERIC_CONFLICT")
    assert row["detail"] == "max spread 5.00 exceeds review limit 2.0"
    assert row["action"].startswith("CONFLICT: authoritative source is crm (250);")


@pytest.mark.parametrize("a,b,verdict", [("ABC Solar LLC", "abc  solar llc", "MATCH"), ("ABC Solar LLC", "ABC Solar L.L.C.", "FORMAT"),
                                         ("ABC Solar", "XYZ Energy", "CONFLICT"), ("ABC", " ", "MISSING")])
def test_text_verdicts(spark, a, b, verdict):
    assert judged(spark, "installer", crm=a, partner=b)["verdict"] == verdict


def test_status_verdicts(spark):
    assert judged(spark, "status", crm="Completed", erp="ACTIVE", signed_document="SIGNED")["verdict"] == "MATCH"
    pending = judged(spark, "status", crm="Pending", erp="PENDING", signed_document="NOT_SENT")
    assert (pending["verdict"], pending["detail"]) == ("CONFLICT", "2 distinct status groups")
    assert judged(spark, "status", crm="Odd", erp="odd")["verdict"] == "MATCH"


def test_authority(spark):
    row = judged(spark, "system_size_kw", crm="255", partner="255", signed_document="250")
    assert (row["authority_source"], row["authority_value"]) == ("signed_document", "250")
    nothing = judged(spark, "installer", crm="—", partner="nan")
    assert nothing["authority_source"] is None and nothing["authority_reason"] == "no source reports this field"


def events(spark, moves):
    rows = [(case, f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", i, to, "r1", "", implicit) for i, (case, to, implicit) in enumerate(moves)]
    df = spark.createDataFrame(rows, "case_id string, at string, seq long, to string, actor string, note string, implicit boolean")
    return df.withColumn("at", F.col("at").cast("timestamp"))


def states(spark, moves, segment=512):
    annotated = cases.annotate(events(spark, moves), segment)
    opened = spark.createDataFrame([(c,) for c in sorted({m[0] for m in moves})], "case_id string").withColumn(
        "created_at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return {r["case_id"]: r for r in cases.case_states(annotated, opened).collect()}


def test_lifecycle(spark):
    moves = [("happy", "IN_REVIEW", False), ("happy", "RESOLVED", False), ("illegal", "RESOLVED", False)]
    moves += [("loop", s, False) for s in ("IN_REVIEW", "WAITING_CLARIFICATION", "IN_REVIEW", "REJECTED", "REOPENED")]
    got = states(spark, moves)
    assert got["happy"]["status"] == "RESOLVED" and got["happy"]["history_rows"] == 3
    assert got["happy"]["started_at"] and got["happy"]["resolved_at"]
    assert (got["illegal"]["status"], got["illegal"]["rejected_events"]) == ("NEW", 1)
    assert got["loop"]["status"] == "REOPENED" and got["loop"]["resolved_at"] is None


def replay(moves):
    state, trail = {}, []
    for case, to, implicit in moves:
        now = state.get(case, "NEW")
        ok = to in policy.TRANSITIONS[now] and (not implicit or now in ("NEW", "REOPENED"))
        trail.append((now, "accepted" if ok else "ignored" if implicit or now == to else "rejected"))
        if ok:
            state[case] = to
    return trail


@pytest.mark.parametrize("segment", [3, 512])
def test_segmented_fold_equals_replay(spark, segment):
    rng = random.Random(7)
    moves = [("hot" if rng.random() < 0.6 else f"c{rng.randint(0, 20)}", rng.choice(list(policy.TRANSITIONS)[1:]), rng.random() < 0.2)
             for _ in range(400)]
    got = {r["seq"]: (r["from_status"], r["outcome"]) for r in cases.annotate(events(spark, moves), segment).collect()}
    assert [got[i] for i in range(len(moves))] == replay(moves)


def test_short_cases_are_moved_once(spark):
    moves = [(c, to, False) for c in ("a", "b", None) for to in ("IN_REVIEW", "RESOLVED", "REOPENED")] + [("long", "IN_REVIEW", False)] * 9
    df = events(spark, moves)
    short = cases.annotate(df)
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "rangepartitioning" not in plan and "SortMergeJoin" not in plan
    cut = cases.annotate(df, 4)  # one case is cut into runs, the others are not
    assert short.columns == cut.columns and short.dtypes == cut.dtypes
    assert sorted(map(str, short.collect())) == sorted(map(str, cut.collect()))
    assert {r["case_id"] for r in short.collect()} == {"a", "b", "long"} and short.agg(F.max("n")).first()[0] == 9


def test_corrections_put_only_concerned_projects_together(spark):
    d = Domain(spark, "/root/testdata/sf0.001")
    resolved = d.opened.join(d.cases.where("status = 'RESOLVED'"), "case_id", "left_semi")
    whole = evidence.correction_proposals(evidence.evidence(d.wide), resolved.select("case_id", "project_id")).withColumn("proposed_by", F.lit("reviewer"))
    assert sorted(map(str, d.corrections.collect())) == sorted(map(str, whole.collect())) and d.corrections.count() > 0
    first = d.case_source.groupBy("case_id").agg(F.date_trunc("day", F.min("at")).alias("created_at"), F.first("project_id").alias("project_id"))
    assert sorted(map(str, d.opened.collect())) == sorted(map(str, first.collect()))
    read = d.corrections._jdf.queryExecution().optimizedPlan().toString()
    assert "o_orderkey" not in read  # of all orders, only those concerned were stored and folded


def test_previous_event(spark):
    moves = [("a", "IN_REVIEW", False), ("b", "IN_REVIEW", False), ("a", "RESOLVED", False), ("a", "REOPENED", False)]
    got = {r["seq"]: r["previous_to"] for r in cases.previous_event(events(spark, moves), bucket=2).collect()}
    assert got == {0: None, 1: None, 2: "IN_REVIEW", 3: "RESOLVED"}


def test_sync_needs_a_resolved_case_with_corrections(spark):
    case = spark.createDataFrame([("a", "RESOLVED"), ("b", "RESOLVED"), ("c", "NEW")], "case_id string, status string")
    fixes = spark.createDataFrame([("a", "system_size_kw", "255", "250", "signed_document", "r1"), ("c", "status", "x", "y", "crm", "r1")],
                                  "case_id string, field string, old_value string, new_value string, authority_source string, proposed_by string")
    errors = {r["case_id"]: r["error"] for r in cases.sync_checks(case, fixes).collect()}
    assert errors == {"a": None, "b": "no approved corrections to sync", "c": "only RESOLVED cases can be synced"}
    assert [r["case_id"] for r in cases.handoff(case, fixes, F.current_timestamp()).collect()] == ["a"]


def test_sla(spark):
    df = spark.sql("SELECT 'p' AS case_id, 'NEW' AS status, timestamp'2024-01-01 00:00:00' AS created_at, CAST(NULL AS TIMESTAMP) AS resolved_at")
    as_of = F.lit("2024-01-05 04:00:00").cast("timestamp")
    assert cases.with_age(df, as_of, 72).first()["sla_breach"]
    assert not cases.with_age(df, as_of, 720).first()["sla_breach"]


def test_qa(spark):
    case = spark.createDataFrame([(c, "RESOLVED") for c in "ABC"], "case_id string, status string")
    done = spark.createDataFrame([("A",)], "case_id string")
    assert sorted(r["case_id"] for r in qa.qa_queue(case, done, 1.0).collect()) == ["B", "C"]
    reviews = spark.createDataFrame([("AGREE", "")] * 9 + [("DISAGREE", " ")], "verdict string, note string")
    assert qa.qa_metrics(reviews).first()["agreement_rate"] == 0.9
    assert qa.qa_metrics(reviews.limit(0)).first()["agreement_rate"] is None
    assert qa.check_reviews(reviews).where("error is not null").count() == 1


def test_kpis(spark):
    case = spark.sql("""SELECT * FROM VALUES ('A', 'RESOLVED', timestamp'2024-01-10 07:00:00', timestamp'2024-01-10 12:00:00'),
        ('B', 'IN_REVIEW', timestamp'2024-01-06 08:00:00', NULL) AS t(case_id, status, created_at, resolved_at)""")
    decisions = spark.createDataFrame([("MATCH", "SOURCE_CONFLICT"), ("CLARIFICATION", None)], "decision string, reason_code string")
    reviews = spark.createDataFrame([("AGREE", "")], "verdict string, note string")
    k = kpi.reviewer_kpis(case, decisions, reviews, "2024-01-10").first()
    assert (k["open_cases"], k["resolved_total"], k["resolved_today"], k["sla_breaches"]) == (1, 1, 1, 1)
    assert (k["clarification_rate"], k["avg_resolution_hours"], k["qa_agreement_rate"]) == (0.5, 5.0, 1.0)
    assert {r["reason_code"] for r in kpi.reason_distribution(decisions).collect()} == {"SOURCE_CONFLICT", "OTHER"}


def test_quality_scores(spark):
    records = spark.createDataFrame([("x", None), ("y", "z")], "a string, b string")
    assert kpi.completeness(records, ["a", "b"]).first()["completeness"] == 0.75
    verdicts = spark.createDataFrame([("MATCH",), ("CONFLICT",)], "verdict string")
    assert kpi.conflict_rate(verdicts).first()["conflict_rate"] == 0.5
    keys = spark.createDataFrame([(i % 97,) for i in range(100)], "k int")
    assert kpi.duplicate_rate(keys, "k").first()["duplicate_rate"] == 0.03


def test_mode_repair_keeps_present_values(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", None), ("h", None)], "g string, v string")
    fixed = sorted((r["g"], r["v"]) for r in profile.fill_with_mode(df, "g", "v").collect() if r["v"])
    assert fixed == [("g", "a"), ("g", "a"), ("g", "b")]


def test_hard_negatives_within_a_hot_value(spark):
    n = 300
    master = spark.range(n).selectExpr("concat('P', id) AS project_id", "concat('c', id) AS customer_name",
                                       "CASE WHEN id % 3 > 0 THEN 'hot' END AS installer", "CAST(NULL AS STRING) AS address")
    records = master.selectExpr("project_id AS record_id", "explode(array('crm', 'erp', 'partner')) AS source_system")
    got = pairs.hard_negative_pairs(master, records).toPandas()
    assert len(got) == 199
    assert (got["master_id_a"] != got["master_id_b"]).all() and (got["source_a"] != got["source_b"]).all()
    assert got["master_id_a"].is_unique


def test_negative_draws_stop_after_n(spark):
    master = spark.range(100).selectExpr("concat('P', id) AS project_id")
    records = master.selectExpr("project_id AS record_id", "explode(array('crm', 'erp', 'partner', 'document')) AS source_system")
    assert pairs.negative_pairs(master, records, 20).count() == 20
    assert pairs.leakage(pairs.negative_pairs(master, records)).first()["negatives_same_project"] == 0


def test_row_rules(spark):
    df = spark.createDataFrame([("1", -1.0, "x"), ("2", None, "y"), ("3", 2.0, None)], "id string, n double, s string")
    rules = [quality.positive("n"), quality.not_null("s"), quality.in_domain("s", ["x"]), quality.has_type("s", "double")]
    got = {(r["source_record_id"], r["rule_name"]) for r in quality.check_rows(df, "t", "id", rules).collect()}
    assert got == {("1", "n_positive"), ("3", "s_not_null"), ("2", "s_domain"), ("1", "s_type"), ("2", "s_type")}
