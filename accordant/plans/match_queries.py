"""Pairs, features, classes, queue, metrics, splits and models."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions import similarity, text
from accordant.operators import explain, features, forest, kpi, metrics, models, pairs, quality, queue, queue_store
from accordant.plans.domain import AS_OF
from accordant.plans.model_sql import linear_sql, newton_sql, random_forest_sql
from accordant.plans.oracle import CTES, TRAIN_SIDE, hash_int, jw, norm, pair_key, rnd
from accordant.plans.registry import query
from accordant.session import durable, scratch_path, stored

PAIR_COLUMNS = ", ".join(pairs.COLUMNS)

# Pairs ---------------------------------------------------------------------------------------------


@query("j5_positive_pairs", f"SELECT {PAIR_COLUMNS} FROM positives")
def positive_pairs(d):
    return d.positives


@query("j6_negative_pairs", f"SELECT {PAIR_COLUMNS} FROM negatives")
def negative_pairs(d):
    return d.negatives


def _hard_sql() -> str:
    ranked = " UNION ALL ".join(
        f"SELECT project_id, '{c}' AS rule, {c} AS v, crm, erp, partner FROM held" for c in ("customer_name", "installer", "address"))
    s1 = hash_int("a || '|' || b", 42, 3)
    s2 = f"({s1} + 1 + {hash_int(chr(97) + ' || ' + chr(39) + '|' + chr(39) + ' || b', 43, 2)}) % 3"
    side = " AND ".join("(" + " OR ".join(f"(source_{s} = '{n}' AND {s}_{n})" for n in pairs.HARD_SOURCES) + ")" for s in "ab")
    return f"""
      SELECT {pair_key('source_a', 'a', 'source_b', 'b')} AS pair_id, source_a, source_b, a AS record_a_id, b AS record_b_id, a AS master_id_a, b AS master_id_b, 0 AS label
      FROM (SELECT p.a, p.b, x.crm AS a_crm, x.erp AS a_erp, x.partner AS a_partner, y.crm AS b_crm, y.erp AS b_erp, y.partner AS b_partner,
              ['crm','erp','partner'][{s1} + 1] AS source_a, ['crm','erp','partner'][{s2} + 1] AS source_b
        FROM (SELECT DISTINCT project_id AS a, nxt AS b FROM (SELECT project_id, LEAD(project_id) OVER (PARTITION BY rule, v ORDER BY MD5('42|' || project_id), project_id) AS nxt
              FROM ({ranked}) WHERE v IS NOT NULL) WHERE nxt IS NOT NULL) p JOIN held x ON x.project_id = p.a JOIN held y ON y.project_id = p.b)
      WHERE {side}"""


@query("j7_hard_negatives", _hard_sql())
def hard_negatives(d):
    return pairs.hard_negative_pairs(d.staged, d.staged_records)


@query("j4_pair_records", """
    SELECT p.pair_id, a.customer_name AS customer_name_a, b.customer_name AS customer_name_b, a.status AS status_a, b.status AS status_b
    FROM pairs p JOIN records a ON a.source_system = p.source_a AND a.record_id = p.record_a_id JOIN records b ON b.source_system = p.source_b AND b.record_id = p.record_b_id""")
def pair_records(d):
    return features.pair_records(d.pairs, d.staged_records).select("pair_id", "customer_name_a", "customer_name_b", "status_a", "status_b")


@query("j8_f21_blocked_candidates", """
    SELECT p.pair_id, LOWER(a.state) || '_' || LOWER(a.city) AS block_key, p.label FROM pairs p JOIN master a ON a.project_id = p.master_id_a
    JOIN master b ON b.project_id = p.master_id_b WHERE a.state = b.state AND a.city = b.city""")
def blocked_candidates(d):
    keyed = pairs.with_block_keys(d.staged.withColumnRenamed("project_id", "record_id")).select("record_id", "block_key")
    return pairs.block_filter(d.pairs, keyed).select("pair_id", "block_key", "label")


@query("a27_block_sizes", "SELECT LOWER(state) || '_' || LOWER(city) AS block_key, COUNT(*) AS records, CAST(COUNT(*) * (COUNT(*) - 1) // 2 AS BIGINT) AS candidates FROM master GROUP BY 1")
def block_sizes(d):
    return pairs.block_sizes(pairs.with_block_keys(d.master)).withColumn("candidates", F.col("candidates").cast("long"))


@query("a27_blocking_statistics", """
    SELECT COUNT(*) AS blocks, SUM(n)::BIGINT AS records, MAX(n) AS largest_block, CAST(SUM(n) * (SUM(n) - 1) // 2 AS BIGINT) AS candidates_before,
      SUM(n * (n - 1) // 2)::BIGINT AS candidates_after, ROUND(1 - SUM(n * (n - 1) // 2) / (SUM(n) * (SUM(n) - 1) / 2e0), 6) AS reduction_ratio
    FROM (SELECT state, city, COUNT(*) AS n FROM master GROUP BY ALL)""")
def blocking_statistics(d):
    found = pairs.blocking_statistics(pairs.with_block_keys(d.master))
    return found.withColumns({c: F.col(c).cast("long") for c in ("candidates_before", "candidates_after")})


@query("a27_candidate_recall", """
    SELECT COUNT(*) AS true_pairs, COUNT(*) FILTER (WHERE c.city IS NOT NULL) AS kept_pairs, ROUND(COUNT(*) FILTER (WHERE c.city IS NOT NULL) / COUNT(*)::DOUBLE, 6) AS recall
    FROM positives p JOIN crm c ON c.project_id = p.master_id_a""")
def candidate_recall(d):
    keyed = pairs.with_block_keys(d.crm.withColumnRenamed("project_id", "record_id")).select("record_id", "block_key")
    return pairs.candidate_recall(d.positives, pairs.block_filter(d.positives, keyed))


@query("a25_c8_leakage", """SELECT COUNT(*) FILTER (WHERE label = 0 AND master_id_a = master_id_b) AS negatives_same_project, COUNT(*) FILTER (WHERE label = 1 AND master_id_a <> master_id_b) AS positives_different_project,
    COUNT(*) FILTER (WHERE label = 1) AS positives, COUNT(*) FILTER (WHERE label = 0) AS negatives FROM pairs""")
def leakage(d):
    return pairs.leakage(d.pairs)


@query("c8_label_consistency", "SELECT source_a, source_b, COUNT(*) FILTER (WHERE (label = 1) <> (master_id_a = master_id_b)) AS violations FROM pairs GROUP BY ALL")
def label_consistency(d):
    wrong = quality.check_labels(d.pairs).select(F.col("source_record_id").alias("pair_id"), F.lit(1).alias("hit"))
    return d.pairs.join(wrong, "pair_id", "left").groupBy("source_a", "source_b").agg(F.count("hit").alias("violations"))


@query("w3_f11_numbered_pairs", f"""
    SELECT 'PAIR-' || LPAD(CAST(number AS VARCHAR), CAST(GREATEST(6, LENGTH(CAST(number AS VARCHAR))) AS INTEGER), '0') AS pair_id,
      source_a, source_b, record_a_id, record_b_id, master_id_a, master_id_b, label
    FROM (SELECT *, CASE WHEN n <= 100000 THEN n + 100000 * kind ELSE 300000 + (n - 100001) * 3 + kind + 1 END AS number
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY kind ORDER BY record_a_id, source_a, source_b, record_b_id) AS n
        FROM (SELECT *, 0 AS kind FROM positives UNION ALL BY NAME SELECT *, 1 AS kind FROM negatives UNION ALL BY NAME SELECT *, 2 AS kind FROM ({_hard_sql()}))))""")
def numbered_pairs(d):
    order = ["record_a_id", "source_a", "source_b", "record_b_id"]
    hard = pairs.hard_negative_pairs(d.staged, d.staged_records)
    return (pairs.numbered(d.positives, "positive", order).unionByName(pairs.numbered(d.negatives, "negative", order))
            .unionByName(pairs.numbered(hard, "hard", order)))


@query("u1_record_map", "SELECT source_system AS source_name, COUNT(record_id) AS ids, COUNT(*) AS records, MIN(record_id) AS first_id, MAX(record_id) AS last_id FROM records GROUP BY 1")
def record_map(d):
    return pairs.record_map(d.records).groupBy("source_name").agg(
        F.count("source_record_id").alias("ids"), F.count("*").alias("records"), F.min("master_project_id").alias("first_id"),
        F.max("master_project_id").alias("last_id"))


@query("u2_entity_ids", "SELECT DISTINCT master_id_a AS entity FROM pairs UNION SELECT DISTINCT master_id_b FROM pairs")
def entity_ids(d):
    return pairs.entity_ids(d.pairs)


@query("u3_unreported_projects", "SELECT project_id FROM master WHERE project_id NOT IN (SELECT project_reference FROM erp WHERE project_reference IS NOT NULL)")
def unreported_projects(d):
    return d.master.select("project_id").join(d.erp.select(F.col("project_reference").alias("project_id")), "project_id", "left_anti")


# Features and classes ----------------------------------------------------------------------------------

FEATURE_SQL = ("pair_id, ROUND(customer_similarity, 6) AS customer_similarity, ROUND(installer_similarity, 6) AS installer_similarity, "
               "ROUND(address_similarity, 6) AS address_similarity, city_match, state_match, ROUND(capacity_diff, 6) AS capacity_diff, status_match, label")


def _rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("customer_similarity", "installer_similarity", "address_similarity", "capacity_diff")})


@query("m1_pairwise_features", f"SELECT {FEATURE_SQL} FROM features")
def pairwise_features(d):
    return _rounded(d.features)


@query("f4_jaro_winkler", f"""
    SELECT p_partkey, ROUND({jw('a', 'b')}, 6) AS names, ROUND({jw('a', 'c')}, 6) AS brands FROM
      (SELECT p_partkey, {norm('p_name')} AS a, {norm("p_type || ' ' || p_name")} AS b, {norm('p_brand')} AS c FROM part)""")
def jaro_winkler(d):
    return d.table("part").select(
        "p_partkey", F.round(similarity.jaro_winkler("p_name", F.concat_ws(" ", "p_type", "p_name")), 6).alias("names"),
        F.round(similarity.jaro_winkler("p_name", "p_brand"), 6).alias("brands"))


@query("f4_similar_installers", f"""
    SELECT a.ord, ROUND({jw('x', 'y')}, 6) AS similarity FROM (SELECT ord, {norm('installer')} AS x FROM crm) a JOIN (SELECT ord, {norm('installer_name')} AS y FROM partner) b ON b.ord = a.ord""")
def similar_installers(d):
    joined = d.crm.select("ord", "installer").join(d.partner.select("ord", "installer_name"), "ord")
    return joined.select("ord", F.round(similarity.jaro_winkler("installer", "installer_name"), 6).alias("similarity"))


BASE = "(customer_similarity + installer_similarity + address_similarity + city_match + state_match) / 5 >= 0.8"


@query("m2_deterministic_baseline", f"""
    SELECT tp, fp, fn, tn, COALESCE(tp / NULLIF(tp + fp, 0)::DOUBLE, 0) AS precision, COALESCE(tp / NULLIF(tp + fn, 0)::DOUBLE, 0) AS recall, COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1
    FROM (SELECT COUNT(*) FILTER (WHERE label = 1 AND p) AS tp, COUNT(*) FILTER (WHERE label = 0 AND p) AS fp, COUNT(*) FILTER (WHERE label = 1 AND NOT p) AS fn,
      COUNT(*) FILTER (WHERE label = 0 AND NOT p) AS tn FROM (SELECT label, {BASE} AS p FROM features))""")
def deterministic_baseline(d):
    return metrics.classification_report(features.baseline_prediction(d.features), "label", "prediction")


@query("m3_exact_title_baseline", f"""
    SELECT tp, fp, fn, tn, ROUND(COALESCE(tp / NULLIF(tp + fp, 0)::DOUBLE, 0), 6) AS precision, ROUND(COALESCE(tp / NULLIF(tp + fn, 0)::DOUBLE, 0), 6) AS recall, ROUND(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1
    FROM (SELECT COUNT(*) FILTER (WHERE label = 1 AND p) AS tp, COUNT(*) FILTER (WHERE label = 0 AND p) AS fp, COUNT(*) FILTER (WHERE label = 1 AND NOT p) AS fn,
      COUNT(*) FILTER (WHERE label = 0 AND NOT p) AS tn FROM (SELECT label, {norm('left_title')} = {norm('right_title')} AS p FROM text_pairs))""")
def exact_title_baseline(d):
    report = metrics.classification_report(features.exact_title_prediction(d.text_pairs), "label", "prediction")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("r1_discrepancy_classes", "SELECT label, classification, COUNT(*) AS pairs FROM explained GROUP BY ALL")
def discrepancy_classes(d):
    return d.explained.groupBy("label", "classification").agg(F.count("*").alias("pairs"))


@query("r2_r3_summaries", "SELECT pair_id, classification, summary, clarification FROM explained")
def summaries(d):
    return d.explained.select("pair_id", "classification", "summary", "clarification")


CONSIDERED = {"Customer similarity": "customer_similarity", "Installer similarity": "installer_similarity", "Address similarity": "address_similarity", "Capacity difference": "capacity_diff"}


@query("r4_explanations", f"""SELECT pair_id, summary AS what_differs, 'Classification: ' || classification AS why_flagged, '{", ".join(CONSIDERED)}' AS considered,
    {", ".join(f"ROUND({c}, 6) AS {c}" for c in CONSIDERED.values())}, 'Verify flagged fields and confirm match status.' AS reviewer_action FROM explained""")
def explanations(d):
    """The explanations' texts, the numbers in them as numbers."""
    schema = "what_differs string, why_flagged string, evidence_considered array<string>, reviewer_action string"
    parsed = d.explained.select("pair_id", F.from_json("explanation", schema).alias("e"))
    lines = [F.get("e.evidence_considered", F.lit(i)) for i in range(len(CONSIDERED))]
    labels = F.concat_ws(", ", *[F.split_part(x, F.lit(": "), F.lit(1)) for x in lines])
    numbers = [F.round(F.split_part(x, F.lit(": "), F.lit(2)).cast("double"), 6).alias(c) for x, c in zip(lines, CONSIDERED.values())]
    return parsed.select("pair_id", "e.what_differs", "e.why_flagged", labels.alias("considered"), *numbers, "e.reviewer_action")


DECISION = "CASE classification WHEN 'ENTITY_MISMATCH' THEN 'REJECT / NON-MATCH' WHEN 'NUMERIC_CONFLICT' THEN 'REQUEST CLARIFICATION' ELSE 'APPROVE / MATCH' END"
SIMULATED = f"(SELECT pair_id, {DECISION} AS decision, 'AI classification: ' || classification AS reason, label FROM explained)"


@query("r5_t4_simulated_decisions", f"SELECT pair_id, decision, reason FROM {SIMULATED} ORDER BY pair_id LIMIT 100")
def simulated_decisions(d):
    return explain.simulate_decisions(d.explained, AS_OF, limit=100).select("pair_id", "decision", "reason")


@query("a24_simulated_agreement", f"""SELECT COUNT(*) AS decisions, COUNT(*) FILTER (WHERE a) AS agreed, ROUND(COUNT(*) FILTER (WHERE a) / COUNT(*)::DOUBLE, 6) AS agreement_rate
    FROM (SELECT (decision = 'APPROVE / MATCH' AND label = 1) OR (decision = 'REJECT / NON-MATCH' AND label = 0) AS a FROM {SIMULATED})""")
def simulated_agreement(d):
    decided = explain.agreement(explain.simulate_decisions(d.explained, AS_OF))
    return decided.agg(F.count("*").alias("decisions"), F.count_if("agreed").alias("agreed"),
                       F.round(F.count_if("agreed") / F.count("*"), 6).alias("agreement_rate"))


@query("r17_feedback_rows", f"SELECT pair_id, decision, reason, '{AS_OF}' AS timestamp, 'v1.0' AS model_version FROM {SIMULATED}")
def feedback_rows(d):
    return explain.simulate_decisions(d.explained, AS_OF).select("pair_id", "decision", "reason", "timestamp", "model_version")


# Queue -----------------------------------------------------------------------------------------------------

@query("r6_j1_j2_queue", "SELECT pair_id, source_a, source_b, classification, match_probability, route, uncertainty FROM queue")
def queue_frame(d):
    moved = pairs.moved_by_pair(d.staged_features, policy.FEATURES)
    frame = queue.queue_frame(d.pairs, moved, explain.explain_pairs(moved), d.matcher.match_probability())
    return frame.select("pair_id", "source_a", "source_b", "classification", "match_probability", "route", "uncertainty")


@query("p10_a1_a2_route_shares", "SELECT route, COUNT(*) AS rows, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share FROM queue GROUP BY route")
def route_shares(d):
    return kpi.shares(d.queue, "route")


@query("r6_updated_queue", "SELECT pair_id, label, classification, match_probability, route, uncertainty FROM queue")
def updated_queue(d):
    """A queue stored from older records, of which one in a hundred projects has changed or is missing, brought up to date."""
    old = d.records.where((F.col("ord") % 200 != 7) | (F.col("source_system") != "partner")).withColumn(
        "customer_name", F.when(F.col("ord") % 100 == 7, F.concat("customer_name", F.lit(" old"))).otherwise(F.col("customer_name"))).where(F.col("ord") % 500 != 11)
    root = scratch_path(d.spark, "queue")
    matcher = models.fit_newton(metrics.training_pairs(d.pair_features))  # no other step reads these features, so they are not stored
    queue_store.build(old, matcher, root)
    queue_store.update(d.records, matcher, root, d.folded)
    return queue_store.read(d.spark, root).select("pair_id", "label", "classification", "match_probability", "route", "uncertainty")


@query("r7_j12_enriched_queue", "SELECT pair_id, case_status, age_days, severity, sla_breach, priority FROM enriched")
def enriched_queue(d):
    return d.enriched.select("pair_id", "case_status", "age_days", "severity", "sla_breach", "priority")


VIEW_FILTER = {"Needs review": "route = 'MANUAL_REVIEW'", "High risk": "route = 'MANUAL_REVIEW' AND classification = 'ENTITY_MISMATCH'",
               "Auto-matchable": "route = 'AUTO_MATCH'", "Non-match": "route = 'NON_MATCH'", "All pairs": "TRUE"}


@query("p5_saved_views", "SELECT " + ", ".join(f"COUNT(*) FILTER (WHERE {c}) AS {v.lower().replace(' ', '_').replace('-', '_')}" for v, c in VIEW_FILTER.items()) + " FROM queue")
def saved_views(d):
    def condition(spec):
        parts = [F.col(c).isin(v) for c, v in spec.items() if v]
        return parts[0] & parts[1] if len(parts) == 2 else (parts[0] if parts else F.lit(True))

    return d.queue.agg(*[F.count_if(condition(s)).alias(v.lower().replace(" ", "_").replace("-", "_")) for v, s in policy.QUEUE_VIEWS.items()])


@query("t2_t3_queue_by_priority", "SELECT pair_id, priority FROM enriched WHERE route = 'MANUAL_REVIEW' ORDER BY priority DESC, pair_id LIMIT 75")
def queue_by_priority(d):
    return queue.queue_view(d.enriched, "Needs review", limit=75).select("pair_id", "priority")


@query("t2_queue_by_uncertainty", "SELECT pair_id, uncertainty FROM queue ORDER BY uncertainty DESC, pair_id LIMIT 300")
def queue_by_uncertainty(d):
    return queue.queue_view(d.queue, "All pairs", "Most uncertain first", 300).select("pair_id", "uncertainty")


@query("t2_queue_lowest_probability", "SELECT pair_id, match_probability FROM queue WHERE route = 'NON_MATCH' ORDER BY match_probability, pair_id LIMIT 25")
def queue_lowest(d):
    return queue.queue_view(d.queue, "Non-match", "Lowest P(match)", 25).select("pair_id", "match_probability")


@query("f16_f19_queue_display", """
    SELECT pair_id, source_a || ' ↔ ' || source_b AS sources, CASE WHEN sla_breach THEN 'BREACH ' || CAST(CAST(ROUND(CAST(age_days AS DECIMAL(28,10)), 0) AS BIGINT) AS VARCHAR) || 'h'
      ELSE CAST(CAST(ROUND(CAST(age_days AS DECIMAL(28,10)), 0) AS BIGINT) AS VARCHAR) || 'h / 72h' END AS sla, priority FROM enriched WHERE case_status <> 'NEW'""")
def queue_display(d):
    from accordant.functions.times import sla_text

    return d.enriched.where(F.col("case_status") != "NEW").select(
        "pair_id", text.pair_label("source_a", "source_b").alias("sources"),
        sla_text(F.col("age_days"), F.col("sla_breach"), policy.SLA_HOURS).alias("sla"), "priority")


SOUGHT = [f"PAIR-{hashlib.md5(b'crm|PRJ-00000123|erp|PRJ-00000123').hexdigest().upper()}", "PRJ-00000123", "nothing of that name"]


@query("p6_search", f"""
    SELECT 'pair' AS kind, pair_id AS id FROM pairs WHERE pair_id IN ({", ".join(f"'{x}'" for x in SOUGHT)})
    UNION ALL SELECT 'project', project_id FROM master WHERE project_id IN ({", ".join(f"'{x}'" for x in SOUGHT)})""")
def search(d):
    """A pair id, a project id and a text that is neither."""
    return reduce(DataFrame.unionByName, [queue.search(d.pairs, d.master, x) for x in SOUGHT])


@query("p7_pairs_of_project", "SELECT pair_id, source_a, source_b, label FROM pairs WHERE record_a_id = 'PRJ-00000123' OR record_b_id = 'PRJ-00000123'")
def pairs_of_project(d):
    return queue.pairs_of_project(d.pairs, "PRJ-00000123").select("pair_id", "source_a", "source_b", "label")


@query("j16_pair_evidence", "SELECT e.field, e.verdict, p.label, COUNT(*) AS pairs FROM pairs p LEFT JOIN evidence e ON e.project_id = p.record_a_id GROUP BY ALL")
def pair_evidence(d):
    from accordant.operators.evidence import evidence

    joined = queue.pair_evidence(d.pairs, evidence(d.wide).select("project_id", "field", "verdict"))
    return joined.groupBy("field", "verdict", "label").agg(F.count("*").alias("pairs"))


@query("a19_a20_queue_shares", f"""
    SELECT COUNT(*) AS pairs, {rnd("COUNT(*) FILTER (WHERE classification IN ('ENTITY_MISMATCH', 'NUMERIC_CONFLICT', 'STATUS_CONFLICT')) / COUNT(*)::DOUBLE", 6)} AS material_conflict_share,
      {rnd("COUNT(*) FILTER (WHERE classification IN ('ENTITY_MISMATCH', 'NUMERIC_CONFLICT')) / COUNT(*)::DOUBLE", 6)} AS high_severity_share FROM explained""")
def queue_shares(d):
    severity = text.choose(F.col("classification"), policy.SEVERITY_OF_CLASS, "LOW")
    return kpi.queue_shares(d.explained.withColumn("severity", severity))


@query("r18_overview", """
    SELECT 'project' AS kind, 'all' AS value, COUNT(*) AS rows FROM master UNION ALL SELECT 'source', source_system, COUNT(*) FROM records GROUP BY 2
    UNION ALL SELECT 'route', route, COUNT(*) FROM queue GROUP BY 2 UNION ALL SELECT 'issue', classification, COUNT(*) FROM queue GROUP BY 2""")
def overview(d):
    q = d.queue.select("route", "classification")
    entries = F.array(F.struct(F.lit("route").alias("kind"), F.col("route").alias("value")),
                      F.struct(F.lit("issue").alias("kind"), F.col("classification").alias("value")))
    counted = q.select(F.explode(entries).alias("e")).groupBy("e.kind", "e.value").agg(F.count("*").alias("rows"))
    per_source = kpi.value_counts(d.records, "source_system").select(F.lit("source").alias("kind"), F.col("source_system").alias("value"), "rows")
    projects = d.master.agg(F.lit("project").alias("kind"), F.lit("all").alias("value"), F.count("*").alias("rows"))
    return counted.unionByName(per_source).unionByName(projects)


@query("m15_prediction_ledger", "SELECT 'entity_matcher' AS model_name, 'v1.0' AS model_version, route AS prediction, 'v1.0' AS feature_schema_version, COUNT(*) AS rows, ROUND(SUM(match_probability), 4) AS total FROM queue GROUP BY route")
def prediction_ledger(d):
    rows = models.prediction_ledger(d.queue, F.lit(AS_OF).cast("timestamp"))
    return rows.groupBy("model_name", "model_version", "prediction", "feature_schema_version").agg(
        F.count("*").alias("rows"), F.round(F.sum("probability").cast("double"), 4).alias("total"))


@query("m12_linear_scores", "SELECT pair_id, match_probability FROM queue")
def linear_scores(d):
    return d.staged_features.select("pair_id", d.matcher.match_probability().alias("match_probability"))


# Metrics and splits -----------------------------------------------------------------------------------------

REPORT = ("COALESCE(tp / NULLIF(tp + fp, 0)::DOUBLE, 0)", "COALESCE(tp / NULLIF(tp + fn, 0)::DOUBLE, 0)", "COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0)::DOUBLE, 0)")
COUNTS = ("COUNT(*) FILTER (WHERE label = 1 AND {p}) AS tp, COUNT(*) FILTER (WHERE label = 0 AND {p}) AS fp, COUNT(*) FILTER (WHERE label = 1 AND NOT {p}) AS fn, "
          "COUNT(*) FILTER (WHERE label = 0 AND NOT {p}) AS tn")


def _six(df):
    return df.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("a12_classification_report", f"SELECT lang, tp, fp, fn, tn, ROUND({REPORT[0]}, 6) AS precision, ROUND({REPORT[1]}, 6) AS recall, ROUND({REPORT[2]}, 6) AS f1 FROM (SELECT lang, {COUNTS.format(p='prediction = 1')} FROM scored GROUP BY lang)")
def classification_report(d):
    return _six(metrics.classification_report(d.scored, "label", "prediction", ["lang"]))


@query("a13_w5_roc_auc", """
    SELECT SUM(label)::BIGINT AS positives, COUNT(*) AS rows, ROUND((SUM(label * r) - SUM(label) * (SUM(label) + 1) / 2e0) / (SUM(label) * (COUNT(*) - SUM(label))), 6) AS roc_auc
    FROM (SELECT label, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2e0 AS r FROM scored)""")
def roc_auc(d):
    return metrics.roc_auc(d.scored, "label", "score").withColumn("roc_auc", F.round("roc_auc", 6))


@query("w5_average_ranks", "SELECT DISTINCT score, COUNT(*) OVER (PARTITION BY score) AS rows, RANK() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2e0 AS average_rank FROM (SELECT ROUND(o_totalprice, -3) AS score FROM orders)")
def average_ranks(d):
    prices = d.table("orders").select((F.round(F.col("o_totalprice") / 1000, 0) * 1000).alias("price"))
    return metrics.average_ranks(prices, "price")


THRESHOLDS = [round(0.30 + 0.05 * i, 2) for i in range(14)]


@query("a14_m14_threshold_sweep", f"""
    SELECT threshold, ROUND({REPORT[0]}, 6) AS precision, ROUND({REPORT[1]}, 6) AS recall, ROUND({REPORT[2]}, 6) AS f1 FROM (SELECT threshold, {COUNTS.format(p='score >= threshold')}
    FROM scored, (SELECT UNNEST([{', '.join(f'{t}e0' for t in THRESHOLDS)}]) AS threshold) GROUP BY threshold)""")
def threshold_sweep(d):
    return _six(metrics.threshold_sweep(d.scored, "label", "score", THRESHOLDS))


@query("a15_error_rates", f"SELECT lang, tp, fp, fn, tn, ROUND(fp / NULLIF(fp + tn, 0)::DOUBLE, 6) AS false_positive_rate, ROUND(fn / NULLIF(fn + tp, 0)::DOUBLE, 6) AS false_negative_rate FROM (SELECT lang, {COUNTS.format(p='prediction = 1')} FROM scored GROUP BY lang)")
def error_rates(d):
    out = metrics.error_rates(d.scored, "label", "prediction", ["lang"])
    return out.withColumns({c: F.round(c, 6) for c in ("false_positive_rate", "false_negative_rate")})


@query("a15_error_rows", "SELECT doc_id, label, prediction, CASE WHEN label = 0 THEN 'FP' ELSE 'FN' END AS error FROM scored WHERE label <> prediction")
def error_rows(d):
    return metrics.error_rows(d.scored, "label", "prediction").select("doc_id", "label", "prediction", "error")


@query("m6_w6_stratified_split", """
    SELECT pair_id, label, CASE WHEN ROW_NUMBER() OVER (PARTITION BY label ORDER BY MD5('42|' || pair_id), pair_id) <= FLOOR(COUNT(*) OVER (PARTITION BY label) * 0.7e0) THEN 'train' ELSE 'test' END AS split FROM pairs""")
def stratified_split(d):
    return metrics.stratified_split(stored(d.pairs.select("pair_id", "label")), "label", "pair_id")


ENTITY_SIDE = TRAIN_SIDE


@query("m7_j11_entity_split", f"""SELECT split, label, COUNT(*) AS pairs FROM (SELECT label, CASE WHEN {ENTITY_SIDE.format('master_id_a')} THEN 'train' ELSE 'test' END AS split FROM pairs
    WHERE ({ENTITY_SIDE.format('master_id_a')}) = ({ENTITY_SIDE.format('master_id_b')})) GROUP BY ALL""")
def entity_split(d):
    return metrics.entity_split(d.pairs).groupBy("split", "label").agg(F.count("*").alias("pairs"))


@query("c14_split_leakage", f"""
    SELECT COUNT(*) AS shared_entities FROM (SELECT entity FROM (SELECT UNNEST([master_id_a, master_id_b]) AS entity, CASE WHEN {ENTITY_SIDE.format('master_id_a')} THEN 'train' ELSE 'test' END AS split
      FROM pairs WHERE ({ENTITY_SIDE.format('master_id_a')}) = ({ENTITY_SIDE.format('master_id_b')})) GROUP BY entity HAVING COUNT(DISTINCT split) > 1)""")
def split_leakage(d):
    return quality.check_split_leakage(metrics.entity_split(d.pairs)).agg(F.count("*").alias("shared_entities"))


@query("j3_inner_merges", "SELECT e.classification, p.label, p.source_a, COUNT(*) AS pairs FROM explained e JOIN pairs p ON p.pair_id = e.pair_id GROUP BY ALL")
def inner_merges(d):
    joined = pairs.join_pairs(d.explained.select("pair_id", "classification"), d.pairs.select("pair_id", "label", "source_a"))
    return joined.groupBy("classification", "label", "source_a").agg(F.count("*").alias("pairs"))


@query("c5_pair_ids_exist", "SELECT COUNT(*) AS entities, COUNT(*) FILTER (WHERE entity NOT IN (SELECT project_id FROM master)) AS orphans FROM (SELECT master_id_a AS entity FROM pairs UNION SELECT master_id_b FROM pairs)")
def pair_ids_exist(d):
    ids = pairs.entity_ids(d.pairs)
    orphans = quality.check_reference(ids, "pairs", "entity", d.master, "project_id").agg(F.count("*")).scalar()
    return ids.agg(F.count("*").alias("entities")).withColumn("orphans", orphans)


@query("c6_similarity_range", "SELECT COUNT(*) AS pairs, COUNT(*) FILTER (WHERE customer_similarity NOT BETWEEN 0 AND 1 OR installer_similarity NOT BETWEEN 0 AND 1 OR address_similarity NOT BETWEEN 0 AND 1) AS failures FROM features")
def similarity_range(d):
    names = policy.FEATURES[:3]
    bad = ~F.col(names[0]).between(0.0, 1.0) | ~F.col(names[1]).between(0.0, 1.0) | ~F.col(names[2]).between(0.0, 1.0)
    return d.features.agg(F.count("*").alias("pairs"), F.count_if(bad).alias("failures"))


# Text features -----------------------------------------------------------------------------------------------

def _titles(d):
    left = d.text_pairs.select(F.concat(F.col("id").cast("string"), F.lit("l")).alias("doc"), F.col("left_title").alias("title"))
    return left.unionByName(d.text_pairs.select(F.concat(F.col("id").cast("string"), F.lit("r")).alias("doc"), F.col("right_title").alias("title")))


@query("m4_f20_tfidf_vocabulary", "SELECT term, df, ROUND(idf, 6) AS idf FROM vocabulary")
def tfidf_vocabulary(d):
    return features.fit_tfidf(_titles(d), "doc", "title").withColumn("idf", F.round("idf", 6))


@query("f20_title_terms", "SELECT id, side, COUNT(*) AS terms, COUNT(DISTINCT term) AS distinct_terms FROM terms GROUP BY ALL")
def title_terms(d):
    counts = features.title_terms(_titles(d), "doc", "title")
    return counts.groupBy(F.regexp_replace("doc", "[lr]$", "").cast("long").alias("id"), F.right("doc", F.lit(1)).alias("side")).agg(
        F.sum("tf").alias("terms"), F.count("*").alias("distinct_terms"))


@query("m5_text_pair_features", f"""
    SELECT p.id, ROUND(title_tfidf_cosine, 5) AS title_tfidf_cosine, (LOWER(left_title) = LOWER(right_title))::INT AS title_exact, (LOWER(left_brand) = LOWER(right_brand))::INT AS brand_match,
      (LOWER(left_category) = LOWER(right_category))::INT AS category_match, CAST(ABS(left_price - right_price) AS DOUBLE) AS price_diff, label
    FROM text_pairs p JOIN cosine c ON c.id = p.id""")
def text_pair_features(d):
    vocabulary = features.fit_tfidf(_titles(d), "doc", "title")
    return features.text_pair_features(d.text_pairs, vocabulary).withColumn("title_tfidf_cosine", F.round("title_tfidf_cosine", 5))


# Models --------------------------------------------------------------------------------------------------------

SPLIT_SQL = """split_rows AS MATERIALIZED (SELECT f.*, CASE WHEN ROW_NUMBER() OVER (PARTITION BY label ORDER BY MD5('42|' || pair_id), pair_id) <= FLOOR(COUNT(*) OVER (PARTITION BY label) * 0.7e0) THEN 'train' ELSE 'test' END AS split FROM features f),
  train_rows AS MATERIALIZED (SELECT * FROM split_rows WHERE split = 'train'), test_rows AS (SELECT * FROM split_rows WHERE split = 'test')"""
LOGISTIC_SQL = f"""WITH {SPLIT_SQL}, logistic AS MATERIALIZED ({newton_sql('train_rows', policy.FEATURES)}),
  judged AS MATERIALIZED (SELECT t.pair_id, t.label, ROUND({linear_sql(policy.FEATURES)}, 8) AS probability FROM test_rows t, logistic m)"""
JUDGED_REPORT = f"""SELECT tp, fp, fn, tn, ROUND({REPORT[0]}, 6) AS precision, ROUND({REPORT[1]}, 6) AS recall, ROUND({REPORT[2]}, 6) AS f1, ROUND(roc_auc, 6) AS roc_auc
  FROM (SELECT {COUNTS.format(p='probability >= 0.5')} FROM judged),
    (SELECT (SUM(label * r) - SUM(label) * (SUM(label) + 1) / 2e0) / (SUM(label) * (COUNT(*) - SUM(label))) AS roc_auc
     FROM (SELECT label, RANK() OVER (ORDER BY probability) + (COUNT(*) OVER (PARTITION BY probability) - 1) / 2e0 AS r FROM judged))"""
#: Size of the forest of the queries; the library's default is 100 trees.
TREES, DEPTH = 20, 6


def _split(d):
    split = metrics.stratified_split(d.staged_features, "label", "pair_id")
    return split.where("split = 'train'"), split.where("split = 'test'")


def _evaluated(scored):
    return _six(models.evaluate(scored)).withColumn("roc_auc", F.round("roc_auc", 6))


@query("m8_logistic_regression", f"{LOGISTIC_SQL} {JUDGED_REPORT}")
def logistic_regression(d):
    train, test = _split(d)
    return _evaluated(models.score(test, models.fit_newton(train)))


@query("m8_coefficients", f"""WITH {SPLIT_SQL}, logistic AS MATERIALIZED ({newton_sql('train_rows', policy.FEATURES)})
    SELECT UNNEST(['(intercept)', {', '.join(f"'{f}'" for f in policy.FEATURES)}]) AS name, ROUND(UNNEST([{', '.join(f'b{i}' for i in range(len(policy.FEATURES) + 1))}]), 6) AS value, TRUE AS settled FROM logistic""")
def coefficients(d):
    """The coefficients, and whether the gradient vanishes there."""
    model = models.fit_newton(_split(d)[0])
    rows = [("(intercept)", round(model.intercept, 6)), *((f, round(w, 6)) for f, w in zip(model.features, model.weights))]
    return d.spark.createDataFrame(rows, "name string, value double").withColumn("settled", F.lit(model.gradient < 1e-9))


@query("m9_random_forest", f"""{random_forest_sql('train_rows', 'test_rows', 'pair_id', policy.FEATURES, TREES, DEPTH).replace('WITH RECURSIVE ', f'WITH RECURSIVE {SPLIT_SQL}, ')},
    judged AS (SELECT t.label, f.probability FROM test_rows t JOIN forest_probability f ON f.pair_id = t.pair_id) {JUDGED_REPORT}""")
def random_forest(d):
    train, test = _split(d)
    return _evaluated(forest.score(test, forest.fit_forest(train, trees=TREES, depth=DEPTH)))


@query("m9_forest_probabilities", f"""{random_forest_sql('train_rows', 'test_rows', 'pair_id', policy.FEATURES, TREES, DEPTH).replace('WITH RECURSIVE ', f'WITH RECURSIVE {SPLIT_SQL}, ')}
    SELECT pair_id, probability FROM forest_probability""")
def forest_probabilities(d):
    train, test = _split(d)
    return forest.score(test, forest.fit_forest(train, trees=TREES, depth=DEPTH)).select("pair_id", "probability")


@query("m10_m11_stored_model", f"""{LOGISTIC_SQL} SELECT pair_id, {rnd('probability', 4)} AS match_probability, 7::BIGINT AS features, (SELECT COUNT(*) FROM train_rows) AS training_rows FROM judged""")
def stored_model(d):
    """Scores of a model that was stored and loaded again, with what its metadata says."""
    train, test = _split(d)
    path = scratch_path(d.spark, "model")
    model = models.fit_newton(train)
    report = models.evaluate(models.score(test, model)).first()
    names = ("precision", "recall", "f1", "roc_auc")
    models.save_model(d.spark, model, path, train.count(), "2024-02-01", {n: round(float(report[n]), 4) for n in names})
    loaded, meta = models.load_model(d.spark, path)
    row = meta.first()
    return models.score(test, loaded).select("pair_id", "match_probability", F.lit(len(row["features"])).cast("long").alias("features"), F.lit(row["training_rows"]).alias("training_rows"))


HARD_FEATURES = CTES["features"].replace("FROM pairs p", f"FROM ({_hard_sql()}) p")
EVALUATION_SQL = f"""WITH RECURSIVE sided AS MATERIALIZED (SELECT f.*, {TRAIN_SIDE.format('p.master_id_a')} AS a, {TRAIN_SIDE.format('p.master_id_b')} AS b FROM features f JOIN pairs p ON p.pair_id = f.pair_id),
  train_rows AS MATERIALIZED (SELECT * FROM sided WHERE a AND b),
  hard AS MATERIALIZED (SELECT f.*, {TRAIN_SIDE.format('p.master_id_a')} AS a, {TRAIN_SIDE.format('p.master_id_b')} AS b FROM ({HARD_FEATURES}) f JOIN ({_hard_sql()}) p ON p.pair_id = f.pair_id),
  asked AS MATERIALIZED (SELECT 'random' AS evaluation, * FROM sided WHERE NOT a AND NOT b UNION ALL SELECT 'hard', * FROM sided WHERE NOT a AND NOT b AND label = 1 UNION ALL SELECT 'hard', * FROM hard WHERE NOT a AND NOT b),
  test_rows AS MATERIALIZED (SELECT *, evaluation || pair_id AS asked_id FROM asked), logistic AS MATERIALIZED ({newton_sql('train_rows', policy.FEATURES)})"""


@query("m13_model_report", f"""{random_forest_sql('train_rows', 'test_rows', 'asked_id', policy.FEATURES, TREES, DEPTH).replace('WITH RECURSIVE ', EVALUATION_SQL + ', ')},
    judged AS (SELECT evaluation, 'baseline' AS model, label, (customer_similarity + installer_similarity + address_similarity + city_match + state_match) / 5 >= 0.8 AS p FROM test_rows
      UNION ALL SELECT evaluation, 'logistic', label, ROUND({linear_sql(policy.FEATURES)}, 8) >= 0.5 FROM test_rows t, logistic m
      UNION ALL SELECT evaluation, 'forest', label, probability >= 0.5 FROM test_rows t JOIN forest_probability f ON f.asked_id = t.asked_id)
    SELECT model, evaluation, ROUND({REPORT[0]}, 6) AS precision, ROUND({REPORT[1]}, 6) AS recall, ROUND({REPORT[2]}, 6) AS f1 FROM (SELECT model, evaluation, {COUNTS.format(p='p')} FROM judged GROUP BY ALL)""")
def model_report(d):
    """Fitted models and the baseline on pairs of unseen entities, with random and with hard negatives."""
    side = metrics.entity_split(d.staged_features)
    train, test = side.where("split = 'train'"), side.where("split = 'test'")
    hard = pairs.hard_negative_pairs(d.staged, d.staged_records)
    hard = metrics.entity_split(features.features_of(features.attach_records(hard, d.folded), keep=pairs.COLUMNS[1:-1])).where("split = 'test'")
    kept = ["pair_id", *policy.FEATURES, "label"]
    asked = durable(test.select(F.lit("random").alias("evaluation"), *kept).unionByName(test.where("label = 1").select(F.lit("hard").alias("evaluation"), *kept))
                    .unionByName(hard.select(F.lit("hard").alias("evaluation"), *kept)))
    scored = [features.baseline_prediction(asked).withColumn("model", F.lit("baseline")),
              models.score(asked, d.matcher).withColumn("model", F.lit("logistic")),
              forest.score(asked, forest.fit_forest(train, trees=TREES, depth=DEPTH)).withColumn("model", F.lit("forest"))]
    judged = reduce(DataFrame.unionByName, [s.select("model", "evaluation", "label", "prediction") for s in scored])
    return _six(metrics.classification_report(judged, "label", "prediction", ["model", "evaluation"])).select("model", "evaluation", "precision", "recall", "f1")
