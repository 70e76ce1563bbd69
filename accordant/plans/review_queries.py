"""Case lifecycle, decisions, second review and KPIs."""

from __future__ import annotations

from pyspark.sql import functions as F

from accordant import policy
from accordant.functions import numbers, times
from accordant.operators import cases, kpi, qa
from accordant.plans.domain import AS_OF, TODAY
from accordant.plans.oracle import blank, rnd
from accordant.plans.registry import query
from accordant.session import stored

STAMP = "yyyy-MM-dd HH:mm:ss"


def _stamps(df, *columns):
    return df.withColumns({c: F.date_format(c, STAMP) for c in columns})


def _sql_stamp(c: str) -> str:
    return f"STRFTIME({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


@query("r8_case_states", f"SELECT case_id, status, assigned_to, {_sql_stamp('created_at')}, {_sql_stamp('started_at')}, {_sql_stamp('resolved_at')}, history_rows, rejected_events FROM cases")
def case_states(d):
    return _stamps(d.cases, "created_at", "started_at", "resolved_at")


@query("r8_event_outcomes", 'SELECT case_id, seq, from_status, "to", outcome FROM annotated')
def event_outcomes(d):
    return d.annotated.select("case_id", "seq", "from_status", "to", "outcome")


@query("r8_status_counts", "SELECT status, COUNT(*) AS cases FROM cases GROUP BY 1")
def status_counts(d):
    return d.cases.groupBy("status").agg(F.count("*").alias("cases"))


@query("r8_case_history", """
    SELECT case_id, 0::BIGINT AS n, NULL AS from_status, 'NEW' AS "to", 'system' AS actor FROM opened
    UNION ALL SELECT case_id, n, from_status, "to", actor FROM annotated WHERE outcome = 'accepted'""")
def case_history(d):
    return cases.history(d.annotated, d.opened).select("case_id", "n", "from_status", "to", "actor")


@query("w8_previous_event", 'SELECT case_id, seq, "to", LAG("to") OVER (PARTITION BY case_id ORDER BY "at", seq) AS previous_to FROM case_events')
def previous_event(d):
    return cases.previous_event(d.case_events).select("case_id", "seq", "to", "previous_to")


@query("r9_corrections", "SELECT case_id, COUNT(*) AS corrections, COUNT(DISTINCT field) AS fields FROM corrections GROUP BY 1")
def corrections(d):
    return d.corrections.groupBy("case_id").agg(F.count("*").alias("corrections"), F.count_distinct("field").alias("fields"))


@query("r10_handoff_rows", f"SELECT case_id, field, authority_source, proposed_by, '{AS_OF}' AS synced_at FROM corrections")
def handoff_rows(d):
    rows = cases.handoff(d.cases, d.corrections, F.lit(AS_OF).cast("timestamp"))
    return _stamps(rows.select("case_id", "field", "authority_source", "proposed_by", "synced_at"), "synced_at")


@query("r10_sync_checks", """
    SELECT error, COUNT(*) AS cases FROM (SELECT CASE WHEN status <> 'RESOLVED' THEN 'only RESOLVED cases can be synced' WHEN n IS NULL THEN 'no approved corrections to sync' END AS error
      FROM cases c LEFT JOIN (SELECT case_id, COUNT(*) AS n FROM corrections GROUP BY 1) k ON k.case_id = c.case_id) GROUP BY 1""")
def sync_checks(d):
    return cases.sync_checks(d.cases, d.corrections).groupBy("error").agg(F.count("*").alias("cases"))


@query("r10_states_after_sync", """
    SELECT status, COUNT(*) AS cases FROM (SELECT CASE WHEN status = 'RESOLVED' AND case_id IN (SELECT case_id FROM corrections) THEN 'SYNCED' ELSE status END AS status FROM cases) GROUP BY 1""")
def states_after_sync(d):
    synced = stored(cases.sync_events(cases.sync_checks(d.staged_cases, d.corrections), F.lit(AS_OF).cast("timestamp")))
    annotated = cases.annotate(d.case_events.unionByName(synced))
    return cases.case_states(annotated, d.opened.drop("project_id")).groupBy("status").agg(F.count("*").alias("cases"))


@query("r11_f14_ages_and_breaches", "SELECT case_id, ROUND(age_hours, 6) AS age_hours, sla_breach FROM aged")
def ages_and_breaches(d):
    aged = cases.with_age(d.cases, F.lit(AS_OF).cast("timestamp"))
    return aged.select("case_id", F.round("age_hours", 6).alias("age_hours"), "sla_breach")


@query("f15_kpi_ages", f"""SELECT case_id, ROUND(GREATEST(0e0, DATE_DIFF('microsecond', created_at, COALESCE(resolved_at, TIMESTAMP '{TODAY} 23:59:59')) / 3.6e9), 6) AS age_hours FROM cases""")
def kpi_ages(d):
    age = times.kpi_age_hours(F.col("created_at"), F.col("resolved_at"), TODAY)
    return d.cases.select("case_id", F.round(age, 6).alias("age_hours"))


CHECKED = f"""(SELECT *, CASE WHEN {blank('reviewer_id')} THEN 'Reviewer ID is required.' WHEN {blank('reason')} THEN 'An explanation is required.'
    WHEN reason_code IS NULL OR reason_code = 'UNKNOWN' THEN 'Unknown reason code.' END AS error FROM decisions)"""


@query("r15_decision_checks", f"SELECT error, decision, COUNT(*) AS decisions FROM {CHECKED} GROUP BY ALL")
def decision_checks(d):
    return cases.check_decisions(d.decisions).groupBy("error", "decision").agg(F.count("*").alias("decisions"))


@query("r15_decision_events", f"""
    SELECT pair_id AS case_id, seq * 2 AS seq, 'IN_REVIEW' AS "to", TRIM(reviewer_id) AS actor, 'reviewer opened the case' AS note, TRUE AS implicit FROM {CHECKED} WHERE error IS NULL
    UNION ALL SELECT pair_id, seq * 2 + 1, CASE decision WHEN 'CLARIFICATION' THEN 'WAITING_CLARIFICATION' ELSE 'RESOLVED' END, TRIM(reviewer_id), decision || ': ' || reason_code, FALSE FROM {CHECKED} WHERE error IS NULL""")
def decision_events(d):
    valid = cases.check_decisions(d.decisions).where(F.col("error").isNull())
    return cases.decision_events(valid).drop("at")


@query("r15_states_after_decisions", f"""
    SELECT status, COUNT(*) AS cases FROM (SELECT pair_id, CASE WHEN decision IS NULL THEN 'NEW' WHEN decision = 'CLARIFICATION' THEN 'WAITING_CLARIFICATION' ELSE 'RESOLVED' END AS status
      FROM (SELECT DISTINCT pair_id FROM decisions) o LEFT JOIN (SELECT pair_id, COALESCE(MIN_BY(decision, (at, seq)) FILTER (WHERE decision <> 'CLARIFICATION'), 'CLARIFICATION') AS decision
        FROM {CHECKED.replace(' decisions)', ' decisions) WHERE error IS NULL')} GROUP BY 1) f USING (pair_id)) GROUP BY 1""".replace("(at, seq)", '("at", seq)'))
def states_after_decisions(d):
    valid = cases.check_decisions(d.decisions).where(F.col("error").isNull())
    annotated = cases.annotate(cases.decision_events(valid))
    return cases.case_states(annotated, d.opened.drop("project_id")).groupBy("status").agg(F.count("*").alias("cases"))


@query("r16_p14_audit_log", f"""SELECT {_sql_stamp('timestamp')}, pair_id, reviewer_id, decision, reason_code, reason, comment, model_version FROM (SELECT *, "at" AS timestamp FROM decisions)""")
def audit_log(d):
    log = _stamps(d.decisions.withColumnRenamed("at", "timestamp"), "timestamp")
    return log.select(*[c for c in policy.AUDIT_COLUMNS if c in log.columns])


@query("r16_a30_case_listing", f"""
    SELECT c.case_id, status, {_sql_stamp('created_at')}, {_sql_stamp('resolved_at')}, COALESCE(n, 0) AS corrections FROM cases c LEFT JOIN (SELECT case_id, COUNT(*) AS n FROM corrections GROUP BY 1) k ON k.case_id = c.case_id""")
def case_listing(d):
    return _stamps(cases.case_listing(d.cases, d.corrections), "created_at", "resolved_at")


SAMPLED = """((SELECT LIST_REDUCE(LIST_PREPEND(CAST(0 AS BIGINT), LIST_TRANSFORM(RANGE(8), lambda i: CAST('0x' || SUBSTR(SHA256(case_id), 8 * i + 1, 8) AS BIGINT))), lambda acc, x: (acc * 96 + x) % 100)) < {})"""


@query("r12_qa_sample", f"SELECT case_id, {SAMPLED.format(10)} AS sampled FROM opened")
def qa_sample(d):
    from accordant.functions.ids import is_sampled

    return d.opened.select("case_id", is_sampled(F.col("case_id"), policy.QA_FRACTION).alias("sampled"))


@query("r13_j13_qa_queue", f"SELECT case_id, status FROM cases WHERE status IN ('RESOLVED', 'SYNCED') AND {SAMPLED.format(50)} AND case_id NOT IN (SELECT case_id FROM reviews WHERE verdict = 'DISAGREE')")
def qa_queue(d):
    done = d.reviews.where("verdict = 'DISAGREE'")
    return qa.qa_queue(d.cases, done, 0.5).select("case_id", "status")


@query("r14_review_checks", f"""SELECT verdict, error, COUNT(*) AS reviews FROM (SELECT verdict, CASE WHEN verdict NOT IN ('AGREE', 'DISAGREE') THEN 'verdict must be AGREE or DISAGREE'
    WHEN verdict = 'DISAGREE' AND {blank('note')} THEN 'A note is required when disagreeing.' END AS error FROM reviews) GROUP BY ALL""")
def review_checks(d):
    return qa.check_reviews(d.reviews).groupBy("verdict", "error").agg(F.count("*").alias("reviews"))


@query("a23_qa_metrics", f"""SELECT COUNT(*) AS qa_sampled, COUNT(*) FILTER (WHERE verdict = 'AGREE') AS agreements, COUNT(*) FILTER (WHERE verdict <> 'AGREE') AS disagreements,
    {rnd("COUNT(*) FILTER (WHERE verdict = 'AGREE') / COUNT(*)::DOUBLE", 3)} AS agreement_rate, {rnd("COUNT(*) FILTER (WHERE verdict <> 'AGREE') / COUNT(*)::DOUBLE", 3)} AS rework_signal_rate FROM reviews""")
def qa_metrics(d):
    return qa.qa_metrics(d.reviews)


@query("a22_reason_distribution", "SELECT COALESCE(reason_code, 'OTHER') AS reason_code, COUNT(*) AS decisions FROM decisions GROUP BY 1")
def reason_distribution(d):
    return kpi.reason_distribution(d.decisions)


@query("a21_reviewer_kpis", f"""
    SELECT COUNT(*) FILTER (WHERE o) AS open_cases, COUNT(*) FILTER (WHERE NOT o) AS resolved_total, COUNT(*) FILTER (WHERE NOT o AND STRFTIME(resolved_at, '%Y-%m-%d') = '{TODAY}') AS resolved_today,
      {rnd("AVG(DATE_DIFF('microsecond', created_at, resolved_at) / 3.6e9) FILTER (WHERE NOT o)", 2)} AS avg_resolution_hours,
      (SELECT {rnd("COUNT(*) FILTER (WHERE decision = 'CLARIFICATION') / COUNT(*)::DOUBLE", 3)} FROM decisions) AS clarification_rate,
      COUNT(*) FILTER (WHERE status = 'REOPENED') AS rework_reopened,
      COUNT(*) FILTER (WHERE o AND DATE_DIFF('microsecond', created_at, COALESCE(resolved_at, TIMESTAMP '{TODAY} 23:59:59')) / 3.6e9 > 72) AS sla_breaches,
      (SELECT {rnd("COUNT(*) FILTER (WHERE verdict = 'AGREE') / COUNT(*)::DOUBLE", 3)} FROM reviews) AS qa_agreement_rate, (SELECT COUNT(*) FROM reviews) AS qa_sampled
    FROM (SELECT *, status IN ('NEW', 'IN_REVIEW', 'WAITING_CLARIFICATION', 'REOPENED') AS o FROM cases)""")
def reviewer_kpis(d):
    return kpi.reviewer_kpis(d.cases, d.decisions, d.reviews, TODAY)


@query("e11_proposal_counts", "SELECT field, authority_source, COUNT(*) AS proposals FROM corrections GROUP BY ALL")
def proposal_counts(d):
    return d.corrections.groupBy("field", "authority_source").agg(F.count("*").alias("proposals"))


@query("j9_resolved_projects", """
    SELECT o.project_id, c.status, w.in_erp, w.installer_crm, ROUND(w.system_size_kw_partner, 4) AS partner_size FROM cases c JOIN opened o ON o.case_id = c.case_id JOIN wide w ON w.project_id = o.project_id""")
def resolved_projects(d):
    linked = d.cases.select("case_id", "status").join(d.opened.select("case_id", "project_id"), "case_id")
    return linked.join(d.wide, "project_id").select("project_id", "status", "in_erp", "installer_crm", F.round("system_size_kw_partner", 4).alias("partner_size"))


@query("f16_priority_scores", """
    SELECT doc_id, CAST(ROUND(CAST(10 * (CASE WHEN quality = 1 THEN 1 ELSE 3 END) + 5e0 * (doc_id % 10) / 10 + 0.5e0 * toxic AS DECIMAL(28,10)), 2) AS DOUBLE) AS priority FROM labels""")
def priority_scores(d):
    severity = F.when(F.col("quality") == 1, "LOW").otherwise("HIGH")
    return d.table("labels").select("doc_id", numbers.priority_score(severity, F.col("doc_id") % 10 / 10, F.col("toxic").cast("double")).alias("priority"))
