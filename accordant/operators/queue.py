"""The review queue: scoring, routing, priority and saved views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.numbers import priority_score, round_dp, route, uncertainty
from accordant.functions.text import choose
from accordant.functions.times import age_hours
from accordant.operators.pairs import join_pairs


def queue_frame(pairs: DataFrame, features: DataFrame, explained: DataFrame, probability: Column) -> DataFrame:
    """Pairs with features, explanation, P(match) by the given expression over the features, route and uncertainty.

    Features of ``moved_by_pair``, and what is explained of them, are moved once for both joins. All three are merged, as
    they are as long as the pairs, whatever Spark takes their size for.
    """
    key = "_pair" if "_pair" in explained.columns else "pair_id"
    notes = explained.select(key, "classification", "summary", "clarification")
    return with_route(join_pairs(pairs, features.drop("label").hint("merge"), "left", notes.hint("merge")), probability)


def with_route(joined: DataFrame, probability: Column) -> DataFrame:
    scored = joined.withColumn("match_probability", probability)
    return (scored.withColumn("route", route(F.col("match_probability")))
            .withColumn("uncertainty", uncertainty(F.col("match_probability"))))


def enrich_queue(queue: DataFrame, cases: DataFrame, as_of: Column, sla_hours: int = policy.SLA_HOURS) -> DataFrame:
    """Case status, age, severity, SLA flag and priority; pairs without a case are NEW and young."""
    terminal = F.col("status").isin(policy.TERMINAL_STATUSES)
    age = age_hours(F.col("created_at"), F.col("resolved_at"), terminal, as_of)
    state = cases.select(F.col("case_id").alias("pair_id"), F.col("status").alias("_status"),
                         round_dp(age / 24, 1).alias("_age"), (~terminal & (age > sla_hours)).alias("_breach"))
    joined = join_pairs(queue, state, "left")
    return (joined.withColumn("case_status", F.coalesce("_status", F.lit(policy.INITIAL_STATUS)))
            .withColumn("age_days", F.coalesce("_age", F.lit(0.0)))
            .withColumn("severity", choose(F.col("classification"), policy.SEVERITY_OF_CLASS, "LOW"))
            .withColumn("sla_breach", F.coalesce("_breach", F.lit(False)))
            .withColumn("priority", priority_score(F.col("severity"), F.col("uncertainty"), F.col("age_days")))
            .drop("_status", "_age", "_breach"))


def queue_view(queue: DataFrame, view: str = "All pairs", sort: str = "Highest priority", limit: int | None = None,
               routes: list[str] | None = None, classes: list[str] | None = None) -> DataFrame:
    """A saved view, sorted and cut; equal sort values are ordered by pair id."""
    spec = policy.QUEUE_VIEWS[view]
    routes = spec["route"] if routes is None else routes
    classes = spec["classification"] if classes is None else classes
    shown = queue
    if routes:
        shown = shown.where(F.col("route").isin(routes))
    if classes:
        shown = shown.where(F.col("classification").isin(classes))
    if limit is None:
        return shown
    column, ascending = policy.QUEUE_SORTS[sort]
    return shown.orderBy(F.col(column).asc() if ascending else F.col(column).desc(), "pair_id").limit(limit)


def pairs_of_project(pairs: DataFrame, project_id: str) -> DataFrame:
    return pairs.where((F.col("record_a_id") == project_id) | (F.col("record_b_id") == project_id))


def search(pairs: DataFrame, master: DataFrame, text: str) -> DataFrame:
    """Look a text up as pair id or project id."""
    hits = pairs.where(F.col("pair_id") == text).select(F.lit("pair").alias("kind"), F.col("pair_id").alias("id"))
    projects = master.where(F.col("project_id") == text).select(
        F.lit("project").alias("kind"), F.col("project_id").alias("id"))
    return hits.unionByName(projects)


def pair_evidence(queue: DataFrame, evidence_rows: DataFrame) -> DataFrame:
    """Field evidence of the first record's project for every queued pair."""
    return queue.join(evidence_rows.withColumnRenamed("project_id", "record_a_id"), "record_a_id", "left")
