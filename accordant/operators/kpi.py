"""Counts, shares, data-quality scores and reviewer KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.numbers import ratio, round_dp
from accordant.functions.text import is_blank
from accordant.functions.times import hours_between, kpi_age_hours
from accordant.operators.qa import qa_columns


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; missing values are not counted."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))


def shares(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """Rows per value with their share of all counted rows."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("share", F.round(F.col("rows") / total, digits))


def completeness(records: DataFrame, fields: list[str], by: list[str] = ()) -> DataFrame:
    """1 - blank cells / all cells over ``fields``."""
    blanks = sum((is_blank(f).cast("long") for f in fields[1:]), is_blank(fields[0]).cast("long"))
    cells = F.count("*") * len(fields)
    return records.groupBy(*by).agg(
        cells.alias("cells"), F.sum(blanks).alias("missing"), (1 - F.sum(blanks) / cells).alias("_c")
    ).withColumn("completeness", round_dp(F.col("_c"), 4)).drop("_c")


def conflict_rate(evidence_rows: DataFrame, by: list[str] = ()) -> DataFrame:
    """Share of comparisons with a CONFLICT verdict."""
    bad = F.count_if(F.col("verdict") == "CONFLICT")
    return evidence_rows.groupBy(*by).agg(F.count("*").alias("comparisons"), bad.alias("conflicts"),
                                          ratio(bad, F.count("*"), 4).alias("conflict_rate"))


def duplicate_rate(df: DataFrame, key: str) -> DataFrame:
    """1 - distinct keys / rows, through one count per key."""
    per_key = df.groupBy(key).agg(F.count("*").alias("_n"))
    rows, keys = F.sum("_n"), F.count(key)
    return per_key.agg(rows.alias("rows"), keys.alias("distinct_keys"),
                       round_dp(1 - ratio(keys, rows), 4).alias("duplicate_rate"))


def queue_shares(queue: DataFrame) -> DataFrame:
    """Material-conflict share (three classes) and high-severity share of the queue."""
    material = F.count_if(F.col("classification").isin(policy.MATERIAL_CLASSES))
    high = F.count_if(F.col("severity") == "HIGH")
    return queue.agg(F.count("*").alias("pairs"), ratio(material, F.count("*"), 6).alias("material_conflict_share"),
                     ratio(high, F.count("*"), 6).alias("high_severity_share"))


def reason_distribution(decisions: DataFrame) -> DataFrame:
    code = F.coalesce("reason_code", F.lit("OTHER")).alias("reason_code")
    return decisions.groupBy(code).agg(F.count("*").alias("decisions"))


def reviewer_kpis(cases: DataFrame, decisions: DataFrame, reviews: DataFrame, today: str,
                  sla_hours: int = policy.SLA_HOURS) -> DataFrame:
    """One row of operational KPIs; each input is read once."""
    open_ = F.col("status").isin(policy.OPEN_STATUSES)
    done = F.col("status").isin(policy.TERMINAL_STATUSES)
    handling = F.when(done, hours_between(F.col("created_at"), F.col("resolved_at")))
    age = kpi_age_hours(F.col("created_at"), F.col("resolved_at"), today)
    decided = decisions.agg(F.struct(
        F.count("*").alias("n"), F.count_if(F.col("decision") == "CLARIFICATION").alias("clarifications"))).scalar()
    checked = reviews.agg(F.struct(*qa_columns())).scalar()
    counted = cases.agg(
        F.count_if(open_).alias("open_cases"), F.count_if(done).alias("resolved_total"),
        F.count_if(done & (F.date_format("resolved_at", "yyyy-MM-dd") == today)).alias("resolved_today"),
        F.avg(handling).alias("_hours"), F.count_if(F.col("status") == "REOPENED").alias("rework_reopened"),
        F.count_if(open_ & (age > sla_hours)).alias("sla_breaches"))
    return counted.select(
        "open_cases", "resolved_total", "resolved_today", round_dp(F.col("_hours"), 2).alias("avg_resolution_hours"),
        ratio(decided.getField("clarifications"), decided.getField("n"), 3).alias("clarification_rate"),
        "rework_reopened", "sla_breaches", checked.getField("agreement_rate").alias("qa_agreement_rate"),
        checked.getField("qa_sampled").alias("qa_sampled"))
