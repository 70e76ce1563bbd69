"""Discrepancy classes, reviewer summaries and clarification drafts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant.functions.numbers import fixed_text
from accordant.functions.text import choose

# Message texts.
CLARIFICATIONS = {
    "NUMERIC_CONFLICT": "Please verify the system capacity value across sources.",
    "STATUS_CONFLICT": "Please confirm the current project status.",
    "ENTITY_MISMATCH": "Please verify if these records refer to the same project.",
    "FORMATTING_DIFFERENCE": "Please confirm the correct address format.",
}
DEFAULT_CLARIFICATION = "Please review the flagged discrepancies."
NOTHING_FOUND = "No significant discrepancies"
REVIEWER_ACTION = "Verify flagged fields and confirm match status."
SIMULATED_DECISIONS = {
    "ENTITY_MISMATCH": "REJECT / NON-MATCH", "NUMERIC_CONFLICT": "REQUEST CLARIFICATION",
}
DEFAULT_SIMULATED_DECISION = "APPROVE / MATCH"
# Limits of the classes, in the order in which they are tried, and of what a summary names.
CUSTOMER_BELOW, CAPACITY_ABOVE, ADDRESS_BELOW, INSTALLER_BELOW = 0.5, 2.0, 0.7, 0.7
LOW_BELOW = 0.8
# Labels of features in summaries and in explanations.
SUMMARY_LABELS = {
    "customer_similarity": "Customer name similarity",
    "installer_similarity": "Installer similarity",
    "address_similarity": "Address similarity",
}
STATUS_DIFFERS = "Status mismatch detected"
CONSIDERED_LABELS = {
    "customer_similarity": "Customer similarity",
    "installer_similarity": "Installer similarity",
    "address_similarity": "Address similarity",
    "capacity_diff": "Capacity difference",
}


def discrepancy_class() -> Column:
    """Ordered rules over the pair features; the first that applies names the class."""
    diff = F.col("capacity_diff")
    return (F.when(F.col("customer_similarity") < CUSTOMER_BELOW, "ENTITY_MISMATCH")
            .when(diff.isNull() | (diff > CAPACITY_ABOVE), "NUMERIC_CONFLICT")
            .when(F.col("status_match") == 0, "STATUS_CONFLICT")
            .when(F.col("address_similarity") < ADDRESS_BELOW, "FORMATTING_DIFFERENCE")
            .when(F.col("installer_similarity") < INSTALLER_BELOW, "POTENTIAL_DUPLICATE")
            .otherwise("OTHER"))


def evidence_summary() -> Column:
    low = [F.when(F.col(c) < LOW_BELOW, F.concat(F.lit(f"{label}: "), fixed_text(F.col(c), 2))) for c, label in SUMMARY_LABELS.items()]
    gap = F.col("capacity_diff")
    capacity = F.when(gap > 0, F.concat(F.lit(f"{CONSIDERED_LABELS['capacity_diff']}: "), fixed_text(gap, 1), F.lit(" kW")))
    parts = [*low, capacity, F.when(F.col("status_match") == 0, STATUS_DIFFERS)]
    return F.coalesce(F.nullif(F.concat_ws("; ", *parts), F.lit("")), F.lit(NOTHING_FOUND))  # the text is put together once


def clarification(classification: Column) -> Column:
    return choose(classification, CLARIFICATIONS, DEFAULT_CLARIFICATION)


def explanation() -> Column:
    """JSON record for the reviewer (expects ``classification`` and ``summary``)."""
    considered = [F.concat(F.lit(f"{label}: "), F.coalesce(F.col(c).cast("string"), F.lit("N/A"))) for c, label in CONSIDERED_LABELS.items()]
    return F.to_json(F.struct(
        F.col("summary").alias("what_differs"),
        F.concat(F.lit("Classification: "), F.coalesce(F.col("classification"), F.lit("UNKNOWN"))).alias("why_flagged"),
        F.array(*considered).alias("evidence_considered"),
        F.lit(REVIEWER_ACTION).alias("reviewer_action")))


def explain_pairs(features: DataFrame) -> DataFrame:
    """Features with class, summary, clarification and explanation."""
    return (features.withColumn("classification", discrepancy_class())
            .withColumn("summary", evidence_summary())
            .withColumn("clarification", clarification(F.col("classification")))
            .withColumn("explanation", explanation()))


def simulate_decisions(explained: DataFrame, at: str, limit: int | None = None, reviewer: str = "reviewer_001",
                       model_version: str = "v1.0") -> DataFrame:
    """Rule-made decisions on all pairs, or on the first ``limit`` of the queue."""
    first = explained if limit is None else explained.orderBy("pair_id").limit(limit)
    return first.select(
        "pair_id", F.lit(reviewer).alias("reviewer_id"),
        choose(F.col("classification"), SIMULATED_DECISIONS, DEFAULT_SIMULATED_DECISION).alias("decision"),
        F.concat(F.lit("AI classification: "), F.col("classification")).alias("reason"),
        F.lit("").alias("comment"), F.lit(model_version).alias("model_version"), F.lit(at).alias("timestamp"), "label")


def agreement(decisions: DataFrame) -> DataFrame:
    """Whether a decision agrees with the label; clarifications never do."""
    d, y = F.col("decision"), F.col("label")
    agreed = ((d == DEFAULT_SIMULATED_DECISION) & (y == 1)) | ((d == SIMULATED_DECISIONS["ENTITY_MISMATCH"]) & (y == 0))
    return decisions.withColumn("agreed", agreed)
