"""Field-level discrepancy evidence over the wide project view.

Rules are read once, when the plan is built, and become Column expressions: comparing all fields of
all projects is a chain of projections without any shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.numbers import fixed_text, parse_number
from accordant.functions.text import alphanumeric_core, choose, is_blank, normalize_evidence
from accordant.operators.align import field_value, first_record

# Verdict texts.
TOO_FEW = "fewer than two sources report this field"
NO_SOURCE = "no source reports this field"
NO_ACTION = "No action — sources agree."
ASK_MISSING = "Request the missing value from the non-reporting source."


def long_values(wide: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """(project_id, field, one value column per authority key) for the given canonical fields."""
    rows = []
    for field in fields or policy.FIELD_SOURCES:
        held = {key: field_value(field, source) for key, source, _ in policy.FIELD_SOURCES[field]}
        rows.append(F.struct(F.lit(field).alias("field"), *[
            held.get(key, F.lit(None)).cast("string").alias(key) for key in policy.SOURCE_PRIORITY]))
    return wide.select("project_id", F.explode(F.array(*rows)).alias("r")).select("project_id", "r.*")


def _group_numbers(equivalents: list[list[str]]) -> dict[str, str]:
    """Normalised member -> number of the first group that lists it."""
    numbers: dict[str, str] = {}
    for i, group in enumerate(equivalents):
        for member in group:
            numbers.setdefault(" ".join(member.split()).lower(), str(i))
    return numbers


def judge(rows: DataFrame, rules: dict | None = None, priority: dict[str, int] | None = None) -> DataFrame:
    """Compare the reported values of each (project, field) row.

    ``rows`` has a ``field`` column and one text column per source key of ``priority``. Adds
    verdict, severity, category, detail, the authoritative source with its value, and the
    recommended action. Each value is normalised once; later steps refer to earlier columns.
    """
    rules = policy.FIELD_RULES if rules is None else rules
    priority = policy.SOURCE_PRIORITY if priority is None else priority
    sources = sorted((s for s in rows.columns if s in priority), key=priority.get)
    field = F.col("field")
    kinds = {f: r["kind"] for f, r in rules.items() if r["kind"] != "text"}
    numeric = {f: r for f, r in rules.items() if r["kind"] == "numeric"}
    categories = {f: _group_numbers(r["equivalents"]) for f, r in rules.items() if r["kind"] == "category"}

    def group_of(text: Column) -> Column:
        result = None
        for name, numbers in categories.items():
            mapped = F.coalesce(choose(text, numbers), F.concat(F.lit("other:"), text)) if numbers else text
            result = F.when(field == name, mapped) if result is None else result.when(field == name, mapped)
        return text if result is None else result.otherwise(text)

    normalised = rows.withColumns({
        "_kind": choose(field, kinds, "text") if kinds else F.lit("text"),
        "_texts": F.array_compact(F.array(*[normalize_evidence(s) for s in sources]))})
    parsed = normalised.withColumns({
        "_known": F.size("_texts"), "_distinct": F.array_distinct("_texts"),
        "_numbers": F.when(F.col("_kind") == "numeric", F.array_compact(F.array(*[parse_number(F.col(s)) for s in sources])))})
    counted = parsed.withColumns({
        "_readable": F.size("_numbers"),
        "_spread": F.when(F.col("_kind") == "numeric", F.array_max("_numbers") - F.array_min("_numbers")),
        "_variants": F.when(F.col("_kind") == "text", F.size(F.array_distinct(F.transform("_distinct", alphanumeric_core))))
        .when(F.col("_kind") == "category", F.size(F.array_distinct(F.transform("_distinct", group_of))))})

    def limit(name: str, default: float) -> Column:
        return choose(field, {f: float(r.get(name, default)) for f, r in numeric.items()}) if numeric else F.lit(None)

    is_kind = {k: F.col("_kind") == k for k in ("numeric", "category", "text")}
    missing = F.when(is_kind["numeric"], F.col("_readable") < 2).otherwise(F.col("_known") < 2)
    verdict = (F.when(missing, "MISSING")
               .when(is_kind["numeric"], F.when(F.col("_spread") <= limit("tolerance", 1.0), "MATCH")
                     .when(F.col("_spread") > limit("review_above", 2.0), "CONFLICT").otherwise("REVIEW"))
               .when(is_kind["category"], F.when(F.col("_variants") == 1, "MATCH").otherwise("CONFLICT"))
               .when(F.size("_distinct") == 1, "MATCH").when(F.col("_variants") == 1, "FORMAT").otherwise("CONFLICT"))
    judged = counted.withColumns({"verdict": verdict, "_authority": _authority(sources)})

    tolerance, review = limit("tolerance", 1.0).cast("string"), limit("review_above", 2.0).cast("string")
    v = F.col("verdict")
    spread = F.concat(F.lit("max spread "), fixed_text(F.col("_spread"), 2))
    detail = (F.when(v == "MISSING", TOO_FEW)
              .when(is_kind["numeric"], F.when(v == "MATCH", F.concat(spread, F.lit(" within tolerance "), tolerance))
                    .when(v == "CONFLICT", F.concat(spread, F.lit(" exceeds review limit "), review))
                    .otherwise(F.concat(spread, F.lit(" inside grey zone ("), tolerance, F.lit(", "), review, F.lit("]"))))
              .when(is_kind["category"], F.when(v == "MATCH", "same status group across sources")
                    .otherwise(F.concat(F.col("_variants").cast("string"), F.lit(" distinct status groups"))))
              .when(v == "MATCH", "identical after normalization").when(v == "FORMAT", "same content, different formatting")
              .otherwise(F.concat(F.size("_distinct").cast("string"), F.lit(" distinct normalized values"))))
    source, value = F.col("_authority.source"), F.col("_authority.value")
    return judged.withColumns({
        "severity": choose(v, policy.SEVERITY_OF_VERDICT, "LOW"),
        "category": choose(field, policy.CATEGORY_OF_FIELD, "OTHER"), "detail": detail,
        "authority_source": source, "authority_value": value, "authority_reason": F.col("_authority.reason"),
        "action": recommended_action(v, source, value)}).drop(*[c for c in judged.columns if c.startswith("_")])


def _authority(sources: list[str]) -> Column:
    """Struct (source, value, reason) of the first source, in priority order, that reports a value."""
    entries = [F.when(~is_blank(s), F.struct(
        F.lit(s).alias("source"), F.col(s).cast("string").alias("value"),
        F.lit(f"{s} outranks others by source priority").alias("reason"))) for s in sources]
    nothing = F.struct(F.lit(None).cast("string").alias("source"), F.lit(None).cast("string").alias("value"),
                       F.lit(NO_SOURCE).alias("reason"))
    return F.coalesce(*entries, nothing)


def recommended_action(verdict: Column, source: Column, value: Column) -> Column:
    long = F.concat(verdict, F.lit(": authoritative source is "), F.coalesce(source, F.lit("n/a")),
                    F.lit(" ("), F.coalesce(value, F.lit("None")),
                    F.lit("); update derived values or request clarification."))
    return F.when(verdict == "MATCH", NO_ACTION).when(verdict == "MISSING", ASK_MISSING).otherwise(long)


def evidence(wide: DataFrame, rules: dict | None = None, priority: dict[str, int] | None = None,
             fields: list[str] | None = None) -> DataFrame:
    """All (or the given) fields of all projects in long form; missing values are shown as a dash."""
    judged = judge(long_values(wide, fields), rules, priority)
    shown = {s: F.coalesce(F.col(s), F.lit("—")) for s in policy.SOURCE_PRIORITY}
    return judged.withColumns(shown).withColumnRenamed("signed_document", "document")


def flagged_lines(evidence_rows: DataFrame) -> DataFrame:
    """Why a project is flagged: every comparison above LOW severity with its symptom."""
    symptom = choose(F.col("severity"), {"HIGH": "Conflict", "MEDIUM": "Needs a look"}, "Note")
    line = F.concat(choose(F.col("field"), policy.FIELD_LABELS), F.lit(" — "), symptom, F.lit(": "), F.col("detail"))
    return evidence_rows.where(F.col("severity") != "LOW").select("project_id", "field", line.alias("line"))


def correction_proposals(evidence_rows: DataFrame, resolved: DataFrame) -> DataFrame:
    """Authoritative values for conflicting fields of projects with a RESOLVED case.

    ``resolved``: (case_id, project_id). The old value is the CRM's.
    """
    open_fields = evidence_rows.where(
        F.col("verdict").isin("CONFLICT", "REVIEW") & F.col("authority_source").isNotNull())
    return resolved.join(open_fields, "project_id").select(
        "case_id", "project_id", "field", F.nullif(F.col("crm"), F.lit("—")).alias("old_value"),
        F.col("authority_value").alias("new_value"), "authority_source")


def provenance_lines(master: DataFrame, crm: DataFrame, document: DataFrame) -> DataFrame:
    """What is known about recency per project."""
    updated = first_record(crm.select("project_id", "updated_at", "ord"), ["project_id"], ["ord"])
    signed = first_record(
        document.select(F.col("project_reference").alias("project_id"), "signed_date", "document_name", "ord"),
        ["project_id"], ["ord"])
    joined = (master.select("project_id").join(updated.drop("ord"), "project_id", "left")
              .join(signed.drop("ord"), "project_id", "left"))
    return joined.select(
        "project_id",
        F.concat(F.lit("CRM updated: "), F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")).alias("crm_line"),
        F.concat(F.lit("Document signed: "), F.date_format("signed_date", "yyyy-MM-dd"), F.lit(" ("),
                 F.col("document_name"), F.lit(")")).alias("document_line"))
