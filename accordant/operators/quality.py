"""Constraint checks that report in the validation-results shape.

Row rules of one table are evaluated in a single pass; key rules aggregate before they shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant.functions.numbers import as_double, nan_to_null
from accordant.operators.profile import dependency_groups

RESULT_COLUMNS = ["source_system", "source_record_id", "rule_name", "rule_type", "passed", "details"]


@dataclass(frozen=True)
class RowRule:
    """A condition on one row; ``shown`` is the value quoted in the result."""

    name: str
    kind: str
    passed: Column
    shown: Column


def not_null(column: str) -> RowRule:
    return RowRule(f"{column}_not_null", "not_null", F.col(column).isNotNull(), F.lit("null"))


def positive(column: str) -> RowRule:
    return RowRule(f"{column}_positive", "positive", F.col(column) > 0, F.col(column).cast("string"))


def in_domain(column: str, values: list) -> RowRule:
    return RowRule(f"{column}_domain", "domain", F.col(column).isin(values), F.col(column).cast("string"))


def in_range(column: str, low: float, high: float) -> RowRule:
    return RowRule(f"{column}_range", "range", F.col(column).between(low, high), F.col(column).cast("string"))


def max_length(column: str, length: int) -> RowRule:
    return RowRule(f"{column}_length", "length", F.length(column) <= length, F.length(column).cast("string"))


def has_type(column: str, type_name: str) -> RowRule:
    """Text that is present must be readable as the declared type."""
    text = F.col(column).cast("string")
    value = as_double(text) if type_name in ("double", "float") else F.col(column).try_cast(type_name)
    readable = F.col(column).isNull() | value.isNotNull()
    return RowRule(f"{column}_type", "type", readable, F.col(column).cast("string"))


def check_rows(df: DataFrame, source_system: str, record_id: str, rules: list[RowRule], failures_only: bool = True) -> DataFrame:
    """One result per row and rule. A condition that is unknown (null) passes, as in SQL, except
    that null never passes ``not_null``."""
    df = nan_to_null(df)
    entries = [F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.kind).alias("rule_type"),
                        F.coalesce(r.passed, F.lit(True)).alias("passed"), r.shown.alias("details")) for r in rules]
    results = F.array(*entries)
    if failures_only:
        results = F.filter(results, lambda r: ~r["passed"])
    return df.select(F.lit(source_system).alias("source_system"), F.col(record_id).cast("string").alias("source_record_id"),
                     F.explode(results).alias("r")).select("source_system", "source_record_id", "r.*").select(*RESULT_COLUMNS)


def _failures(df: DataFrame, source_system: str, key: Column, name: str, kind: str, details: Column) -> DataFrame:
    return df.select(F.lit(source_system).alias("source_system"), key.cast("string").alias("source_record_id"),
                     F.lit(name).alias("rule_name"), F.lit(kind).alias("rule_type"), F.lit(False).alias("passed"),
                     details.alias("details"))


def check_unique(df: DataFrame, source_system: str, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (null keys are not compared)."""
    repeated = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return _failures(repeated, source_system, F.concat_ws("|", *keys), "_".join(keys) + "_unique", "unique",
                     F.concat(F.col("_n").cast("string"), F.lit(" rows")))


def check_reference(df: DataFrame, source_system: str, column: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Values without a parent row, with the number of rows that hold them.

    Values are counted before the anti-join, so a repeated orphan is looked up once.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("_n"))
    orphans = values.join(parents.select(F.col(parent_key).alias(column)), column, "left_anti")
    return _failures(orphans, source_system, F.col(column), f"{column}_reference", "foreign_key",
                     F.concat(F.col("_n").cast("string"), F.lit(" rows")))


def check_dependency(df: DataFrame, source_system: str, key: str, targets: list[str]) -> DataFrame:
    """Keys whose targets are not unique, one result per key and target."""
    groups = dependency_groups(df, key, targets)
    entries = F.filter(F.array(*[F.struct(F.lit(t).alias("t"), F.col(f"varies_{t}").alias("v")) for t in targets]),
                       lambda e: e["v"])
    rows = groups.select(key, F.explode(entries).alias("e"))
    return rows.select(F.lit(source_system).alias("source_system"), F.col(key).cast("string").alias("source_record_id"),
                       F.concat(F.lit(f"{key}_determines_"), F.col("e.t")).alias("rule_name"),
                       F.lit("functional_dependency").alias("rule_type"), F.lit(False).alias("passed"),
                       F.lit("several values").alias("details"))


def check_labels(pairs: DataFrame, source_system: str = "pairs") -> DataFrame:
    """Pairs whose label contradicts their project ids."""
    same = F.col("master_id_a").eqNullSafe(F.col("master_id_b"))
    wrong = pairs.where(((F.col("label") == 1) & ~same) | ((F.col("label") == 0) & same))
    return _failures(wrong, source_system, F.col("pair_id"), "label_matches_ids", "consistency", F.col("label").cast("string"))


def check_split_leakage(split: DataFrame) -> DataFrame:
    """Entities that occur on both sides of a split."""
    sides = split.select(F.explode(F.array("master_id_a", "master_id_b")).alias("entity"), "split")
    both = sides.groupBy("entity").agg((F.min("split") != F.max("split")).alias("_both")).where("_both")
    return both.select("entity")


def required_columns(df: DataFrame, required: list[str]) -> list[str]:
    """Required columns a table does not have (known from the schema alone)."""
    return [c for c in required if c not in df.columns]


def summary(results: DataFrame) -> DataFrame:
    """Failures per source and rule."""
    return results.groupBy("source_system", "rule_name", "rule_type").agg(
        F.count_if(~F.col("passed")).alias("failures"))
