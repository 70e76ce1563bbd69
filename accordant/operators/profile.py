"""Column, table and series profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant.functions.numbers import nan_to_null
from accordant.operators.ranking import exact_quantiles, join_on


def mean_by(df: DataFrame, key, columns: list[str], name: str) -> DataFrame:
    """Means of ``columns`` per derived key (hour of day, calendar date ...)."""
    return nan_to_null(df).groupBy(key.alias(name)).agg(*[F.avg(c).alias(f"avg_{c}") for c in columns])


def describe(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """count, mean, std, min, exact quartiles and max per group."""
    df = nan_to_null(df)
    basic = df.groupBy(*keys).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    quartiles = exact_quantiles(df, keys, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    if not keys:
        picked = quartiles.select(F.struct("q25", "q50", "q75")).scalar()
        return basic.select("*", *[picked.getField(q).alias(q) for q in ("q25", "q50", "q75")])
    return join_on(basic, quartiles, keys, "left")


def missing_cells(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Missing cells per column in one pass, as (column, missing, rows)."""
    columns = columns or df.columns
    counted = nan_to_null(df).agg(F.count("*").alias("rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns])
    return counted.select("rows", F.explode(entries).alias("e")).select("e.column", "e.missing", "rows")


def top_missing(df: DataFrame, n: int = 8) -> DataFrame:
    return missing_cells(df).orderBy(F.desc("missing"), "column").limit(n)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(F.sum("_n").alias("rows"), (F.sum("_n") - F.count("*")).alias("duplicates"))


def dependency_groups(df: DataFrame, key: str, targets: list[str]) -> DataFrame:
    """Per key, whether each target has more than one value.

    Smallest and largest value differ exactly when there are two distinct ones, so no distinct
    aggregation (and none of its row expansion) is needed.
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.coalesce(F.min(t) != F.max(t), F.lit(False)).alias(f"varies_{t}") for t in targets])


def dependency_violations(df: DataFrame, key: str, target: str) -> DataFrame:
    """Number of keys with several targets, and of keys."""
    groups = dependency_groups(df, key, [target])
    return groups.agg(F.count_if(F.col(f"varies_{target}")).alias("violating_entities"),
                      F.count("*").alias("total_entities"))


def first_violators(df: DataFrame, key: str, target: str, n: int = 10) -> DataFrame:
    return dependency_groups(df, key, [target]).where(F.col(f"varies_{target}")).select(key).orderBy(key).limit(n)


def source_conflicts(df: DataFrame, key: str, first: str, second: str) -> DataFrame:
    """Keys tracked, keys with contradicting reports on either attribute, and an example."""
    groups = dependency_groups(df, key, [first, second])
    a, b = F.col(f"varies_{first}"), F.col(f"varies_{second}")
    return groups.agg(F.count("*").alias("tracked"), F.count_if(a).alias("conflicting_first"),
                      F.count_if(b).alias("conflicting_second"), F.min(F.when(a, F.col(key))).alias("example"))


def group_mode(df: DataFrame, key: str, target: str) -> DataFrame:
    """Most frequent value per key; the lowest among equals.

    Counts per (key, value) first, so the second step sees distinct values only.
    """
    counts = df.where(F.col(key).isNotNull() & F.col(target).isNotNull()).groupBy(key, target).agg(F.count("*").alias("_n"))
    best = F.min_by(target, F.struct(-F.col("_n"), F.col(target)))
    return counts.groupBy(key).agg(best.alias("mode"))


def fill_with_mode(df: DataFrame, key: str, target: str) -> DataFrame:
    """Missing values replaced by the mode of their group; values that are present stay."""
    filled = df.join(group_mode(df, key, target), key, "left")
    return filled.withColumn(target, F.coalesce(F.col(target), F.col("mode"))).drop("mode")


def series_summary(df: DataFrame, time: str, source: str, columns: list[str]) -> DataFrame:
    """Rows, time range, number of sources and means."""
    per_source = nan_to_null(df).groupBy(source).agg(
        F.count("*").alias("_n"), F.min(time).alias("_first"), F.max(time).alias("_last"),
        *[F.sum(c).alias(f"_s_{c}") for c in columns], *[F.count(c).alias(f"_c_{c}") for c in columns])
    return per_source.agg(
        F.sum("_n").alias("rows"), F.min("_first").alias("first"), F.max("_last").alias("last"),
        F.count(source).alias("sources"),
        *[F.try_divide(F.sum(f"_s_{c}"), F.sum(f"_c_{c}")).alias(f"avg_{c}") for c in columns])
