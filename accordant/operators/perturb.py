"""Controlled cell corruption with a log of every change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant.functions.ids import shuffle_hash

# Kinds of corruption and the spellings of a status.
KINDS = ["text_formatting", "numeric_drift", "missing", "status_variant"]
STATUS_VARIANTS = {
    "Completed": ["Complete", "COMPLETED", "completed"],
    "In Progress": ["In Progress", "IN PROGRESS", "in progress"],
    "Pending": ["Pending", "PENDING", "pending"],
    "On Hold": ["On Hold", "ON HOLD", "on hold"],
}
_SPAN = 65536  # four hex digits per column


def _digits(id_column: str, seed: int, i: int) -> Column:
    """Draw of the i-th column: four hex digits of a digest, which serves eight columns."""
    digest = shuffle_hash(F.col(id_column), seed + 2 * (i // 8))
    return F.conv(F.substring(digest, 4 * (i % 8) + 1, 4), 16, 10).cast("int")


def _variant(value: Column, draw: Column) -> Column:
    result = value
    for status, spellings in STATUS_VARIANTS.items():
        pick = F.get(F.array(*[F.lit(s) for s in spellings]), draw % len(spellings))
        result = F.when(value == status, pick).otherwise(result)
    return result


def corruption_plan(df: DataFrame, id_column: str, columns: list[str], rate: float = 0.05, seed: int = 42) -> DataFrame:
    """Rows with, per column, the drawn kind (null for most cells) and the new value.

    ``rate`` is the expected number of corrupted cells per row, spread over all ``columns``.
    Digests of the row id supply all draws, so the result does not depend on partitioning.
    """
    drawn = df
    cut = int(rate / len(columns) * _SPAN)
    for i, c in enumerate(columns):
        draw = _digits(id_column, seed + 1, i)
        kind = F.get(F.array(*[F.lit(k) for k in KINDS]), draw % 4)
        drawn = drawn.withColumn(f"_kind_{c}", F.when(_digits(id_column, seed, i) < cut, kind))
        numeric = dict(df.dtypes)[c] in ("double", "float", "int", "bigint")
        rest = F.floor(draw / 4)
        if numeric:
            old = F.col(c).cast("double")
            drift = old * (0.8 + 0.4 * (rest % 1000) / 1000)
            new = (F.when(F.col(f"_kind_{c}") == "numeric_drift", drift)
                   .when(F.col(f"_kind_{c}") == "missing", F.lit(None)).otherwise(old))
        else:
            old = F.col(c).cast("string")
            cased = F.when(rest % 2 == 0, F.upper(old)).otherwise(F.lower(old))
            new = (F.when(F.col(f"_kind_{c}") == "text_formatting", cased)
                   .when(F.col(f"_kind_{c}") == "missing", F.lit(None))
                   .when(F.col(f"_kind_{c}") == "status_variant", _variant(old, rest.cast("int"))).otherwise(old))
        drawn = drawn.withColumn(f"_new_{c}", new)
    return drawn


def corrupted(plan: DataFrame, columns: list[str]) -> DataFrame:
    """The table with the drawn changes applied."""
    rest = [c for c in plan.columns if not c.startswith("_") and c not in columns]
    return plan.select(*rest, *[F.col(f"_new_{c}").alias(c) for c in columns])


def corruption_log(plan: DataFrame, source: str, id_column: str, columns: list[str]) -> DataFrame:
    """One row per drawn cell: field, old and new value, kind."""
    cells = F.array(*[F.when(F.col(f"_kind_{c}").isNotNull(), F.struct(
        F.lit(c).alias("field"), F.col(c).cast("string").alias("old_value"),
        F.col(f"_new_{c}").cast("string").alias("new_value"), F.col(f"_kind_{c}").alias("corruption_type")))
        for c in columns])
    rows = plan.select(F.col(id_column).alias("record_id"), F.explode(F.array_compact(cells)).alias("c"))
    return rows.select(F.lit(source).alias("source"), "record_id", "c.*")


def effective_corruption(log: DataFrame) -> DataFrame:
    """Logged operations per kind and how many of them changed nothing."""
    return log.groupBy("source", "corruption_type").agg(
        F.count("*").alias("operations"),
        F.count_if(F.col("old_value").eqNullSafe(F.col("new_value"))).alias("no_ops"))
