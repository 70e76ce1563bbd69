"""Warehouse tables: conform to the declared columns, refresh, read back."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accordant import schemas

# Tables that are usually read by one source or day are laid out that way.
PARTITIONED = {"source_records": ["source_system"], "anomalies": ["source_system"], "validation_results": ["source_system"]}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Declared columns in order, cast to their types; columns the input lacks become null."""
    return df.select(*[
        (F.col(name) if name in df.columns else F.lit(None)).cast("string" if kind.startswith("varchar") else kind).alias(name)
        for name, kind in schemas.columns(table)])


def _manifests(spark: SparkSession, root: str) -> list:
    try:
        return spark.read.schema("version long, name string, path string").option("recursiveFileLookup", True).json(f"{root}/commits").collect()  # a row for a table and version
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return []


def _current(spark: SparkSession, root: str) -> tuple[int, dict[str, str]]:
    """The last committed version and where its tables are."""
    rows = _manifests(spark, root)
    version = max((r["version"] for r in rows), default=-1)
    return version, {r["name"]: r["path"] for r in rows if r["version"] == version}


def refresh(tables: dict[str, DataFrame], root: str) -> int:
    """Full refresh of the given tables, of all or of none; returns the version that is current then.

    Every table is written to a place of its own. The list of tables of the new version, with those that
    were not given as they were, is written last in one folder; until then, and if anything fails, readers see the
    version before. Of two refreshes at once, the second one fails.
    """
    spark = next(iter(tables.values())).sparkSession
    version, current = _current(spark, root)
    version += 1
    for name, df in tables.items():
        current[name] = f"tables/{name}-{version}-{uuid.uuid4().hex}"
        writer = conform(df, name).write.option("compression", "zstd")  # ids are digests, of which others leave the text as it is
        if name in PARTITIONED:
            writer = writer.partitionBy(*PARTITIONED[name])
        writer.parquet(f"{root}/{current[name]}")
    manifest = spark.createDataFrame([(version, name, path) for name, path in current.items()], "version long, name string, path string")
    manifest.coalesce(1).write.mode("errorifexists").json(f"{root}/commits/{version:012d}")
    return version


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current version."""
    path = _current(spark, root)[1][table]
    return spark.read.parquet(f"{root}/{path}").select(*[name for name, _ in schemas.columns(table)])


def refresh_jdbc(df: DataFrame, table: str, url: str, properties: dict[str, str]) -> None:
    """The same refresh into a relational database the caller provides; the table definition stays."""
    conform(df, table).write.mode("overwrite").option("truncate", True).jdbc(url, table, properties=properties)
