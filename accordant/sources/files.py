"""File sources and sinks, validation before ingest and the canonical projection."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from accordant import policy, schemas
from accordant.functions.numbers import as_double
from accordant.sources.records import csv_records

CANONICAL = ["source_system", "source_record_id", "master_project_id", "raw_file_reference", "ingested_at"]
SUPPORTED = [".csv"]


#: Quotes are doubled inside quoted fields, in what is read and what is written.
_FORM = {"quote": '"', "escape": '"'}


def header_of(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Column names in the first record of a file, or of one file of a folder."""
    return spark.read.options(**_FORM).option("header", True).option("multiLine", True).csv(path).columns


def _parsed(spark: SparkSession, path: str | list[str], header: list[str], names: list[str]) -> DataFrame:
    """The records of the files as texts in columns ``names``, and ``_file``; a file with another header is an error."""
    schema = ", ".join(f"`{c}` string" for c in [*names, "_corrupt_record"])
    fields = F.from_csv("record", schema, {**_FORM, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    rows = csv_records(spark, path).select("name", "first", fields.alias("r"))
    lower = [c.lower() for c in header]
    same = reduce(lambda x, y: x & y, [F.col(f"r.`{n}`").eqNullSafe(c) for n, c in zip(names, header, strict=True) if lower.count(c.lower()) == 1], F.lit(True))
    refused = F.raise_error(F.lit(f"files below {path} have different headers")).cast("boolean")
    return rows.where(F.when(F.col("first") & ~(same & F.col("r._corrupt_record").isNull()), refused).otherwise(~F.col("first"))).select(
        "r.*", F.col("name").alias("_file"))


def read_csv(spark: SparkSession, path: str | list[str], schema: str, limit: int | None = None, file_column: str | None = None) -> DataFrame:
    """CSV with header under a declared schema; unreadable records are kept in ``_corrupt_record``.

    Quoted fields may hold line breaks, separators and doubled quotes; large files are read by many tasks
    all the same. Columns are bound by name: the header gives their order, columns that are not declared are
    left out, declared ones that are missing are null. Files of a folder whose headers differ are an error.
    With a ``limit``, files are read from their start as far as needed. ``file_column`` adds the name of the file.
    """
    declared = StructType.fromDDL(schema)
    header = header_of(spark, path)
    names = [f"c{i}" for i in range(len(header))]
    if limit is None:
        raw = _parsed(spark, path, header, names)
    else:
        in_file = StructType([StructField(c, StringType()) for c in [*names, "_corrupt_record"]])
        raw = (spark.read.schema(in_file).options(**_FORM).option("header", True).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", "_corrupt_record").option("multiLine", True).csv(path).withColumn("_file", F.col("_metadata.file_name")))
    # values are read as texts and cast here, so that an unreadable one shows whichever columns are used later
    held = dict(zip(header, names))
    typed = {f.name: as_double(F.trim(held[f.name])) if f.dataType.typeName() == "double" else F.col(held[f.name]).try_cast(f.dataType)
             for f in declared if f.name in held}
    bad = reduce(lambda x, y: x | y, [F.col(held[n]).isNotNull() & v.isNull() for n, v in typed.items()], F.lit(False))
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in names])
    df = raw.select(*[(typed[f.name] if f.name in typed else F.lit(None).cast(f.dataType)).alias(f.name) for f in declared],
                    F.coalesce(F.col("_corrupt_record"), F.when(bad, line)).alias("_corrupt_record"),
                    *([F.col("_file").alias(file_column)] if file_column else []))
    return df if limit is None else df.limit(limit)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**_FORM, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).option("header", True).csv(path)


def read_latest_jsonl(spark: SparkSession, path: str, schema: str, key: str, order: str) -> DataFrame:
    """JSON lines where the last entry per key counts; ``order`` tells which entry is later."""
    df = spark.read.schema(schema).json(path).where(F.col(key).isNotNull())
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(key, "_r.*")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def append_handoff(rows: DataFrame, path: str) -> None:
    """Append correction rows to the handoff export, one folder per sync date."""
    dated = rows.withColumn("sync_date", F.to_date("synced_at"))
    dated.write.mode("append").option("header", True).partitionBy("sync_date").csv(path)


def read_label_windows(spark: SparkSession, path: str) -> DataFrame:
    """Nested JSON {series: [[start, end], ...]} as rows (series, start, end)."""
    text = spark.read.option("wholetext", True).text(path)
    parsed = text.select(F.from_json("value", "map<string,array<array<string>>>").alias("m"))
    series = parsed.select(F.explode("m").alias("series", "spans"))
    return series.select("series", F.explode("spans").alias("w")).select(
        "series", F.element_at("w", 1).cast("timestamp").alias("start"), F.element_at("w", 2).cast("timestamp").alias("end"))


def empty_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files of no bytes below ``folder`` (a path or pattern), which Spark's readers pass over."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in system.globStatus(path) or []:
        for file in system.listStatus(status.getPath()) if status.isDirectory() else [status]:
            name = file.getPath().getName()
            if file.isFile() and file.getLen() == 0 and name[0] not in "_.":
                found.append(name)
    return sorted(found)


def validate_file(spark: SparkSession, path: str, required: list[str]) -> list[str]:
    """Problems that keep a file out of the ingest (empty list when there are none).

    Reads the header only; folders written by Spark count as files of their extension.
    """
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    if extension not in SUPPORTED:
        return [f"Unsupported file format: {extension}"]
    try:
        columns = header_of(spark, path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return [f"File not found: {path}"]
        return [f"Error reading file: {type(error).__name__}"]
    missing = [c for c in required if c not in columns]
    return [f"Missing required columns: {', '.join(missing)}"] if missing else []


def canonical(df: DataFrame, source: str, id_column: str, file_name: str | Column, at: Column | None = None) -> DataFrame:
    """Provenance rows; a missing id stays null, so that it can be quarantined, and so does the id of an
    unreadable line (``_corrupt_record``)."""
    record = F.col(id_column).cast("string")
    if "_corrupt_record" in df.columns:
        record = F.when(F.col("_corrupt_record").isNull(), record)
    return df.select(F.lit(source).alias("source_system"), record.alias("source_record_id"),
                     record.alias("master_project_id"), (F.lit(file_name) if isinstance(file_name, str) else file_name).alias("raw_file_reference"),
                     (F.current_timestamp() if at is None else at).alias("ingested_at"))


def ingest(spark: SparkSession, files: dict[str, str], at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Validate and unite the given source files; returns (canonical records, validation ledger).

    The loop runs over source configurations while the plan is built, never over data.
    """
    accepted, ledger = [], []
    for source, path in files.items():
        errors = validate_file(spark, path, policy.REQUIRED_COLUMNS[source])
        ledger.append((source, os.path.basename(path), not errors, "; ".join(errors)))
        if not errors:
            df = read_csv(spark, path, schemas.SOURCE_FILES[source])
            accepted.append(canonical(df, source, policy.ID_COLUMN[source], os.path.basename(path), at))
    checks = spark.createDataFrame(ledger, "source_system string, file_name string, passed boolean, details string")
    if not accepted:
        raise ValueError("no source passed validation: " + "; ".join(row[3] for row in ledger))
    return reduce(DataFrame.unionByName, accepted), checks


def ingestion_runs(records: DataFrame, run_id: str, started: Column, completed: Column) -> DataFrame:
    """Run ledger per source: rows read, usable and without an id."""
    ok = F.col("source_record_id").isNotNull()
    return records.groupBy("source_system", F.col("raw_file_reference").alias("file_name")).agg(
        F.count("*").alias("rows_processed"), F.count_if(ok).alias("rows_successful"), F.count_if(~ok).alias("rows_failed")
    ).select(F.lit(run_id).alias("run_id"), "source_system", "file_name", "rows_processed", "rows_successful", "rows_failed",
             started.alias("started_at"), completed.alias("completed_at"),
             F.when(F.col("rows_failed") == 0, "COMPLETED").otherwise("COMPLETED_WITH_ERRORS").alias("status"))


def write_with_ledger(records: DataFrame, path: str, run_id: str, started: Column, completed: Column, sources: dict[str, str]) -> DataFrame:
    """Write the usable canonical records, and return the run ledger counted by the pass that wrote them.

    ``sources``: file name by source, a few of them. Unusable records are counted and left out.
    """
    ok = F.col("source_record_id").isNotNull()
    names = list(sources)
    counts = Observation()
    of = [F.col("source_system") == s for s in names]
    metrics = [m for i, mine in enumerate(of) for m in (F.count_if(mine).alias(f"read{i}"), F.count_if(mine & ok).alias(f"kept{i}"))]
    records.observe(counts, *metrics).where(ok).write.mode("overwrite").parquet(path)
    found = counts.get
    rows = [(run_id, s, sources[s], found[f"read{i}"], found[f"kept{i}"], found[f"read{i}"] - found[f"kept{i}"]) for i, s in enumerate(names)]
    ledger = records.sparkSession.createDataFrame(rows, "run_id string, source_system string, file_name string, rows_processed long, rows_successful long, rows_failed long")
    return ledger.select("*", started.alias("started_at"), completed.alias("completed_at"),
                         F.when(F.col("rows_failed") == 0, "COMPLETED").otherwise("COMPLETED_WITH_ERRORS").alias("status"))
