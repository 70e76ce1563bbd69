"""File sources and sinks, ingest, warehouse tables.

Each query writes tables derived from the given data with Spark and reads them back through the
operator under test.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accordant import policy, schemas
from accordant.operators import cases, explain
from accordant.plans import evidence_queries
from accordant.plans.domain import AS_OF
from accordant.plans.match_queries import SIMULATED
from accordant.plans.registry import query
from accordant.session import scratch_path
from accordant.session import stored as materialize
from accordant.sources import files, warehouse


def _at():
    return F.lit(AS_OF).cast("timestamp")


def _export(d, names) -> dict[str, str]:
    root = scratch_path(d.spark, "exports")
    paths = {}
    for name in names:
        paths[name] = f"{root}/{name}.csv"
        files.write_csv(d.sources[name].drop("ord"), paths[name])
    return paths


@query("s1_csv_scan", """SELECT project_id, customer_name, installer, system_size_kw, address, city, state, status, STRFTIME(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM crm""")
def csv_scan(d):
    df = files.read_csv(d.spark, _export(d, ["crm"])["crm"], schemas.SOURCE_FILES["crm"])
    return df.drop("_corrupt_record").withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@query("s1_quoted_csv", """
    SELECT project_id, CASE WHEN ord % 3 = 0 THEN customer_name || chr(10) || '"' || city || '", ' || state ELSE customer_name END AS customer_name,
      CASE WHEN ord % 4 = 0 THEN '"' || installer || '",' || chr(10) || chr(10) ELSE installer END AS installer, system_size_kw, address || ', ' || city AS address
    FROM crm""")
def quoted_csv(d):
    """Line breaks, quotes and separators inside fields."""
    path = f"{scratch_path(d.spark, 'exports')}/crm.csv"
    files.write_csv(d.crm.select(
        "project_id", F.when(F.col("ord") % 3 == 0, F.concat("customer_name", F.lit('\n"'), "city", F.lit('", '), "state")).otherwise(F.col("customer_name")).alias("customer_name"),
        F.when(F.col("ord") % 4 == 0, F.concat(F.lit('"'), "installer", F.lit('",\n\n'))).otherwise(F.col("installer")).alias("installer"),
        "system_size_kw", F.concat("address", F.lit(", "), "city").alias("address")), path)
    return files.read_csv(d.spark, path, "project_id string, customer_name string, installer string, system_size_kw double, address string").drop("_corrupt_record")


@query("s1_reordered_csv", """SELECT project_id, customer_name, installer, system_size_kw, NULL::VARCHAR AS address, city, state, status, STRFTIME(updated_at, '%Y-%m-%d %H:%M:%S') AS updated_at FROM crm""")
def reordered_csv(d):
    """A file with its columns in another order, one too many and one missing."""
    path = f"{scratch_path(d.spark, 'exports')}/crm.csv"
    df = d.crm.drop("ord", "address").withColumn("remark", F.lit("x"))
    files.write_csv(df.select(*reversed(df.columns)), path)
    read = files.read_csv(d.spark, path, schemas.SOURCE_FILES["crm"])
    return read.drop("_corrupt_record").withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss"))


@query("s13_malformed_rows", f"""
    SELECT 'crm' AS source_system, COUNT(*) AS rows_processed, COUNT(*) FILTER (WHERE ord % 7 <> 0) AS rows_successful, COUNT(*) FILTER (WHERE ord % 7 = 0) AS rows_failed FROM crm""")
def malformed_rows(d):
    """Every seventh line has a text for its capacity: it is processed, and fails."""
    path = f"{scratch_path(d.spark, 'exports')}/crm.csv"
    size = F.when(F.col("ord") % 7 == 0, F.lit("abc")).otherwise(F.col("system_size_kw").cast("string"))
    files.write_csv(d.crm.withColumn("system_size_kw", size).drop("ord"), path)
    records, _ = files.ingest(d.spark, {"crm": path}, _at())
    runs = files.ingestion_runs(records, "run", _at(), _at())
    return runs.select("source_system", "rows_processed", "rows_successful", "rows_failed")


@query("s2_capped_scan", "SELECT LEAST(COUNT(*), 1000) AS rows, 8::BIGINT AS columns FROM crm")
def capped_scan(d):
    """The row cap is the feature: a look at the first rows of a file."""
    df = files.read_csv(d.spark, _export(d, ["crm"])["crm"], schemas.SOURCE_FILES["crm"], limit=1000)
    return df.agg(F.count("*").alias("rows"), F.lit(len(df.columns) - 2).cast("long").alias("columns"))


@query("s3_label_windows", """SELECT series, STRFTIME("start", '%Y-%m-%d %H:%M:%S') AS start, STRFTIME("end", '%Y-%m-%d %H:%M:%S') AS "end" FROM windows""")
def label_windows(d):
    path = scratch_path(d.spark, "windows")
    stamp = "yyyy-MM-dd HH:mm:ss"
    span = F.array(F.date_format("start", stamp), F.date_format("end", stamp))
    per_series = d.windows.groupBy("series").agg(F.collect_list(span).alias("spans"))
    nested = per_series.select(F.to_json(F.create_map("series", "spans")).alias("value"))
    nested.write.text(path)
    read = files.read_label_windows(d.spark, path)
    return read.select("series", F.date_format("start", stamp).alias("start"), F.date_format("end", stamp).alias("end"))


@query("s4_s11_latest_case_lines", "SELECT case_id, status FROM cases")
def latest_case_lines(d):
    """Two appended versions of every case: the opening line and the current one."""
    path = scratch_path(d.spark, "cases")
    line = d.cases.select("case_id", "status", F.col("created_at").cast("string"), F.col("resolved_at").cast("string"), F.lit(2).alias("line"))
    opening = line.withColumns({"status": F.lit("NEW"), "line": F.lit(1)})
    files.write_jsonl(line, path)
    files.write_jsonl(opening, path, "append")
    return files.read_latest_jsonl(d.spark, path, schemas.CASE_FILE + ", line int", "case_id", "line").select("case_id", "status")


@query("s5_corruption_log_file", evidence_queries.LOG_SQL)
def corruption_log_file(d):
    path = scratch_path(d.spark, "log")
    files.write_jsonl(evidence_queries.corruption_log(d), path)
    return d.spark.read.schema("source string, record_id string, field string, old_value string, new_value string, corruption_type string").json(path)


@query("s6_canonical_records", f"""
    SELECT 'crm' AS source_system, project_id AS source_record_id, project_id AS master_project_id, 'crm.csv' AS raw_file_reference, '{AS_OF}' AS ingested_at FROM crm""")
def canonical_records(d):
    rows = files.canonical(d.crm, "crm", "project_id", "crm.csv", _at())
    return rows.withColumn("ingested_at", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss"))


@query("s7_c9_file_validation", """
    SELECT 'crm' AS source_system, '' AS problems, COUNT(*) AS rows FROM crm UNION ALL SELECT 'erp', 'Missing required columns: customer', COUNT(*) FROM erp
    UNION ALL SELECT 'partner', 'Unsupported file format: .dat', COUNT(*) FROM partner""")
def file_validation(d):
    """A complete file, one without a required column, and one of an unsupported kind."""
    root = scratch_path(d.spark, "exports")
    files.write_csv(d.crm.drop("ord"), f"{root}/crm.csv")
    files.write_csv(d.erp.drop("ord", "customer"), f"{root}/erp.csv")
    files.write_csv(d.partner.drop("ord"), f"{root}/partner.dat")
    found = [(s, "; ".join(files.validate_file(d.spark, f"{root}/{f}", policy.REQUIRED_COLUMNS[s])))
             for s, f in (("crm", "crm.csv"), ("erp", "erp.csv"), ("partner", "partner.dat"))]
    counts = d.records.where("source_system <> 'document'").groupBy("source_system").agg(F.count("*").alias("rows"))
    return counts.join(d.spark.createDataFrame(found, "source_system string, problems string"), "source_system")


@query("s8_u1_multi_source_ingest", "SELECT source_system, COUNT(*) AS records, COUNT(record_id) AS with_id FROM records WHERE source_system <> 'partner' GROUP BY 1")
def multi_source_ingest(d):
    paths = {**_export(d, ["crm", "erp", "document"]), "partner": "partner.xlsx"}
    records, _ = files.ingest(d.spark, paths, _at())
    return records.groupBy("source_system").agg(F.count("*").alias("records"), F.count("source_record_id").alias("with_id"))


@query("s9_table_sink", "SELECT status, COUNT(*) AS projects, ROUND(SUM(system_size_kw), 4) AS size FROM master GROUP BY status")
def table_sink(d):
    path = scratch_path(d.spark, "master")
    files.write_table(d.master, path)
    return d.spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("projects"), F.round(F.sum("system_size_kw"), 4).alias("size"))


@query("s10_handoff_file", "SELECT field, authority_source, COUNT(*) AS corrections FROM corrections GROUP BY ALL")
def handoff_file(d):
    path = scratch_path(d.spark, "handoff")
    files.append_handoff(cases.handoff(d.cases, d.corrections, _at()), path)
    read = d.spark.read.option("header", True).csv(path)
    return read.groupBy("field", "authority_source").agg(F.count("*").alias("corrections"))


def _content(*columns: str) -> str:
    """Order-free digest of columns: the sum of a part of each row's MD5."""
    return f"SUM(CAST('0x' || SUBSTR(MD5(CONCAT_WS('|', {', '.join(columns)})), 1, 8) AS BIGINT))::BIGINT"


WAREHOUSE_ROWS = {
    "projects": ("master", ["project_id", "customer_name", "installer", "CAST(CAST(system_size_kw AS DECIMAL(10,2)) AS VARCHAR)", "address", "city", "state", "postcode", "status"]),
    "source_records": ("records", ["source_system", "record_id"]),
    "entity_matches": ("pairs", ["pair_id", "source_a", "source_b", "record_a_id", "record_b_id", "CAST(label AS VARCHAR)"]),
    "model_predictions": ("explained", ["'ai_reviewer'", "'v1.0'", "classification", "'0.5000'"]),
    "reviewer_feedback": (SIMULATED, ["pair_id", "decision", "reason", "'v1.0'"]),
}


@query("s12_warehouse_refresh", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS rows, {_content(*columns)} AS content FROM {source}" for name, (source, columns) in WAREHOUSE_ROWS.items()))
def warehouse_refresh(d):
    """Five tables, two of them refreshed a second time."""
    root = scratch_path(d.spark, "warehouse")
    d.neighbours = materialize(d.neighbours)  # two tables are made from it
    records = d.records.select("source_system", F.col("record_id").alias("source_record_id"), F.col("record_id").alias("master_project_id"))
    predictions = d.explained.select(F.lit("ai_reviewer").alias("model_name"), F.lit("v1.0").alias("model_version"), F.col("classification").alias("prediction"), F.lit(0.5).alias("probability"))
    feedback = explain.simulate_decisions(d.explained, AS_OF).select("pair_id", F.col("decision").alias("reviewer_decision"), F.col("reason").alias("reviewer_reason"), "model_version")
    warehouse.refresh({"projects": d.master, "source_records": records.limit(0), "entity_matches": d.pairs, "model_predictions": predictions, "reviewer_feedback": feedback.limit(0)}, root)
    warehouse.refresh({"source_records": records, "reviewer_feedback": feedback}, root)

    def stored(name, *columns):
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *columns)), 1, 8), 16, 10).cast("long")
        return warehouse.read(d.spark, root, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"), F.sum(digest).alias("content"))

    return reduce(DataFrame.unionByName, [
        stored("projects", "project_id", "customer_name", "installer", "system_size_kw", "address", "city", "state", "postcode", "status"),
        stored("source_records", "source_system", "source_record_id"),
        stored("entity_matches", "pair_id", "source_a", "source_b", "record_a_id", "record_b_id", "label"),
        stored("model_predictions", "model_name", "model_version", "prediction", "probability"),
        stored("reviewer_feedback", "pair_id", "reviewer_decision", "reviewer_reason", "model_version")])


@query("s13_ingestion_runs", """
    SELECT 'run-1' AS run_id, source_system, source_system || '.csv' AS file_name, COUNT(*) AS rows_processed, COUNT(record_id) AS rows_successful, COUNT(*) - COUNT(record_id) AS rows_failed,
      CASE WHEN COUNT(*) = COUNT(record_id) THEN 'COMPLETED' ELSE 'COMPLETED_WITH_ERRORS' END AS status FROM records WHERE source_system IN ('crm', 'erp') GROUP BY source_system""")
def ingestion_runs(d):
    records, _ = files.ingest(d.spark, _export(d, ["crm", "erp"]), _at())
    return files.ingestion_runs(records, "run-1", _at(), _at()).drop("started_at", "completed_at")


@query("s13_ledger_of_the_write", """
    SELECT 'run-2' AS run_id, source_system, source_system || '.csv' AS file_name, COUNT(*) AS rows_processed, COUNT(record_id) AS rows_successful, COUNT(*) - COUNT(record_id) AS rows_failed,
      CASE WHEN COUNT(*) = COUNT(record_id) THEN 'COMPLETED' ELSE 'COMPLETED_WITH_ERRORS' END AS status, (SELECT COUNT(record_id) FROM records WHERE source_system IN ('crm', 'erp')) AS written
    FROM records WHERE source_system IN ('crm', 'erp') GROUP BY source_system""")
def ledger_of_the_write(d):
    """The ledger counted while the records are written, in one scan of the exports."""
    records, _ = files.ingest(d.spark, _export(d, ["crm", "erp"]), _at())
    path = scratch_path(d.spark, "ingested")
    ledger = files.write_with_ledger(records, path, "run-2", _at(), _at(), {"crm": "crm.csv", "erp": "erp.csv"})
    return ledger.drop("started_at", "completed_at").withColumn("written", F.lit(d.spark.read.parquet(path).count()))


@query("s14_exported_view", "SELECT pair_id, route, match_probability FROM queue WHERE route = 'MANUAL_REVIEW'")
def exported_view(d):
    from accordant.operators.queue import queue_view

    path = scratch_path(d.spark, "view")
    files.write_csv(queue_view(d.queue, "Needs review", limit=None).select("pair_id", "route", "match_probability"), path)
    return files.read_csv(d.spark, path, "pair_id string, route string, match_probability double").drop("_corrupt_record")


@query("s7_mixed_timestamps", "SELECT COUNT(*) AS readings, STRFTIME(MIN(ts), '%Y-%m-%d %H:%M') AS first, STRFTIME(MAX(ts), '%Y-%m-%d %H:%M') AS last FROM events")
def mixed_timestamps(d):
    """Readings whose timestamps come in two notations."""
    from accordant.functions.times import parse_timestamp

    path = scratch_path(d.spark, "readings")
    late = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("user_id") % 2 == 0, F.date_format("ts", "dd-MM-yyyy HH:mm")).otherwise(late)
    files.write_csv(d.table("events").select("event_id", text.alias("DATE_TIME"), "value"), path)
    read = files.read_csv(d.spark, path, "event_id long, DATE_TIME string, value double")
    parsed = read.select(F.date_format(parse_timestamp(F.col("DATE_TIME")), "yyyy-MM-dd HH:mm").alias("t"))
    return parsed.agg(F.count("t").alias("readings"), F.min("t").alias("first"), F.max("t").alias("last"))
