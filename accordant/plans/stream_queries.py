"""Streaming forms, run over the given tables until they are drained and compared with batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from accordant import policy
from accordant.operators import anomaly
from accordant.plans.domain import AS_OF, Domain
from accordant.plans.registry import query
from accordant.session import scratch_path, stored
from accordant.sources import files
from accordant.streaming import case_replay, jobs

#: Files, and so micro-batches, in which events arrive.
ARRIVALS = 6
OPEN = ", ".join(f"'{s}'" for s in policy.OPEN_STATUSES)


class StreamDomain(Domain):
    """The same derivations with ``events`` read as a stream."""

    def table(self, name):
        if name != "events":
            return super().table(name)
        schema = self.spark.read.parquet(f"{self.path}/events.parquet").schema
        raw = self.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(self.path)
        return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def _drain(d, df, mode="append"):
    out, checkpoint = scratch_path(d.spark, "stream"), scratch_path(d.spark, "progress")
    jobs.run_to_files(df, out, checkpoint, mode)
    return d.spark.read.parquet(f"{out}/b*")


@query("g1_watched_folder", """
    SELECT 'records' AS kind, record_id AS id, 1::BIGINT AS rows FROM records WHERE source_system = 'erp' AND record_id IS NOT NULL
    UNION ALL SELECT 'quarantine', NULL, COUNT(*) - COUNT(record_id) FROM records WHERE source_system = 'erp'
    UNION ALL SELECT 'ledger', 'COMPLETED_WITH_ERRORS', COUNT(*) FROM records WHERE source_system = 'erp'
    UNION ALL SELECT 'ledger', 'FAILED', 0""")
def watched_folder(d):
    """Exports whose customers hold line breaks, the same files again under other names, and an empty file."""
    root = scratch_path(d.spark, "watched")
    one = Domain(d.spark, d.path)
    one.placed = d.placed.repartition(1)  # one file is written by one task, to which only what its lines are made of is moved
    erp = one.erp.withColumn("customer", F.concat(F.lit('"Dear"\n'), "customer", F.lit(", "))).drop("ord")
    files.write_csv(erp, f"{root}/in/first.csv")
    folder = f"{root}/in/*.csv"

    def run():
        jobs.watch_exports(d.spark, folder, "erp", f"{root}/out", f"{root}/progress", F.lit(AS_OF).cast("timestamp")).awaitTermination()

    run()
    files.write_csv(erp, f"{root}/in/second.csv")
    d.spark.createDataFrame([], "value string").repartition(1).write.csv(f"{root}/in/third.csv")
    run()
    read = d.spark.read.parquet
    records = read(f"{root}/out/records/batch=*").select(F.lit("records").alias("kind"), F.col("source_record_id").alias("id"), F.lit(1).cast("long").alias("rows"))
    quarantine = read(f"{root}/out/quarantine/batch=0").agg(F.lit("quarantine").alias("kind"), F.lit(None).cast("string").alias("id"), F.count("*").alias("rows"))
    ledger = read(f"{root}/out/ledger/batch=*").dropDuplicates(["rows_processed", "status"]).select(
        F.lit("ledger").alias("kind"), F.regexp_extract("status", "^[A-Z_]+", 0).alias("id"), F.col("rows_processed").alias("rows"))
    return records.unionByName(quarantine).unionByName(ledger)


@query("g2_idempotent_records", """
    SELECT event_type AS source_system, user_id::VARCHAR AS source_record_id, STRFTIME(MIN(ts), '%Y-%m-%d %H:%M:%S') AS first_seen FROM events GROUP BY 1, 2""")
def idempotent_records(d):
    """Of repeated (type, user) arrivals in several micro-batches, the first one stays."""
    folder = scratch_path(d.spark, "arrivals")
    rows = d.table("events").select(F.col("event_type").alias("source_system"), F.col("user_id").cast("string").alias("source_record_id"), F.col("ts").alias("ingested_at"))
    low, high = rows.agg(F.min(F.unix_seconds("ingested_at")), F.max(F.unix_seconds("ingested_at"))).first()
    part = F.floor((F.unix_seconds("ingested_at") - low) * 3 / (high - low + 1))
    for k in range(3):
        rows.where(part == k).coalesce(1).write.mode("append").parquet(folder)
    arriving = d.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    out = scratch_path(d.spark, "stream")
    jobs.run_to_unique(arriving, ["source_system", "source_record_id"], out, scratch_path(d.spark, "progress"))
    return d.spark.read.parquet(out).select("source_system", "source_record_id", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("first_seen"))


def _case_stream(d):
    """Case updates over the events in several files, one to a micro-batch, in an order of arrival that differs from that of the events.

    An event arrives up to 50 minutes after its time, and the files follow the arrival.
    """
    folder = scratch_path(d.spark, "arrivals")
    events = d.case_events.select("case_id", "at", "seq", "to", "implicit", F.date_trunc("day", "at").alias("created_at"))
    arrival = F.unix_seconds("at") + F.crc32(F.col("seq").cast("string")) % 3000
    arriving = stored(events.withColumn("arrival", arrival))
    low, high = arriving.agg(F.min("arrival"), F.max("arrival")).first()
    part = F.least(F.floor((F.col("arrival") - low) * ARRIVALS / (high - low + 1)), F.lit(ARRIVALS - 1))
    for k in range(ARRIVALS):
        arriving.where(part == k).drop("arrival").repartition(1).write.mode("append").parquet(folder)
    stream = d.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return _drain(d, case_replay.case_updates(stream), "update")


@query("g3_live_case_states", "SELECT case_id, status, CAST(history_rows - 1 AS INTEGER) AS moves FROM cases")
def live_case_states(d):
    states = _case_stream(d).where("kind = 'state'")
    latest = states.groupBy("case_id").agg(F.max_by(F.struct("status", "moves"), "batch").alias("s"))
    return latest.select("case_id", "s.status", "s.moves")


@query("g4_sla_alerts", f"""
    SELECT case_id, COALESCE(MAX_BY("to", n) FILTER (WHERE outcome = 'accepted' AND "at" <= due),  'NEW') AS status
    FROM (SELECT a.*, o.created_at + INTERVAL 72 HOUR AS due, (SELECT DATE_TRUNC('minute', MAX(ts) - INTERVAL 1 HOUR) FROM events) AS settled
          FROM annotated a JOIN opened o ON o.case_id = a.case_id)
    WHERE due < settled AND "at" < settled GROUP BY case_id
    HAVING COALESCE(MAX_BY("to", n) FILTER (WHERE outcome = 'accepted' AND "at" <= due), 'NEW') IN ({OPEN})
    UNION ALL
    SELECT case_id, MIN_BY("to", n) FILTER (WHERE outcome = 'accepted' AND "at" > due AND "to" IN ({OPEN})) AS status
    FROM (SELECT a.*, o.created_at + INTERVAL 72 HOUR AS due, (SELECT DATE_TRUNC('minute', MAX(ts) - INTERVAL 1 HOUR) FROM events) AS settled
          FROM annotated a JOIN opened o ON o.case_id = a.case_id)
    WHERE due < settled AND "at" < settled GROUP BY case_id
    HAVING COALESCE(MAX_BY("to", n) FILTER (WHERE outcome = 'accepted' AND "at" <= due), 'NEW') NOT IN ({OPEN})
      AND COUNT(*) FILTER (WHERE outcome = 'accepted' AND "at" > due AND "to" IN ({OPEN})) > 0""")
def sla_alerts(d):
    """Cases open at their deadline, or reopened after it, as far as the watermark has come."""
    return _case_stream(d).where("kind = 'sla_breach'").select("case_id", "status")


@query("g5_daily_reason_counts", """
    SELECT STRFTIME(DATE_TRUNC('day', "at"), '%Y-%m-%d') AS day, COALESCE(reason_code, 'OTHER') AS reason_code, COUNT(*) AS decisions FROM decisions GROUP BY ALL""")
def daily_reason_counts(d):
    """All days, open ones included: every batch updates the counts of its days, and the last one holds."""
    counts = _drain(d, jobs.daily_reason_counts(StreamDomain(d.spark, d.path).decisions), "update")
    latest = counts.groupBy("day", "reason_code").agg(F.max_by("decisions", "batch").alias("decisions"))
    return latest.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "reason_code", "decisions")


@query("g6_flagged_stream", "SELECT point_id, iqr, zscore, percentile FROM flags")
def flagged_stream(d):
    limits = anomaly.fences(d.telemetry, ["series"], "value")
    arriving = StreamDomain(d.spark, d.path).telemetry
    return _drain(d, jobs.flag_stream(arriving, limits, ["series"], "value")).select("point_id", "iqr", "zscore", "percentile")
