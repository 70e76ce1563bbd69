"""Structured Streaming forms of ingest, case state, daily counts and anomaly flags."""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accordant import policy, schemas
from accordant.operators.anomaly import fence_flags
from accordant.sources.files import CANONICAL, canonical, empty_files, header_of, ingestion_runs, read_csv, validate_file


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keyed_state(spark: SparkSession) -> None:
    """Streams started from now on keep their state in RocksDB and store its changes only, batch by batch."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")


class Ingest:
    """Two streams in a row: files to checked records, and those to records that are new."""

    def __init__(self, reading: StreamingQuery, store: Callable[[], StreamingQuery], at_once: bool):
        self.reading, self._store = reading, store
        self.storing = None if at_once else store()

    def awaitTermination(self) -> None:
        self.reading.awaitTermination()
        self.storing = self.storing or self._store()
        self.storing.awaitTermination()

    def stop(self) -> None:
        for stream in (self.reading, self.storing):
            if stream is not None:
                stream.stop()


def watch_exports(spark: SparkSession, folder: str, source: str, out: str, checkpoint: str, at: Column | None = None,
                  max_files: int = 100, **trigger) -> Ingest:
    """Watched folder of source exports -> canonical records, quarantine and a run ledger per file.

    A micro-batch takes at most ``max_files`` files and binds their columns by name. Records without an id
    and unreadable ones are quarantined; a file without the required columns fails as a whole. Files that are
    empty when a micro-batch looks at the folder fail too, in the ledger of batch -1. Every micro-batch replaces its own sub-folders, so a repeated batch writes nothing twice. Records
    that pass are staged, and a second stream keeps the first of each id (``first_of_keys``), so that a batch
    costs what its own files do, however much is stored.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    arriving = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", max_files).load(folder).select("path")
    trigger = trigger or {"availableNow": True}
    keys = ["source_system", "source_record_id"]
    staged = f"{out}/staged"

    def load(batch: DataFrame, batch_id: int) -> None:
        started = F.lit(datetime.now(timezone.utc))
        by_header, failed = defaultdict(list), []
        for path in sorted(r.path for r in batch.distinct().collect()):  # max_files at most
            problems = validate_file(spark, path, policy.REQUIRED_COLUMNS[source])
            if problems:
                failed.append((str(batch_id), source, os.path.basename(path), 0, 0, 0, "FAILED: " + "; ".join(problems)))
            else:
                by_header[tuple(header_of(spark, path))].append(path)
        empty = [("-1", source, name, 0, 0, 0, "FAILED: Empty file") for name in empty_files(spark, folder)]
        ledger, unfilled = (spark.createDataFrame(rows, "run_id string, source_system string, file_name string, rows_processed long, rows_successful long, "
                                                  "rows_failed long, status string").withColumns({"started_at": started, "completed_at": F.current_timestamp()})
                            for rows in (failed, empty))
        unfilled.write.mode("overwrite").parquet(f"{out}/ledger/batch=-1")
        if by_header:
            records = [canonical(read_csv(spark, paths, schemas.SOURCE_FILES[source], file_column="_file"), source, policy.ID_COLUMN[source], F.col("_file"), at)
                       for paths in by_header.values()]
            rows = reduce(DataFrame.unionByName, records).persist()
            usable = F.col("source_record_id").isNotNull()
            rows.where(usable).write.mode("overwrite").parquet(f"{staged}/batch={batch_id}")
            rows.where(~usable).write.mode("overwrite").parquet(f"{out}/quarantine/batch={batch_id}")
            runs = ingestion_runs(rows, str(batch_id), started, F.current_timestamp())
            named = spark.createDataFrame([(os.path.basename(p),) for paths in by_header.values() for p in paths], "file_name string")
            without = named.join(runs, "file_name", "left_anti").select(  # a header and nothing else
                F.lit(str(batch_id)).alias("run_id"), F.lit(source).alias("source_system"), "file_name", *[F.lit(0).cast("long").alias(c) for c in (
                    "rows_processed", "rows_successful", "rows_failed")], started.alias("started_at"), F.current_timestamp().alias("completed_at"), F.lit("COMPLETED").alias("status"))
            ledger = ledger.unionByName(runs).unionByName(without)
            ledger.write.mode("overwrite").parquet(f"{out}/ledger/batch={batch_id}")
            rows.unpersist()
        else:
            ledger.write.mode("overwrite").parquet(f"{out}/ledger/batch={batch_id}")

    def store() -> StreamingQuery:
        fields = ", ".join(f"{c} timestamp" if c == "ingested_at" else f"{c} string" for c in CANONICAL)
        records = spark.readStream.schema(fields).option("cleanSource", "delete").parquet(f"{staged}/batch=*")
        return _store_unique(records, keys, ["raw_file_reference", "ingested_at"], f"{out}/records", f"{checkpoint}/records", trigger)

    reading = arriving.writeStream.foreachBatch(load).option("checkpointLocation", f"{checkpoint}/files").trigger(**trigger).start()
    return Ingest(reading, store, at_once="availableNow" in trigger)


def first_of_keys(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of a stream, the rows whose key has not come before, the first by ``order`` of those of one micro-batch.

    To be run in update mode. The state holds, without a horizon, the row and the micro-batch of each key; a
    key that comes again changes neither and is left out. Null is a key like any other.
    """
    rest = [c for c in rows.columns if c not in keys]
    now = F.current_timestamp()  # the time of the micro-batch, the same when it is repeated
    first = rows.withColumn("_batch", now).groupBy(*keys).agg(
        F.min_by(F.struct("_batch", *rest), F.struct("_batch", *order)).alias("_row"))
    return first.where(F.col("_row._batch") == now).select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest])


def _store_unique(rows: DataFrame, keys: list[str], order: list[str], out: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    keyed_state(rows.sparkSession)
    return (first_of_keys(rows, keys, order).writeStream.outputMode("update").foreachBatch(save)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def idempotent(records: DataFrame, time: str = "ingested_at", delay: str = "1 day") -> DataFrame:
    """Drop repeated (source, record) arrivals within the watermark; ``run_to_unique`` has no horizon."""
    return records.withWatermark(time, delay).dropDuplicatesWithinWatermark(["source_system", "source_record_id"])


def run_to_unique(df: DataFrame, keys: list[str], out: str, checkpoint: str, order: list[str] | None = None) -> None:
    """Store each key once, however late it comes again; of one micro-batch the first row by ``order`` (all other columns by default)."""
    order = order or [c for c in df.columns if c not in keys]
    _store_unique(df, keys, order, out, checkpoint, {"availableNow": True}).awaitTermination()


def daily_reason_counts(decisions: DataFrame, time: str = "at", delay: str = "1 day") -> DataFrame:
    """Decisions and reason codes per day."""
    code = F.coalesce("reason_code", F.lit("OTHER")).alias("reason_code")
    grouped = decisions.withWatermark(time, delay).groupBy(F.window(time, "1 day").alias("w"), code)
    return grouped.agg(F.count("*").alias("decisions")).select(F.col("w.start").alias("day"), "reason_code", "decisions")


def flag_stream(points: DataFrame, limits: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Fence flags of arriving points against thresholds frozen by a batch run (stream-static join)."""
    return fence_flags(points, limits, keys, value)


def run_to_files(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is available and stop; every batch replaces its own output folder."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b{batch_id}")

    query = (df.writeStream.outputMode(mode).foreachBatch(save).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
