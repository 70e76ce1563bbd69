"""Session defaults and durable intermediate results."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Input bytes to a shuffle part, and the most parts a shuffle starts with.
SHUFFLE_INPUT, MOST_PARTS = 4 << 20, 4000
#: Compressed bytes of a shuffle, and of stored files, that a task is meant to take; sorted ids take some fifty times that in memory.
SHUFFLE_TASK, FILE_TASK = 8 << 20, 16 << 20
#: Bytes beyond which the JVM interprets a generated method instead of compiling it.
LONGEST_METHOD = 8000
#: Spark's setting by which a finished execution deletes its shuffle files.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "accordant", master: str | None = None, **conf) -> SparkSession:
    """Session for tools and tests; a cluster job passes its own session instead."""
    builder = SparkSession.builder.appName(app).config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on (UTC timestamps, adaptive skew handling)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    _ship_package(spark)
    return spark


_shipped: set[str] = set()  # application ids whose executors already have the package


def _ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers, which need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="accordant-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or a scratch one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="accordant-"))
    return context.getCheckpointDir()


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/scratch-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the application's part of the shared folder."""
    return f"{_scratch(spark)}/{name}-{uuid.uuid4().hex}"


def size_shuffles(spark: SparkSession, folder: str) -> int:
    """Start shuffles with a part for each ``SHUFFLE_INPUT`` bytes of the tables in ``folder``, at least the configured number.

    Adaptive execution joins small parts again, up to ``SHUFFLE_TASK`` bytes, and a task reads ``FILE_TASK`` bytes of files, so
    that what a task holds does not grow with the tables. Steps whose joint method would be interpreted run one by one, compiled.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    held = path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(-(-held // SHUFFLE_INPUT), MOST_PARTS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLE_TASK))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(FILE_TASK))
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(LONGEST_METHOD))
    return parts


def drop_scratch(spark: SparkSession) -> None:
    """Delete all that this application has stored in the shared folder, once its results are written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that later stages survive executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Like ``durable`` for tables as large as the input: compressed, and read by column. Keeps no partitioning.

    Its shuffle files go as soon as it is written; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, "stored"), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
