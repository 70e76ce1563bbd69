"""Anomaly flags for measurements: fences, z-score, rolling median/MAD, labels and injection."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accordant.functions.ids import hash_int, shuffle_hash
from accordant.functions.numbers import nan_to_null
from accordant.operators.ranking import exact_quantiles, halo_buckets, join_on, ordered_rank

# Detector constants.
IQR_FACTOR = 1.5
Z_LIMIT = 3.0
MAD_SCALE = 0.6745
MAD_LIMIT = 3.5
MAD_WINDOW = 96
MAD_EPSILON = 1e-10


def fences(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per-group thresholds of the IQR, percentile and z-score detectors."""
    df = nan_to_null(df)
    q = exact_quantiles(df, keys, value, {"q01": 0.01, "q25": 0.25, "q75": 0.75, "q99": 0.99})
    moments = df.groupBy(*keys).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"))
    spread = F.col("q75") - F.col("q25")
    return join_on(moments, q, keys).select(
        *keys, (F.col("q25") - IQR_FACTOR * spread).alias("iqr_low"), (F.col("q75") + IQR_FACTOR * spread).alias("iqr_high"),
        F.col("q01").alias("pct_low"), F.col("q99").alias("pct_high"), "mean", "std")


def _outside(value: Column, low: str, high: str) -> Column:
    return F.coalesce((value < F.col(low)) | (value > F.col(high)), F.lit(False))


def z_score(value: Column) -> Column:
    return F.abs(F.try_divide(value - F.col("mean"), F.col("std")))


def fence_flags(df: DataFrame, limits: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows with one flag per detector; ``limits`` may come from other (earlier) data."""
    v = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    return join_on(df, limits, keys, "left").select(
        *df.columns, _outside(v, "iqr_low", "iqr_high").alias("iqr"),
        F.coalesce(z_score(v) > Z_LIMIT, F.lit(False)).alias("zscore"),
        _outside(v, "pct_low", "pct_high").alias("percentile"))


def _rolling(values: pd.Series, window: int) -> pd.Series:
    return values.rolling(window=window, center=True, min_periods=1).median()


def rolling_mad(df: DataFrame, keys: list[str], order: list[str], value: str, window: int = MAD_WINDOW,
                threshold: float = MAD_LIMIT, bucket: int = 20000) -> DataFrame:
    """Rows with the modified z-score against a centred rolling median/MAD, and its flag.

    A series is cut into runs of ``bucket`` rows with the neighbours both rolling stages need, so
    one long series is processed by many tasks and the result equals the one over the whole series.
    """
    before, after = 2 * (window // 2), 2 * ((window - 1) // 2)
    ranked = ordered_rank(df, keys, order, name="_rank")
    runs = halo_buckets(ranked, "_rank", bucket, before, after)
    names = [*df.columns, "score"]
    schema = runs.select(*df.columns, F.lit(0.0).alias("score")).schema

    def score(run: pd.DataFrame) -> pd.DataFrame:
        run = run.sort_values("_rank", ignore_index=True)
        x = run[value].astype("float64")
        center = _rolling(x, window)
        mad = _rolling((x - center).abs(), window)
        run["score"] = MAD_SCALE * (x - center) / (mad + MAD_EPSILON)
        return run.loc[run["_owned"], names]

    scored = runs.groupBy(*keys, "_bucket").applyInPandas(score, schema)
    return scored.withColumn("rolling_mad", F.coalesce(F.abs("score") > threshold, F.lit(False)))


def label_intervals(windows: DataFrame, key: str) -> DataFrame:
    """Label windows as disjoint intervals per calendar day: (key, day, start, end).

    A point then meets at most one interval, so attaching labels cannot multiply rows, and the day
    is an equality condition, so a key with many windows does not turn into a range scan.
    """
    days = windows.withColumn("day", F.explode(F.sequence(F.to_date("start"), F.to_date("end"))))
    w = Window.partitionBy(key, "day").orderBy("start", "end")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = days.withColumn("_new", (reach.isNull() | (F.col("start") > reach)).cast("int"))
    islands = marked.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(key, "day", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def label_points(points: DataFrame, windows: DataFrame, key: str, time: str) -> DataFrame:
    """0/1 label per point: inside a window of its series, both ends included."""
    spans = label_intervals(windows, key).select(
        F.col(key).alias("_key"), F.col("day").alias("_day"), F.col("start").alias("_start"), F.col("end").alias("_end"))
    hit = ((F.col(key) == F.col("_key")) & (F.to_date(time) == F.col("_day"))
           & F.col(time).between(F.col("_start"), F.col("_end")))
    return points.join(spans, hit, "left").withColumn(
        "label", F.col("_key").isNotNull().cast("int")).drop("_key", "_day", "_start", "_end")


def inject(df: DataFrame, id_column: str, value: str, n: int = 50, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Raise ``n`` hash-drawn rows to 2..5 times the maximum; returns (table, injection log)."""
    drawn = df.select(id_column, shuffle_hash(F.col(id_column), seed).alias("_h")).orderBy("_h", id_column).limit(n)
    factor = 2 + 3 * hash_int(F.col(id_column), seed + 1, 1000) / 1000
    log = drawn.select(id_column, factor.alias("factor"))
    top = df.agg(F.max(value)).scalar()
    changed = df.join(log, id_column, "left")
    new_value = F.when(F.col("factor").isNotNull(), top * F.col("factor")).otherwise(F.col(value))
    return changed.withColumn(value, new_value).drop("factor"), log


def recovery(flags: DataFrame, log: DataFrame, id_column: str, flag: str) -> DataFrame:
    """Injected rows, those the detector flagged, and the recovery rate."""
    hits = log.select(id_column).join(flags.select(id_column, flag), id_column, "left")
    return hits.agg(F.count("*").alias("injected"), F.count_if(flag).alias("detected"),
                    F.round(F.try_divide(F.count_if(flag), F.count("*")), 6).alias("recovery_rate"))


def ledger(flags: DataFrame, source: str, id_column: str, value: str, detectors: dict[str, str], at: Column) -> DataFrame:
    """Long anomaly ledger: one row per flagged record and detector."""
    entries = F.array(*[F.when(F.col(c), F.struct(F.lit(c).alias("anomaly_type"), F.lit(reason).alias("reason")))
                        for c, reason in detectors.items()])
    rows = flags.select(F.col(id_column).cast("string").alias("source_record_id"),
                        F.concat(F.lit(f"{value}="), F.col(value).cast("string")).alias("evidence"),
                        F.col(value).cast("decimal(14,4)").alias("anomaly_score"),
                        F.explode(F.array_compact(entries)).alias("a"))
    return rows.select(F.lit(source).alias("source_system"), "source_record_id", "a.anomaly_type", "anomaly_score",
                       "evidence", "a.reason", at.alias("detected_at"))
