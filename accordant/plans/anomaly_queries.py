"""Measurements: labels, fences, rolling MAD, isolation forest, LOF, injection."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from accordant.operators import anomaly, metrics, neighbours, outliers, profile
from accordant.plans.domain import AS_OF
from accordant.plans.oracle import hash_int
from accordant.plans.registry import query

DETECTORS = ("iqr", "zscore", "percentile")
REPORT = ("ROUND(COALESCE(tp / NULLIF(tp + fp, 0)::DOUBLE, 0), 6) AS precision, ROUND(COALESCE(tp / NULLIF(tp + fn, 0)::DOUBLE, 0), 6) AS recall, "
          "ROUND(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1")


def _flags(d):
    return anomaly.fence_flags(d.telemetry, anomaly.fences(d.telemetry, ["series"], "value"), ["series"], "value")


@query("j10_point_labels", "SELECT point_id, label FROM labelled")
def point_labels(d):
    return anomaly.label_points(d.telemetry, d.windows, "series", "ts").select("point_id", "label")


@query("j10_label_shares", "SELECT series, SUM(label)::BIGINT AS labelled, COUNT(*) AS points FROM labelled GROUP BY 1")
def label_shares(d):
    labelled = anomaly.label_points(d.telemetry, d.windows, "series", "ts")
    return labelled.groupBy("series").agg(F.sum("label").alias("labelled"), F.count("*").alias("points"))


@query("n1_n2_n3_fences", "SELECT series, ROUND(iqr_low, 6) AS iqr_low, ROUND(iqr_high, 6) AS iqr_high, ROUND(pct_low, 6) AS pct_low, ROUND(pct_high, 6) AS pct_high, ROUND(mean, 6) AS mean, ROUND(std, 6) AS std FROM fences")
def fences(d):
    limits = anomaly.fences(d.telemetry, ["series"], "value")
    return limits.select("series", *[F.round(c, 6).alias(c) for c in limits.columns if c != "series"])


@query("n1_n2_n3_flags", "SELECT point_id, iqr, zscore, percentile FROM flags")
def fence_flags(d):
    return _flags(d).select("point_id", *DETECTORS)


HOLED = "(SELECT point_id, series, ts, CASE WHEN point_id % 50 <> 0 THEN value END AS value FROM telemetry)"


def _holed(d):
    """Every fiftieth value is NaN, which counts as missing."""
    return d.telemetry.withColumn("value", F.when(F.col("point_id") % 50 != 0, F.col("value")).otherwise(F.lit(float("nan"))))


@query("n1_n2_n3_flags_with_nan", f"""
    SELECT point_id, COALESCE(value < q[2] - 1.5e0 * (q[3] - q[2]) OR value > q[3] + 1.5e0 * (q[3] - q[2]), FALSE) AS iqr, COALESCE(ABS((value - mean) / std) > 3, FALSE) AS zscore,
      COALESCE(value < q[1] OR value > q[4], FALSE) AS percentile
    FROM {HOLED} t JOIN (SELECT series, QUANTILE_CONT(value, [0.01, 0.25, 0.75, 0.99]) AS q, AVG(value) AS mean, STDDEV_SAMP(value) AS std FROM {HOLED} GROUP BY series) f ON f.series = t.series""")
def fence_flags_with_nan(d):
    df = _holed(d)
    return anomaly.fence_flags(df, anomaly.fences(df, ["series"], "value"), ["series"], "value").select("point_id", *DETECTORS)


@query("a8_a10_describe_with_nan", f"""
    SELECT s.series, COUNT(value) AS count, ROUND(AVG(value), 6) AS mean, ROUND(STDDEV_SAMP(value), 6) AS std, MIN(value) AS min, MAX(value) AS max, (SELECT COUNT(*) - COUNT(value) FROM {HOLED}) AS missing
    FROM {HOLED} s GROUP BY s.series""")
def describe_with_nan(d):
    df = _holed(d)
    missing = profile.missing_cells(df, ["value"]).select("missing").scalar()
    out = profile.describe(df, ["series"], "value").select("series", "count", "mean", "std", "min", "max")
    return out.withColumns({**{c: F.round(c, 6) for c in ("mean", "std")}, "missing": missing})


@query("a28_outlier_shares", "SELECT series, COUNT(*) FILTER (WHERE iqr) AS outliers, ROUND(100 * COUNT(*) FILTER (WHERE iqr) / COUNT(*)::DOUBLE, 4) AS percent FROM flags GROUP BY series")
def outlier_shares(d):
    return _flags(d).groupBy("series").agg(F.count_if("iqr").alias("outliers"), F.round(100 * F.count_if("iqr") / F.count("*"), 4).alias("percent"))


@query("n4_w1_w2_rolling_mad", "SELECT point_id, ROUND(score, 4) AS score, rolling_mad FROM mad")
def rolling_mad(d):
    out = anomaly.rolling_mad(d.telemetry, ["series"], ["ts", "point_id"], "value", bucket=2000)
    return out.select("point_id", F.round("score", 4).alias("score"), "rolling_mad")


@query("n4_one_series", """
    SELECT COUNT(*) AS points, COUNT(*) FILTER (WHERE ABS(0.6745e0 * (value - center) / (mad + 1e-10)) > 3.5) AS flagged
    FROM (SELECT *, MEDIAN(ABS(value - center)) OVER (ORDER BY ts, point_id ROWS BETWEEN 48 PRECEDING AND 47 FOLLOWING) AS mad
      FROM (SELECT *, MEDIAN(value) OVER (ORDER BY ts, point_id ROWS BETWEEN 48 PRECEDING AND 47 FOLLOWING) AS center FROM telemetry))""")
def one_series(d):
    """All points as a single unkeyed series, as the file order of the source has it."""
    whole = d.telemetry.withColumn("all", F.lit("all"))
    out = anomaly.rolling_mad(whole, ["all"], ["ts", "point_id"], "value", bucket=2000)
    return out.agg(F.count("*").alias("points"), F.count_if("rolling_mad").alias("flagged"))


@query("n9_detector_evaluation", f"""
    SELECT series, detector, tp, fp, fn, {REPORT} FROM (SELECT series, detector, COUNT(*) FILTER (WHERE label = 1 AND flag) AS tp, COUNT(*) FILTER (WHERE label = 0 AND flag) AS fp, COUNT(*) FILTER (WHERE label = 1 AND NOT flag) AS fn
      FROM (SELECT m.series, 'rolling_mad' AS detector, l.label, m.rolling_mad AS flag FROM mad m JOIN labelled l ON l.point_id = m.point_id) GROUP BY ALL)""")
def detector_evaluation(d):
    flagged = anomaly.rolling_mad(d.telemetry, ["series"], ["ts", "point_id"], "value", bucket=2000)
    labelled = anomaly.label_points(flagged, d.windows, "series", "ts")
    judged = labelled.select("series", F.lit("rolling_mad").alias("detector"), "label", F.col("rolling_mad").cast("int").alias("prediction"))
    report = metrics.classification_report(judged, "label", "prediction", ["series", "detector"]).drop("tn")
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query("n10_flagged_profile", """
    SELECT series, COUNT(value) AS count, ROUND(AVG(value), 6) AS mean, ROUND(STDDEV_SAMP(value), 6) AS std, MIN(value) AS min, MAX(value) AS max, ROUND(QUANTILE_CONT(value, 0.25), 6) AS q25,
      ROUND(QUANTILE_CONT(value, 0.5), 6) AS q50, ROUND(QUANTILE_CONT(value, 0.75), 6) AS q75 FROM mad WHERE rolling_mad GROUP BY series""")
def flagged_profile(d):
    flagged = anomaly.rolling_mad(d.telemetry, ["series"], ["ts", "point_id"], "value", bucket=2000).where("rolling_mad")
    out = profile.describe(flagged, ["series"], "value")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


FACTOR = hash_int("CAST(point_id AS VARCHAR)", 43, 1000)
INJECTED = f"""(SELECT t.point_id, series, ts, CASE WHEN i.point_id IS NOT NULL THEN (SELECT MAX(value) FROM telemetry) * (2 + 3 * {FACTOR.replace('point_id', 't.point_id')} / 1000e0) ELSE value END AS value, i.point_id IS NOT NULL AS hit
    FROM telemetry t LEFT JOIN (SELECT point_id FROM telemetry ORDER BY MD5('42|' || point_id), point_id LIMIT 50) i ON i.point_id = t.point_id)"""


@query("n7_injected_points", f"SELECT point_id, ROUND(value, 6) AS value FROM {INJECTED}")
def injected_points(d):
    changed, _ = anomaly.inject(d.telemetry, "point_id", "value")
    return changed.select("point_id", F.round("value", 6).alias("value"))


@query("n8_a29_recovery", f"""
    SELECT COUNT(*) AS injected, COUNT(*) FILTER (WHERE f) AS detected, ROUND(COUNT(*) FILTER (WHERE f) / COUNT(*)::DOUBLE, 6) AS recovery_rate
    FROM (SELECT hit, ABS(0.6745e0 * (value - center) / (mad + 1e-10)) > 3.5 AS f FROM (SELECT *, MEDIAN(ABS(value - center)) OVER (PARTITION BY series ORDER BY ts, point_id ROWS BETWEEN 48 PRECEDING AND 47 FOLLOWING) AS mad
      FROM (SELECT *, MEDIAN(value) OVER (PARTITION BY series ORDER BY ts, point_id ROWS BETWEEN 48 PRECEDING AND 47 FOLLOWING) AS center FROM {INJECTED}))) WHERE hit""")
def recovery(d):
    changed, log = anomaly.inject(d.telemetry, "point_id", "value")
    flags = anomaly.rolling_mad(changed, ["series"], ["ts", "point_id"], "value", bucket=2000)
    return anomaly.recovery(flags, log, "point_id", "rolling_mad")


@query("n11_anomaly_ledger", f"""
    SELECT 'telemetry' AS source_system, CAST(point_id AS VARCHAR) AS source_record_id, 'iqr' AS anomaly_type, 'outside the IQR fence' AS reason, CAST(value AS DOUBLE) AS anomaly_score, '{AS_OF}' AS detected_at FROM flags WHERE iqr
    UNION ALL SELECT 'telemetry', CAST(point_id AS VARCHAR), 'zscore', 'more than three deviations from the mean', CAST(value AS DOUBLE), '{AS_OF}' FROM flags WHERE zscore
    UNION ALL SELECT 'telemetry', CAST(point_id AS VARCHAR), 'percentile', 'outside the 1st to 99th percentile', CAST(value AS DOUBLE), '{AS_OF}' FROM flags WHERE percentile""")
def anomaly_ledger(d):
    reasons = {"iqr": "outside the IQR fence", "zscore": "more than three deviations from the mean", "percentile": "outside the 1st to 99th percentile"}
    rows = anomaly.ledger(_flags(d), "telemetry", "point_id", "value", reasons, F.lit(AS_OF).cast("timestamp"))
    return rows.drop("evidence").withColumns({"anomaly_score": F.col("anomaly_score").cast("double"), "detected_at": F.date_format("detected_at", "yyyy-MM-dd HH:mm:ss")})


def _path(n: str) -> str:
    return f"CASE WHEN {n} > 2 THEN 2e0 * (LN({n} - 1) + {np.euler_gamma!r}) - 2e0 * ({n} - 1) / {n}::DOUBLE WHEN {n} = 2 THEN 1e0 ELSE 0e0 END"


def _mod(x: str, seed: int, modulus: int) -> str:
    return f"(CAST('0x' || SUBSTR(MD5('{seed}|' || {x}), 1, 14) AS BIGINT) % {modulus})"


def forest_sql(source: str, columns: list[str], key: str, trees: int = outliers.TREES, sample: int = outliers.SAMPLE, seed: int = 42) -> str:
    """Expressions up to ``forest_scores`` (one row for each distinct tuple of the columns), for more than ``sample`` rows."""
    levels, p, names = int(np.ceil(np.log2(sample))), outliers.DRAWS, ", ".join(columns)
    parts = [f"forest_rows AS MATERIALIZED (SELECT {key} AS row_key, {_mod(f'CAST({key} AS VARCHAR)', seed, p)} AS place, {', '.join(f'COALESCE({c}, 0) AS {c}' for c in columns)} FROM {source})",
             f"""level0 AS MATERIALIZED (SELECT tree, CAST(1 AS BIGINT) AS node, {names} FROM (SELECT tree, {names}, ROW_NUMBER() OVER (PARTITION BY tree ORDER BY
               (place * ((tree * 7919 + {seed * 104_729 + 1_299_709}) % {p}) + tree * 15485863) % {p}, row_key) AS rn FROM forest_rows, (SELECT UNNEST(RANGE({trees})) AS tree)) WHERE rn <= {sample})"""]
    for k in range(levels + 1):
        spans = " UNION ALL ".join(f"SELECT tree, node, {i} AS feature, MIN({c}) AS low, MAX({c}) AS high, MD5('{seed}|' || tree || '|' || node || '|{c}') AS o FROM level{k} GROUP BY tree, node" for i, c in enumerate(columns))
        share = f"{_mod("tree || '|' || node", seed + 1, 1 << 28)} / {float(1 << 28)!r}"
        found = f"SELECT tree, node, MIN_BY(feature, o) AS feature, MIN_BY(low, o) AS low, MIN_BY(high, o) AS high FROM ({spans}) WHERE high > low AND {k} < {levels} GROUP BY tree, node"
        parts.append(f"""nodes{k} AS MATERIALIZED (SELECT s.tree, s.node, COALESCE(f.feature, -1) AS feature, f.low + ({share.replace('tree', 's.tree').replace('node', 's.node')}) * (f.high - f.low) AS threshold,
          CASE WHEN f.feature IS NULL THEN {k} + {_path('s.n')} ELSE 0e0 END AS depth
          FROM (SELECT tree, node, COUNT(*) AS n FROM level{k} GROUP BY tree, node) s LEFT JOIN ({found}) f ON f.tree = s.tree AND f.node = s.node)""")
        if k < levels:
            value = "CASE n.feature " + " ".join(f"WHEN {i} THEN l.{c}" for i, c in enumerate(columns)) + " END"
            parts.append(f"""level{k + 1} AS MATERIALIZED (SELECT l.tree, 2 * l.node + CASE WHEN {value} <= n.threshold THEN 0 ELSE 1 END AS node, {', '.join(f'l.{c}' for c in columns)}
              FROM level{k} l JOIN nodes{k} n ON n.tree = l.tree AND n.node = l.node WHERE n.feature >= 0)""")
    value = "CASE n.feature " + " ".join(f"WHEN {i} THEN w.{c}" for i, c in enumerate(columns)) + " END"
    parts += [f"tree_nodes AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM nodes{k}' for k in range(levels + 1))})",
              f"""walk AS (SELECT tree, CAST(1 AS BIGINT) AS node, {names} FROM (SELECT DISTINCT {names} FROM forest_rows), (SELECT UNNEST(RANGE({trees})) AS tree)
                UNION ALL SELECT w.tree, 2 * w.node + CASE WHEN {value} <= n.threshold THEN 0 ELSE 1 END, {', '.join(f'w.{c}' for c in columns)} FROM walk w JOIN tree_nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature >= 0)""",
              f"""forest_scores AS MATERIALIZED (SELECT {', '.join(f'w.{c}' for c in columns)}, ROUND(POWER(2e0, -(SUM(n.depth) / {trees}) / {float(outliers._expected_path(sample))!r}), 10) AS anomaly_score
                FROM walk w JOIN tree_nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature < 0 GROUP BY ALL)"""]
    return "WITH RECURSIVE " + ",\n".join(parts)


@query("n5_isolation_forest", f"""{forest_sql('events', ['value'], 'event_id')}
    SELECT e.event_id AS point_id, e.event_type AS series, e.value, f.anomaly_score, f.anomaly_score > (SELECT QUANTILE_CONT(anomaly_score, 0.95) FROM events JOIN forest_scores USING (value)) AS isolation_forest
    FROM events e JOIN forest_scores f ON f.value = e.value""")
def isolation_forest(d):
    return outliers.isolation_forest(d.telemetry, ["value"], "point_id").select("point_id", "series", "value", "anomaly_score", "isolation_forest")


LINE_KEY = "l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey"
LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount"]


@query("n5_isolation_forest_columns", f"""{forest_sql('lineitem', LINE_COLUMNS, LINE_KEY)}
    SELECT {LINE_KEY} AS row_id, f.*, f.anomaly_score > (SELECT QUANTILE_CONT(anomaly_score, 0.99) FROM lineitem JOIN forest_scores USING ({', '.join(LINE_COLUMNS)})) AS isolation_forest
    FROM lineitem l JOIN forest_scores f USING ({', '.join(LINE_COLUMNS)})""")
def isolation_forest_columns(d):
    lines = d.table("lineitem").select(F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row_id"), *LINE_COLUMNS)
    return outliers.isolation_forest(lines, LINE_COLUMNS, "row_id", 0.01)


#: Neighbours of a value are among the 20 before and the 20 after it; equal gaps in the order of the values.
LOF_SQL = """WITH ranked AS MATERIALIZED (SELECT event_id, event_type, value, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY value, event_id) AS r FROM events),
    around AS (SELECT *, LIST({'v': value, 'r': r}) OVER (PARTITION BY event_type ORDER BY r ROWS BETWEEN 20 PRECEDING AND 20 FOLLOWING) AS w FROM ranked),
    nearest AS MATERIALIZED (SELECT event_id, event_type, r, LIST_SORT(LIST_TRANSFORM(LIST_FILTER(w, lambda x: x.r <> r), lambda x: {'gap': ABS(x.v - value), 'r': x.r}))[1:20] AS k FROM around),
    links AS MATERIALIZED (SELECT event_id, event_type, r, UNNEST(k).gap AS gap, UNNEST(k).r AS o FROM nearest),
    density AS MATERIALIZED (SELECT l.event_type, l.r, 1 / (AVG(GREATEST(l.gap, n.k[-1].gap)) + 1e-10) AS lrd FROM links l JOIN nearest n ON n.event_type = l.event_type AND n.r = l.o GROUP BY l.event_type, l.r),
    factors AS MATERIALIZED (SELECT l.event_type, l.r, ANY_VALUE(l.event_id) AS event_id, ROUND(AVG(o.lrd) / ANY_VALUE(own.lrd), 6) AS lof FROM links l JOIN density o ON o.event_type = l.event_type AND o.r = l.o
      JOIN density own ON own.event_type = l.event_type AND own.r = l.r GROUP BY l.event_type, l.r)"""


@query("n6_w7_local_outlier_factor", f"""{LOF_SQL}
    SELECT f.event_id AS point_id, f.event_type AS series, e.value, f.lof, f.lof > q.q AS local_outlier_factor FROM factors f JOIN events e ON e.event_id = f.event_id
    JOIN (SELECT event_type, QUANTILE_CONT(lof, 0.95) AS q FROM factors GROUP BY event_type) q ON q.event_type = f.event_type""")
def local_outlier_factor(d):
    return outliers.local_outlier_factor(d.telemetry, ["series"], "value", "point_id").select("point_id", "series", "value", "lof", "local_outlier_factor")


@query("n6_factors_over_columns", """
    WITH p AS MATERIALIZED (SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x, p_retailprice AS y, COALESCE(q, 0) AS z FROM part LEFT JOIN (SELECT l_partkey, SUM(l_quantity) AS q FROM lineitem GROUP BY 1) ON l_partkey = p_partkey),
      part_pairs AS (SELECT a.id, b.id AS o, SQRT(POWER(a.x - b.x, 2) + POWER(a.y - b.y, 2) + POWER(a.z - b.z, 2)) AS gap, b.x, b.y, b.z FROM p a JOIN p b ON a.id <> b.id),
      links AS MATERIALIZED (SELECT id, o, gap FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY gap, x, y, z, o) AS r FROM part_pairs) WHERE r <= 20),
      radius AS (SELECT id, MAX(gap) AS radius FROM links GROUP BY id),
      density AS MATERIALIZED (SELECT l.id, 1 / (SUM(GREATEST(gap, radius)) / 20 + 1e-10) AS lrd FROM links l JOIN radius r ON r.id = l.o GROUP BY l.id),
      factors AS MATERIALIZED (SELECT l.id, ROUND(SUM(o.lrd) / 20 / ANY_VALUE(own.lrd), 6) AS lof FROM links l JOIN density o ON o.id = l.o JOIN density own ON own.id = l.id GROUP BY l.id)
    SELECT id AS p_partkey, lof, lof > (SELECT QUANTILE_CONT(lof, 0.95) FROM factors) AS local_outlier_factor FROM factors""")
def factors_over_columns(d):
    """Parts by size, price and quantity sold."""
    sold = d.table("lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("sold"))
    parts = d.table("part").join(sold, "p_partkey", "left").select("p_partkey", "p_size", "p_retailprice", "sold")
    return neighbours.local_outlier_factors(parts, ["p_size", "p_retailprice", "sold"]).select("p_partkey", "lof", "local_outlier_factor")


@query("n9_forest_evaluation", f"""{forest_sql('events', ['value'], 'event_id')}
    SELECT series, tp, fp, fn, tn, {REPORT} FROM (SELECT series, COUNT(*) FILTER (WHERE label = 1 AND flag) AS tp, COUNT(*) FILTER (WHERE label = 0 AND flag) AS fp, COUNT(*) FILTER (WHERE label = 1 AND NOT flag) AS fn,
        COUNT(*) FILTER (WHERE label = 0 AND NOT flag) AS tn
      FROM (SELECT l.series, l.label, f.anomaly_score > q.q AS flag FROM labelled l JOIN forest_scores f ON f.value = l.value JOIN (
        SELECT series, s[CAST(FLOOR(pos) AS BIGINT) + 1] + (s[CAST(CEIL(pos) AS BIGINT) + 1] - s[CAST(FLOOR(pos) AS BIGINT) + 1]) * (pos - FLOOR(pos)) AS q
        FROM (SELECT l.series, LIST_SORT(LIST(f.anomaly_score)) AS s, (COUNT(*) - 1) * (1 - GREATEST(AVG(l.label), 0.01)) AS pos FROM labelled l JOIN forest_scores f ON f.value = l.value GROUP BY l.series)) q
        ON q.series = l.series) GROUP BY series)""")
def forest_evaluation(d):
    """The forest against the labels, cut per series at its label share (at least one percent)."""
    labelled = anomaly.label_points(d.telemetry, d.windows, "series", "ts")
    share = labelled.groupBy("series").agg(F.greatest(F.avg("label"), F.lit(0.01)).alias("share"))
    scored = outliers.isolation_scores(labelled, outliers.fit_isolation_forest(d.telemetry, ["value"], "point_id"))
    flagged = outliers.flag_top_share(scored, ["series"], "anomaly_score", share, "flag")
    judged = flagged.select("series", "label", F.col("flag").cast("int").alias("prediction"))
    report = metrics.classification_report(judged, "label", "prediction", ["series"])
    return report.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})
