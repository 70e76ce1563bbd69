"""Alignment, field evidence, data quality and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from accordant import policy
from accordant.functions import ids, numbers, text, times
from accordant.operators import align, evidence, kpi, perturb, profile, quality
from accordant.plans.oracle import norm, norm_ev
from accordant.plans.registry import query

CAPACITY = "system_size_kw"


@query("e1_capacity_conflicts", f"""
    SELECT project_id, verdict, detail, authority_source, ROUND(CAST(authority_value AS DOUBLE), 4) AS authority_value,
      CASE verdict WHEN 'MATCH' THEN 'No action — sources agree.' WHEN 'MISSING' THEN 'Request the missing value from the non-reporting source.'
        ELSE verdict || ': authoritative source is ' || authority_source || ' (' || authority_value || '); update derived values or request clarification.' END AS action
    FROM evidence WHERE field = '{CAPACITY}' AND verdict <> 'MATCH'""")
def capacity_conflicts(d):
    """Projects whose reported capacity differs, with the authoritative source and the next step."""
    judged = evidence.evidence(d.wide, fields=[CAPACITY])
    return judged.where(F.col("verdict") != "MATCH").select(
        "project_id", "verdict", "detail", "authority_source", F.round(F.col("authority_value").cast("double"), 4).alias("authority_value"),
        "action")


@query("e1_numeric_verdict_counts", f"SELECT verdict, COUNT(*) AS projects FROM evidence WHERE field = '{CAPACITY}' GROUP BY verdict")
def numeric_verdicts(d):
    return evidence.evidence(d.wide, fields=[CAPACITY]).groupBy("verdict").agg(F.count("*").alias("projects"))


@query("e2_text_verdicts", "SELECT field, verdict, detail, COUNT(*) AS projects FROM evidence WHERE field IN ('customer_name', 'installer', 'address') GROUP BY ALL")
def text_verdicts(d):
    judged = evidence.evidence(d.wide, fields=["customer_name", "installer", "address"])
    return judged.groupBy("field", "verdict", "detail").agg(F.count("*").alias("projects"))


@query("e3_category_verdicts", "SELECT verdict, detail, COUNT(*) AS projects FROM evidence WHERE field = 'status' GROUP BY ALL")
def category_verdicts(d):
    return evidence.evidence(d.wide, fields=["status"]).groupBy("verdict", "detail").agg(F.count("*").alias("projects"))


@query("e4_field_records", "SELECT project_id, field, verdict, severity, category, detail FROM evidence")
def field_records(d):
    return evidence.evidence(d.wide).select("project_id", "field", "verdict", "severity", "category", "detail")


@query("e5_authoritative_values", """
    SELECT project_id, field, authority_source, CASE WHEN field = 'system_size_kw' THEN CAST(ROUND(CAST(authority_value AS DOUBLE), 4) AS VARCHAR) ELSE authority_value END AS authority_value,
      CASE WHEN authority_source IS NULL THEN 'no source reports this field' ELSE authority_source || ' outranks others by source priority' END AS reason FROM evidence""")
def authoritative_values(d):
    value = F.when(F.col("field") == CAPACITY, F.round(F.col("authority_value").try_cast("double"), 4).cast("string")).otherwise(F.col("authority_value"))
    return evidence.evidence(d.wide).select("project_id", "field", "authority_source", value.alias("authority_value"), F.col("authority_reason").alias("reason"))


@query("e6_recommended_actions", """
    SELECT project_id, field, CASE verdict WHEN 'MATCH' THEN 'No action — sources agree.' WHEN 'MISSING' THEN 'Request the missing value from the non-reporting source.'
      ELSE verdict || ': authoritative source is ' || authority_source || CASE WHEN field = 'system_size_kw' THEN '' ELSE ' (' || authority_value || '); update derived values or request clarification.' END END AS action
    FROM evidence""")
def recommended_actions(d):
    """Every action; of capacities without the number, whose text differs between engines."""
    short = F.regexp_replace("action", r" \((.|\n)*\); update.*$", "")
    return evidence.evidence(d.wide).select("project_id", "field", F.when(F.col("field") == CAPACITY, short).otherwise(F.col("action")).alias("action"))


@query("e7_field_values", """
    SELECT project_id, customer_name_crm, customer_name_erp, installer_crm, installer_partner, ROUND(system_size_kw_crm, 6) AS system_size_kw_crm,
      ROUND(system_size_kw_erp, 6) AS system_size_kw_erp, ROUND(system_size_kw_partner, 6) AS system_size_kw_partner, address_crm, address_partner,
      status_crm, status_erp, status_partner, status_document FROM wide""")
def field_values(d):
    sizes = {f"{CAPACITY}_{s}": F.round(f"{CAPACITY}_{s}", 6) for s in ("crm", "erp", "partner")}
    return d.wide.withColumns(sizes).drop("in_crm", "in_erp", "in_partner", "in_document")


@query("e8_verdicts_by_field", "SELECT field, verdict, severity, COUNT(*) AS comparisons FROM evidence GROUP BY ALL")
def verdicts_by_field(d):
    return evidence.evidence(d.wide).groupBy("field", "verdict", "severity").agg(F.count("*").alias("comparisons"))


SHOWN = ("crm", "erp", "partner", "document")


@query("e9_evidence_table", f"""
    SELECT e.project_id, e.field, {', '.join(f"COALESCE(NULLIF(TRIM(v.{s}), ''), '—') AS {s}" for s in SHOWN)},
      e.authority_source, e.verdict, e.detail FROM evidence e JOIN field_values v ON v.project_id = e.project_id AND v.field = e.field WHERE e.field <> 'system_size_kw'
    UNION ALL SELECT e.project_id, e.field, {', '.join(f"CASE WHEN v.{s} IS NULL THEN '—' ELSE 'reported' END AS {s}" for s in SHOWN)}, e.authority_source, e.verdict, e.detail
      FROM evidence e JOIN field_values v ON v.project_id = e.project_id AND v.field = e.field WHERE e.field = 'system_size_kw'""")
def evidence_table(d):
    shown = [F.when((F.col("field") == CAPACITY) & (F.col(s) != "—"), "reported").otherwise(F.col(s)).alias(s) for s in SHOWN]
    return evidence.evidence(d.wide).select("project_id", "field", *shown, "authority_source", "verdict", "detail")


@query("e10_flagged_lines", """
    SELECT project_id, field, CASE field WHEN 'customer_name' THEN 'Customer' WHEN 'installer' THEN 'Installer' WHEN 'system_size_kw' THEN 'System size (kW)'
      WHEN 'address' THEN 'Address' ELSE 'Status' END || ' — ' || CASE severity WHEN 'HIGH' THEN 'Conflict' ELSE 'Needs a look' END || ': ' || detail AS line
    FROM evidence WHERE severity <> 'LOW'""")
def flagged_lines(d):
    return evidence.flagged_lines(evidence.evidence(d.wide))


@query("e11_correction_proposals", """
    SELECT case_id, project_id, field, authority_source, CASE WHEN field = 'system_size_kw' THEN CAST(ROUND(CAST(new_value AS DOUBLE), 4) AS VARCHAR) ELSE new_value END AS new_value FROM corrections""")
def correction_proposals(d):
    value = F.when(F.col("field") == CAPACITY, F.round(F.col("new_value").try_cast("double"), 4).cast("string")).otherwise(F.col("new_value"))
    return d.corrections.select("case_id", "project_id", "field", "authority_source", value.alias("new_value"))


@query("e12_provenance_lines", """
    SELECT project_id, 'CRM updated: ' || STRFTIME(updated_at, '%Y-%m-%d %H:%M:%S') AS crm_line,
      'Document signed: ' || STRFTIME(install_date, '%Y-%m-%d') || ' (solar_Agreement_' || project_id || '.pdf)' AS document_line FROM master""")
def provenance(d):
    return evidence.provenance_lines(d.master, d.crm, d.document)


@query("e12_freshness_by_source", """
    SELECT 'crm' AS source_system, STRFTIME(MAX(updated_at), '%Y-%m-%d %H:%M:%S') AS latest FROM crm
    UNION ALL SELECT 'document', STRFTIME(MAX(signed_date), '%Y-%m-%d %H:%M:%S') FROM document""")
def freshness(d):
    crm = d.crm.select(F.lit("crm").alias("source_system"), F.col("updated_at").alias("t"))
    signed = d.document.select(F.lit("document").alias("source_system"), F.col("signed_date").cast("timestamp").alias("t"))
    return crm.unionByName(signed).groupBy("source_system").agg(F.date_format(F.max("t"), "yyyy-MM-dd HH:mm:ss").alias("latest"))


# Projections and lookups -------------------------------------------------------------------------

@query("p1_source_projections", """
    SELECT source_system, COUNT(*) AS records, COUNT(record_id) AS with_id, COUNT(customer_name) AS customers, COUNT(installer) AS installers,
      ROUND(SUM(system_size_kw), 4) AS size, COUNT(address) AS addresses, COUNT(city) AS cities, COUNT(state) AS states, COUNT(status) AS statuses FROM records GROUP BY 1""")
def source_projections(d):
    return align.align(d.sources).groupBy("source_system").agg(
        F.count("*").alias("records"), F.count("record_id").alias("with_id"), F.count("customer_name").alias("customers"),
        F.count("installer").alias("installers"), F.round(F.sum("system_size_kw"), 4).alias("size"), F.count("address").alias("addresses"),
        F.count("city").alias("cities"), F.count("state").alias("states"), F.count("status").alias("statuses"))


@query("p2_status_mapping", "SELECT m.status, e.record_status, s.signing_status, COUNT(*) AS projects FROM master m JOIN erp e ON e.ord = m.ord JOIN document s ON s.ord = m.ord GROUP BY ALL")
def status_mapping(d):
    s = F.col("status")
    return d.master.groupBy("status", text.choose(s, policy.ERP_STATUS).alias("record_status"),
                            text.choose(s, policy.SIGNING_STATUS).alias("signing_status")).agg(F.count("*").alias("projects"))


@query("p3_first_existing_column", """
    SELECT 'erp' AS source_system, COUNT(region) AS states, COUNT(record_status) AS statuses, 0::BIGINT AS cities FROM erp
    UNION ALL SELECT 'partner', 0, COUNT(completion_status), 0 FROM partner UNION ALL SELECT 'document', 0, 0, COUNT(*) * 0 FROM document
    UNION ALL SELECT 'crm', COUNT(state), COUNT(status), COUNT(city) FROM crm""")
def first_existing_column(d):
    parts = [df.agg(F.lit(name).alias("source_system"), F.count(align.existing(df, ["state", "region"])).alias("states"),
                    F.count(align.existing(df, policy.FEATURE_COLUMNS["status"])).alias("statuses"),
                    F.count(align.existing(df, ["city"])).alias("cities")) for name, df in d.sources.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("p4_project_lookup", "SELECT source_system, record_id, installer, evidence_status FROM records WHERE record_id = (SELECT MAX(project_id) FROM master)")
def project_lookup(d):
    last = d.master.select(F.max("project_id").alias("record_id"))
    return d.records.join(last, "record_id", "left_semi").select("source_system", "record_id", "installer", "evidence_status")


@query("p8_zero_filled", "SELECT COUNT(*) AS records, ROUND(SUM(COALESCE(installed_capacity, 0)), 4) AS size, COUNT(*) FILTER (WHERE COALESCE(installed_capacity, 0) = 0) AS zeros FROM erp")
def zero_filled(d):
    filled = d.erp.na.fill(0, ["installed_capacity"])
    return filled.agg(F.count("*").alias("records"), F.round(F.sum("installed_capacity"), 4).alias("size"),
                      F.count_if(F.col("installed_capacity") == 0).alias("zeros"))


@query("p9_blank_values", """
    SELECT COUNT(*) FILTER (WHERE reviewer_id IS NULL OR TRIM(reviewer_id) IN ('', 'nan', 'None', '—')) AS blank_reviewers,
      COUNT(*) FILTER (WHERE reason IS NULL OR TRIM(reason) IN ('', 'nan', 'None', '—')) AS blank_reasons,
      COUNT(*) FILTER (WHERE reason_code IS NULL) AS blank_codes FROM decisions""")
def blank_values(d):
    return d.decisions.agg(*[F.count_if(text.is_blank(c)).alias(n) for c, n in (
        ("reviewer_id", "blank_reviewers"), ("reason", "blank_reasons"), ("reason_code", "blank_codes"))])


@query("p12_p13_severity_and_category", "SELECT field, category, verdict, severity FROM evidence GROUP BY ALL")
def severity_and_category(d):
    return evidence.evidence(d.wide).select("field", "category", "verdict", "severity").distinct()


# Scalar functions ----------------------------------------------------------------------------------

@query("f1_f3_text_normalisation", f"""
    SELECT {norm('text')} = LOWER(text) AS already_stripped, LENGTH({norm_ev('text')}) AS evidence_length, LENGTH({norm('source')}) AS source_length,
      LENGTH(REGEXP_REPLACE({norm_ev('text')}, '[^a-z0-9]', '', 'g')) AS core_length, doc_id FROM documents""")
def text_normalisation(d):
    folded = text.normalize_evidence("text")
    return d.table("documents").select(
        (text.normalize_match("text") == F.lower("text")).alias("already_stripped"), F.length(folded).alias("evidence_length"),
        F.length(text.normalize_match("source")).alias("source_length"), F.length(text.alphanumeric_core(folded)).alias("core_length"), "doc_id")


@query("f5_f6_f13_numbers", """
    SELECT c.project_id, ROUND(COALESCE(ABS(c.system_size_kw - e.installed_capacity), 0), 6) AS capacity_diff,
      TRY_CAST(REPLACE(SPLIT_PART(c.address, ' ', 1) || ',000', ',', '') AS DOUBLE) AS parsed, TRY_CAST(c.installer AS DOUBLE) IS NULL AS unreadable
    FROM crm c LEFT JOIN erp e ON e.project_reference = c.project_id""")
def number_functions(d):
    joined = d.crm.join(d.erp.select(F.col("project_reference").alias("project_id"), "installed_capacity"), "project_id", "left")
    return joined.select("project_id", F.round(numbers.abs_difference(F.col(CAPACITY), F.col("installed_capacity")), 6).alias("capacity_diff"),
                         numbers.parse_number(F.concat(F.substring_index("address", " ", 1), F.lit(",000"))).alias("parsed"),
                         numbers.parse_number(F.col("installer")).isNull().alias("unreadable"))


@query("f5_f6_suffixed_numbers", """
    SELECT project_id, CASE WHEN ord % 4 = 0 THEN CAST(system_size_kw AS DOUBLE) WHEN ord % 4 = 1 THEN CAST(system_size_kw AS DOUBLE) * 100 END AS number FROM master""")
def suffixed_numbers(d):
    """Plain and exponent texts are numbers, texts with a type suffix are not."""
    size = F.col(CAPACITY).cast("string")
    text = F.concat(size, F.element_at(F.array(*map(F.lit, ("", "e2", "d", "F"))), (F.col("ord") % 4 + 1).cast("int")))
    return d.master.select("project_id", numbers.to_number(text).alias("number"))


@query("f7_f8_f17_timestamps", """
    SELECT event_id, STRFTIME(DATE_TRUNC('minute', ts), '%Y-%m-%dT%H:%M:%S') AS by_minute, STRFTIME(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
      CAST(HOUR(ts) AS INTEGER) AS hour, STRFTIME(ts, '%Y-%m-%d') AS day, TRUE AS garbage_is_null FROM events""")
def timestamp_functions(d):
    e = d.table("events")
    return e.select("event_id", times.iso_seconds(times.parse_timestamp(F.date_format("ts", "dd-MM-yyyy HH:mm"))).alias("by_minute"),
                    times.iso_seconds(times.parse_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))).alias("iso"),
                    F.hour("ts").alias("hour"), F.to_date("ts").cast("string").alias("day"),
                    times.parse_timestamp(F.col("event_type")).isNull().alias("garbage_is_null"))


@query("f9_f10_f11_identifiers", """
    SELECT project_id, 'ENV-' || UPPER(SUBSTR(MD5(project_id), 1, 12)) AS envelope,
      CAST((SELECT LIST_REDUCE(LIST_PREPEND(CAST(0 AS BIGINT), LIST_TRANSFORM(RANGE(8), lambda i: CAST('0x' || SUBSTR(SHA256(project_id), 8 * i + 1, 8) AS BIGINT))),
        lambda acc, x: (acc * 96 + x) % 100)) AS INTEGER) AS bucket, LPAD(CAST(ord AS VARCHAR), CAST(GREATEST(6, LENGTH(CAST(ord AS VARCHAR))) AS INTEGER), '0') AS padded FROM master""")
def identifiers(d):
    p = F.col("project_id")
    return d.master.select("project_id", ids.envelope_id(p).alias("envelope"), ids.sha256_mod100(p).cast("int").alias("bucket"),
                           ids.zero_pad(F.col("ord"), 6).alias("padded"))


@query("f12_f18_f21_text_flags", """
    SELECT city, state, LOWER(state) || '_' || LOWER(city) AS block_key, UPPER(installer) AS upper_name, LOWER(installer) AS lower_name,
      CASE WHEN LOWER(COALESCE(city, '')) = LOWER(COALESCE(state, '')) THEN 1e0 ELSE 0e0 END AS same, COUNT(*) AS records FROM crm GROUP BY ALL""")
def text_flags(d):
    return d.crm.groupBy("city", "state", text.block_key("state", "city").alias("block_key"),
                         text.case_variant("installer", F.lit(True)).alias("upper_name"), text.case_variant("installer", F.lit(False)).alias("lower_name"),
                         text.same_text("city", "state").alias("same")).agg(F.count("*").alias("records"))


# Aggregations ----------------------------------------------------------------------------------------

@query("a3_mean_by_hour", "SELECT CAST(HOUR(ts) AS INTEGER) AS hour, ROUND(AVG(value), 6) AS avg_value FROM events GROUP BY 1")
def mean_by_hour(d):
    return profile.mean_by(d.table("events"), F.hour("ts"), ["value"], "hour").withColumn("avg_value", F.round("avg_value", 6))


@query("a4_mean_by_date", "SELECT STRFTIME(ts, '%Y-%m-%d') AS day, ROUND(AVG(value), 6) AS avg_value FROM events GROUP BY 1")
def mean_by_date(d):
    return profile.mean_by(d.table("events"), F.to_date("ts").cast("string"), ["value"], "day").withColumn("avg_value", F.round("avg_value", 6))


@query("a5_dependency_violations", "SELECT COUNT(*) FILTER (WHERE n > 1) AS violating_entities, COUNT(*) AS total_entities FROM (SELECT p_name, COUNT(DISTINCT p_brand) AS n FROM part WHERE p_name IS NOT NULL GROUP BY p_name)")
def dependency_violations(d):
    return profile.dependency_violations(d.table("part"), "p_name", "p_brand")


@query("a6_source_conflicts", """
    SELECT COUNT(*) AS tracked, COUNT(*) FILTER (WHERE a > 1) AS conflicting_first, COUNT(*) FILTER (WHERE b > 1) AS conflicting_second, MIN(l_orderkey) FILTER (WHERE a > 1) AS example
    FROM (SELECT l_orderkey, COUNT(DISTINCT l_returnflag) AS a, COUNT(DISTINCT l_linestatus) AS b FROM lineitem GROUP BY l_orderkey)""")
def source_conflicts(d):
    return profile.source_conflicts(d.table("lineitem"), "l_orderkey", "l_returnflag", "l_linestatus")


@query("a7_group_mode", "SELECT p_name, p_brand AS mode FROM (SELECT p_name, p_brand, COUNT(*) AS n FROM part GROUP BY ALL) QUALIFY ROW_NUMBER() OVER (PARTITION BY p_name ORDER BY n DESC, p_brand) = 1")
def group_mode(d):
    return profile.group_mode(d.table("part"), "p_name", "p_brand")


@query("a8_describe_series", """
    SELECT series, COUNT(value) AS count, ROUND(AVG(value), 6) AS mean, ROUND(STDDEV_SAMP(value), 6) AS std, MIN(value) AS min, MAX(value) AS max,
      ROUND(QUANTILE_CONT(value, 0.25), 6) AS q25, ROUND(QUANTILE_CONT(value, 0.5), 6) AS q50, ROUND(QUANTILE_CONT(value, 0.75), 6) AS q75 FROM telemetry GROUP BY series""")
def describe_series(d):
    out = profile.describe(d.telemetry, ["series"], "value")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "std", "q25", "q50", "q75")})


@query("a9_exact_quantiles", "SELECT l_returnflag, ROUND(QUANTILE_CONT(l_extendedprice, 0.01), 4) AS p01, ROUND(QUANTILE_CONT(l_extendedprice, 0.5), 4) AS p50, ROUND(QUANTILE_CONT(l_extendedprice, 0.99), 4) AS p99 FROM lineitem GROUP BY 1")
def exact_quantiles(d):
    from accordant.operators.ranking import exact_quantiles as quantiles

    q = quantiles(d.table("lineitem").select("l_returnflag", "l_extendedprice"), ["l_returnflag"], "l_extendedprice", {"p01": 0.01, "p50": 0.5, "p99": 0.99})
    return q.withColumns({c: F.round(c, 4) for c in ("p01", "p50", "p99")})


@query("a9_sketched_quantiles", """
    SELECT l_returnflag, UNNEST([0.01e0, 0.5e0, 0.99e0]) AS probability, COUNT(*) AS rows, TRUE AS within FROM lineitem GROUP BY l_returnflag""")
def sketched_quantiles(d):
    """Approximate quantiles from merged monthly sketches: are their true ranks within one percent?"""
    from accordant.operators import ranking

    lines = d.table("lineitem").select("l_returnflag", F.date_trunc("month", "l_shipdate").alias("month"), "l_extendedprice")
    merged = ranking.merge_sketches(ranking.quantile_sketches(lines, ["l_returnflag", "month"], "l_extendedprice"), ["l_returnflag"])
    points = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
    found = ranking.sketch_quantiles(merged, ["l_returnflag"], points)
    judged = lines.join(found, "l_returnflag").groupBy("l_returnflag").agg(F.count("*").alias("rows"), *[
        f.alias(f"{n}_{side}") for n in points for side, f in (("upto", F.count_if(F.col("l_extendedprice") <= F.col(n))), ("below", F.count_if(F.col("l_extendedprice") < F.col(n))))])
    rows = F.array(*[F.struct(F.lit(p).alias("probability"), ((F.col(f"{n}_below") <= (p + 0.01) * F.col("rows")) & (F.col(f"{n}_upto") >= (p - 0.01) * F.col("rows"))).alias("within"))
                     for n, p in points.items()])
    return judged.select("l_returnflag", "rows", F.explode(rows).alias("r")).select("l_returnflag", "rows", "r.*")


@query("a10_missing_cells", """
    SELECT * FROM (SELECT 'customer_name' AS "column", COUNT(*) FILTER (WHERE customer_name IS NULL) AS missing, COUNT(*) AS rows FROM records
    UNION ALL SELECT 'installer', COUNT(*) FILTER (WHERE installer IS NULL), COUNT(*) FROM records UNION ALL SELECT 'address', COUNT(*) FILTER (WHERE address IS NULL), COUNT(*) FROM records
    UNION ALL SELECT 'city', COUNT(*) FILTER (WHERE city IS NULL), COUNT(*) FROM records UNION ALL SELECT 'state', COUNT(*) FILTER (WHERE state IS NULL), COUNT(*) FROM records
    UNION ALL SELECT 'system_size_kw', COUNT(*) FILTER (WHERE system_size_kw IS NULL), COUNT(*) FROM records UNION ALL SELECT 'status', COUNT(*) FILTER (WHERE status IS NULL), COUNT(*) FROM records
    UNION ALL SELECT 'record_id', COUNT(*) FILTER (WHERE record_id IS NULL), COUNT(*) FROM records)""")
def missing_cells(d):
    return profile.missing_cells(d.records, ["customer_name", "installer", "address", "city", "state", "system_size_kw", "status", "record_id"])


@query("a10_t5_top_missing", """
    SELECT "column", missing, rows FROM (SELECT UNNEST(['customer_ref', 'project_reference', 'customer', 'installed_capacity', 'region', 'record_status', 'ord']) AS "column",
      UNNEST([COUNT(*) - COUNT(customer_ref), COUNT(*) - COUNT(project_reference), COUNT(*) - COUNT(customer), COUNT(*) - COUNT(installed_capacity), COUNT(*) - COUNT(region), COUNT(*) - COUNT(record_status), COUNT(*) - COUNT(ord)]) AS missing,
      COUNT(*) AS rows FROM erp) ORDER BY missing DESC, "column" LIMIT 3""")
def top_missing(d):
    return profile.top_missing(d.erp, 3)


@query("a11_duplicate_rows", "SELECT (SELECT COUNT(*) FROM lineitem) AS rows, (SELECT COUNT(*) FROM lineitem) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_returnflag, l_linestatus, l_quantity FROM lineitem)) AS duplicates")
def duplicate_rows(d):
    return profile.duplicate_rows(d.table("lineitem").select("l_partkey", "l_returnflag", "l_linestatus", "l_quantity"))


@query("a16_completeness", """
    SELECT source_system, COUNT(*) * 5 AS cells, SUM((customer_name IS NULL)::INT + (installer IS NULL)::INT + (system_size_kw IS NULL)::INT + (address IS NULL)::INT + (evidence_status IS NULL)::INT)::BIGINT AS missing,
      CAST(ROUND(CAST(1 - SUM((customer_name IS NULL)::INT + (installer IS NULL)::INT + (system_size_kw IS NULL)::INT + (address IS NULL)::INT + (evidence_status IS NULL)::INT) / (COUNT(*) * 5e0) AS DECIMAL(28,10)), 4) AS DOUBLE) AS completeness
    FROM records GROUP BY source_system""")
def completeness(d):
    return kpi.completeness(d.records, ["customer_name", "installer", CAPACITY, "address", "evidence_status"], ["source_system"])


@query("a17_conflict_rate", """SELECT field, COUNT(*) AS comparisons, COUNT(*) FILTER (WHERE verdict = 'CONFLICT') AS conflicts,
    CAST(ROUND(CAST(COUNT(*) FILTER (WHERE verdict = 'CONFLICT') / COUNT(*)::DOUBLE AS DECIMAL(28,10)), 4) AS DOUBLE) AS conflict_rate FROM evidence GROUP BY field""")
def conflict_rate(d):
    return kpi.conflict_rate(evidence.evidence(d.wide), ["field"])


@query("a18_duplicate_rate", """SELECT COUNT(*) AS rows, COUNT(DISTINCT l_partkey) AS distinct_keys,
    CAST(ROUND(CAST(1 - CAST(COUNT(DISTINCT l_partkey) AS DOUBLE) / COUNT(*) AS DECIMAL(28,10)), 4) AS DOUBLE) AS duplicate_rate FROM lineitem""")
def duplicate_rate(d):
    return kpi.duplicate_rate(d.table("lineitem"), "l_partkey")


@query("a26_series_summary", "SELECT COUNT(*) AS rows, STRFTIME(MIN(ts), '%Y-%m-%d') AS first, STRFTIME(MAX(ts), '%Y-%m-%d') AS last, COUNT(DISTINCT series) AS sources, ROUND(AVG(value), 6) AS avg_value FROM telemetry")
def series_summary(d):
    out = profile.series_summary(d.telemetry, "ts", "series", ["value"])
    return out.withColumns({"first": F.to_date("first").cast("string"), "last": F.to_date("last").cast("string"), "avg_value": F.round("avg_value", 6)})


@query("t5_first_violators", "SELECT p_name FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING COUNT(DISTINCT p_brand) > 1 ORDER BY p_name LIMIT 10")
def first_violators(d):
    return profile.first_violators(d.table("part"), "p_name", "p_brand")


@query("w4_first_record", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem QUALIFY ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1")
def first_record(d):
    lines = d.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return align.first_record(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])


# Constraints -------------------------------------------------------------------------------------------

SUMMARY_SQL = "SELECT source_system, rule_name, rule_type, COUNT(*) AS failures FROM ({}) GROUP BY ALL"


@query("c1_c12_unique_keys", """
    SELECT 'lineitem' AS source_system, l_orderkey || '|' || l_linenumber AS source_record_id, 'l_orderkey_l_linenumber_unique' AS rule_name, 'unique' AS rule_type, FALSE AS passed, COUNT(*) || ' rows' AS details
      FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1
    UNION ALL SELECT 'part', p_name, 'p_name_unique', 'unique', FALSE, COUNT(*) || ' rows' FROM part GROUP BY p_name HAVING COUNT(*) > 1""")
def unique_keys(d):
    return quality.check_unique(d.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]).unionByName(
        quality.check_unique(d.table("part"), "part", ["p_name"]))


@query("c2_c3_c4_c6_row_rules", """
    SELECT 'erp' AS source_system, 'project_reference_not_null' AS rule_name, 'not_null' AS rule_type, COUNT(*) AS failures FROM erp WHERE project_reference IS NULL
    UNION ALL SELECT 'erp', 'installed_capacity_range', 'range', COUNT(*) FROM erp WHERE installed_capacity NOT BETWEEN 0 AND 15
    UNION ALL SELECT 'erp', 'record_status_domain', 'domain', COUNT(*) FROM erp WHERE record_status NOT IN ('ACTIVE', 'PENDING')""")
def row_rules(d):
    rules = [quality.not_null("project_reference"), quality.positive("installed_capacity"), quality.in_range("installed_capacity", 0.0, 15.0),
             quality.in_domain("record_status", ["ACTIVE", "PENDING"])]
    return quality.summary(quality.check_rows(d.erp, "erp", "ord", rules))


@query("c2_row_rule_results", """
    SELECT 'erp' AS source_system, CAST(ord AS VARCHAR) AS source_record_id, 'project_reference_not_null' AS rule_name, 'not_null' AS rule_type, project_reference IS NOT NULL AS passed, 'null' AS details FROM erp""")
def row_rule_results(d):
    return quality.check_rows(d.erp, "erp", "ord", [quality.not_null("project_reference")], failures_only=False)


@query("c5_j15_references", """
    SELECT 'erp' AS source_system, project_reference AS source_record_id, 'project_reference_reference' AS rule_name, 'foreign_key' AS rule_type, FALSE AS passed, '1 rows' AS details
    FROM erp WHERE project_reference IS NOT NULL AND project_reference NOT IN (SELECT external_reference FROM partner WHERE capacity IS NOT NULL)""")
def references(d):
    parents = d.partner.where(F.col("capacity").isNotNull())
    return quality.check_reference(d.erp, "erp", "project_reference", parents, "external_reference")


@query("c7_null_columns", """SELECT "column", missing FROM (SELECT UNNEST(['customer', 'installed_capacity', 'region']) AS "column",
    UNNEST([COUNT(*) - COUNT(customer), COUNT(*) - COUNT(installed_capacity), COUNT(*) - COUNT(region)]) AS missing FROM erp) WHERE missing > 0""")
def null_columns(d):
    return profile.missing_cells(d.erp, ["customer", "installed_capacity", "region"]).where("missing > 0").select("column", "missing")


@query("c9_required_columns", "SELECT 'erp' AS source_system, 'address' AS column, COUNT(*) AS rows FROM erp")
def required_columns(d):
    missing = quality.required_columns(d.erp, [*policy.REQUIRED_COLUMNS["erp"], "address"])
    return d.erp.agg(F.count("*").alias("rows")).select(F.lit("erp").alias("source_system"), F.explode(F.array(*[F.lit(c) for c in missing])).alias("column"), "rows")


@query("c10_dependencies", """
    SELECT 'part' AS source_system, p_name AS source_record_id, 'p_name_determines_p_brand' AS rule_name, 'functional_dependency' AS rule_type, FALSE AS passed, 'several values' AS details FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_brand) > 1
    UNION ALL SELECT 'part', p_name, 'p_name_determines_p_type', 'functional_dependency', FALSE, 'several values' FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_type) > 1""")
def dependencies(d):
    return quality.check_dependency(d.table("part"), "part", "p_name", ["p_brand", "p_type"])


@query("c11_declared_types", """
    SELECT 'crm' AS source_system, 'state_length' AS rule_name, 'length' AS rule_type, COUNT(*) AS failures FROM crm WHERE LENGTH(state) > 7 HAVING COUNT(*) > 0
    UNION ALL SELECT 'crm', 'address_type', 'type', COUNT(*) FROM crm WHERE address IS NOT NULL AND TRY_CAST(address AS DOUBLE) IS NULL""")
def declared_types(d):
    rules = [quality.max_length("state", 7), quality.max_length("project_id", 50), quality.has_type("address", "double")]
    return quality.summary(quality.check_rows(d.crm, "crm", "project_id", rules))


def _parts(d):
    p = d.table("part")
    return p.withColumn("p_brand", F.when(F.col("p_partkey") % 17 != 0, F.col("p_brand")))


PART_CTE = "(SELECT p_partkey, p_name, CASE WHEN p_partkey % 17 <> 0 THEN p_brand END AS p_brand FROM part)"


@query("c13_j14_mode_repair", f"""
    SELECT p_partkey, p_name, COALESCE(p_brand, mode) AS p_brand FROM {PART_CTE} x LEFT JOIN (SELECT p_name AS g, p_brand AS mode FROM
      (SELECT p_name, p_brand, COUNT(*) AS n FROM {PART_CTE} WHERE p_brand IS NOT NULL GROUP BY ALL) QUALIFY ROW_NUMBER() OVER (PARTITION BY p_name ORDER BY n DESC, p_brand) = 1) m ON m.g = x.p_name""")
def mode_repair(d):
    return profile.fill_with_mode(_parts(d), "p_name", "p_brand").select("p_partkey", "p_name", "p_brand")


@query("c13_repair_effect", f"""
    SELECT 'before' AS stage, COUNT(*) FILTER (WHERE n > 1) AS violating_entities, COUNT(*) AS total_entities, SUM(nulls)::BIGINT AS missing FROM (SELECT p_name, COUNT(DISTINCT p_brand) AS n, COUNT(*) - COUNT(p_brand) AS nulls FROM {PART_CTE} GROUP BY 1)
    UNION ALL SELECT 'after', COUNT(*) FILTER (WHERE n > 1), COUNT(*), 0 FROM (SELECT p_name, COUNT(DISTINCT p_brand) AS n FROM {PART_CTE} GROUP BY 1)""")
def repair_effect(d):
    def measured(df, stage):
        groups = profile.dependency_violations(df, "p_name", "p_brand")
        missing = df.agg(F.count_if(F.col("p_brand").isNull())).scalar()
        return groups.select(F.lit(stage).alias("stage"), "violating_entities", "total_entities", missing.alias("missing"))

    before = _parts(d)
    return measured(before, "before").unionByName(measured(profile.fill_with_mode(before, "p_name", "p_brand"), "after"))


# Perturbation ------------------------------------------------------------------------------------------

CELLS = ["customer_name", "installer", "address", "city", "status", CAPACITY, "state", "postcode", "install_day"]


def _cell(i: int, digest: str) -> str:
    return f"CAST('0x' || SUBSTR({digest}{i // 8}, {4 * (i % 8) + 1}, 4) AS INTEGER)"


def _kind(i: int) -> str:
    cut = int(0.05 / len(CELLS) * 65536)
    return f"CASE WHEN {_cell(i, 'w')} < {cut} THEN ['text_formatting','numeric_drift','missing','status_variant'][{_cell(i, 'h')} % 4 + 1] END"


def _new(i: int, c: str) -> str:
    rest = f"({_cell(i, 'h')} // 4)"
    if c == CAPACITY:
        return f"CASE {_kind(i)} WHEN 'numeric_drift' THEN {c} * (0.8e0 + 0.4e0 * ({rest} % 1000) / 1000) WHEN 'missing' THEN NULL ELSE {c} END"
    variant = (f"CASE {c} WHEN 'Completed' THEN ['Complete','COMPLETED','completed'][{rest} % 3 + 1] WHEN 'In Progress' THEN ['In Progress','IN PROGRESS','in progress'][{rest} % 3 + 1] "
               f"WHEN 'Pending' THEN ['Pending','PENDING','pending'][{rest} % 3 + 1] WHEN 'On Hold' THEN ['On Hold','ON HOLD','on hold'][{rest} % 3 + 1] ELSE {c} END")
    return (f"CASE {_kind(i)} WHEN 'text_formatting' THEN CASE WHEN {rest} % 2 = 0 THEN UPPER({c}) ELSE LOWER({c}) END WHEN 'missing' THEN NULL "
            f"WHEN 'status_variant' THEN {variant} ELSE {c} END")


DIGESTS = ("(SELECT *, CAST(install_date AS VARCHAR) AS install_day, MD5('42|' || project_id) AS w0, MD5('43|' || project_id) AS h0, MD5('44|' || project_id) AS w1, "
           "MD5('45|' || project_id) AS h1 FROM master)")
LOG_SQL = " UNION ALL ".join(
    f"SELECT 'crm' AS source, project_id AS record_id, '{c}' AS field, {f'CAST(ROUND({c}, 6) AS VARCHAR)' if c == CAPACITY else c} AS old_value, "
    f"{f'CAST(ROUND({_new(i, c)}, 6) AS VARCHAR)' if c == CAPACITY else _new(i, c)} AS new_value, {_kind(i)} AS corruption_type FROM {DIGESTS} WHERE {_kind(i)} IS NOT NULL"
    for i, c in enumerate(CELLS))


def _plan(d):
    master = d.master.withColumn("install_day", F.col("install_date").cast("string"))
    return perturb.corruption_plan(master.select("project_id", *CELLS), "project_id", CELLS)


@query("x1_corrupted_cells", f"SELECT project_id, {', '.join(f'ROUND({_new(i, c)}, 6) AS {c}' if c == CAPACITY else f'{_new(i, c)} AS {c}' for i, c in enumerate(CELLS))} FROM {DIGESTS}")
def corrupted_cells(d):
    return perturb.corrupted(_plan(d), CELLS).withColumn(CAPACITY, F.round(CAPACITY, 6))


@query("x2_corruption_log", LOG_SQL)
def corruption_log(d):
    log = perturb.corruption_log(_plan(d), "crm", "project_id", CELLS)
    size = F.col("field") == CAPACITY
    return log.withColumns({c: F.when(size, F.round(F.col(c).try_cast("double"), 6).cast("string")).otherwise(F.col(c)) for c in ("old_value", "new_value")})


@query("x3_effective_corruption", f"SELECT source, corruption_type, COUNT(*) AS operations, COUNT(*) FILTER (WHERE old_value IS NOT DISTINCT FROM new_value) AS no_ops FROM ({LOG_SQL}) GROUP BY ALL")
def effective_corruption(d):
    return perturb.effective_corruption(perturb.corruption_log(_plan(d), "crm", "project_id", CELLS))
