"""SQL (DuckDB dialect) counterparts of the derived tables, for checking results.

``compose`` puts the common table expressions a query needs in front of it.
"""

from __future__ import annotations

import re

from accordant import policy
from accordant.operators.cases import LEGAL
from accordant.operators.explain import CLARIFICATIONS, DEFAULT_CLARIFICATION, NOTHING_FOUND
from accordant.plans.domain import AS_OF
from accordant.plans.model_sql import linear_sql, newton_sql


def rnd(x: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def norm(x: str) -> str:
    return f"COALESCE(LOWER(REGEXP_REPLACE({x}, '^\\s+|\\s+$', '', 'g')), '')"


def norm_ev(x: str) -> str:
    return f"NULLIF(LOWER(TRIM(REGEXP_REPLACE({x}, '\\s+', ' ', 'g'))), '')"


def pair_key(sa: str, ra: str, sb: str, rb: str) -> str:
    return f"'PAIR-' || UPPER(MD5({sa} || '|' || {ra} || '|' || {sb} || '|' || {rb}))"


def hash_int(x: str, seed: int, modulus: int) -> str:
    return f"(CAST('0x' || SUBSTR(MD5('{seed}|' || {x}), 1, 7) AS BIGINT) % {modulus})"


def case_of(x: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {x} = '{k}' THEN '{v}'" if isinstance(v, str) else f"WHEN {x} = '{k}' THEN {v}"
                     for k, v in mapping.items())
    return f"CASE {whens} ELSE {default} END"


def jw(a: str, b: str) -> str:
    """Jaro-Winkler of two normalised columns with the prefix bonus at every level."""
    shared = " ".join(
        f"WHEN LENGTH({a}) >= {n} AND LENGTH({b}) >= {n} AND SUBSTR({a},1,{n}) = SUBSTR({b},1,{n}) THEN {n}"
        for n in (4, 3, 2, 1))
    return (f"CASE WHEN {a} = '' OR {b} = '' THEN 0.0 WHEN {a} = {b} THEN 1.0 ELSE JARO_SIMILARITY({a}, {b}) + "
            f"(CASE {shared} ELSE 0 END) * 0.1e0 * (1 - JARO_SIMILARITY({a}, {b})) END")


def _in(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def fixed(x: str, digits: int) -> str:
    return f"CAST(CAST(ROUND(CAST({x} AS DECIMAL(28,10)), {digits}) AS DECIMAL(28,{digits})) AS VARCHAR)"


def blank(x: str) -> str:
    return f"({x} IS NULL OR TRIM({x}) IN ({_in(policy.BLANK_TEXTS)}))"


STREETS = "['Harbor','Juniper','Quarry','Sunset','Willow']"
WAYS = "['Court','Lane','Road','Street','Way']"
STATUSES = "['Completed','In Progress','Pending','On Hold']"

PROBABILITY = rnd(linear_sql(policy.FEATURES), 4)

#: Which side of the entity split an entity is on.
TRAIN_SIDE = f"{hash_int('{}', 42, 1000)} < 700"


def _low(column: str, label: str) -> str:
    return f"CASE WHEN {column} < 0.8 THEN '{label}: ' || {fixed(column, 2)} END"


SUMMARY = f"""COALESCE(NULLIF(CONCAT_WS('; ', {_low('customer_similarity', 'Customer name similarity')},
  {_low('installer_similarity', 'Installer similarity')}, {_low('address_similarity', 'Address similarity')},
  CASE WHEN capacity_diff > 0 THEN 'Capacity difference: ' || {fixed('capacity_diff', 1)} || ' kW' END,
  CASE WHEN status_match = 0 THEN 'Status mismatch detected' END), ''), '{NOTHING_FOUND}')"""

CTES: dict[str, str] = {
    "master": f"""
      SELECT 'PRJ-' || CASE WHEN LENGTH(CAST(o_orderkey AS VARCHAR)) < 8 THEN LPAD(CAST(o_orderkey AS VARCHAR), 8, '0')
                       ELSE CAST(o_orderkey AS VARCHAR) END AS project_id,
        c_name AS customer_name, s_name AS installer, ROUND(3 + (o_orderkey % 121) / 10e0, 1) AS system_size_kw,
        CAST(100 + o_orderkey % 9900 AS VARCHAR) || ' ' || {STREETS}[o_orderkey % 5 + 1] || ' ' || {WAYS}[o_orderkey % 7 % 5 + 1] AS address,
        n_name AS city, r_name AS state, CAST(10000 + o_orderkey % 89999 AS VARCHAR) AS postcode,
        {STATUSES}[o_orderkey % 7 % 4 + 1] AS status, CAST(o_orderdate AS DATE) AS install_date,
        o_orderdate + TO_SECONDS(o_orderkey % 86400) AS updated_at, o_orderkey AS ord
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey JOIN supplier ON s_suppkey = o_orderkey % (SELECT COUNT(*) FROM supplier)""",
    "crm": """
      SELECT project_id, CASE WHEN ord % 40 <> 33 THEN customer_name END AS customer_name, installer, system_size_kw, address,
        CASE WHEN ord % 50 <> 29 THEN city END AS city, state,
        CASE WHEN ord % 25 = 13 THEN UPPER(status) ELSE status END AS status, updated_at, ord FROM master""",
    "erp": f"""
      SELECT customer_name AS customer_ref, CASE WHEN ord % 50 <> 13 THEN project_id END AS project_reference,
        CASE WHEN ord % 20 = 3 THEN UPPER(customer_name) WHEN ord % 33 <> 5 THEN customer_name END AS customer,
        CASE WHEN ord % 20 = 7 THEN system_size_kw * 1.2e0 WHEN ord % 20 <> 11 THEN system_size_kw END AS installed_capacity,
        state AS region, {case_of('status', policy.ERP_STATUS)} AS record_status, ord FROM master""",
    "partner": """
      SELECT project_id AS external_reference,
        CASE WHEN ord % 20 = 9 THEN REPLACE(installer, '#', '-') WHEN ord % 60 = 41 THEN 'Alt ' || installer ELSE installer END AS installer_name,
        CASE WHEN ord % 40 = 11 THEN NULL WHEN ord % 30 = 17 THEN system_size_kw + 1.5e0 ELSE system_size_kw END AS capacity,
        CASE WHEN ord % 45 = 22 THEN LOWER(address) WHEN ord % 70 <> 31 THEN address END AS site_address,
        status AS completion_status, ord FROM master""",
    "document": f"""
      SELECT 'ENV-' || UPPER(SUBSTR(MD5(project_id), 1, 12)) AS envelope_reference, project_id AS project_reference,
        {case_of('status', policy.SIGNING_STATUS)} AS signing_status, install_date AS signed_date,
        'solar_Agreement_' || project_id || '.pdf' AS document_name, ord FROM master""",
    "records": """
      SELECT 'crm' AS source_system, project_id AS record_id, customer_name, installer, address, city, state, system_size_kw,
        status, status AS evidence_status, ord FROM crm
      UNION ALL SELECT 'erp', project_reference, customer, NULL, NULL, NULL, region, installed_capacity, record_status, record_status, ord FROM erp
      UNION ALL SELECT 'partner', external_reference, NULL, installer_name, site_address, NULL, NULL, capacity, completion_status, completion_status, ord FROM partner
      UNION ALL SELECT 'document', project_reference, NULL, NULL, NULL, NULL, NULL, NULL, NULL, signing_status, ord FROM document""",
    "wide": """
      SELECT m.project_id, c.customer_name AS customer_name_crm, e.customer AS customer_name_erp, c.installer AS installer_crm,
        p.installer_name AS installer_partner, c.system_size_kw AS system_size_kw_crm, e.installed_capacity AS system_size_kw_erp,
        p.capacity AS system_size_kw_partner, c.address AS address_crm, p.site_address AS address_partner, c.status AS status_crm,
        e.record_status AS status_erp, p.completion_status AS status_partner, d.signing_status AS status_document,
        c.project_id IS NOT NULL AS in_crm, e.project_reference IS NOT NULL AS in_erp,
        p.external_reference IS NOT NULL AS in_partner, d.project_reference IS NOT NULL AS in_document
      FROM master m LEFT JOIN crm c ON c.project_id = m.project_id LEFT JOIN erp e ON e.project_reference = m.project_id
      LEFT JOIN partner p ON p.external_reference = m.project_id LEFT JOIN document d ON d.project_reference = m.project_id""",
    "field_values": """
      SELECT project_id, 'customer_name' AS field, customer_name_crm AS crm, customer_name_erp AS erp, CAST(NULL AS VARCHAR) AS partner, CAST(NULL AS VARCHAR) AS document FROM wide
      UNION ALL SELECT project_id, 'installer', installer_crm, NULL, installer_partner, NULL FROM wide
      UNION ALL SELECT project_id, 'system_size_kw', CAST(system_size_kw_crm AS VARCHAR), CAST(system_size_kw_erp AS VARCHAR), CAST(system_size_kw_partner AS VARCHAR), NULL FROM wide
      UNION ALL SELECT project_id, 'address', address_crm, NULL, address_partner, NULL FROM wide
      UNION ALL SELECT project_id, 'status', status_crm, status_erp, status_partner, status_document FROM wide""",
    "unpivoted": f"""
      SELECT project_id, field, src, rank, value, {norm_ev('value')} AS n, TRY_CAST(REPLACE(TRIM(value), ',', '') AS DOUBLE) AS num
      FROM (SELECT project_id, field, 'crm' AS src, 2 AS rank, crm AS value FROM field_values
            UNION ALL SELECT project_id, field, 'erp', 3, erp FROM field_values
            UNION ALL SELECT project_id, field, 'partner', 4, partner FROM field_values
            UNION ALL SELECT project_id, field, 'signed_document', 1, document FROM field_values)""",
    "folded": f"""
      SELECT project_id, field, COUNT(n) AS known, COUNT(num) AS known_num, MAX(num) - MIN(num) AS spread,
        COUNT(DISTINCT n) AS texts, COUNT(DISTINCT REGEXP_REPLACE(n, '[^a-z0-9]', '', 'g')) AS cores,
        COUNT(DISTINCT CASE WHEN n IN ('completed','active','signed') THEN '0' WHEN n IN ('in progress','pending','pending_signature') THEN '1'
          WHEN n IN ('not_sent') THEN '2' WHEN n IN ('on hold','suspended','declined') THEN '3' ELSE n END) AS groups,
        MIN_BY(src, rank) FILTER (WHERE NOT {blank('value')}) AS authority_source,
        MIN_BY(TRIM(value), rank) FILTER (WHERE NOT {blank('value')}) AS authority_value
      FROM unpivoted GROUP BY project_id, field""",
    "evidence": f"""
      SELECT *, {case_of('verdict', policy.SEVERITY_OF_VERDICT)} AS severity, {case_of('field', policy.CATEGORY_OF_FIELD)} AS category,
        CASE WHEN known < 2 OR (field = 'system_size_kw' AND known_num < 2) THEN 'fewer than two sources report this field'
          WHEN field = 'system_size_kw' AND verdict = 'MATCH' THEN 'max spread ' || {fixed('spread', 2)} || ' within tolerance 1.0'
          WHEN field = 'system_size_kw' AND verdict = 'CONFLICT' THEN 'max spread ' || {fixed('spread', 2)} || ' exceeds review limit 2.0'
          WHEN field = 'system_size_kw' THEN 'max spread ' || {fixed('spread', 2)} || ' inside grey zone (1.0, 2.0]'
          WHEN field = 'status' AND verdict = 'MATCH' THEN 'same status group across sources'
          WHEN field = 'status' THEN CAST(groups AS VARCHAR) || ' distinct status groups'
          WHEN verdict = 'MATCH' THEN 'identical after normalization'
          WHEN verdict = 'FORMAT' THEN 'same content, different formatting'
          ELSE CAST(texts AS VARCHAR) || ' distinct normalized values' END AS detail
      FROM (SELECT *, CASE
          WHEN field = 'system_size_kw' THEN CASE WHEN known_num < 2 THEN 'MISSING' WHEN spread <= 1.0 THEN 'MATCH' WHEN spread > 2.0 THEN 'CONFLICT' ELSE 'REVIEW' END
          WHEN field = 'status' THEN CASE WHEN known < 2 THEN 'MISSING' WHEN groups = 1 THEN 'MATCH' ELSE 'CONFLICT' END
          WHEN known < 2 THEN 'MISSING' WHEN texts = 1 THEN 'MATCH' WHEN cores = 1 THEN 'FORMAT' ELSE 'CONFLICT' END AS verdict FROM folded)""",
    "held": """
      SELECT m.project_id, c.project_id IS NOT NULL AS crm, e.project_reference IS NOT NULL AS erp,
        p.external_reference IS NOT NULL AS partner, d.project_reference IS NOT NULL AS document, m.customer_name, m.installer, m.address
      FROM master m LEFT JOIN crm c ON c.project_id = m.project_id LEFT JOIN erp e ON e.project_reference = m.project_id
      LEFT JOIN partner p ON p.external_reference = m.project_id LEFT JOIN document d ON d.project_reference = m.project_id""",
    "positives": f"""
      SELECT {pair_key('source_a', 'project_id', 'source_b', 'project_id')} AS pair_id, source_a, source_b, project_id AS record_a_id,
        project_id AS record_b_id, project_id AS master_id_a, project_id AS master_id_b, 1 AS label
      FROM ({" UNION ALL ".join(f"SELECT project_id, '{a}' AS source_a, '{b}' AS source_b FROM held WHERE {a} AND {b}"
            for a, b in [('crm', 'erp'), ('crm', 'partner'), ('crm', 'document'), ('erp', 'partner'), ('erp', 'document'), ('partner', 'document')])})""",
    "negatives": f"""
      SELECT {pair_key('source_a', 'a', 'source_b', 'b')} AS pair_id, source_a, source_b, a AS record_a_id, b AS record_b_id,
        a AS master_id_a, b AS master_id_b, 0 AS label
      FROM (SELECT x.project_id AS a, y.project_id AS b, x.crm AS a_crm, x.erp AS a_erp, x.partner AS a_partner, x.document AS a_document,
              y.crm AS b_crm, y.erp AS b_erp, y.partner AS b_partner, y.document AS b_document,
              ['crm','erp','partner','document'][s1 + 1] AS source_a, ['crm','erp','partner','document'][s2 + 1] AS source_b
            FROM (SELECT *, {hash_int("project_id || '|' || nxt", 42, 4)} AS s1,
                    ({hash_int("project_id || '|' || nxt", 42, 4)} + 1 + {hash_int("project_id || '|' || nxt", 43, 3)}) % 4 AS s2
                  FROM (SELECT *, LEAD(project_id) OVER (ORDER BY MD5('42|' || project_id), project_id) AS nxt FROM held)) x
            JOIN held y ON y.project_id = x.nxt)
      WHERE {" AND ".join("(" + " OR ".join(f"(source_{s} = '{n}' AND {s}_{n})" for n in policy.SOURCES) + ")" for s in "ab")}""",
    "pairs": "SELECT * FROM positives UNION ALL SELECT * FROM negatives",
    "normed": f"""
      SELECT source_system, record_id, {norm('customer_name')} AS customer, {norm('installer')} AS installer, {norm('address')} AS address,
        {norm('city')} AS city, {norm('state')} AS state, system_size_kw AS size, {norm('status')} AS status
      FROM records WHERE record_id IS NOT NULL""",
    "features": f"""
      SELECT pair_id, {jw('a.customer', 'b.customer')} AS customer_similarity, {jw('a.installer', 'b.installer')} AS installer_similarity,
        {jw('a.address', 'b.address')} AS address_similarity, CASE WHEN a.city = b.city THEN 1e0 ELSE 0e0 END AS city_match,
        CASE WHEN a.state = b.state THEN 1e0 ELSE 0e0 END AS state_match, COALESCE(ABS(a.size - b.size), 0e0) AS capacity_diff,
        CASE WHEN a.status = b.status THEN 1e0 ELSE 0e0 END AS status_match, label
      FROM pairs p JOIN normed a ON a.source_system = p.source_a AND a.record_id = p.record_a_id
      JOIN normed b ON b.source_system = p.source_b AND b.record_id = p.record_b_id""",
    "entity_train": f"""
      SELECT f.* FROM features f JOIN pairs p ON p.pair_id = f.pair_id WHERE {TRAIN_SIDE.format('p.master_id_a')} AND {TRAIN_SIDE.format('p.master_id_b')}""",
    "matcher": newton_sql("entity_train", policy.FEATURES),
    "explained": f"""
      SELECT *, {case_of('classification', CLARIFICATIONS, f"'{DEFAULT_CLARIFICATION}'")} AS clarification, {SUMMARY} AS summary
      FROM (SELECT *, CASE WHEN customer_similarity < 0.5 THEN 'ENTITY_MISMATCH' WHEN capacity_diff > 2.0 THEN 'NUMERIC_CONFLICT'
          WHEN status_match = 0 THEN 'STATUS_CONFLICT' WHEN address_similarity < 0.7 THEN 'FORMATTING_DIFFERENCE'
          WHEN installer_similarity < 0.7 THEN 'POTENTIAL_DUPLICATE' ELSE 'OTHER' END AS classification FROM features)""",
    "queue": f"""
      SELECT *, CASE WHEN match_probability >= 0.9 THEN 'AUTO_MATCH' WHEN match_probability < 0.3 THEN 'NON_MATCH' ELSE 'MANUAL_REVIEW' END AS route,
        {rnd('0.5 - ABS(match_probability - 0.5)', 4)} AS uncertainty
      FROM (SELECT p.source_a, p.source_b, p.record_a_id, p.record_b_id, p.master_id_a, p.master_id_b, e.*, {PROBABILITY} AS match_probability
            FROM matcher m, pairs p LEFT JOIN explained e ON e.pair_id = p.pair_id)""",
    "enriched": f"""
      SELECT q.*, COALESCE(c.status, 'NEW') AS case_status, COALESCE({rnd('c.age_hours / 24', 1)}, 0e0) AS age_days,
        {case_of('classification', policy.SEVERITY_OF_CLASS, "'LOW'")} AS severity, COALESCE(c.sla_breach, FALSE) AS sla_breach,
        {rnd(f"10e0 * ({case_of('classification', {k: policy.SEVERITY_SCORE[v] for k, v in policy.SEVERITY_OF_CLASS.items()}, '1')}) + 5e0 * uncertainty + 0.5e0 * COALESCE({rnd('c.age_hours / 24', 1)}, 0e0)", 2)} AS priority
      FROM queue q LEFT JOIN aged c ON c.case_id = q.pair_id""",
    "telemetry": "SELECT event_id AS point_id, event_type AS series, ts, value FROM events",
    "windows": """
      SELECT series, d0 + TO_HOURS(w[1]) AS "start", d0 + TO_HOURS(w[2]) AS "end"
      FROM (SELECT series, DATE_TRUNC('day', MIN(ts))::TIMESTAMP AS d0 FROM telemetry GROUP BY series),
        (SELECT UNNEST([[72, 84], [80, 110], [240, 252], [480, 530]]) AS w)""",
    "labelled": """
      SELECT t.*, CAST(EXISTS (SELECT 1 FROM windows w WHERE w.series = t.series AND t.ts BETWEEN w."start" AND w."end") AS INTEGER) AS label
      FROM telemetry t""",
    "fences": """
      SELECT series, q[2] - 1.5e0 * (q[3] - q[2]) AS iqr_low, q[3] + 1.5e0 * (q[3] - q[2]) AS iqr_high, q[1] AS pct_low, q[4] AS pct_high, mean, std
      FROM (SELECT series, QUANTILE_CONT(value, [0.01, 0.25, 0.75, 0.99]) AS q, AVG(value) AS mean, STDDEV_SAMP(value) AS std FROM telemetry GROUP BY series)""",
    "flags": """
      SELECT t.*, value < iqr_low OR value > iqr_high AS iqr, ABS((value - mean) / std) > 3 AS zscore, value < pct_low OR value > pct_high AS percentile
      FROM telemetry t JOIN fences f ON f.series = t.series""",
    "mad": """
      SELECT *, 0.6745e0 * (value - center) / (mad + 1e-10) AS score, ABS(0.6745e0 * (value - center) / (mad + 1e-10)) > 3.5 AS rolling_mad
      FROM (SELECT *, MEDIAN(ABS(value - center)) OVER (PARTITION BY series ORDER BY ts, point_id ROWS BETWEEN 48 PRECEDING AND 47 FOLLOWING) AS mad
        FROM (SELECT *, MEDIAN(value) OVER (PARTITION BY series ORDER BY ts, point_id ROWS BETWEEN 48 PRECEDING AND 47 FOLLOWING) AS center FROM telemetry))""",
    "case_source": f"""
      SELECT {pair_key("'crm'", 'project_id', "'partner'", 'project_id')} AS case_id, * FROM (
        SELECT 'PRJ-' || CASE WHEN LENGTH(CAST(user_id * 31 + DAY(ts) AS VARCHAR)) < 8 THEN LPAD(CAST(user_id * 31 + DAY(ts) AS VARCHAR), 8, '0')
            ELSE CAST(user_id * 31 + DAY(ts) AS VARCHAR) END AS project_id,
          ts AS "at", event_id AS seq, event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "case_events": """
      SELECT case_id, "at", seq, CASE event_type WHEN 'view' THEN 'IN_REVIEW' WHEN 'click' THEN 'WAITING_CLARIFICATION' WHEN 'purchase' THEN 'RESOLVED'
          WHEN 'error' THEN 'REJECTED' ELSE 'REOPENED' END AS "to", 'reviewer_' || (k % 5) AS actor,
        ROW_NUMBER() OVER (PARTITION BY case_id ORDER BY "at", seq) AS n FROM case_source""",
    "opened": """SELECT case_id, ANY_VALUE(project_id) AS project_id, DATE_TRUNC('day', MIN("at"))::TIMESTAMP AS created_at FROM case_source GROUP BY case_id""",
    "replay": f"""
      SELECT case_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS VARCHAR) AS from_status, 'NEW' AS state, CAST(NULL AS TIMESTAMP) AS "at",
        CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS "to", CAST(NULL AS VARCHAR) AS actor, FALSE AS accepted FROM opened
      UNION ALL
      SELECT e.case_id, e.n, r.state, CASE WHEN r.state || '>' || e."to" IN ({_in(LEGAL)}) THEN e."to" ELSE r.state END,
        e."at", e.seq, e."to", e.actor, r.state || '>' || e."to" IN ({_in(LEGAL)})
      FROM replay r JOIN case_events e ON e.case_id = r.case_id AND e.n = r.n + 1""",
    "annotated": """
      SELECT case_id, n, "at", seq, "to", actor, from_status, CASE WHEN accepted THEN 'accepted' WHEN from_status = "to" THEN 'ignored' ELSE 'rejected' END AS outcome
      FROM replay WHERE n > 0""",
    "cases": f"""
      SELECT o.case_id, f.status, f.assigned_to, o.created_at, f.started_at,
        CASE WHEN f.status IN ({_in(policy.TERMINAL_STATUSES)}) THEN f.closed END AS resolved_at, f.moves + 1 AS history_rows, f.rejected_events
      FROM opened o JOIN (SELECT case_id, MAX_BY(state, n) AS status, MAX_BY(actor, n) FILTER (WHERE accepted) AS assigned_to,
          MIN("at") FILTER (WHERE accepted AND "to" = 'IN_REVIEW') AS started_at,
          MAX("at") FILTER (WHERE accepted AND "to" IN ('RESOLVED', 'REJECTED')) AS closed, COUNT(*) FILTER (WHERE accepted) AS moves,
          COUNT(*) FILTER (WHERE n > 0 AND NOT accepted AND from_status <> "to") AS rejected_events
        FROM replay GROUP BY case_id) f ON f.case_id = o.case_id""",
    "aged": f"""
      SELECT *, status NOT IN ({_in(policy.TERMINAL_STATUSES)}) AND age_hours > 72 AS sla_breach
      FROM (SELECT *, GREATEST(0e0, DATE_DIFF('microsecond', created_at, CASE WHEN status IN ({_in(policy.TERMINAL_STATUSES)}) THEN resolved_at
          ELSE TIMESTAMP '{AS_OF}' END) / 3.6e9) AS age_hours FROM cases)""",
    "decisions": f"""
      SELECT case_id AS pair_id, "at", seq, CASE WHEN seq % 41 = 0 THEN '  ' ELSE 'reviewer_00' || (k % 5) END AS reviewer_id,
        CASE event_type WHEN 'purchase' THEN 'MATCH' WHEN 'error' THEN 'NON_MATCH' ELSE 'CLARIFICATION' END AS decision,
        [{_in(policy.REASON_CODES)}, 'UNKNOWN', NULL][k % 9 + 1] AS reason_code, CASE WHEN seq % 37 = 0 THEN '' ELSE 'event ' || seq END AS reason,
        '' AS comment, 'v1.0' AS model_version FROM case_source""",
    "reviews": """
      SELECT case_id, 'qa_001' AS qa_reviewer, CASE k % 10 WHEN 0 THEN 'DISAGREE' WHEN 1 THEN 'MAYBE' ELSE 'AGREE' END AS verdict,
        CASE WHEN seq % 2 = 0 THEN 'checked again' ELSE '' END AS note, 'v1.0' AS model_version
      FROM (SELECT case_id, MIN(seq) AS seq, MAX(k) AS k FROM case_source WHERE event_type = 'purchase' GROUP BY case_id)""",
    "corrections": """
      SELECT c.case_id, e.project_id, e.field, e.crm AS old_value, e.authority_value AS new_value, e.authority_source, 'reviewer' AS proposed_by
      FROM cases c JOIN opened o ON o.case_id = c.case_id JOIN (SELECT e.*, v.crm FROM evidence e JOIN field_values v
        ON v.project_id = e.project_id AND v.field = e.field) e ON e.project_id = o.project_id
      WHERE c.status = 'RESOLVED' AND e.verdict IN ('CONFLICT', 'REVIEW') AND e.authority_source IS NOT NULL""",
    "text_pairs": """
      SELECT l.doc_id AS id, l.text AS left_title, r.text AS right_title, l.lang AS left_brand, r.lang AS right_brand,
        l.source AS left_category, r.source AS right_category, l.n_chars AS left_price, r.n_chars AS right_price, quality AS label
      FROM documents l JOIN documents r ON r.doc_id = l.doc_id + 1 JOIN labels b ON b.doc_id = l.doc_id""",
    "scored": """
      SELECT *, CAST(score >= 0.5 AS INTEGER) AS prediction FROM (SELECT b.doc_id, lang, quality AS label,
        ROUND(n_chars / (n_chars + 1500e0), 3) AS score FROM labels b JOIN documents d ON d.doc_id = b.doc_id)""",
    "sides": f"""
      SELECT id, 'l' AS side, REGEXP_EXTRACT_ALL(LOWER(left_title), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM text_pairs
      UNION ALL SELECT id, 'r', REGEXP_EXTRACT_ALL(LOWER(right_title), '[\\p{{L}}\\p{{N}}_]{{2,}}') FROM text_pairs""",
    "terms": """
      SELECT id, side, UNNEST(LIST_CONCAT(w, LIST_TRANSFORM(LIST_ZIP(w[1:-2], w[2:]), lambda z: z[1] || ' ' || z[2]))) AS term FROM sides""",
    "vocabulary": """
      SELECT term, df, LN((1 + (SELECT COUNT(*) FROM sides)) / (1 + df)) + 1 AS idf FROM (
        SELECT term, SUM(tf) AS total, COUNT(*) AS df FROM (SELECT id, side, term, COUNT(*) AS tf FROM terms GROUP BY ALL) GROUP BY term
        ORDER BY total DESC, term LIMIT 5000)""",
    "cosine": """
      SELECT p.id, CASE WHEN ll > 0 AND rr > 0 THEN dot / (SQRT(ll) * SQRT(rr)) ELSE 0e0 END AS title_tfidf_cosine FROM text_pairs p LEFT JOIN (
        SELECT id, SUM(l * r) AS dot, SUM(l * l) AS ll, SUM(r * r) AS rr FROM (
          SELECT id, t.term, COUNT(*) FILTER (WHERE side = 'l') * ANY_VALUE(idf) AS l, COUNT(*) FILTER (WHERE side = 'r') * ANY_VALUE(idf) AS r
          FROM terms t JOIN vocabulary v ON v.term = t.term GROUP BY id, t.term) GROUP BY id) c ON c.id = p.id""",
}


#: Expressions that several others read.
STORED = {"features", "matcher", "queue"}


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_]+", sql))
    return [name for name in CTES if name in words and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b|,\s*{name}\b", sql)]


def compose(sql: str) -> str:
    """``sql`` preceded by the expressions it refers to, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in _needs(CTES[name]):
            if needed != name:
                visit(needed)
        ordered.append(name)

    for name in _needs(sql):
        visit(name)
    sql = sql.strip()
    if not ordered:
        return sql
    own = re.match(r"WITH (RECURSIVE )?", sql)  # expressions that the query brings along follow the shared ones
    recursive = "RECURSIVE " if "replay" in ordered or (own and own[1]) else ""
    body = ",\n".join(f"{name} AS {'MATERIALIZED ' * (name in STORED)}({CTES[name].strip()})" for name in ordered)
    return f"WITH {recursive}{body},\n{sql[own.end():]}" if own else f"WITH {recursive}{body}\n{sql}"
