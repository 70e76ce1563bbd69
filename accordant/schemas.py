"""Declared schemas of files and warehouse tables."""

from __future__ import annotations

# Source exports as they arrive in CSV files.
SOURCE_FILES = {
    "crm": "project_id string, customer_name string, installer string, system_size_kw double, address string, "
           "city string, state string, status string, updated_at timestamp",
    "erp": "customer_ref string, project_reference string, customer string, installed_capacity double, region string, "
           "record_status string",
    "partner": "external_reference string, installer_name string, capacity double, site_address string, "
               "completion_status string",
    "document": "envelope_reference string, project_reference string, signing_status string, signed_date date, "
                "document_name string",
}
CASE_FILE = "case_id string, status string, created_at string, resolved_at string"

# Warehouse tables with their declared column types.
WAREHOUSE = {
    "projects": "project_id varchar(50), customer_name varchar(255), installer varchar(255), system_size_kw decimal(10,2), "
                "address varchar(500), city varchar(100), state varchar(10), postcode varchar(10), status varchar(50), "
                "install_date date, updated_at timestamp",
    "source_records": "source_system varchar(50), source_record_id varchar(100), master_project_id varchar(50), "
                      "ingestion_run_id varchar(50), raw_file_reference varchar(500), ingested_at timestamp",
    "entity_matches": "pair_id varchar(50), source_a varchar(50), source_b varchar(50), record_a_id varchar(100), "
                      "record_b_id varchar(100), master_id_a varchar(50), master_id_b varchar(50), label int, "
                      "match_probability decimal(5,4), model_version varchar(50), created_at timestamp",
    "documents": "envelope_reference varchar(100), project_reference varchar(50), signing_status varchar(50), "
                 "signed_date date, document_name varchar(255)",
    "validation_results": "source_system varchar(50), source_record_id varchar(100), rule_name varchar(100), "
                          "rule_type varchar(50), passed boolean, details string, validated_at timestamp",
    "anomalies": "source_system varchar(50), source_record_id varchar(100), anomaly_type varchar(50), "
                 "anomaly_score decimal(10,4), evidence string, reason string, detected_at timestamp",
    "review_queue": "pair_id varchar(50), priority int, project_id varchar(50), source_systems string, "
                    "issue_type varchar(50), match_probability decimal(5,4), anomaly_score decimal(10,4), "
                    "status varchar(50), created_at timestamp",
    "review_decisions": "pair_id varchar(50), reviewer_id varchar(50), decision varchar(50), reason string, "
                        "comment string, model_version varchar(50), timestamp timestamp",
    "model_predictions": "model_name varchar(100), model_version varchar(50), prediction varchar(50), "
                         "probability decimal(5,4), feature_schema_version varchar(50), created_at timestamp",
    "reviewer_feedback": "pair_id varchar(50), model_probability decimal(5,4), anomaly_score decimal(10,4), "
                         "ai_classification varchar(50), reviewer_decision varchar(50), reviewer_reason string, "
                         "reviewer_comment string, timestamp timestamp, model_version varchar(50)",
    "audit_logs": "who varchar(100), what string, when timestamp, why string, model_version varchar(50), "
                  "source_evidence string",
    "model_versions": "model_name varchar(100), model_version varchar(50), training_date date, metrics string, "
                      "status varchar(50), created_at timestamp",
    "ingestion_runs": "run_id varchar(50), source_system varchar(50), file_name varchar(255), rows_processed int, "
                      "rows_successful int, rows_failed int, started_at timestamp, completed_at timestamp, "
                      "status varchar(50)",
}


def columns(table: str) -> list[tuple[str, str]]:
    """(column, type) pairs of a warehouse table."""
    import re

    return [tuple(part.strip().split(" ", 1)) for part in re.split(r",\s+(?=[a-z_]+ )", WAREHOUSE[table])]
