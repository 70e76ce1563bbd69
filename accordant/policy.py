"""Review policy: the values every operator reads instead of repeating numbers.

Fixed values: they have to equal the published policy, word lists and message texts of the
system whose results this library reproduces.
"""

from __future__ import annotations

# Model and routing.
MODEL = {
    "name": "entity_matcher",
    "version": "v1.0",
    "type": "logistic_regression",
    "feature_schema_version": "v1.0",
}
FEATURES = [
    "customer_similarity",
    "installer_similarity",
    "address_similarity",
    "city_match",
    "state_match",
    "capacity_diff",
    "status_match",
]
AUTO_MATCH = 0.90
MANUAL_REVIEW_LOW = 0.30

# Source authority, lower number wins.
SOURCE_PRIORITY = {"signed_document": 1, "crm": 2, "erp": 3, "partner": 4}

# Field rules.
FIELD_RULES = {
    "system_size_kw": {"kind": "numeric", "tolerance": 1.0, "review_above": 2.0},
    "customer_name": {"kind": "text", "match_threshold": 0.92},
    "installer": {"kind": "text", "match_threshold": 0.85},
    "address": {"kind": "text", "match_threshold": 0.80},
    "status": {
        "kind": "category",
        "equivalents": [
            ["Completed", "ACTIVE", "SIGNED"],
            ["In Progress", "PENDING", "PENDING_SIGNATURE"],
            ["Pending", "PENDING", "NOT_SENT"],
            ["On Hold", "SUSPENDED", "DECLINED"],
        ],
    },
}
FIELD_LABELS = {
    "customer_name": "Customer",
    "installer": "Installer",
    "system_size_kw": "System size (kW)",
    "address": "Address",
    "status": "Status",
}

# Verdict -> severity, field -> category, class -> severity.
SEVERITY_OF_VERDICT = {
    "CONFLICT": "HIGH", "REVIEW": "MEDIUM", "FORMAT": "MEDIUM", "MISSING": "MEDIUM", "MATCH": "LOW",
}
CATEGORY_OF_FIELD = {
    "system_size_kw": "NUMERIC_CONFLICT",
    "status": "STATUS_CONFLICT",
    "customer_name": "ENTITY_MISMATCH",
    "installer": "POTENTIAL_DUPLICATE",
    "address": "FORMATTING_DIFFERENCE",
}
SEVERITY_OF_CLASS = {
    "ENTITY_MISMATCH": "HIGH", "NUMERIC_CONFLICT": "HIGH",
    "STATUS_CONFLICT": "MEDIUM", "DOCUMENT_MISMATCH": "MEDIUM", "MISSING_DATA": "MEDIUM",
    "FORMATTING_DIFFERENCE": "LOW", "POTENTIAL_DUPLICATE": "LOW", "OTHER": "LOW",
}
MATERIAL_CLASSES = ["ENTITY_MISMATCH", "NUMERIC_CONFLICT", "STATUS_CONFLICT"]
SEVERITY_SCORE = {"HIGH": 3, "MEDIUM": 2, "LOW": 1}
PRIORITY_WEIGHTS = {"severity": 10.0, "uncertainty": 5.0, "age_days": 0.5}

# Reason codes, QA and SLA.
REASON_CODES = [
    "SOURCE_CONFLICT", "MISSING_INFORMATION", "DUPLICATE", "INCORRECT_VALUE",
    "FORMATTING_ISSUE", "UNABLE_TO_VERIFY", "OTHER",
]
SLA_HOURS = 72
QA_FRACTION = 0.10
QA_VERDICTS = ["AGREE", "DISAGREE"]

# Case lifecycle.
INITIAL_STATUS = "NEW"
OPEN_STATUSES = ["NEW", "IN_REVIEW", "WAITING_CLARIFICATION", "REOPENED"]
TERMINAL_STATUSES = ["RESOLVED", "REJECTED", "SYNCED"]
QA_ELIGIBLE_STATUSES = ["RESOLVED", "SYNCED"]
TRANSITIONS = {
    "NEW": ["IN_REVIEW"],
    "IN_REVIEW": ["WAITING_CLARIFICATION", "RESOLVED", "REJECTED"],
    "WAITING_CLARIFICATION": ["IN_REVIEW", "RESOLVED"],
    "RESOLVED": ["REOPENED", "SYNCED"],
    "REJECTED": ["REOPENED"],
    "REOPENED": ["IN_REVIEW"],
    "SYNCED": [],
}
TARGET_OF_DECISION = {
    "MATCH": "RESOLVED", "NON_MATCH": "RESOLVED", "CLARIFICATION": "WAITING_CLARIFICATION",
}

# Texts counted as blank.
BLANK_TEXTS = ["", "nan", "None", "—"]

# Saved queue views and sort orders.
QUEUE_VIEWS = {
    "Needs review": {"route": ["MANUAL_REVIEW"], "classification": []},
    "High risk": {"route": ["MANUAL_REVIEW"], "classification": ["ENTITY_MISMATCH"]},
    "Auto-matchable": {"route": ["AUTO_MATCH"], "classification": []},
    "Non-match": {"route": ["NON_MATCH"], "classification": []},
    "All pairs": {"route": [], "classification": []},
}
QUEUE_SORTS = {
    "Highest priority": ("priority", False),
    "Most uncertain first": ("uncertainty", False),
    "Highest P(match)": ("match_probability", False),
    "Lowest P(match)": ("match_probability", True),
    "Oldest first": ("age_days", False),
}

# Canonical field -> (authority key, source, column).
FIELD_SOURCES = {
    "customer_name": [("crm", "crm", "customer_name"), ("erp", "erp", "customer")],
    "installer": [("crm", "crm", "installer"), ("partner", "partner", "installer_name")],
    "system_size_kw": [
        ("crm", "crm", "system_size_kw"),
        ("erp", "erp", "installed_capacity"),
        ("partner", "partner", "capacity"),
    ],
    "address": [("crm", "crm", "address"), ("partner", "partner", "site_address")],
    "status": [
        ("crm", "crm", "status"),
        ("erp", "erp", "record_status"),
        ("partner", "partner", "completion_status"),
        ("signed_document", "document", "signing_status"),
    ],
}
SOURCES = ["crm", "erp", "partner", "document"]
ID_COLUMN = {
    "crm": "project_id",
    "erp": "project_reference",
    "partner": "external_reference",
    "document": "project_reference",
}
# Column names a canonical feature field may have; the first one present in a source is used.
FEATURE_COLUMNS = {
    "customer_name": ["customer_name", "customer"],
    "installer": ["installer", "installer_name"],
    "address": ["address", "site_address"],
    "city": ["city"],
    "state": ["state", "region"],
    "system_size_kw": ["system_size_kw", "installed_capacity", "capacity"],
    "status": ["status", "record_status", "completion_status"],
}
REQUIRED_COLUMNS = {
    "crm": ["project_id", "customer_name", "installer", "system_size_kw"],
    "erp": ["project_reference", "customer", "installed_capacity"],
    "partner": ["external_reference", "installer_name", "capacity"],
    "document": ["project_reference", "signing_status", "document_name"],
}
ERP_STATUS = {
    "Completed": "ACTIVE", "In Progress": "PENDING", "Pending": "PENDING", "On Hold": "SUSPENDED",
}
SIGNING_STATUS = {
    "Completed": "SIGNED", "In Progress": "PENDING_SIGNATURE", "Pending": "NOT_SENT",
    "On Hold": "DECLINED",
}
AUDIT_COLUMNS = [
    "timestamp", "pair_id", "reviewer_id", "decision", "reason_code", "reason", "comment",
    "model_version",
]
HANDOFF_COLUMNS = [
    "case_id", "field", "old_value", "new_value", "authority_source", "proposed_by", "synced_at",
]
