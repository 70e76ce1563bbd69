"""Source exports, canonical alignment and first-record lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.ids import envelope_id
from accordant.functions.text import choose, strip


def crm_export(master: DataFrame) -> DataFrame:
    return master.select("project_id", "customer_name", "installer", "system_size_kw", "address",
                         "city", "state", "status", "updated_at", "ord")


def erp_export(master: DataFrame) -> DataFrame:
    return master.select(
        F.col("customer_name").alias("customer_ref"), F.col("project_id").alias("project_reference"),
        F.col("customer_name").alias("customer"), F.col("system_size_kw").alias("installed_capacity"),
        F.col("state").alias("region"),
        choose(F.col("status"), policy.ERP_STATUS).alias("record_status"), "ord")


def partner_export(master: DataFrame) -> DataFrame:
    return master.select(
        F.col("project_id").alias("external_reference"), F.col("installer").alias("installer_name"),
        F.col("system_size_kw").alias("capacity"), F.col("address").alias("site_address"),
        F.col("status").alias("completion_status"), "ord")


def document_export(master: DataFrame) -> DataFrame:
    return master.select(
        envelope_id(F.col("project_id")).alias("envelope_reference"),
        F.col("project_id").alias("project_reference"),
        choose(F.col("status"), policy.SIGNING_STATUS).alias("signing_status"),
        F.col("install_date").alias("signed_date"),
        F.concat(F.lit("solar_Agreement_"), F.col("project_id"), F.lit(".pdf")).alias("document_name"), "ord")


def existing(df: DataFrame, names: list[str]) -> Column:
    """The first of ``names`` that is a column of ``df`` (chosen by presence, not by value)."""
    for name in names:
        if name in df.columns:
            return F.col(name)
    return F.lit(None)


def align(sources: dict[str, DataFrame]) -> DataFrame:
    """All source records in one long table under canonical names.

    ``status`` is the matching view of the status (documents have none); ``evidence_status`` also
    carries the signing status. ``ord`` is the input order used to pick the first record of an id.
    """
    aligned = []
    for name, df in sources.items():
        evidence = next(c for _, s, c in policy.FIELD_SOURCES["status"] if s == name)
        aligned.append(df.select(
            F.lit(name).alias("source_system"),
            F.col(policy.ID_COLUMN[name]).cast("string").alias("record_id"),
            *[existing(df, names).cast("double" if field == "system_size_kw" else "string").alias(field)
              for field, names in policy.FEATURE_COLUMNS.items()],
            F.col(evidence).cast("string").alias("evidence_status"),
            F.col("ord")))
    return reduce(DataFrame.unionByName, aligned)


def first_record(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row per key in input order; rows without a key are left out.

    An aggregate, so duplicates collapse before the shuffle and a hot key is no hot task.
    """
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.dropna(subset=keys).groupBy(*keys).agg(first).select(*keys, "_row.*")


def wide_view(master: DataFrame, records: DataFrame) -> DataFrame:
    """One row per project with each source's first record as ``<field>_<source>`` columns.

    All sources are folded to one row per id in a single shuffle, then joined to the projects.
    """
    fields = {
        "customer_name": ["crm", "erp"], "installer": ["crm", "partner"],
        "system_size_kw": ["crm", "erp", "partner"], "address": ["crm", "partner"],
        "evidence_status": ["crm", "erp", "partner", "document"],
    }
    payload = F.struct("customer_name", "installer", "system_size_kw", "address", "evidence_status")
    folded = (records.where(F.col("record_id").isNotNull()).groupBy(F.col("record_id").alias("project_id"))
              .agg(*[F.min_by(payload, F.when(F.col("source_system") == s, F.col("ord"))).alias(s)
                     for s in policy.SOURCES]))
    columns = [F.col(f"{s}.{field}").alias(f"{field.replace('evidence_', '')}_{s}")
               for field, sources in fields.items() for s in sources]
    present = [F.col(s).isNotNull().alias(f"in_{s}") for s in policy.SOURCES]
    return master.join(folded.select("project_id", *columns, *present), "project_id", "left").na.fill(
        False, [f"in_{s}" for s in policy.SOURCES])


def field_value(field: str, source: str) -> Column:
    """Column of the wide view holding a field's value as text; blank text counts as missing."""
    return F.nullif(strip(f"{field}_{source}"), F.lit(""))


def project_lookup(wide: DataFrame, project_id: str) -> DataFrame:
    """One project across all sources (an equality filter the scan can use)."""
    return wide.where(F.col("project_id") == project_id)


def project_sources(records: DataFrame, project_id: str) -> DataFrame:
    """The rows the sources hold on one project."""
    return records.where(F.col("record_id") == project_id)
