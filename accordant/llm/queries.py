"""Queries over the whole test tables, one for each operator, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accordant.llm import decontamination, jaccard_join, language_id, license_scan, line_dedup, packing, quality_rules, simhash_balls, spelling_variants, substring_dedup, token_counts, toxicity, whitening
from accordant.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


@_query("op1_decontamination")
def _decontamination(table) -> DataFrame:
    return decontamination.decontaminate(table("documents"), table("benchmark"))


@_query("op2_quality_rules")
def _quality_rules(table) -> DataFrame:
    return quality_rules.apply_rules(table("documents"), table("labels"))


@_query("op3_language_id")
def _language_id(table) -> DataFrame:
    return language_id.identify(table("pages"), table("documents"))


@_query("op4_toxicity")
def _toxicity(table) -> DataFrame:
    return toxicity.score_documents(table("documents"), table("labels"))


@_query("op5_jaccard_join", jaccard_join.ORACLE_SQL)
def _jaccard_join(table) -> DataFrame:
    return jaccard_join.link_documents(table("documents"), size=3, numerator=90)


@_query("op6_token_counts")
def _token_counts(table) -> DataFrame:
    return token_counts.count_tokens(table("documents"))


@_query("op7_line_dedup", line_dedup.ORACLE_SQL)
def _line_dedup(table) -> DataFrame:
    return line_dedup.dedup_lines(table("documents")).select("doc_id", "text", "n_lines", "n_removed")


@_query("op8_packing")
def _packing(table) -> DataFrame:
    return packing.pack_documents(table("documents"))


@_query("op9_license_scan", license_scan.ORACLE_SQL)
def _license_scan(table) -> DataFrame:
    return license_scan.scan_licenses(table("documents"))


@_query("op10_substring_dedup", substring_dedup.ORACLE_SQL)
def _substring_dedup(table) -> DataFrame:
    return substring_dedup.dedup_substrings(table("documents")).drop("kept")


@_query("op11_spelling_variants")
def _spelling_variants(table) -> DataFrame:
    return spelling_variants.group_variants(table("documents"), slips=199)


@_query("op12_embedding_whitening")
def _embedding_whitening(table) -> DataFrame:
    return whitening.whiten(table("embeddings"))


@_query("op13_simhash_dedup")
def _simhash_dedup(table) -> DataFrame:
    return simhash_balls.group_documents(table("documents"))
