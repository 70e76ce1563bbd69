"""Registry of runnable queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from accordant.plans.domain import Domain
from accordant.plans.oracle import compose
from accordant.session import prepare, size_shuffles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(domain)`` under ``name``; ``oracle`` may use the shared table expressions."""

    def register(fn: Callable[[Domain], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            size_shuffles(spark, sf_dir)
            return fn(Domain(spark, sf_dir.rstrip("/")))

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = compose(oracle)
        return fn

    return register


def load_all() -> None:
    from accordant.plans import anomaly_queries, evidence_queries, match_queries, review_queries, source_queries, stream_queries  # noqa: F401
