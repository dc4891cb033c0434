"""All registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stallkeep.queries import audits, baselines, calendar, checks, conformance, increments, ingestion, kpis, star, validation
from stallkeep.queries.oracle import with_blocks
from stallkeep.queries.shape import portable
from stallkeep.session import scratch_root

MODULES = (ingestion, audits, checks, conformance, calendar, star, validation, baselines, increments, kpis)


def _run(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        scratch_root(spark)
        return portable(query(spark, sf_dir))

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(query) for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: with_blocks(sql) for module in MODULES for name, sql in module.ORACLE.items()}
