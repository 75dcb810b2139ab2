"""The registered queries of the engine and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import auditing, deciding, extras, fusing, grammar, inspecting, proving, reading, recovering, selection, streamed

MODULES = (selection, reading, deciding, fusing, auditing, recovering, grammar, inspecting, proving, extras, streamed)


def entry(spark: SparkSession) -> DataFrame:
    """The flagship query: every case decided, on the smallest tables."""
    return queries()["decide_gates"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, (query, _) in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, (_, sql) in module.QUERIES.items() if sql is not None}
