"""All registered queries of the engine and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import queries_graph, queries_kg, queries_titles

MODULES = (queries_graph, queries_titles, queries_kg)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
