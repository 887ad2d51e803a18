"""All queries of the core by name, and the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Modules with a QUERIES dict (name to callable) and perhaps an SQL dict (name to text).
MODULES = ("quality_queries", "quality_sql", "domain_queries", "analytics_queries", "window_queries", "join_queries", "rule_queries", "text_queries", "layout_queries", "staged_queries", "stream_queries")

Query = Callable[[SparkSession, str], DataFrame]


def collect() -> tuple[dict[str, Query], dict[str, str]]:
    """Every module's queries and SQL texts; a name told twice is an error."""
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for name in MODULES:
        module = import_module(f"ledgerloom.plans.{name}")
        for target, found in ((queries, getattr(module, "QUERIES", {})), (sql, getattr(module, "SQL", {}))):
            twice = target.keys() & found.keys()
            if twice:
                raise ValueError(f"told twice: {sorted(twice)}")
            target.update(found)
    return queries, sql
