"""Registry of the core's queries; each module brings QUERIES and SQL."""

from __future__ import annotations

import importlib

MODULES = ("packed_queries", "function_queries", "scan_queries", "report_queries", "schema_queries", "more_queries", "derived_queries")


def collect() -> tuple[dict, dict]:
    """All queries and all SQL of the core."""
    queries: dict = {}
    sql: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"traceloom.plans.{name}")
        queries |= module.QUERIES
        sql |= module.SQL
    return queries, sql
