"""Registry of this folder's queries; each module brings QUERIES and SQL."""

from __future__ import annotations

import importlib

MODULES = ("cluster_links", "drift", "packing", "chunking", "mixing", "pii_queries", "name_variants", "bit_match", "invariants")

QUERIES: dict = {}
SQL: dict = {}
for _name in MODULES:
    _module = importlib.import_module(f"traceloom.llm.{_name}")
    QUERIES |= _module.QUERIES
    SQL |= _module.SQL
