"""All queries outside the llm subpackage."""

from __future__ import annotations

from kbspark import document_queries, list_queries, snapshot_queries, table_queries

_MODULES = (snapshot_queries, document_queries, table_queries, list_queries)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
