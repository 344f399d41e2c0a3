"""The queries of this subpackage and the SQL they are held against."""

from __future__ import annotations

from kbspark.llm import grouping_queries, mixing_queries, neardup_queries, personal_queries, splitting_queries, tokens_queries, toxicity_queries

_MODULES = (splitting_queries, grouping_queries, neardup_queries, personal_queries, tokens_queries, mixing_queries, toxicity_queries)

QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
