"""Registered queries: one Spark plan + one DuckDB oracle SQL per operator group."""

from mailframe.plans.registry import QUERIES, ORACLE_SQL  # noqa: F401
from mailframe.plans import sync_queries, document_queries, search_queries, parse_queries, store_queries  # noqa: F401
