"""All queries outside the optional subpackage, and their SQL."""

from __future__ import annotations

from jobweave.plans import core_queries, duplicate_queries, page_queries, parser_queries, read_queries, serving_queries, star_queries, warehouse_queries

_MODULES = [core_queries, read_queries, duplicate_queries, warehouse_queries, serving_queries, parser_queries, page_queries, star_queries]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: v for m in _MODULES for k, v in m.ORACLE.items()}
