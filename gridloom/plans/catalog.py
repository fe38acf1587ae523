"""All registered queries and their SQL twins."""

from __future__ import annotations

from gridloom.plans import array_queries, file_queries, keyed_queries, learning_queries, profiling_queries

_MODULES = (profiling_queries, array_queries, file_queries, keyed_queries, learning_queries)


def all_queries() -> dict:
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
