"""All queries of the library with their DuckDB counterparts."""

from __future__ import annotations

from . import documents, joins, layers, runs, series, stages, usage

MODULES = (layers, runs, series, stages, joins, documents, usage)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
