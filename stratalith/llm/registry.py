"""Queries of this subpackage and their DuckDB SQL, for the driver's contract."""

from __future__ import annotations

from . import (
    centroids,
    decontamination,
    embedding_dedup,
    histogram_shards,
    license_scan,
    merkle,
    packing,
    pii,
    secret_scan,
    simhash,
    substrings,
    toxicity,
    url_reputation,
)

MODULES = (
    url_reputation,
    packing,
    license_scan,
    secret_scan,
    decontamination,
    simhash,
    embedding_dedup,
    toxicity,
    histogram_shards,
    pii,
    centroids,
    substrings,
    merkle,
)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in getattr(module, "SQL", {}).items()}
