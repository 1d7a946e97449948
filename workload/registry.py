"""All registered queries."""

from __future__ import annotations

from workload import attention, cutoffs, facets, ingestion, vectors

MODULES = [attention, cutoffs, facets, vectors, ingestion]


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
