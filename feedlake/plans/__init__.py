"""Queries over the given tables, each with its check in SQL."""

from __future__ import annotations

from feedlake.plans import (
    incremental, ingest, medallion, retrieval, routing, tables, vectors,
)
from feedlake.plans.registry import Query

_AREAS = (ingest, medallion, tables, vectors, retrieval, routing, incremental)


def catalog() -> dict[str, Query]:
    """All queries by name."""
    return {name: query for area in _AREAS for name, query in area.QUERIES.items()}
