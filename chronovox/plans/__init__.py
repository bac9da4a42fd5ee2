"""Queries over the driver's tables: each a DataFrame plan and, where there is one, equivalent SQL."""

from __future__ import annotations

from . import frame_queries, registry, space_queries, stat_queries  # noqa: F401  they register their queries


def queries() -> dict:
    return registry.QUERIES


def oracle_sql() -> dict[str, str]:
    return registry.ORACLE_SQL
