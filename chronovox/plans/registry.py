"""Registration of a query with its SQL, rounded alike on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, keys: str, doubles: str = "", sql: str | None = None, more: tuple = (), digits: int = 6):
    """Register a plan with columns ``keys`` and ``doubles``; sums of doubles depend on their order, so they are rounded."""
    k, r = keys.split(), doubles.split()

    def add(plan):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plan(spark, sf_dir).select(*k, *[(F.round(F.col(c), digits) + F.lit(0.0)).alias(c) for c in r])

        QUERIES[name] = run
        if sql:
            columns = ", ".join([*k, *(f"round({c}, {digits}) + 0.0 AS {c}" for c in r)])
            ORACLE_SQL[name] = views.with_views(f"SELECT {columns} FROM ({sql})", *more)
        return plan

    return add


def corr(x: str, y: str) -> str:
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


def orthogonal(source: str, keys: str, columns: list[str]) -> tuple[tuple[str, str], ...]:
    """Views g0, g1, ... of ``source``: by turns each column is made orthogonal to those before it, over the rows of a key; the last is named q."""
    out, own = [], f"SELECT * FROM {source}"
    for k, c in enumerate(columns[:-1]):
        out.append((f"g{k}", own))
        rest = ", ".join(f"{x} - {c} * sum({x} * {c}) OVER w / nullif(sum({c} * {c}) OVER w, 0) AS {x}" for x in columns[k + 1 :])
        own = f"SELECT * REPLACE ({rest}) FROM g{k} WINDOW w AS (PARTITION BY {keys})"
    return (*out, ("q", own))
