"""Names of the queries, their functions and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsflow.plans.views import SQL

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: str = "") -> Callable[[Query], Query]:
    """Register a query; `views` names the input views that its SQL reads."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return fn
    return add


def with_views(sql: str, views: str) -> str:
    """SQL with the definitions of the views it reads in front."""
    named = [f"{v} AS ({SQL[v]})" for v in views.split()]
    if not named:
        return sql
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {', '.join(named)}, {sql[15:]}"
    if sql.upper().startswith("WITH "):
        return f"WITH {', '.join(named)}, {sql[5:]}"
    return f"WITH {', '.join(named)} {sql}"
