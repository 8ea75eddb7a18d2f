"""Registry of checks: name -> (Spark callable, optional DuckDB SQL)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .views import SQL_VIEWS, Tables

Query = Callable[[Tables], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``sql`` may read the derived views by name."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"check {name} registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return build

    return register


def _views_in(sql: str) -> set[str]:
    return {
        v
        for v in re.findall(r"(?:from|join)\s+(\w+)\b", sql, flags=re.IGNORECASE)
        if v in SQL_VIEWS
    }


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the CTEs of the derived views it uses, dependencies first."""
    needed: list[str] = []

    def add(view: str) -> None:
        if view in needed:
            return
        for dependency in _views_in(SQL_VIEWS[view]):
            add(dependency)
        needed.append(view)

    for view in sorted(_views_in(sql)):
        add(view)
    if not needed:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
