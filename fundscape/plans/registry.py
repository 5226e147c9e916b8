"""All queries of the fund library by name, with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of (spark, sf_dir) under ``name``."""

    def add(fn: Callable) -> Callable:
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql:
            ORACLE_SQL[name] = sql
        return fn

    return add
