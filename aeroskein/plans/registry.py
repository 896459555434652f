"""The list of registered queries, and SQL pieces that they share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: Common table expressions by name; one may use those before it.
TABLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with SQL for it that may use the shared tables."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"{name} is registered already")
        QUERIES[name] = f
        if sql:
            ORACLES[name] = with_tables(sql)
        return f

    return add


def with_tables(sql: str) -> str:
    """`sql` after the definitions of the shared tables that it uses, directly or through others."""
    wanted: set[str] = set()

    def add(text: str) -> None:
        for name in TABLES:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                wanted.add(name)
                add(TABLES[name])

    add(sql)
    own = ",\n".join(f"{k} as ({v.strip()})" for k, v in TABLES.items() if k in wanted)
    if not own:
        return sql
    begin = re.match(r"\s*with(\s+recursive)?\b", sql)
    return f"{begin[0]} {own},\n{sql[begin.end():]}" if begin else f"with {own}\n{sql}"
