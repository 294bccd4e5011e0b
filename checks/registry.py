"""Registers a Spark query under its key, with its SQL where one exists."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.fixtures import DUCKDB, sources, views
from tagloom.sources.tables import Sources

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
CTES: dict[str, str] = dict(views(DUCKDB))


def cte(name: str, sql: str) -> None:
    """A named SQL block that later blocks and queries may use."""
    CTES[name] = sql


def _used(sql: str) -> list[str]:
    """Blocks a statement needs, in definition order. String literals name no blocks."""
    needed: set[str] = set()
    open_texts = [sql]
    while open_texts:
        words = set(re.findall(r"\w+", re.sub(r"'(?:[^']|'')*'", " ", open_texts.pop())))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            open_texts.append(CTES[name])
    return [name for name in CTES if name in needed]


def with_blocks(sql: str) -> str:
    blocks = ",\n".join(f"{name} AS ({CTES[name]})" for name in _used(sql))
    return f"WITH {blocks}\n{sql}" if blocks else sql


def query(name: str, sql: str | None = None):
    """Decorates ``f(sources) -> DataFrame``."""
    def register(make: Callable[[Sources], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: make(sources(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return make
    return register
