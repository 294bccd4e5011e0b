"""Aggregates that can be taken in one step or in two.

Every plain metric is associative, so ``first`` over rows followed by ``merge`` over
partial results equals ``first`` alone. That lets many tags of one source share a
single aggregation, even when one of them needs the values of a column (the most frequent
one, or their set): every task sends a key's distinct values and partial results in one row,
so the rows are shuffled once. Without plain metrics beside it, a mode or a set takes a finer
grouping first: then only values are shuffled, a key's values from many tasks.

Buffers are numbers only, so Spark keeps the whole group-by a hash aggregation with
map-side combining; a hot key is reduced before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.functions.ladders import label_at
from tagloom.functions.text import join_distinct, join_set

_GROUP_ROWS = "__rows"


@dataclass(frozen=True)
class Metric:
    """A plain aggregate: ``how`` is sum, count, count_if, min or max."""

    how: str
    of: str

    def first(self) -> str:
        return f"{self.how}({self.of})"

    def merge(self, partial: str) -> str:
        return f"{self.how if self.how in ('min', 'max') else 'sum'}({partial})"

    def combine(self, one: str, other: str) -> str:
        """Two partial results of one row; a missing one counts as none."""
        if self.how in ("min", "max"):
            return f"{'least' if self.how == 'min' else 'greatest'}({one}, {other})"
        return f"coalesce({one} + {other}, {one}, {other})"


@dataclass(frozen=True)
class ModeOf:
    """Most frequent value of a column; ties go to the smaller value, nulls count zero."""

    column: str

    def final(self) -> str:
        return f"min(struct(-{_GROUP_ROWS} AS n, {self.column} AS value)).value"

    def whole(self) -> str:
        return f"mode({self.column}, true)"


@dataclass(frozen=True)
class SetOf:
    """Distinct values of a column as a sorted, comma-joined text."""

    column: str

    def final(self) -> str:
        return join_distinct(self.column)

    def whole(self) -> str:
        return join_set(self.column)


def latest(time: str, position: str, size: int) -> Metric:
    """The newest row's ladder position, packed with its time into one exact decimal.

    Equal times go to the rung listed first. Every bigint time fits; a row without a time
    counts as older than all of them.
    """
    when = f"coalesce(CAST({time} AS DECIMAL(20,0)), CAST({-2**63 - 1} AS DECIMAL(20,0)))"
    return Metric("max", f"{when} * {size} + ({size - 1} - {position})")


def latest_label(packed: str, labels: list[str]) -> str:
    size = len(labels)
    return label_at(f"{size - 1} - CAST(pmod({packed}, {size}) AS INT)", labels)


def _named(expressions: Mapping[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in expressions.items()]


def aggregate(rows: DataFrame, key: str, metrics: Mapping[str, Metric | ModeOf | SetOf]) -> DataFrame:
    """One row per key with all metrics, from one scan of ``rows``."""
    plain = {n: m for n, m in metrics.items() if isinstance(m, Metric)}
    fine = {n: m for n, m in metrics.items() if not isinstance(m, Metric)}
    first = {n: m.first() for n, m in plain.items()}
    if not fine:
        return rows.groupBy(key).agg(*_named(first))
    columns = {m.column for m in fine.values()}
    if len(columns) > 1:
        raise ValueError(f"one aggregation can refine by one column only, got {sorted(columns)}")
    (column,) = columns
    if plain:
        return rows.groupBy(key).agg(*_named({**first, **{n: m.whole() for n, m in fine.items()}}))
    partial = rows.groupBy(key, column).agg(F.expr(f"count({column})").alias(_GROUP_ROWS))
    return partial.groupBy(key).agg(*_named({n: m.final() for n, m in fine.items()}))
