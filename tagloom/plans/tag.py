"""Tags as data, and the fused computation of many tags of one source.

A tag is split into metrics (aggregates over its source) and labels (expressions over
the metrics). All metrics of a source go into one aggregation and all labels into one
projection, so ten tags of the orders cost one scan of the orders.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from tagloom.operators.grouping import with_totals
from tagloom.operators.metrics import Metric, ModeOf, SetOf, aggregate


@dataclass(frozen=True)
class Tag:
    """Everything is SQL expression text.

    ``inputs``: values derived from a source row, computed once however many metrics use
    them. ``metrics``: aggregates per key. ``totals``: one-row aggregates over all keys.
    ``values``: numbers derived from these, computed once however often a ladder compares
    them. ``columns``: output column -> label; a tag that does not apply (``present`` is
    false) is null.
    """

    columns: dict[str, str]
    metrics: dict[str, Metric | ModeOf | SetOf] = field(default_factory=dict)
    inputs: dict[str, str] = field(default_factory=dict)
    totals: dict[str, str] = field(default_factory=dict)
    values: dict[str, str] = field(default_factory=dict)
    present: str | None = None

    def outputs(self) -> list[str]:
        def guarded(label: str) -> str:
            return label if self.present is None else f"CASE WHEN {self.present} THEN {label} END"
        return [f"{guarded(label)} AS {name}" for name, label in self.columns.items()]


def _merged(parts: Iterable[dict]) -> dict:
    """Union of the tags' definitions; a name stands for one definition only."""
    merged: dict = {}
    for part in parts:
        for name, value in part.items():
            if merged.setdefault(name, value) != value:
                raise ValueError(f"two definitions of {name}: {merged[name]} and {value}")
    return merged


def _derived(rows: DataFrame, expressions: dict[str, str]) -> DataFrame:
    return rows.withColumns({n: F.expr(sql) for n, sql in expressions.items()}) if expressions else rows


def project_tags(rows: DataFrame, tags: Iterable[Tag], key: str = "id") -> DataFrame:
    """The labels of all tags over their metrics, or over the rows themselves: no shuffle."""
    tags = list(tags)
    valued = _derived(rows, _merged(t.values for t in tags))
    return valued.selectExpr(key, *[c for t in tags for c in t.outputs()])


def metric_rows(rows: DataFrame, tags: Iterable[Tag]) -> DataFrame:
    """Source rows with the values that the tags' metrics take."""
    return _derived(rows, _merged(t.inputs for t in tags))


def metrics_of(tags: Iterable[Tag]) -> dict[str, Metric | ModeOf | SetOf]:
    return _merged(t.metrics for t in tags)


def _per_key(rows: DataFrame, tags: list[Tag], key: str) -> DataFrame:
    return aggregate(metric_rows(rows, tags), key, metrics_of(tags))


def labelled(per_key: DataFrame, tags: Iterable[Tag], key: str = "id",
             stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The tags of metrics that were aggregated per key before. ``stage`` may store these first; stored
    partitions may be other ones, so the rows (not what the totals read) are dealt by key again."""
    tags = list(tags)
    totals = _merged(t.totals for t in tags)
    if totals and stage:
        stored = stage(per_key)
        per_key = with_totals(stored.repartition(key), totals, over=stored)
    elif totals:
        per_key = with_totals(per_key, totals)
    return project_tags(per_key, tags, key)


def aggregate_tags(rows: DataFrame, tags: Iterable[Tag], key: str = "id",
                   stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All tags of one source: one aggregation, then one projection.

    Tags with totals compare a key with the whole population. Their totals are taken
    over the per-key metrics; ``stage`` may store those first, so that many tags with
    totals do not read the source twice.
    """
    tags = list(tags)
    return labelled(_per_key(rows, tags, key), tags, key, stage)


def single_tag(rows: DataFrame, tag: Tag, key: str = "id") -> DataFrame:
    """One tag on its own; keys it does not apply to are left out."""
    per_key = _per_key(rows, [tag], key) if tag.metrics else rows
    if tag.totals:
        per_key = with_totals(per_key, tag.totals)
    if tag.present is not None:
        per_key = per_key.where(tag.present)
    return project_tags(per_key, [tag], key)
