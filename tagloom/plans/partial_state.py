"""Aggregates that are kept and added to: a day's log is merged in, the days before are not read again.

The state is one row per key with partial results (counts, sums, least, greatest, newest packed values): what
``Metric`` can merge. It is bucketed by the key, so a new day shuffles only its own partial results,
never the state. Days can come in any order, since merging has none; a day that is in already
is left out, so a run can be repeated. A state knows its days, and versions are published like
those of the profile: a failed run changes nothing, and of two days added at once the later one is
merged with the other.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagloom.operators.metrics import Metric
from tagloom.plans.log_tags import log_tags, logs_with_id, viewed_products
from tagloom.plans.tag import Tag, labelled, metric_rows, metrics_of
from tagloom.sources.bucketed import read_bucketed, write_bucketed
from tagloom.sources.versions import Versions

_NOTE = "_days.json"


@dataclass(frozen=True)
class PartialState:
    spark: SparkSession
    root: str
    keys: Sequence[str]
    metrics: Mapping[str, Metric]
    buckets: int

    def _versions(self) -> Versions:
        return Versions(self.spark, self.root)

    def days(self, version: int | None = None) -> list[str]:
        version = self._versions().newest() if version is None else version
        return [] if version is None else json.loads(self._versions().note(version, _NOTE))

    def read(self, version: int | None = None) -> DataFrame | None:
        """The merged state, None when no day was added."""
        path = self._versions().path(version)
        return None if path is None else read_bucketed(self.spark, path)

    def partial(self, rows: DataFrame) -> DataFrame:
        """The state of some rows alone; rows without a whole key have none."""
        known = rows.dropna(subset=list(self.keys))
        return known.groupBy(*self.keys).agg(*[F.expr(m.first()).alias(name) for name, m in self.metrics.items()])

    def merged(self, state: DataFrame, more: DataFrame) -> DataFrame:
        """Both states as one. A join, whose stored side stays in its buckets: below a union Spark
        would drop them."""
        fresh = more.select(*[F.col(c).alias(f"__{c}") for c in more.columns])
        joined = state.join(fresh, [state[key] == fresh[f"__{key}"] for key in self.keys], "full_outer")
        both = {name: F.expr(m.combine(name, f"__{name}")) for name, m in self.metrics.items()}
        return joined.select(*[F.coalesce(key, f"__{key}").alias(key) for key in self.keys],
                             *[value.cast(state.schema[name].dataType).alias(name) for name, value in both.items()])

    def add(self, day: str, rows: DataFrame) -> int:
        """The version that holds the day; a new one unless the day was added before."""
        versions = self._versions()
        fresh = self.partial(rows).repartition(self.buckets, *self.keys)
        while True:
            base = versions.newest()
            days = self.days(base) if base else []
            if day in days:
                return base
            run = versions.new_run()
            state = self.read(base) if base else None
            write_bucketed(fresh if state is None else self.merged(state, fresh), f"{self.root}/{run}", self.keys, self.buckets)
            versions.put_note(run, _NOTE, json.dumps(sorted([*days, day])))
            if versions.publish(run, (base or 0) + 1):
                return (base or 0) + 1
            versions.drop(run)


# ---- what the log tags and models keep ------------------------------------------------

def log_tag_state(spark: SparkSession, root: str, buckets: int, tags: Mapping[str, Tag] | None = None) -> PartialState:
    """Per visitor: the metrics of all log tags."""
    return PartialState(spark, root, ["id"], metrics_of((tags or log_tags()).values()), buckets)


def add_log_day(state: PartialState, day: str, logs: DataFrame, tags: Mapping[str, Tag] | None = None) -> int:
    return state.add(day, metric_rows(logs_with_id(logs), (tags or log_tags()).values()))


def tags_of_state(state: DataFrame, tags: Mapping[str, Tag] | None = None) -> DataFrame:
    """The log tags of everything added so far, from one scan of the state."""
    return labelled(state, (tags or log_tags()).values())


def view_state(spark: SparkSession, root: str, buckets: int) -> PartialState:
    """Per visitor and product: the number of page views, which the models rate by and the viewed
    products are a list of."""
    return PartialState(spark, root, ["userId", "productId"], {"rating": Metric("count", "userId")}, buckets)


def add_view_day(state: PartialState, day: str, logs: DataFrame) -> int:
    return state.add(day, viewed_products(logs).withColumnRenamed("id", "userId"))


def value_state(spark: SparkSession, root: str, value: str, buckets: int) -> PartialState:
    """Per id and value: how often the value occurred."""
    return PartialState(spark, root, ["id", value], {"rows": Metric("count", value)}, buckets)


def mode_of_state(counts: DataFrame, value: str, name: str) -> DataFrame:
    """Most frequent value per id from such counts; ties go to the smaller value."""
    best = F.min_by(value, F.struct((-F.col("rows")).alias("rows"), F.col(value)))
    return counts.groupBy("id").agg(best.alias(name))
