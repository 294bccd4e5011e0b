"""Orders and order lines stored for their join: both bucketed by the order number.

Eight of the tags and all order models need the lines of orders. Bucketed alike, every program that needs
the join reads it bucket by bucket, without a shuffle; the shuffle is paid once, when the tables are stored.

A bucket cannot be split, so there are more of them for more rows: a version has as many as hold at most ``bucket_rows`` rows
each, and at least the store's number; its folders tell how many. Order numbers with more than ``hot_rows`` rows on either side, and
rows without a number, are stored apart in plain files. Their join is an ordinary one, which adaptive
execution splits or broadcasts by measure.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tagloom.operators import joining
from tagloom.operators.staging import scratch, stage
from tagloom.sources.bucketed import read_bucketed, write_bucketed
from tagloom.sources.tables import Sources
from tagloom.sources.versions import Versions

HOT_ROWS = 1_000_000
BUCKET_ROWS = 1_000_000  # of the larger table, on average: what one task sorts
_KEYS = {"orders": "orderSn", "goods": "cOrderSn"}


def _hot(orders: DataFrame, goods: DataFrame, hot_rows: int) -> tuple[DataFrame, list[Observation]]:
    """Order numbers that are hot on either side, at most total rows / ``hot_rows`` of them, staged; and the rows
    with a number of each side, counted on the way."""
    counts, totals = [], [Observation(), Observation()]
    for df, key, total in ((orders, _KEYS["orders"], totals[0]), (goods, _KEYS["goods"], totals[1])):
        per_number = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("hot")).agg(F.count(F.lit(1)).alias("rows"))
        counts.append(per_number.observe(total, F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")))
    hot = counts[0].unionByName(counts[1]).where(F.col("rows") > hot_rows).select("hot").distinct()
    return stage(hot, "hot-orders"), totals


@dataclass(frozen=True)
class OrderStore:
    """Versions of the two tables below ``root``; ``buckets`` is the least number, best at least the shuffle width."""

    spark: SparkSession
    root: str
    buckets: int
    hot_rows: int = HOT_ROWS
    bucket_rows: int = BUCKET_ROWS

    def write(self, orders: DataFrame, goods: DataFrame) -> int:
        """Replaces both tables; a version always holds what was written together."""
        def fill(path: str) -> None:
            with scratch(self.spark):
                hot, totals = _hot(orders, goods, self.hot_rows)
                buckets = max(self.buckets, -(-max(total.get["rows"] for total in totals) // self.bucket_rows))
                for name, df in (("orders", orders), ("goods", goods)):
                    own = F.col(_KEYS[name])
                    write_bucketed(df.where(own.isNotNull()).join(hot, own == F.col("hot"), "left_anti"), f"{path}/{name}", [_KEYS[name]], buckets)
                    apart = df.join(hot, own == F.col("hot"), "left_semi").unionByName(df.where(own.isNull()))
                    apart.write.parquet(f"{path}/{name}-apart")
        return Versions(self.spark, self.root).put(fill)

    def open(self, users: DataFrame, logs: DataFrame, version: int | None = None) -> StoredSources:
        """All sources, with orders and lines of one version."""
        path = Versions(self.spark, self.root).path(version)
        if path is None:
            raise FileNotFoundError(f"{self.root} has no version yet")
        near = {name: read_bucketed(self.spark, f"{path}/{name}") for name in _KEYS}
        apart = {name: self.spark.read.parquet(f"{path}/{name}-apart") for name in _KEYS}
        whole = {name: self.spark.read.parquet(f"{path}/{name}").unionByName(apart[name]) for name in _KEYS}  # no buckets below a union
        return StoredSources(users, whole["orders"], whole["goods"], logs, (near, apart))


@dataclass(frozen=True)
class StoredSources(Sources):
    """Sources whose order lines are joined bucket by bucket."""

    parts: tuple[dict[str, DataFrame], dict[str, DataFrame]]

    def order_lines(self, id_digits: int | None) -> DataFrame:
        near, apart = (joining.order_lines(part["orders"], part["goods"], id_digits) for part in self.parts)
        return near.unionByName(apart)
