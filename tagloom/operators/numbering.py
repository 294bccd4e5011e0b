"""Dense numbers over a whole table without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tagloom.operators.staging import stage


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """Rows with their zero-based place in the given order, as a long.

    A range sort gives every partition a stretch of the order; a row's number is its place
    within the partition plus the rows of the partitions before. The sorted rows are staged,
    so that a retry sees the same partitions. Only one row per partition meets in one task.
    """
    placed = stage(_placed(df.orderBy(*order)), "numbered")
    return _offset(placed, name)


def numbered_ids(ids: DataFrame, name: str = "number") -> DataFrame:
    """Different ids with dense numbers in no particular order: within a partition by id, and
    partition after partition as the shuffle that made the ids different left them. No further
    shuffle and no sampling of the order."""
    return _offset(stage(_placed(ids.distinct().sortWithinPartitions(*ids.columns)), "numbered"), name)


def _placed(df: DataFrame) -> DataFrame:
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.select("*", F.spark_partition_id().alias("__part"), place.alias("__place"))


def _offset(placed: DataFrame, name: str) -> DataFrame:
    parts = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(parts.select("__part", before.alias("__before")))  # a row per partition
    return placed.join(offsets, "__part").withColumn(name, F.col("__before") + F.col("__place")).drop("__part", "__place", "__before")
