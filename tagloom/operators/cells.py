"""Wide rows to (id, column, value) cells and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def to_cells(df: DataFrame, key: str = "id", columns: Sequence[str] | None = None) -> DataFrame:
    """One row per non-null cell, values as text. By default every column, the key included."""
    names = sorted(columns or df.columns)
    texts = df.select(F.col(key).alias("__key"), *[F.col(c).cast("string").alias(c) for c in names])
    return (texts.unpivot(["__key"], names, "column", "value")
            .where(F.col("value").isNotNull())
            .withColumnRenamed("__key", key))


def from_cells(cells: DataFrame, columns: Sequence[str], key: str = "id", version: str = "ts") -> DataFrame:
    """One row per key; of several versions of a cell the newest wins (equal versions: larger value)."""
    newest = [
        F.max(F.when(F.col("column") == c, F.struct(F.col(version), F.col("value"))))["value"].alias(c)
        for c in columns
    ]
    return cells.where(F.col("column").isin(*columns)).groupBy(key).agg(*newest)


def sorted_cells(cells: DataFrame, key: str = "id") -> DataFrame:
    """Cells dealt by ranges of keys and sorted, as they are best stored."""
    return cells.repartitionByRange(key, "column").sortWithinPartitions(key, "column")


def write_cells(cells: DataFrame, path: str, key: str = "id") -> None:
    """A rerun replaces the directory. Where others may read meanwhile, publish versions instead:
    ``Versions(spark, root).put_table(sorted_cells(cells))``."""
    sorted_cells(cells, key).write.mode("overwrite").parquet(path)
