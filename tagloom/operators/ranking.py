"""Top-N lists per key and their wide form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n_per_key(df: DataFrame, key: str, order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n rows per key with their zero-based rank.

    The filter stands on the bare row number: Spark then cuts each key to n rows in
    every task before the shuffle, so a hot key never comes together whole.
    """
    numbered = df.withColumn("__row", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return numbered.where(F.col("__row") <= n).withColumn(rank, F.col("__row") - 1).drop("__row")


def ranks_to_columns(ranked: DataFrame, key: str, rank: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column per rank; a rank a key does not have is null."""
    cells = [F.max(F.when(F.col(rank) == k, F.col(value))).alias(name) for k, name in enumerate(names)]
    return ranked.groupBy(key).agg(*cells)
