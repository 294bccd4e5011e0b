"""Per-key operators: most frequent, newest, distinct, sets, two-level averages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tagloom.functions.text import join_distinct
from tagloom.operators.metrics import ModeOf, aggregate


def mode_per_key(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Most frequent value per key: counts combine map-side, no sort of the raw rows."""
    return aggregate(df, key, {name: ModeOf(value)})


def last_per_key(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Newest row per key by the order columns (general form, any column type)."""
    newest = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(key).agg(newest.alias("row")).select(key, "row.*")


def dedup_by_key(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by the listed columns.

    The distinct step hashes repeated rows away map-side, so a key that holds a large
    share of the rows reaches the second step as a handful of rows. (``min_by`` instead
    of ``min``: under ``min`` Spark removes the distinct step as redundant.)
    """
    smallest = F.min_by(F.struct(*columns), F.struct(*columns))
    return (df.select(key, *columns).distinct()
            .groupBy(key).agg(smallest.alias("row")).select(key, "row.*"))


def set_join(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Sorted, comma-joined set of values per key.

    Repeats are removed by a hash aggregation before a key's values come together.
    """
    return df.select(key, value).distinct().groupBy(key).agg(F.expr(join_distinct(value)).alias(name))


def set_pieces(df: DataFrame, key: str, value: str, pieces: int | None = None) -> DataFrame:
    """(key, piece, values, text): the sorted set of each key, cut into pieces in ascending order.

    Distinct values are dealt by ranges of (key, value), so a key with a third of all values lies
    on a third of the partitions and no task sorts more than one partition. A piece is what a
    key has on one partition; its text is null when it holds only nulls. Without a number of
    ``pieces`` adaptive execution sizes the partitions by bytes.
    """
    bounds = [key, value] if pieces is None else [pieces, key, value]
    ranged = df.select(key, value).distinct().repartitionByRange(*bounds)
    placed = ranged.withColumn("piece", F.spark_partition_id())
    joined = f"CASE WHEN count({value}) > 0 THEN {join_distinct(value)} END"
    return placed.groupBy(key, "piece").agg(F.count(value).alias("values"), F.expr(joined).alias("text"))


def set_join_ranged(df: DataFrame, key: str, value: str, name: str, pieces: int | None = None) -> DataFrame:
    """``set_join`` for keys of very many values: sorted texts of value ranges are joined in order.

    Two shuffles of the distinct values more than ``set_join``; the last step holds a key's text,
    which is the result, and never its values one by one.
    """
    ordered = "array_sort(collect_list(struct(piece, text)))"
    texts = f"transform(filter({ordered}, x -> x.text IS NOT NULL), x -> x.text)"
    return set_pieces(df, key, value, pieces).groupBy(key).agg(F.expr(f"array_join({texts}, ',')").alias(name))


def with_totals(per_key: DataFrame, totals: dict[str, str], over: DataFrame | None = None) -> DataFrame:
    """Adds a struct ``totals`` of one-row aggregates over ``per_key`` itself, or over the same rows
    before they were dealt anew.

    A scalar subquery: no driver round trip and no join.
    """
    one_row = (per_key if over is None else over).agg(*[F.expr(sql).alias(n) for n, sql in totals.items()])
    return per_key.withColumn("totals", one_row.select(F.struct(*totals).alias("t")).scalar())
