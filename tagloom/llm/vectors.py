"""Vectors of whole numbers, as exact integers for the operators that must not round."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagloom.operators.staging import stage

LARGEST = 1 << 24  # of a whole number; larger ones are an error, so that sums of products stay exact
_EXACT = 1 << 53  # float64 holds every whole number below


def _floors(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, null where the vector is null or holds null or
    non-finite components."""
    parts = vector.cast("array<double>")
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    too_large = F.raise_error(F.lit(f"a component is not below {LARGEST} / {scale} in size"))
    floors = F.transform(parts, lambda x: F.when(F.abs(x) * scale < LARGEST, F.floor(x * scale).cast("int")).otherwise(too_large))
    return F.when(F.coalesce(finite, F.lit(False)), floors)


def whole_vectors(df: DataFrame, vector: str, scale: int, columns: Sequence[Column], multiple: int = 1) -> tuple[DataFrame, int, int]:
    """Staged rows (row, vector, columns) of the vectors without null or non-finite components, their
    common width and their number.

    ``row`` numbers the rows, whatever their ids. Vectors of several lengths get zeros at their
    end up to the longest length, rounded up to a ``multiple``.
    """
    read = df.select(*columns, _floors(F.col(vector), scale).alias("vector")).where("vector IS NOT NULL")
    rows = stage(read.withColumn("row", F.monotonically_increasing_id()), "whole-vectors")
    longest, number = rows.agg(F.max(F.size("vector")), F.count(F.lit(1))).first()
    width = -(-(longest or 0) // multiple) * multiple
    padding = F.array_repeat(F.lit(0), F.greatest(F.lit(0), F.lit(width) - F.size("vector")))
    return rows.withColumn("vector", F.concat("vector", padding)), width, number


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """A column of equally long lists as a matrix of long integers."""
    parts = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(parts.flatten()).astype(np.int64).reshape(len(parts), width)


def products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x times y transposed, exact: in float64 where every sum is a whole number it can hold."""
    most = max(1, int(np.abs(x).max(initial=0))) * max(1, int(np.abs(y).max(initial=0))) * max(1, x.shape[1])
    if most < _EXACT:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    return x @ y.T
