"""Intermediate tables in the shared folder: they cut lineage, are read column by column,
and survive lost executors."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tagloom.session import new_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame, name: str = "stage", kept: bool = False) -> DataFrame:
    """Writes the rows below the shared folder and reads them back.

    The folder belongs to the caller's run: it may be removed once nothing that was
    derived from the returned frame is read any more. Inside ``scratch`` that is the end
    of the block, unless the table is ``kept``. The shuffle files of the write go with its end.
    """
    path = new_path(df.sparkSession, name)
    known = _staged.get()
    if known is not None and not kept:
        known.append(path)
    with _shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes a query's shuffle files when the query ends, and not when the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def discard(staged: DataFrame) -> None:
    """Removes a staged table before its block ends, once its rows are read no more."""
    spark = staged.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in staged.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables staged inside the block when it ends, but for those kept."""
    paths: list[str] = []
    before = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(before)
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, paths):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
