"""Parquet folders that are bucketed by some columns, without a catalogue of tables.

Two such folders with equally many buckets join on these columns, and one is aggregated by them,
without moving a row. Spark carries buckets on tables only: a folder is named as one for the
moment in which a frame is resolved, and a marker beside its files says how.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tagloom.functions.casting import text


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """One sorted file per bucket. A key's rows come to one task: keep hot keys out."""
    spark, table = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_buckets-{buckets}-{'+'.join(keys)}")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, False).close()


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_buckets-*")
    markers = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    if len(markers) != 1:
        raise FileNotFoundError(f"{path} is no bucketed folder")
    _, buckets, keys = markers[0].getPath().getName().split("-", 2)
    by = ", ".join(f"`{key}`" for key in keys.split("+"))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    table = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION {text(path)}")
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
