"""Relational tables through Spark's JDBC source. Credentials come from the caller only."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def as_options(self) -> dict[str, str]:
        named = {"url": self.url, "dbtable": self.table, "user": self.user,
                 "password": self.password, "driver": self.driver}
        return {**{k: v for k, v in named.items() if v is not None}, **self.options}


def parallel_read_options(column: str, lower: int, upper: int, partitions: int,
                          fetch_size: int = 10_000) -> dict[str, str]:
    """Range-split read: one query per partition instead of one connection for the table.

    The bounds only place the split points; rows outside them are still read.
    """
    if partitions < 1 or upper <= lower:
        raise ValueError("need at least one partition and upper > lower")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(partitions), "fetchsize": str(fetch_size)}


def export_options(connections: int, batch_size: int = 5_000) -> dict[str, str]:
    """Overwrite keeps the table's definition (truncate) and bounds the open connections."""
    return {"truncate": "true", "batchsize": str(batch_size), "numPartitions": str(connections)}


def read_table(spark: SparkSession, table: JdbcTable, split: dict[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**table.as_options(), **(split or {})).load()


def export_table(df: DataFrame, table: JdbcTable, connections: int = 16) -> None:
    options = {**table.as_options(), **export_options(connections)}
    df.write.format("jdbc").mode("overwrite").options(**options).save()
