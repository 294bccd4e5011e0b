"""Table catalogues: logical column name -> stored cell and type.

A catalogue is JSON: ``{"table": {"name": ...}, "rowkey": ..., "columns": {name: {"cf":
..., "col": ..., "type": ...}}}``. Type names are case-insensitive; a logical name may
differ from the name of its cell.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, DoubleType, IntegerType, LongType, StringType

from tagloom.sources.versions import Versions

_TYPES: dict[str, DataType] = {
    "long": LongType(), "bigint": LongType(), "int": IntegerType(), "double": DoubleType(),
    "string": StringType(),
}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    cell: str
    type: DataType


@dataclass(frozen=True)
class TableSpec:
    table: str
    key: str
    columns: tuple[ColumnSpec, ...]

    @staticmethod
    def from_json(text: str) -> "TableSpec":
        doc = json.loads(text)
        columns = tuple(
            ColumnSpec(name, c["col"], _TYPES[c["type"].lower()]) for name, c in doc["columns"].items())
        keys = [c.name for c in columns if c.cell == doc["rowkey"]]
        if len(keys) != 1:
            raise ValueError(f"catalogue of {doc['table']['name']} must map its row key once")
        return TableSpec(doc["table"]["name"], keys[0], columns)

    @staticmethod
    def of(table: str, key: str, *names: str) -> "TableSpec":
        """A catalogue whose columns are all text but the long key."""
        columns = [ColumnSpec(key, key, LongType())] + [ColumnSpec(n, n, StringType()) for n in names]
        return TableSpec(table, key, tuple(columns))

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def project(self, stored: DataFrame) -> DataFrame:
        """Only the catalogue's columns, under their logical names and types.

        A cell the store has never written reads as null, as in any sparse table. The
        select is all it takes for the parquet reader to read just these columns.
        """
        present = {c.lower() for c in stored.columns}
        return stored.select([
            (F.col(c.cell) if c.cell.lower() in present else F.lit(None)).try_cast(c.type).alias(c.name)
            for c in self.columns
        ])

    def store(self, df: DataFrame) -> DataFrame:
        """The inverse: catalogue columns under their cell names. Rows need a key."""
        return df.where(F.col(self.key).isNotNull()).select(
            [F.col(c.name).cast(c.type).alias(c.cell) for c in self.columns])


def scan(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    return spec.project(spark.read.parquet(path))


def clone_table(spark: SparkSession, source: str, target: str, read: TableSpec, write: TableSpec) -> None:
    """Copies the columns of one catalogue into a new table."""
    write.store(scan(spark, read, source)).write.mode("overwrite").parquet(target)


def clone_version(spark: SparkSession, source: str, target: Versions, read: TableSpec, write: TableSpec) -> int:
    """The same as a new version of the target, whose readers keep the one they opened."""
    return target.put_table(write.store(scan(spark, read, source)))


# ---- fixed values: source tables -----------------------------------------------

USERS = TableSpec.of("tbl_users", "id", "username", "gender", "job", "marriage", "nationality",
                     "politicalFace", "birthday", "lastLoginTime")
ORDERS = TableSpec.of("tbl_orders", "id", "memberId", "orderSn", "orderAmount", "finishTime",
                      "paymentCode", "orderStatus", "smManualTime", "city")
GOODS = TableSpec.of("tbl_goods", "id", "cOrderSn", "productId", "productName", "productType", "cateId",
                     "brandId", "price", "number", "productAmount", "shippingFee", "activityPrice",
                     "couponAmount", "orderPromotionAmount")
LOGS = TableSpec.of("tbl_logs", "id", "global_user_id", "log_time", "loc_url", "ref_url", "user_agent")
