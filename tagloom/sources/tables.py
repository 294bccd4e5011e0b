"""The four source tables as one argument."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tagloom.operators import joining
from tagloom.sources.catalog import GOODS, LOGS, ORDERS, USERS, scan


@dataclass(frozen=True)
class Sources:
    users: DataFrame
    orders: DataFrame
    goods: DataFrame
    logs: DataFrame

    @staticmethod
    def read(spark: SparkSession, root: str) -> "Sources":
        return Sources(*[scan(spark, s, f"{root}/{s.table}") for s in (USERS, ORDERS, GOODS, LOGS)])

    def order_lines(self, id_digits: int | None) -> DataFrame:
        """Orders joined with their lines, keyed by customer id."""
        return joining.order_lines(self.orders, self.goods, id_digits)

    def register_views(self, profile: DataFrame | None = None) -> None:
        """Names every source, and the profile, for SQL."""
        self.users.createOrReplaceTempView("tbl_users")
        self.orders.createOrReplaceTempView("tbl_orders")
        self.goods.createOrReplaceTempView("tbl_goods")
        self.logs.createOrReplaceTempView("tbl_logs")
        if profile is not None:
            profile.createOrReplaceTempView("customer_profile")
