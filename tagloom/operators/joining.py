"""Joins. No hints: adaptive execution broadcasts a side only after measuring it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagloom.functions.casting import literal, suffix_id, to_long
from tagloom.labels import NO_COUPON
from tagloom.operators.grouping import dedup_by_key


def orders_with_id(orders: DataFrame, id_digits: int | None) -> DataFrame:
    """Orders keyed by customer id. Orders without a readable id cannot be stored."""
    keyed = orders.withColumnRenamed("id", "orderId").withColumn("id", F.expr(suffix_id("memberId", id_digits)))
    return keyed.where("id IS NOT NULL")


def line_values() -> dict[str, str]:
    """Numbers of an order line, parsed before the join so that only they are shuffled."""
    price, number, fee = to_long("price"), to_long("number"), to_long("shippingFee")
    return {
        "paid": to_long("productAmount"),
        "priced": "productAmount IS NOT NULL",
        "listed": f"try_add(try_multiply({price}, {number}), {fee})",
        "usedActivity": f"activityPrice <> {literal(NO_COUPON)}",
        "usedCoupon": f"couponAmount <> {literal(NO_COUPON)}",
        "usedPromotion": f"orderPromotionAmount <> {literal(NO_COUPON)}",
    }


def order_lines(orders: DataFrame, goods: DataFrame, id_digits: int | None) -> DataFrame:
    """Orders joined with their lines on the order number, keyed by customer id."""
    left = orders_with_id(orders, id_digits).select("id", "orderSn")
    right = goods.drop("id").withColumns({name: F.expr(sql) for name, sql in line_values().items()})
    return left.join(right, left.orderSn == right.cOrderSn, "inner").drop("cOrderSn")


def product_names(goods: DataFrame, name: str = "productName") -> DataFrame:
    """One row per product with its name (or another attribute)."""
    return dedup_by_key(goods.where("productId IS NOT NULL"), "productId", [name])


def lookup(df: DataFrame, on: str, dimension: DataFrame, key: str) -> DataFrame:
    """Inner lookup on a dimension with one row per key.

    The dimension grows with the catalogue, so it is never force-broadcast: adaptive
    execution broadcasts it when it is measured small and otherwise splits hot keys.
    """
    return df.join(dimension.withColumnRenamed(key, on), on, "inner")


def lookup_book(df: DataFrame, column: str, book: DataFrame, default: str, name: str) -> DataFrame:
    """Code-book decode with the book as a two-column table (code, label); misses get the default."""
    renamed = book.toDF(column, name)
    return df.join(renamed, column, "left").withColumn(name, F.coalesce(name, F.lit(default)))
