"""Tags of orders joined with their lines (see ``operators.joining.order_lines``)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tagloom import labels as L
from tagloom.functions.ladders import bin_ladder
from tagloom.functions.text import share
from tagloom.operators.grouping import set_join_ranged
from tagloom.operators.metrics import Metric, SetOf
from tagloom.plans.tag import Tag


def _sums() -> dict[str, Metric]:
    return {"paid_sum": Metric("sum", "paid"), "listed_sum": Metric("sum", "listed")}


def coupons() -> Tag:
    """How many lines used an activity price, a coupon, an order promotion."""
    columns = {"activity": "usedActivity", "coupon": "usedCoupon", "promotion": "usedPromotion"}
    return Tag({name: f"CAST({name}_lines AS STRING)" for name in columns},
               {f"{name}_lines": Metric("count_if", used) for name, used in columns.items()})


def discount(ladder=L.DISCOUNT) -> Tag:
    """Paid over listed value."""
    return Tag({"discount": bin_ladder("paid_share", ladder, L.UNKNOWN)}, _sums(),
               values={"paid_share": share("paid_sum", "listed_sum")})


def price_sensitivity(ladder=L.PRICE_SENSITIVITY) -> Tag:
    """Share of discounted lines + relative mean discount + discount share of the value."""
    lines, cut_lines = "priced_lines", "cut_lines"
    value, cut = "listed_sum", "(listed_sum - paid_sum)"
    measure = (f"({share(cut_lines, lines)}"
               f" + try_divide({share(cut, cut_lines)}, {share(value, lines)})"
               f" + {share(cut, value)})")
    return Tag({"PriceSensitivity": bin_ladder("sensitivity", ladder, L.UNKNOWN)}, {
        **_sums(),
        "priced_lines": Metric("count_if", "priced"),
        "cut_lines": Metric("count_if", "try_subtract(listed, paid) > 0"),
    }, values={"sensitivity": measure})


def purchase_goods() -> Tag:
    return Tag({"purchaseGoods": "bought_names"}, {"bought_names": SetOf("productName")})


def purchase_goods_ranged(lines: DataFrame) -> DataFrame:
    """``purchase_goods`` alone, for customers with very many products."""
    return set_join_ranged(lines, "id", "productName", "purchaseGoods")


def line_tags() -> dict[str, Tag]:
    return {
        "coupons": coupons(),
        "discount": discount(),
        "price_sensitivity": price_sensitivity(),
        "purchase_goods": purchase_goods(),
    }
