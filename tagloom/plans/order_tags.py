"""Tags of the orders, per customer id."""

from __future__ import annotations

from tagloom import labels as L
from tagloom.functions.casting import to_long
from tagloom.functions.ladders import bin_ladder, decode_position
from tagloom.functions.text import share, share_3_decimals
from tagloom.functions.timing import days_between
from tagloom.operators.metrics import Metric, ModeOf, latest, latest_label
from tagloom.plans.tag import Tag

_AMOUNT = {"amount": to_long("orderAmount")}
_FINISH = {"finish": to_long("finishTime")}


def home_city(book=L.HOME_CITY, default: str = L.HOME_CITY_DEFAULT) -> Tag:
    """City of the customer's newest order."""
    labels = [*book.values(), default]
    return Tag({"jiguan": latest_label("city_latest", labels)},
               {"city_latest": latest("finish", decode_position("city", book), len(labels))}, inputs=_FINISH)


def payment() -> Tag:
    """Most used payment code."""
    return Tag({"paymentCode": "payment_mode"}, {"payment_mode": ModeOf("paymentCode")})


def spend_total(ladder=L.SPEND_TOTAL) -> Tag:
    return Tag({"ComsumptionAbility": bin_ladder("amount_sum", ladder, L.UNKNOWN)},
               {"amount_sum": Metric("sum", "amount")}, inputs=_AMOUNT)


def spend_max(ladder=L.SPEND_MAX) -> Tag:
    return Tag({"MaxSingleComsumption": bin_ladder("amount_max", ladder, L.UNKNOWN)},
               {"amount_max": Metric("max", "amount")}, inputs=_AMOUNT)


def spend_avg(ladder=L.SPEND_AVG) -> Tag:
    return Tag({"PerCustomerTransation": bin_ladder("amount_mean", ladder, L.UNKNOWN)},
               {"amount_sum": Metric("sum", "amount"), "amount_rows": Metric("count", "amount")},
               inputs=_AMOUNT, values={"amount_mean": share("amount_sum", "amount_rows")})


def purchase_frequency(ladder=L.PURCHASE_FREQUENCY) -> Tag:
    return Tag({"purchaseFrequency": bin_ladder("order_rows", ladder, L.UNKNOWN)},
               {"order_rows": Metric("count", "1")})


def advisory(ladder=L.ADVISORY) -> Tag:
    """Share of orders with a customer-service contact."""
    return Tag({"AdvisoryServiceFrequency": bin_ladder("advised_share", ladder, L.UNKNOWN)}, {
        "advised": Metric("count_if", f"{to_long('smManualTime')} > 0"),
        "amount_texts": Metric("count", "orderAmount"),
    }, values={"advised_share": share_3_decimals("advised", "amount_texts")})


def consumption_cycle(ladder=L.CONSUMPTION_CYCLE) -> Tag:
    """Days between first and last finished order, per finished order."""
    finished = "CASE WHEN finish > 0 THEN finish END"
    days = share(days_between("finish_max", "finish_min"), "finish_rows")
    return Tag({"consumptionCycle": bin_ladder("cycle_days", ladder, L.UNKNOWN)}, {
        "finish_max": Metric("max", finished),
        "finish_min": Metric("min", finished),
        "finish_rows": Metric("count", finished),
    }, inputs=_FINISH, values={"cycle_days": days}, present="finish_rows > 0")


def replacement(ladder=L.REPLACEMENT) -> Tag:
    return Tag({"replacementRate": bin_ladder("replaced_share", ladder, L.UNKNOWN)}, {
        "replaced": Metric("count_if", "orderStatus = '1'"),
        "status_texts": Metric("count", "orderStatus"),
    }, values={"replaced_share": share_3_decimals("replaced", "status_texts")})


def returns(ladder=L.RETURN) -> Tag:
    return Tag({"returnRate": bin_ladder("returned_share", ladder)}, {
        "returned": Metric("count_if", "orderStatus = '0'"),
        "order_ids": Metric("count", "orderId"),
    }, values={"returned_share": share("returned", "order_ids")})


def order_tags(ladders: dict | None = None) -> dict[str, Tag]:
    """All order tags; ``ladders`` replaces default ladders by tag name."""
    own = ladders or {}

    def built(name, make):
        return make(own[name]) if name in own else make()
    return {
        "home_city": home_city(),
        "payment": payment(),
        "spend_total": built("spend_total", spend_total),
        "spend_max": built("spend_max", spend_max),
        "spend_avg": built("spend_avg", spend_avg),
        "purchase_frequency": built("purchase_frequency", purchase_frequency),
        "advisory": built("advisory", advisory),
        "consumption_cycle": built("consumption_cycle", consumption_cycle),
        "replacement": built("replacement", replacement),
        "return": built("return", returns),
    }
