"""Tags of the page-view log, per visitor id."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tagloom import labels as L
from tagloom.functions.casting import literal, whole_id
from tagloom.functions.ladders import case, rung, text_position
from tagloom.functions.text import product_id
from tagloom.functions.timing import epoch_micros, hour_of
from tagloom.operators.grouping import set_join
from tagloom.operators.metrics import Metric, latest, latest_label
from tagloom.plans.tag import Tag

_SEEN = {"seen": epoch_micros("log_time")}


def logs_with_id(logs: DataFrame) -> DataFrame:
    """Log rows keyed by visitor id; rows of unknown visitors cannot be stored."""
    keyed = logs.withColumnRenamed("id", "logId").withColumn("id", F.expr(whole_id("global_user_id")))
    return keyed.where("id IS NOT NULL")


def _average(count: str, population: int | None) -> str:
    """Mean count over the population, by default all visitors of the log."""
    people = "count(id)" if population is None else literal(population)
    return f"try_divide(CAST(sum({count}) AS DOUBLE), CAST({people} AS DOUBLE))"


def _frequency(count: str, average: str, low_factor: float) -> str:
    low, high = f"{count} * {literal(low_factor)}", f"{count} / {literal(L.FREQUENCY_HIGH_DIVISOR)}"
    return case([
        (f"{count} = 0", L.FREQUENCY_NONE),
        (f"{low} < {average}", L.FREQUENCY_LOW),
        (f"{low} >= {average} AND {high} < {average}", L.FREQUENCY_MID),
        (f"{high} >= {average}", L.FREQUENCY_HIGH),
    ])


def login_frequency(population: int | None = None) -> Tag:
    """Log-ins against the average of the population; visitors without one have no tag."""
    return Tag(
        {"LoginFrequency": _frequency("logins", "totals.login_average", L.LOGIN_LOW_FACTOR)},
        {"logins": Metric("count_if", f"loc_url LIKE {literal(L.LOGIN_PATTERN)}")},
        totals={"login_average": _average("logins", population)},
        present="logins > 0")


def view_frequency(population: int | None = None) -> Tag:
    return Tag(
        {"ViewFrequency": _frequency("views", "totals.view_average", L.VIEW_LOW_FACTOR)},
        {"views": Metric("count", "global_user_id")},
        totals={"view_average": _average("views", population)})


def watch_time() -> Tag:
    """Minutes between first and last view, in whole seconds; a span in [1, 2) has no label."""
    label = case([
        ("watched < 1", L.WATCH_UNDER_ONE),
        ("CAST(watched AS INT) BETWEEN 2 AND 5", L.WATCH_ONE_TO_FIVE),
        ("watched >= 5", L.WATCH_OVER_FIVE),
    ])
    return Tag({"WatchTime": label}, {"seen_max": Metric("max", "seen"), "seen_min": Metric("min", "seen")},
               inputs=_SEEN, values={"watched": "(seen_max DIV 1000000 - seen_min DIV 1000000) / 60D"})


def read_period(ladder=L.READ_PERIOD, default: str = L.READ_PERIOD_DEFAULT) -> Tag:
    """Most frequent part of the day; ties go to the smaller text.

    The periods are a fixed short list, so each is one counter of the shared aggregation
    and the most frequent one is picked from the counters: no second grouping.
    """
    names = sorted({str(b.label) for b in ladder} | {default})
    of_hour = [names.index(rung(hour, ladder, default)) for hour in range(24)]
    period = f"coalesce(element_at(array({', '.join(map(str, of_hour))}), {hour_of('log_time')} + 1), {names.index(default)})"
    counters = {f"period_{i}": Metric("count_if", f"period = {i}") for i in range(len(names))}
    pick = case([(f"{counter} = period_most", name) for counter, name in zip(counters, names)])
    return Tag({"ReadedTime_Browser": pick}, counters,
               inputs={"period": period},
               values={"period_most": f"greatest({', '.join(counters)})"})


def device(rules=L.DEVICE, default: str = L.DEVICE_DEFAULT) -> Tag:
    """Device of the newest view."""
    labels = [*[r.label for r in rules], default]
    return Tag({"device": latest_label("device_latest", labels)},
               {"device_latest": latest("seen", text_position("user_agent", rules), len(labels))}, inputs=_SEEN)


def page_type(rules=L.PAGE_TYPE, default: str = L.PAGE_TYPE_DEFAULT) -> Tag:
    """Kind of the newest page seen and of the page it was reached from."""
    labels = [*[r.label for r in rules], default]
    urls = {"browser_loc_url": "loc_url", "browser_ref_url": "ref_url"}
    return Tag(
        {name: latest_label(f"{url}_latest", labels) for name, url in urls.items()},
        {f"{url}_latest": latest("seen", text_position(url, rules), len(labels)) for url in urls.values()},
        inputs=_SEEN)


def viewed_products(logs: DataFrame) -> DataFrame:
    """(id, productId) per product page view, with whole-number product ids."""
    viewed = logs_with_id(logs).selectExpr("id", f"{whole_id(product_id('loc_url'), 'BIGINT')} AS productId")
    return viewed.where("productId IS NOT NULL")


def view_goods(logs: DataFrame, goods: DataFrame, joined=set_join) -> DataFrame:
    """Names of all viewed products, as one sorted list per visitor.

    Both sides are made distinct first: repeated views and repeated order lines would
    otherwise multiply in the join. ``joined`` is ``set_join``, or ``set_join_ranged`` for
    visitors with very many products.
    """
    names = goods.selectExpr(f"{whole_id('productId', 'BIGINT')} AS productId", "productName").distinct()
    named = viewed_products(logs).distinct().join(names, "productId", "inner")
    return joined(named, "id", "productName", "ViewGoods")


def log_tags(population: int | None = None) -> dict[str, Tag]:
    return {
        "login_frequency": login_frequency(population),
        "view_frequency": view_frequency(population),
        "watch_time": watch_time(),
        "read_period": read_period(),
        "device": device(),
        "page_type": page_type(),
    }
