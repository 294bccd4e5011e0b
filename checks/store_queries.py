"""What is kept between runs: orders and lines stored for their join, grouped profiles, states of logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.operator_queries import VIEWS
from checks.registry import ORACLES, query
from checks.settings import ID_DIGITS
from checks.tag_queries import _LOGIN, _PSM, LINE_SQL, LOG_SQL
from tagloom.operators.joining import orders_with_id
from tagloom.plans import partial_state as S
from tagloom.plans.line_tags import line_tags
from tagloom.plans.order_tags import payment
from tagloom.plans.profile_groups import ProfileGroups
from tagloom.plans.tag import aggregate_tags, project_tags, single_tag
from tagloom.plans.user_tags import constellation, gender, job
from tagloom.session import new_path
from tagloom.sources.order_store import OrderStore

BUCKETS = 8
DAYS = 3


def _stored(s):
    store = OrderStore(s.users.sparkSession, new_path(s.users.sparkSession, "orders"), BUCKETS)
    store.write(s.orders, s.goods)
    return store.open(s.users, s.logs)


@query("stored_order_lines", ORACLES["join_orders_goods"])
def _order_lines(s):
    """The join of orders and lines, read from co-bucketed tables."""
    return _stored(s).order_lines(ID_DIGITS).select("id", "orderSn", "productId", "paid", "listed")


@query("stored_line_tags", f"SELECT cid AS id, {', '.join(LINE_SQL.values())} FROM {_PSM.format(9)}")
def _line_tags(s):
    return aggregate_tags(_stored(s).order_lines(ID_DIGITS), line_tags().values())


@query("profile_groups_upsert", ORACLES["profile_upsert"])
def _groups(s):
    """Three programs with columns of two groups, each writing only its own."""
    spark = s.users.sparkSession
    store = ProfileGroups(spark, new_path(spark, "profile"), {"person": ["gender", "job"], "orders": ["paymentCode"]}, BUCKETS)
    store.upsert(project_tags(s.users.where("job <> '3'"), [gender(), job()]))
    others = project_tags(s.users.where("job <> '5'"), [constellation()]).withColumnRenamed("constellation", "gender")
    store.upsert(others)
    codes = single_tag(orders_with_id(s.orders, ID_DIGITS), payment())
    store.upsert(codes.join(others.select("id"), "id", "left_semi"))
    return store.read()


def _by_day(s):
    """The log in a few parts, as if they had come on different days."""
    for day in range(DAYS):
        yield f"part-{day}", s.logs.where(F.pmod(F.dayofyear("log_time"), F.lit(DAYS)) == day)


@query("log_tags_by_day", f"""SELECT uid AS id, {', '.join(LOG_SQL.values())}, period AS "ReadedTime_Browser",
    case when logins > 0 then {_LOGIN} end AS "LoginFrequency" FROM gsum JOIN gper USING (uid), gtot""")
def _log_tags(s):
    """All log tags from states that each day's log was merged into."""
    spark = s.logs.sparkSession
    state = S.log_tag_state(spark, new_path(spark, "log-state"), BUCKETS)
    for day, logs in _by_day(s):
        S.add_log_day(state, day, logs)
    return S.tags_of_state(state.read())


@query("rating_views_by_day", f"SELECT * FROM {VIEWS}")
def _ratings(s):
    spark = s.logs.sparkSession
    state = S.view_state(spark, new_path(spark, "view-state"), BUCKETS)
    for day, logs in _by_day(s):
        S.add_view_day(state, day, logs)
    return state.read()
