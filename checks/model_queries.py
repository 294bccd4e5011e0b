"""Value segments and favourites. Scores and ratings have SQL; fitted models have none."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.operator_queries import VIEWS
from checks.registry import query
from checks.settings import AS_OF_ORDERS, FREQUENCY, ID_DIGITS, MONEY, PROFILE, RECENCY
from tagloom import labels as L
from tagloom.plans import profile as P
from tagloom.plans import recommend as R
from tagloom.plans import rfm as V
from tagloom.session import new_path

_METRICS = f"""SELECT memberId AS "memberId", cast(datediff('day', cast(make_timestamp(max(try_cast(finishTime as bigint)) * 1000000) as date), date '{AS_OF_ORDERS}') as int) AS recency,
    count(orderSn) AS frequency, round(sum(try_cast(orderAmount as double)), 2) AS money FROM fx_orders GROUP BY memberId"""


def scores(s):
    return V.rfm_scores(V.rfm_metrics(s.orders, AS_OF_ORDERS), RECENCY, FREQUENCY, MONEY)


def segments(member_scores):
    return V.Segments(V.fit_segments(member_scores), L.USER_VALUE)


@query("rfm_metrics", _METRICS)
def _metrics(s):
    metrics = V.rfm_metrics(s.orders, AS_OF_ORDERS)
    return metrics.select("memberId", "recency", "frequency", F.round("money", 2).alias("money"))


@query("rfm_scores", f"""SELECT "memberId",
    cast(case when recency >= 30 and recency < 120 then 5 when recency >= 120 and recency < 210 then 4 when recency >= 210 and recency < 300 then 3
      when recency >= 300 and recency < 480 then 2 when recency >= 480 then 1 end as int) AS recency,
    cast(case when frequency >= 20 then 5 when frequency >= 15 then 4 when frequency >= 10 then 3 when frequency >= 5 then 2
      when frequency >= 1 then 1 end as int) AS frequency,
    cast(case when money >= 2000000 then 5 when money between 1000000 and 1999990 then 4 when money between 500000 and 999990 then 3
      when money between 100000 and 499990 then 2 when money <= 99990 then 1 end as int) AS money FROM ({_METRICS})""")
def _scores(s):
    return scores(s).select("memberId", "recency", "frequency", "money")


@query("rfm_kmeans_fit")
def _kmeans(s):
    """Cluster centres: one row per cluster."""
    centers = V.segment_centers(V.fit_segments(scores(s)))
    return s.orders.sparkSession.createDataFrame(centers, "cluster int, recency double, frequency double, money double")


@query("tag_user_value")
def _user_value(s):
    member_scores = scores(s)
    return V.user_value(member_scores, segments(member_scores), ID_DIGITS)


@query("als_fit_views")
def _als_fit(s):
    """The fitted visitor factors."""
    return R.fit_page_views(R.view_ratings(s.logs), s.goods).user_factors()


@query("als_topn_wide")
def _als_topn(s):
    products = R.product_dimension(s.goods)
    return R.page_view_favourites(R.fit_page_views(R.view_ratings(s.logs), products), products)


@query("tag_favor_products")
def _favor_products(s):
    return R.favourite_products(R.view_ratings(s.logs), s.goods)


@query("tag_favor_types")
def _favor_types(s):
    return R.favourite_types(R.bought_items(s.orders, s.goods, ID_DIGITS), s.goods)


@query("tag_favor_brands")
def _favor_brands(s):
    return R.favourite_brands(R.bought_items(s.orders, s.goods, ID_DIGITS))


@query("model_roundtrip")
def _roundtrip(s):
    """Both model kinds saved to the shared folder, loaded and applied."""
    spark = s.orders.sparkSession
    member_scores = scores(s)
    named, factors = new_path(spark, "segments"), new_path(spark, "factors")
    segments(member_scores).save(spark, named)
    products = R.product_dimension(s.goods)
    R.fit_page_views(R.view_ratings(s.logs), products).save(factors)
    values = V.user_value(member_scores, V.Segments.load(spark, named), ID_DIGITS)
    names = R.page_view_favourites(R.Favourites.load(spark, factors, "productId"), products)
    return values.join(names.select("id", "productName0"), "id", "left")


@query("profile_full")
def _profile_full(s):
    """The whole profile, with value segments and favourites."""
    spark = s.orders.sparkSession
    stage = P.checkpointed(spark)
    member_scores = stage(scores(s)) if stage else scores(s)
    value = V.user_value(member_scores, segments(member_scores), ID_DIGITS)
    return P.build_profile(spark, s, PROFILE, [value, *R.favourite_frames(s, ID_DIGITS, stage)])


# ---- what SQL can say of fitted models: who is covered, by how much -----------------

_SCORED = f"""SELECT cast(right("memberId", {ID_DIGITS}) as bigint) AS id, "lastFinish",
    (recency >= 30 AND frequency >= 1 AND (money <= 99990 OR money between 100000 and 499990 OR money between 500000 and 999990
      OR money between 1000000 and 1999990 OR money >= 2000000)) IS TRUE AS scored
    FROM ({_METRICS}) JOIN (SELECT memberId AS "memberId", max(try_cast(finishTime as bigint)) AS "lastFinish" FROM fx_orders GROUP BY memberId) USING ("memberId")"""


@query("user_value_coverage", f"""SELECT id, coalesce(bool_or(scored) FILTER (WHERE "lastFinish" = newest), false) AS named
    FROM (SELECT *, max("lastFinish") OVER (PARTITION BY id) AS newest FROM ({_SCORED})) GROUP BY id""")
def _value_coverage(s):
    """Every customer with whether a segment was found: exactly where the newest member has all scores."""
    values = _user_value(s)
    allowed = F.col("userValue").isin(*L.USER_VALUE.values())
    return values.select("id", F.when(allowed, True).when(F.col("userValue") == L.UNKNOWN, False).alias("named"))


@query("topn_coverage", f"""SELECT DISTINCT "userId" AS id, least({len(L.RANK_COLUMNS)}, (SELECT count(DISTINCT v."productId") FROM {VIEWS} v JOIN fx_goods g ON try_cast(g.productId as bigint) = v."productId")) AS items
    FROM {VIEWS} v JOIN fx_goods g ON try_cast(g.productId as bigint) = v."productId" """)
def _topn_coverage(s):
    """Every visitor with a list of the fitted model's best items, and the number of different items on it."""
    return _covered(R.fit_page_views(R.view_ratings(s.logs), s.goods), len(L.RANK_COLUMNS))


def _covered(fitted, most):
    return R.top_items(fitted, most).groupBy("id").agg(F.countDistinct(fitted.item).alias("items"))


@query("favourite_coverage", f"""SELECT DISTINCT cast(cid as bigint) AS id, least({L.TOP_TYPES}, (SELECT count(DISTINCT cast(productId as bigint)) FROM l9)) AS items FROM l9""")
def _favourite_coverage(s):
    """Every buyer with a list of the fitted model's best products, and the number of different products on it."""
    items = R.bought_items(s.orders, s.goods, ID_DIGITS)
    return _covered(R.fit_als(R.order_ratings(items), "productId", L.ALS_FAVOURITES), L.TOP_TYPES)


@query("roundtrip_equal", f"""SELECT count(DISTINCT id) AS customers, cast(0 as bigint) AS different FROM ({_SCORED}) WHERE id IS NOT NULL""")
def _roundtrip_equal(s):
    """Customers, and how many of them a stored and loaded model labels otherwise."""
    spark, path = s.orders.sparkSession, new_path(s.orders.sparkSession, "segments")
    member_scores, fitted = scores(s), segments(scores(s))
    fitted.save(spark, path)
    direct = V.user_value(member_scores, fitted, ID_DIGITS)
    loaded = V.user_value(member_scores, V.Segments.load(spark, path), ID_DIGITS).withColumnRenamed("userValue", "again")
    return direct.join(loaded, "id", "full_outer").agg(
        F.count(F.lit(1)).alias("customers"), F.count_if(~F.col("userValue").eqNullSafe(F.col("again"))).alias("different"))
