"""Single operators and functions, each over a whole source table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ORACLES, query
from checks.settings import AS_OF_LOGIN, AS_OF_ORDERS, ID_DIGITS
from tagloom import labels as L
from tagloom.functions.casting import suffix_id, to_double, to_int, to_long
from tagloom.functions.ladders import bin_ladder, decode, decode_many
from tagloom.functions.text import (explode_list, join_field, product_id, share, share_3_decimals,
                                    split_to_columns)
from tagloom.functions.timing import (birth_year, days_between, days_since, epoch_date, epoch_seconds,
                                      hour_of, month_day, recency_days)
from tagloom.labels import Bin
from tagloom.operators.grouping import dedup_by_key, mode_per_key, set_join, set_join_ranged
from tagloom.operators.joining import (lookup, lookup_book, order_lines, orders_with_id, product_names)
from tagloom.operators.ranking import top_n_per_key
from tagloom.plans.log_tags import logs_with_id
from tagloom.plans.recommend import (bought_items, brand_ratings, brand_sets, counted_items, names_by_rank,
                                     order_ratings, view_ratings, with_line_copies)

AMT = "cast(trunc(try_cast(orderAmount as double)) as bigint)"


def orders(s):
    return orders_with_id(s.orders, ID_DIGITS)


def lines(s):
    return order_lines(s.orders, s.goods, ID_DIGITS)

# ---- projections, filters ------------------------------------------------------------


@query("op_rename", 'SELECT id AS "userId", username FROM fx_users')
def _rename(s):
    """Renaming a column that is not there changes nothing."""
    return s.users.select("id", "username").withColumnRenamed("id", "userId").withColumnRenamed("nobody", "x")


@query("op_drop", "SELECT id, gender FROM fx_users")
def _drop(s):
    return s.users.select("id", "gender", "job").drop("job", "nobody")


@query("op_filter_notnull", 'SELECT id, lastLoginTime AS "lastLoginTime" FROM fx_users WHERE lastLoginTime IS NOT NULL')
def _notnull(s):
    return s.users.select("id", "lastLoginTime").where(F.col("lastLoginTime").isNotNull())


@query("op_filter_cmp", 'SELECT id, try_cast(smManualTime as bigint) AS "Time" FROM fx_orders WHERE try_cast(smManualTime as bigint) > 0')
def _cmp(s):
    return s.orders.selectExpr("id", f"{to_long('smManualTime')} AS Time").where("Time > 0")


@query("op_filter_like", "SELECT id, loc_url FROM fx_logs WHERE loc_url LIKE '%login%'")
def _like(s):
    return s.logs.select("id", "loc_url").where(F.col("loc_url").like(L.LOGIN_PATTERN))


@query("op_decode_map", """SELECT id, case city when '716' then '北京市' when '173' then '山东青岛' when '335' then '甘肃兰州'
    when '271' then '重庆市' else 'null' end AS city FROM fx_orders""")
def _decode_map(s):
    return s.orders.selectExpr("id", f"{decode('city', L.HOME_CITY, L.HOME_CITY_DEFAULT)} AS city")


@query("op_decode_join", """SELECT id, nationality AS code, case nationality when '1' then '中国大陆' when '2' then '中国香港' when '3' then '中国澳门'
    when '4' then '中国台湾' when '5' then '其他' else '未知' end AS label FROM fx_users""")
def _decode_join(s):
    """The same decode with the book as a table."""
    book = s.users.sparkSession.createDataFrame(list(L.NATIONALITY.items()), "code string, label string")
    users = s.users.select("id", F.col("nationality").alias("code"))
    return lookup_book(users, "code", book, L.UNKNOWN, "label")


@query("op_decode_many", """SELECT id, productId AS "productId", case when brandId in ('297', '301', '0') then '1' when brandId = '298' then '2'
    when brandId = '299' then '3' when brandId in ('303', '5') then '4' when brandId = '305' then '5' else '0' end AS brand FROM fx_goods""")
def _decode_many(s):
    brand = decode_many("brandId", L.BRAND_GROUP, L.BRAND_GROUP_DEFAULT)
    return s.goods.selectExpr("id", "productId", f"{brand} AS brand")


@query("op_bin_ladder", f"""SELECT id, case when {AMT} >= 400000 then 'a' when {AMT} > 200000 and {AMT} <= 300000 then 'b'
    when {AMT} < 100000 then 'c' end AS bin FROM fx_orders""")
def _bins(s):
    """A ladder with a gap and no default."""
    ladder = [Bin("a", ge=400000), Bin("b", gt=200000, le=300000), Bin("c", lt=100000)]
    return s.orders.selectExpr("id", f"{to_long('orderAmount')} AS amount").selectExpr("id", f"{bin_ladder('amount', ladder)} AS bin")


@query("op_between", f"SELECT id, {AMT} AS amount FROM fx_orders WHERE {AMT} BETWEEN 100000 AND 199999")
def _between(s):
    return s.orders.selectExpr("id", f"{to_long('orderAmount')} AS amount").where(F.col("amount").between(100000, 199999))

# ---- joins ------------------------------------------------------------------------------


@query("join_orders_goods", 'SELECT cid AS id, orderSn AS "orderSn", productId AS "productId", paid, listed FROM l9')
def _join(s):
    return lines(s).select("id", "orderSn", "productId", "paid", "listed")


@query("product_preference", """SELECT cid AS id, orderSn AS "orderSn", productType AS "productType", cateId AS "cateId",
    brandId AS "brandId" FROM l3""")
def _preference(s):
    """Type, category and brand of every order line, ids from three characters."""
    return order_lines(s.orders, s.goods, 3).select("id", "orderSn", "productType", "cateId", "brandId")


VIEWS = """(SELECT try_cast(global_user_id as bigint) AS "userId", try_cast(regexp_extract(loc_url, '/product/([0-9]+)\\.html', 1) as bigint) AS "productId",
    count(*) AS rating FROM fx_logs WHERE try_cast(regexp_extract(loc_url, '/product/([0-9]+)\\.html', 1) as bigint) IS NOT NULL GROUP BY 1, 2)"""


@query("als_ratings_joined", f"""SELECT "userId", v."productId", rating, count(*) AS copies FROM {VIEWS} v
    JOIN fx_goods g ON try_cast(g.productId as bigint) = v."productId" GROUP BY "userId", v."productId", rating""")
def _als_joined(s):
    """The many-to-many join of ratings and order lines, its repeated rows counted instead of repeated."""
    return with_line_copies(view_ratings(s.logs), s.goods)


@query("lookup_item_name", """SELECT r.id, r."productId", n.name AS "productName" FROM
    (SELECT DISTINCT cid AS id, productId AS "productId" FROM l9) r
    JOIN (SELECT productId AS pid, min(productName) AS name FROM fx_goods GROUP BY productId) n ON n.pid = r."productId" """)
def _lookup(s):
    items = lines(s).select("id", "productId").distinct()
    return lookup(items, "productId", product_names(s.goods), "productId").select("id", "productId", "productName")


BEST = """(SELECT cid AS id, productId, row_number() OVER (PARTITION BY cid ORDER BY count(*) DESC, try_cast(productId as bigint)) - 1 AS rank
    FROM l9 GROUP BY cid, productId)"""


def most_bought(s, n):
    counts = lines(s).groupBy("id", "productId").agg(F.count(F.lit(1)).alias("bought"))
    return top_n_per_key(counts, "id", [F.col("bought").desc(), F.expr(to_long("productId")).asc()], n)


@query("topn_names_wide", "SELECT b.id, " + ", ".join(f'max(case when rank = {k} then name end) AS "productName{k}"' for k in range(9))
       + f""" FROM {BEST} b JOIN (SELECT productId AS pid, min(productName) AS name FROM fx_goods GROUP BY productId) n
    ON n.pid = b.productId WHERE rank < 9 GROUP BY b.id""")
def _topn_names(s):
    """Names of the nine most bought products, one column per rank."""
    return names_by_rank(most_bought(s, 10), s.goods)

# ---- aggregates ---------------------------------------------------------------------------


@query("agg_count", 'SELECT cid AS id, paymentCode AS "paymentCode", count(paymentCode) AS n FROM o9 GROUP BY cid, paymentCode')
def _count(s):
    return orders(s).groupBy("id", "paymentCode").agg(F.count("paymentCode").alias("n"))


@query("agg_rowcount", "SELECT cid AS id, count(*) AS n FROM o9 GROUP BY cid")
def _rowcount(s):
    return orders(s).groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("agg_sum_long", "SELECT cid AS id, cast(sum(amt) as bigint) AS total FROM o9 GROUP BY cid")
def _sum_long(s):
    return orders(s).groupBy("id").agg(F.sum(F.expr(to_long("orderAmount"))).alias("total"))


@query("agg_sum_double", "SELECT cid AS id, round(sum(try_cast(orderAmount as double)), 2) AS total FROM o9 GROUP BY cid")
def _sum_double(s):
    return orders(s).groupBy("id").agg(F.round(F.sum(F.expr(to_double("orderAmount"))), 2).alias("total"))


@query("agg_sum_expr", "SELECT cid AS id, cast(sum(listed) as bigint) AS listed FROM l9 GROUP BY cid")
def _sum_expr(s):
    return lines(s).groupBy("id").agg(F.sum("listed").alias("listed"))


@query("agg_avg", "SELECT cid AS id, round(avg(amt), 4) AS mean FROM o9 GROUP BY cid")
def _avg(s):
    return orders(s).groupBy("id").agg(F.round(F.avg(F.expr(to_long("orderAmount"))), 4).alias("mean"))


@query("agg_minmax", "SELECT cid AS id, min(fin) AS first, max(fin) AS last FROM o9 GROUP BY cid")
def _minmax(s):
    time = F.expr(to_long("finishTime"))
    return orders(s).groupBy("id").agg(F.min(time).alias("first"), F.max(time).alias("last"))


@query("agg_max_epoch", 'SELECT memberId AS "memberId", max(fin) AS last FROM o9 GROUP BY memberId')
def _max_epoch(s):
    return s.orders.groupBy("memberId").agg(F.max(F.expr(to_long("finishTime"))).alias("last"))


@query("agg_count_if", """SELECT cid AS id, cast(count(*) filter (activityPrice <> '0.00') as bigint) AS activity,
    cast(count(*) filter (listed - paid > 0) as bigint) AS cut FROM l9 GROUP BY cid""")
def _count_if(s):
    return lines(s).groupBy("id").agg(F.count_if("usedActivity").alias("activity"),
                                      F.count_if(F.col("listed") - F.col("paid") > 0).alias("cut"))


@query("agg_ratio", """SELECT cid AS id, round(count(*) filter (orderStatus = '0')::double / nullif(count(id), 0), 6) AS ratio
    FROM o9 GROUP BY cid""")
def _ratio(s):
    counted = orders(s).groupBy("id").agg(F.count_if(F.col("orderStatus") == "0").alias("part"), F.count("orderId").alias("n"))
    return counted.selectExpr("id", f"round({share('part', 'n')}, 6) AS ratio")


@query("agg_span", """SELECT uid AS id, round((max(cast(floor(epoch(log_time)) as bigint)) - min(cast(floor(epoch(log_time)) as bigint))) / 60.0::double, 4) AS minutes
    FROM g GROUP BY uid""")
def _span(s):
    seconds = F.expr(epoch_seconds("log_time"))
    return logs_with_id(s.logs).groupBy("id").agg(F.round((F.max(seconds) - F.min(seconds)) / 60, 4).alias("minutes"))


@query("rating_views", f"SELECT * FROM {VIEWS}")
def _rating_views(s):
    return view_ratings(s.logs)


@query("rating_orders", """SELECT cast(cid as bigint) AS "userId", cast(productId as bigint) AS "productId", count(*) AS rating FROM l9 GROUP BY 1, 2""")
def _rating_orders(s):
    return order_ratings(bought_items(s.orders, s.goods, ID_DIGITS))


_BRAND = """case when brandId in ('297', '301', '0') then 1 when brandId = '298' then 2 when brandId = '299' then 3
    when brandId in ('303', '5') then 4 when brandId = '305' then 5 else 0 end"""


@query("rating_brands", f"""SELECT cast(cid as bigint) AS "userId", cast({_BRAND} as bigint) AS brand, count(*) AS rating FROM l9 GROUP BY 1, 2""")
def _rating_brands(s):
    return brand_ratings(counted_items(bought_items(s.orders, s.goods, ID_DIGITS)))


@query("agg_two_level", """SELECT cast(sum(n) as bigint) AS views, count(*) AS visitors, round(sum(n) / 950.0::double, 4) AS mean
    FROM (SELECT uid, count(*) AS n FROM g GROUP BY uid)""")
def _two_level(s):
    per_visitor = logs_with_id(s.logs).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return per_visitor.agg(F.sum("n").alias("views"), F.count(F.lit(1)).alias("visitors"),
                           F.round(F.sum("n") / 950, 4).alias("mean"))


@query("agg_set_join", """SELECT cid AS id, string_agg(DISTINCT productType, ',' ORDER BY productType) AS types FROM l9 GROUP BY cid""")
def _set_join(s):
    return set_join(lines(s), "id", "productType", "types")


@query("agg_set_join_ranged", ORACLES["agg_set_join"])
def _set_join_ranged(s):
    return set_join_ranged(lines(s), "id", "productType", "types")


@query("op_mode_per_key", """SELECT cid AS id, productType AS "favouriteType" FROM (SELECT cid, productType,
    row_number() OVER (PARTITION BY cid ORDER BY count(*) DESC, productType) AS r FROM l9 GROUP BY cid, productType) WHERE r = 1""")
def _mode(s):
    return mode_per_key(lines(s), "id", "productType", "favouriteType")

# ---- sort, limit, distinct ------------------------------------------------------------------


@query("op_sort", "SELECT cid AS id, count(*) AS n FROM o9 GROUP BY cid ORDER BY n, id")
def _sort(s):
    return orders(s).groupBy("id").agg(F.count(F.lit(1)).alias("n")).orderBy("n", "id")


@query("op_limit", "SELECT cid AS id, count(*) AS n FROM o9 GROUP BY cid ORDER BY n DESC, id LIMIT 20")
def _limit(s):
    """The display head of a report: the 20 most frequent buyers."""
    counted = orders(s).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.col("n").desc(), "id").limit(20)


@query("op_dedup_key", """SELECT productId AS "productId", (min(row(productName, productType))).unnamed1 AS "productName",
    (min(row(productName, productType))).unnamed2 AS "productType" FROM fx_goods GROUP BY productId""".replace(
        "row(productName, productType)", "{'unnamed1': productName, 'unnamed2': productType}"))
def _dedup(s):
    return dedup_by_key(s.goods, "productId", ["productName", "productType"])


_NAMES = f"""SELECT cid, string_agg(DISTINCT b, ',' ORDER BY b) AS s FROM (SELECT cid, case {_BRAND}
    when 1 then '海尔' when 2 then '卡萨帝' when 3 then '统帅' when 4 then '小超人' when 5 then '摩卡' else '其他' end AS b FROM l9) GROUP BY cid"""


@query("bought_brand_sets", f'SELECT cid AS id, s AS "favorBrandName" FROM ({_NAMES})')
def _brand_sets(s):
    """The set-join of brand names, on bought brands."""
    bought = bought_items(s.orders, s.goods, ID_DIGITS)
    return brand_sets(bought)


@query("distinct_brand_sets", f'SELECT DISTINCT s AS "favorBrandName" FROM ({_NAMES})')
def _distinct_sets(s):
    bought = bought_items(s.orders, s.goods, ID_DIGITS)
    return brand_sets(bought).select("favorBrandName").distinct()

# ---- scalar functions -------------------------------------------------------------------------


@query("fn_suffix_id", """SELECT id, try_cast(right(memberId, 3) as bigint) AS last3, try_cast(right(memberId, 9) as bigint) AS last9,
    try_cast(memberId as bigint) AS whole FROM fx_orders""")
def _suffix(s):
    return s.orders.selectExpr("id", f"{suffix_id('memberId', 3)} AS last3", f"{suffix_id('memberId', 9)} AS last9",
                               f"{suffix_id('memberId', None)} AS whole")


@query("fn_trunc_ratio", """SELECT cid AS id, (count(*) filter (orderStatus = '1') * 1000 // count(orderStatus)) / 1000.0::double AS ratio
    FROM o9 GROUP BY cid""")
def _trunc(s):
    counted = orders(s).groupBy("id").agg(F.count_if(F.col("orderStatus") == "1").alias("part"), F.count("orderStatus").alias("n"))
    return counted.selectExpr("id", f"{share_3_decimals('part', 'n')} AS ratio")


@query("fn_hour", "SELECT id, cast(hour(log_time) as int) AS hour FROM fx_logs")
def _hour(s):
    return s.logs.selectExpr("id", f"{hour_of('log_time')} AS hour")


def item_lists(s):
    """Five most bought products per customer as a comma-joined list in rank order."""
    ranked = most_bought(s, 5).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "productId"))).alias("items"))
    return ranked.select("id", "items")


_LIST = f"(SELECT id, string_agg(productId, ',' ORDER BY rank) AS items FROM {BEST} WHERE rank < 5 GROUP BY id)"


@query("fn_array_field_join", f"SELECT id, items FROM {_LIST}")
def _field_join(s):
    return item_lists(s).selectExpr("id", f"{join_field('items', 'productId')} AS items")


@query("fn_split_columns", "SELECT id, " + ", ".join(f"nullif(split_part(items, ',', {i + 1}), '') AS col_{i}" for i in range(5)) + f" FROM {_LIST}")
def _split(s):
    text = item_lists(s).selectExpr("id", f"{join_field('items', 'productId')} AS items")
    return text.selectExpr("id", *split_to_columns("items", [f"col_{i}" for i in range(5)]))


@query("fn_explode_list", f"SELECT id, productId AS item FROM {BEST} WHERE rank < 5")
def _explode(s):
    text = item_lists(s).selectExpr("id", f"{join_field('items', 'productId')} AS items")
    return text.selectExpr("id", f"{explode_list('items')} AS item")


@query("fn_product_id", """SELECT id, case when instr(loc_url, '/product/') > 0 and instr(loc_url, '.html') > instr(loc_url, '/product/')
    then substr(loc_url, instr(loc_url, '/product/') + 9, instr(loc_url, '.html') - instr(loc_url, '/product/') - 9) end AS product FROM fx_logs""")
def _product(s):
    return s.logs.selectExpr("id", f"{product_id('loc_url')} AS product")


@query("fn_date_parts", """SELECT id, cast(year(cast(birthday as date)) as int) AS year,
    cast(month(cast(birthday as date)) * 100 + day(cast(birthday as date)) as int) AS month_day FROM fx_users""")
def _dates(s):
    return s.users.selectExpr("id", f"{birth_year('birthday')} AS year", f"{month_day('birthday')} AS month_day")


@query("fn_epoch_days", """SELECT cid AS id, cast(make_timestamp(min(fin) * 1000000) as date) AS first,
    cast(datediff('day', cast(make_timestamp(min(fin) * 1000000) as date), cast(make_timestamp(max(fin) * 1000000) as date)) as int) AS days
    FROM o9 GROUP BY cid""")
def _epoch_days(s):
    time = F.expr(to_long("finishTime"))
    spans = orders(s).groupBy("id").agg(F.min(time).alias("lo"), F.max(time).alias("hi"))
    return spans.selectExpr("id", f"{epoch_date('lo')} AS first", f"{days_between('hi', 'lo')} AS days")


@query("fn_recency", f"""SELECT id, cast(datediff('day', cast(make_timestamp(try_cast(finishTime as bigint) * 1000000) as date), date '{AS_OF_ORDERS}') as int) AS days
    FROM fx_orders""")
def _recency(s):
    return s.orders.selectExpr("id", f"{recency_days(AS_OF_ORDERS, to_long('finishTime'))} AS days")


@query("fn_epoch", "SELECT id, cast(floor(epoch(log_time)) as bigint) AS seconds FROM fx_logs")
def _epoch(s):
    return s.logs.selectExpr("id", f"{epoch_seconds('log_time')} AS seconds")


@query("fn_days_since", f"""SELECT id, (epoch(timestamp '{AS_OF_LOGIN}') - try_cast(lastLoginTime as double)) / 86400 AS days FROM fx_users""")
def _days_since(s):
    return s.users.selectExpr("id", f"{days_since(AS_OF_LOGIN, 'lastLoginTime')} AS days")


@query("fn_casts", f"""SELECT id, {AMT} AS amount, cast({AMT} as int) AS amount_int, try_cast(orderAmount as double) AS exact,
    try_cast(paymentCode as bigint) AS no_number FROM fx_orders""")
def _casts(s):
    return s.orders.selectExpr("id", f"{to_long('orderAmount')} AS amount", f"{to_int('orderAmount')} AS amount_int",
                               f"{to_double('orderAmount')} AS exact", f"{to_long('paymentCode')} AS no_number")
