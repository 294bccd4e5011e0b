"""One query per tag, and the fused queries that must agree with them."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import ORACLES, cte, query
from checks.settings import AS_OF_LOGIN, ID_DIGITS, LADDERS
from tagloom.functions.ladders import text_ladder
from tagloom.labels import DEVICE, DEVICE_DEFAULT, PAGE_TYPE, PAGE_TYPE_DEFAULT
from tagloom.operators.grouping import last_per_key, set_join_ranged
from tagloom.operators.joining import order_lines, orders_with_id
from tagloom.plans.line_tags import line_tags, purchase_goods_ranged
from tagloom.plans.log_tags import log_tags, logs_with_id, view_goods
from tagloom.plans.order_tags import order_tags
from tagloom.plans.tag import aggregate_tags, single_tag
from tagloom.plans.user_tags import user_tags

# ---- users -------------------------------------------------------------------------

USER_SQL = {
    "num": "cast(id as varchar) AS num",
    "gender": "case gender when '1' then '男' when '2' then '女' else '未知' end AS gender",
    "job": """case job when '1' then '学生' when '2' then '公务员' when '3' then '军人' when '4' then '警察'
        when '5' then '教师' when '6' then '白领' else '其他' end AS job""",
    "marriage": "case marriage when '1' then '未婚' when '2' then '已婚' when '3' then '离异' else '未知' end AS marriage",
    "nationality": """case nationality when '1' then '中国大陆' when '2' then '中国香港' when '3' then '中国澳门'
        when '4' then '中国台湾' when '5' then '其他' else '未知' end AS nationality""",
    "political_face": """case politicalFace when '1' then '群众' when '2' then '党员' when '3' then '无党派人士'
        else '未知' end AS "politicalFace" """,
    "age_range": """case cast(floor(year(try_cast(birthday as date)) / 10) as int)
        when 195 then '50后' when 196 then '60后' when 197 then '70后' when 198 then '80后' when 199 then '90后'
        when 200 then '00后' when 201 then '10后' when 202 then '20后' else '未知' end AS "ageRange" """,
    "constellation": """case
        when strftime(try_cast(birthday as date), '%m-%d') between '03-21' and '04-20' then '白羊座'
        when strftime(try_cast(birthday as date), '%m-%d') between '04-21' and '05-20' then '金牛座'
        when strftime(try_cast(birthday as date), '%m-%d') between '05-21' and '06-21' then '双子座'
        when strftime(try_cast(birthday as date), '%m-%d') between '06-22' and '07-23' then '巨蟹座'
        when strftime(try_cast(birthday as date), '%m-%d') between '07-24' and '08-23' then '狮子座'
        when strftime(try_cast(birthday as date), '%m-%d') between '08-24' and '09-23' then '处女座'
        when strftime(try_cast(birthday as date), '%m-%d') between '09-24' and '10-23' then '天秤座'
        when strftime(try_cast(birthday as date), '%m-%d') between '10-24' and '11-22' then '天蝎座'
        when strftime(try_cast(birthday as date), '%m-%d') between '11-23' and '12-21' then '人马座'
        when strftime(try_cast(birthday as date), '%m-%d') >= '12-22' then '摩羯座'
        when strftime(try_cast(birthday as date), '%m-%d') <= '01-20' then '摩羯座'
        when strftime(try_cast(birthday as date), '%m-%d') between '01-21' and '02-19' then '水瓶座'
        when strftime(try_cast(birthday as date), '%m-%d') between '02-20' and '03-20' then '双鱼座'
        else '未知' end AS constellation""",
    "latest_login": f"""case
        when (epoch(timestamp '{AS_OF_LOGIN}') - try_cast(lastLoginTime as double)) / 86400 <= 0 then '超过30天未登录'
        when (epoch(timestamp '{AS_OF_LOGIN}') - try_cast(lastLoginTime as double)) / 86400 <= 1 then '1天内'
        when (epoch(timestamp '{AS_OF_LOGIN}') - try_cast(lastLoginTime as double)) / 86400 <= 7 then '7天内'
        when (epoch(timestamp '{AS_OF_LOGIN}') - try_cast(lastLoginTime as double)) / 86400 <= 14 then '14天内'
        when (epoch(timestamp '{AS_OF_LOGIN}') - try_cast(lastLoginTime as double)) / 86400 <= 30 then '30天内'
        else '超过30天未登录' end AS "LatestLogin" """,
}

for _name, _sql in USER_SQL.items():
    @query(f"tag_{_name}", f"SELECT id, {_sql} FROM fx_users")
    def _user_tag(s, name=_name):
        return single_tag(s.users, user_tags(AS_OF_LOGIN)[name])

# ---- orders ------------------------------------------------------------------------

for _n in (3, 9):
    cte(f"o{_n}", f"""SELECT try_cast(right(memberId, {_n}) as bigint) AS cid,
        cast(trunc(try_cast(orderAmount as double)) as bigint) AS amt,
        try_cast(finishTime as bigint) AS fin, * FROM fx_orders""")
    cte(f"pay{_n}", f"""SELECT cid, paymentCode FROM (
        SELECT cid, paymentCode, row_number() OVER (PARTITION BY cid ORDER BY count(paymentCode) DESC, paymentCode) AS r
        FROM o{_n} GROUP BY cid, paymentCode) WHERE r = 1""")

_DAYS = "datediff('day', cast(make_timestamp(min(fin) * 1000000) as date), cast(make_timestamp(max(fin) * 1000000) as date))"
# Ties of the newest order: the city listed first in the code book.
_CITY = "case city when '716' then 0 when '173' then 1 when '335' then 2 when '271' then 8 else 24 end"
_CITY_NAME = "case city when '716' then '北京市' when '173' then '山东青岛' when '335' then '甘肃兰州' when '271' then '重庆市' else 'null' end"


def _order_sql(total, biggest, mean, frequent, cycle):
    """Order tags for ladders multiplied by the given factors (frequent: the two bounds)."""
    t, m, a = total, biggest, mean
    high, mid = frequent
    return {
        "home_city": f"arg_max({_CITY_NAME}, row(fin, -({_CITY}))) AS jiguan",
        "spend_total": f"""case when sum(amt) >= 1000000*{t} then '超高' when sum(amt) >= 800000*{t} then '高'
            when sum(amt) >= 600000*{t} then '中上' when sum(amt) >= 400000*{t} then '中'
            when sum(amt) >= 200000*{t} then '中下' when sum(amt) >= 100000*{t} then '低'
            when sum(amt) < 100000*{t} then '很低' else '未知' end AS "ComsumptionAbility" """,
        "spend_max": f"""case when max(amt) >= 50000*{m} then '>50000'
            when max(amt) >= 30000*{m} and max(amt) < 49999*{m} then '30000-49999'
            when max(amt) >= 10000*{m} and max(amt) < 29999*{m} then '10000-29999'
            when max(amt) < 9999*{m} then '1-9999' else '未知' end AS "MaxSingleComsumption" """,
        "spend_avg": f"""case when avg(amt) >= 5000*{a} then '>5000'
            when avg(amt) >= 3000*{a} and avg(amt) < 4999*{a} then '3000-4999'
            when avg(amt) >= 1000*{a} and avg(amt) < 2999*{a} then '1000-2999'
            when avg(amt) < 999*{a} then '1-999' else '未知' end AS "PerCustomerTransation" """,
        "purchase_frequency": f"""case when count(*) >= {high} then '高' when count(*) >= {mid} then '中'
            when count(*) >= 0 then '低' else '未知' end AS "purchaseFrequency" """,
        "advisory": """case when count(*) filter (try_cast(smManualTime as bigint) > 0) * 1000 // nullif(count(orderAmount), 0) >= 300 then '高'
            when count(*) filter (try_cast(smManualTime as bigint) > 0) * 1000 // nullif(count(orderAmount), 0) >= 100 then '中'
            when count(*) filter (try_cast(smManualTime as bigint) > 0) * 1000 // nullif(count(orderAmount), 0) < 100 then '低'
            else '未知' end AS "AdvisoryServiceFrequency" """,
        "consumption_cycle": f"""case
            when {_DAYS}::double / count(fin) >= 150*{cycle} then '6月' when {_DAYS}::double / count(fin) >= 120*{cycle} then '5月'
            when {_DAYS}::double / count(fin) >= 90*{cycle} then '4月' when {_DAYS}::double / count(fin) >= 60*{cycle} then '3月'
            when {_DAYS}::double / count(fin) >= 30*{cycle} then '2月' when {_DAYS}::double / count(fin) >= 14*{cycle} then '1月'
            when {_DAYS}::double / count(fin) >= 7*{cycle} then '2周' when {_DAYS}::double / count(fin) < 7*{cycle} then '7日'
            else '未知' end AS "consumptionCycle" """,
        "replacement": """case
            when count(*) filter (orderStatus = '1') * 1000 // nullif(count(orderStatus), 0) >= 300 then '高'
            when count(*) filter (orderStatus = '1') * 1000 // nullif(count(orderStatus), 0) >= 1 then '中'
            when count(*) filter (orderStatus = '1') * 1000 // nullif(count(orderStatus), 0) < 1 then '低'
            else '未知' end AS "replacementRate" """,
        "return": """case when count(*) filter (orderStatus = '0')::double / count(id) >= 0.01 then '高'
            when count(*) filter (orderStatus = '0')::double / count(id) >= 0.005 then '中'
            when count(*) filter (orderStatus = '0')::double / count(id) >= 0 then '低' end AS "returnRate" """,
    }


ORDER_SQL = _order_sql(5, 9, 80, (15, 8), 2)
ORDER_SQL_DEFAULT = _order_sql(1, 1, 1, (400, 200), 1)

for _name, _sql in ORDER_SQL.items():
    @query(f"tag_{_name}", f"SELECT cid AS id, {_sql} FROM o9 GROUP BY cid")
    def _order_tag(s, name=_name):
        return single_tag(orders_with_id(s.orders, ID_DIGITS), order_tags(LADDERS)[name])


@query("tag_payment", 'SELECT cid AS id, paymentCode AS "paymentCode" FROM pay9')
def _payment(s):
    return single_tag(orders_with_id(s.orders, ID_DIGITS), order_tags()["payment"])


@query("order_tags_suffix3", f"""SELECT t.*, pay3.paymentCode AS "paymentCode" FROM (
    SELECT cid AS id, {', '.join(ORDER_SQL_DEFAULT.values())} FROM o3 GROUP BY cid) t
    JOIN pay3 ON pay3.cid = t.id""")
def _order_tags_suffix3(s):
    """All order tags fused, default ladders, ids from three characters."""
    return aggregate_tags(orders_with_id(s.orders, 3), order_tags().values())


@query("latest_city", """SELECT cid AS id, city FROM (
    SELECT cid, city, row_number() OVER (PARTITION BY cid ORDER BY fin DESC, id DESC) AS r FROM o9) WHERE r = 1""")
def _latest_city(s):
    orders = (orders_with_id(s.orders, ID_DIGITS)
              .select("id", "city", "orderId", F.col("finishTime").try_cast("bigint").alias("finish")))
    return last_per_key(orders, "id", ["finish", "orderId"], ["city"])

# ---- orders with their lines ---------------------------------------------------------

for _n in (3, 9):
    cte(f"l{_n}", f"""SELECT o.cid, g.productId, g.productName, g.productType, g.cateId, g.brandId,
        g.activityPrice, g.couponAmount, g.orderPromotionAmount, g.productAmount, o.orderSn,
        try_cast(g.productAmount as bigint) AS paid,
        try_cast(g.price as bigint) * try_cast(g.number as bigint) + try_cast(g.shippingFee as bigint) AS listed
        FROM o{_n} o JOIN fx_goods g ON o.orderSn = g.cOrderSn""")
    cte(f"lsum{_n}", f"""SELECT cid, cast(sum(paid) as double) AS paid, cast(sum(listed) as double) AS listed,
        cast(sum(listed) - sum(paid) as double) AS cut, cast(count(productAmount) as double) AS n,
        cast(count(*) filter (listed - paid > 0) as double) AS k,
        count(*) filter (activityPrice <> '0.00') AS act, count(*) filter (couponAmount <> '0.00') AS cou,
        count(*) filter (orderPromotionAmount <> '0.00') AS pro,
        string_agg(DISTINCT productName, ',' ORDER BY productName) AS names FROM l{_n} GROUP BY cid""")

LINE_SQL = {
    "coupons": "cast(act as varchar) AS activity, cast(cou as varchar) AS coupon, cast(pro as varchar) AS promotion",
    "discount": """case when paid / nullif(listed, 0) >= 0.8 and paid / nullif(listed, 0) <= 1 then '8折-9折'
        when paid / nullif(listed, 0) >= 0.5 and paid / nullif(listed, 0) < 0.8 then '5折-7折'
        when paid / nullif(listed, 0) >= 0.3 and paid / nullif(listed, 0) < 0.5 then '3折-4折'
        else '未知' end AS discount""",
    "price_sensitivity": """case when psm >= 1 then '极度敏感' when psm >= 0.6 then '比较敏感' when psm >= 0.3 then '一般敏感'
        when psm >= 0 then '不太敏感' when psm < 0 then '极度不敏感' else '未知' end AS "PriceSensitivity" """,
    "purchase_goods": 'names AS "purchaseGoods"',
}
_PSM = "(SELECT *, k / nullif(n, 0) + (cut / nullif(k, 0)) / (listed / nullif(n, 0)) + cut / nullif(listed, 0) AS psm FROM lsum{0})"

for _name, _sql in LINE_SQL.items():
    @query(f"tag_{_name}", f"SELECT cid AS id, {_sql} FROM {_PSM.format(9)}")
    def _line_tag(s, name=_name):
        return single_tag(order_lines(s.orders, s.goods, ID_DIGITS), line_tags()[name])


@query("tag_purchase_goods_ranged", ORACLES["tag_purchase_goods"])
def _purchase_goods_ranged(s):
    return purchase_goods_ranged(order_lines(s.orders, s.goods, ID_DIGITS))


@query("line_tags_suffix3", f"SELECT cid AS id, {', '.join(LINE_SQL.values())} FROM {_PSM.format(3)}")
def _line_tags_suffix3(s):
    """All order-line tags fused, ids from three characters."""
    return aggregate_tags(order_lines(s.orders, s.goods, 3), line_tags().values())

# ---- logs ----------------------------------------------------------------------------

cte("g", "SELECT try_cast(global_user_id as bigint) AS uid, * FROM fx_logs WHERE try_cast(global_user_id as bigint) IS NOT NULL")


def _page(url: str, as_number: bool) -> str:
    names = ["登录页", "首页", "分类页", "商品页", "我的订单页", "其他"]
    out = [str(i) if as_number else f"'{n}'" for i, n in enumerate(names)]
    return f"""case when {url} like '%login%' then {out[0]}
        when {url} like '%index%' or {url} = 'http://www.eshop.com/' or {url} = 'http://m.eshop.com/' then {out[1]}
        when {url} like '%/c/%' then {out[2]} when {url} like '%/product/%' then {out[3]}
        when {url} like '%order%' then {out[4]} else {out[5]} end"""


def _device(as_number: bool) -> str:
    out = [str(i) if as_number else f"'{n}'" for i, n in enumerate(["Windows", "Mac", "Android", "IOS", "Linux"])]
    return f"""case when user_agent like '%Windows%' then {out[0]} when user_agent like '%Mac OS%' then {out[1]}
        when user_agent like '%Android%' then {out[2]} when user_agent like '%CPU iPhone OS%' then {out[3]} else {out[4]} end"""


_PERIOD = """case when hour(log_time) between 1 and 7 then '1点-7点' when hour(log_time) between 8 and 12 then '8点-12点'
    when hour(log_time) between 13 and 17 then '13点-17点' when hour(log_time) between 18 and 21 then '18点-21点'
    else '22点-24点' end"""

cte("gsum", f"""SELECT uid, count(*) filter (loc_url like '%login%') AS logins, count(global_user_id) AS views,
    (max(cast(floor(epoch(log_time)) as bigint)) - min(cast(floor(epoch(log_time)) as bigint))) / 60.0::double AS minutes,
    arg_max({_device(False)}, row(epoch_us(log_time), -({_device(True)}))) AS device,
    arg_max({_page('loc_url', False)}, row(epoch_us(log_time), -({_page('loc_url', True)}))) AS loc,
    arg_max({_page('ref_url', False)}, row(epoch_us(log_time), -({_page('ref_url', True)}))) AS ref
    FROM g GROUP BY uid""")
cte("gtot", """SELECT cast(sum(logins) as double) / cast(count(uid) as double) AS la,
    cast(sum(views) as double) / cast(count(uid) as double) AS va FROM gsum""")
cte("gper", f"""SELECT uid, period FROM (
    SELECT uid, period, row_number() OVER (PARTITION BY uid ORDER BY count(*) DESC, period) AS r
    FROM (SELECT uid, {_PERIOD} AS period FROM g) GROUP BY uid, period) WHERE r = 1""")
cte("gview", """SELECT uid, string_agg(DISTINCT productName, ',' ORDER BY productName) AS names FROM (
    SELECT uid, try_cast(case when instr(loc_url, '/product/') > 0 and instr(loc_url, '.html') > instr(loc_url, '/product/')
      then substr(loc_url, instr(loc_url, '/product/') + 9, instr(loc_url, '.html') - instr(loc_url, '/product/') - 9) end as int) AS pid
    FROM g) v JOIN (SELECT DISTINCT try_cast(productId as int) AS pid, productName FROM fx_goods) p USING (pid) GROUP BY uid""")

_LOGIN = """case when logins = 0 then '无' when logins * 1.8::double < la then '较少'
    when logins * 1.8::double >= la and logins / 1.2::double < la then '一般'
    when logins / 1.2::double >= la then '经常' end"""
LOG_SQL = {
    "view_frequency": """case when views = 0 then '无' when views * 4::double < va then '较少'
        when views * 4::double >= va and views / 1.2::double < va then '一般'
        when views / 1.2::double >= va then '经常' end AS "ViewFrequency" """,
    "watch_time": """case when minutes < 1 then '1分钟内' when trunc(minutes) between 2 and 5 then '1-5分钟'
        when minutes >= 5 then '5分钟以上' end AS "WatchTime" """,
    "device": "device",
    "page_type": "loc AS browser_loc_url, ref AS browser_ref_url",
}

for _name, _sql in LOG_SQL.items():
    @query(f"tag_{_name}", f"SELECT uid AS id, {_sql} FROM gsum, gtot")
    def _log_tag(s, name=_name):
        return single_tag(logs_with_id(s.logs), log_tags()[name])


@query("tag_login_frequency", f'SELECT uid AS id, {_LOGIN} AS "LoginFrequency" FROM gsum, gtot WHERE logins > 0')
def _login(s):
    return single_tag(logs_with_id(s.logs), log_tags()["login_frequency"])


@query("tag_login_frequency_950", f"""SELECT uid AS id, {_LOGIN} AS "LoginFrequency"
    FROM gsum, (SELECT cast(sum(logins) as double) / 950.0::double AS la FROM gsum) WHERE logins > 0""")
def _login_950(s):
    """The population as a given number."""
    return single_tag(logs_with_id(s.logs), log_tags(950)["login_frequency"])


@query("tag_read_period", 'SELECT uid AS id, period AS "ReadedTime_Browser" FROM gper')
def _period(s):
    return single_tag(logs_with_id(s.logs), log_tags()["read_period"])


@query("tag_view_goods", 'SELECT uid AS id, names AS "ViewGoods" FROM gview')
def _view_goods(s):
    return view_goods(s.logs, s.goods)


@query("tag_view_goods_ranged", ORACLES["tag_view_goods"])
def _view_goods_ranged(s):
    return view_goods(s.logs, s.goods, set_join_ranged)


@query("watch_time_daily", """SELECT uid AS id, day, case when minutes < 1 then '1分钟内' when trunc(minutes) between 2 and 5
    then '1-5分钟' when minutes >= 5 then '5分钟以上' end AS "WatchTime" FROM (
    SELECT uid, cast(log_time as date) AS day,
    (max(cast(floor(epoch(log_time)) as bigint)) - min(cast(floor(epoch(log_time)) as bigint))) / 60.0::double AS minutes
    FROM g GROUP BY uid, cast(log_time as date))""")
def _watch_daily(s):
    """Watch time per visitor and day, where all its labels occur."""
    logs = logs_with_id(s.logs).withColumn("day", F.col("log_time").cast("date"))
    by_day = logs.withColumn("visit", F.struct("id", "day"))
    return single_tag(by_day, log_tags()["watch_time"], "visit").select("visit.id", "visit.day", "WatchTime")


@query("latest_device", f"""SELECT uid AS id, d AS device FROM (
    SELECT uid, {_device(False)} AS d, row_number() OVER (PARTITION BY uid ORDER BY log_time DESC, id DESC) AS r FROM g) WHERE r = 1""")
def _latest_device(s):
    rows = logs_with_id(s.logs).selectExpr(
        "id", "log_time", "logId", f"{text_ladder('user_agent', DEVICE, DEVICE_DEFAULT)} AS device")
    return last_per_key(rows, "id", ["log_time", "logId"], ["device"])


@query("latest_page", f"""SELECT uid AS id, loc AS browser_loc_url, ref AS browser_ref_url FROM (
    SELECT uid, {_page('loc_url', False)} AS loc, {_page('ref_url', False)} AS ref,
    row_number() OVER (PARTITION BY uid ORDER BY log_time DESC, id DESC) AS r FROM g) WHERE r = 1""")
def _latest_page(s):
    rows = logs_with_id(s.logs).selectExpr("id", "log_time", "logId", *[
        f"{text_ladder(u, PAGE_TYPE, PAGE_TYPE_DEFAULT)} AS browser_{u}" for u in ("loc_url", "ref_url")])
    return last_per_key(rows, "id", ["log_time", "logId"], ["browser_loc_url", "browser_ref_url"])
