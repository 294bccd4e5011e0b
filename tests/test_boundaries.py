"""Every edge of every ladder and code book, on inline rows."""

import pytest
from pyspark.sql import functions as F

from tagloom import labels as L
from tagloom.functions import casting, ladders, text, timing
from tagloom.plans import line_tags, log_tags, order_tags, rfm, user_tags
from tagloom.plans.tag import single_tag


def evaluate(spark, sql: str, values: list, kind: str = "string") -> list:
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"n int, v {kind}").selectExpr("n", f"{sql} AS r")
    return [r.r for r in sorted(df.collect(), key=lambda r: r.n)]


def labels(spark, ladder, values, default=None, kind="double"):
    numbers = [None if v is None else float(v) for v in values]
    return evaluate(spark, ladders.bin_ladder("v", ladder, default), numbers, kind)


def user_tag(spark, tag, column: str, values: list) -> list:
    df = spark.createDataFrame(list(enumerate(values)), f"id bigint, {column} string")
    return [r[1] for r in sorted(single_tag(df, tag).collect())]


BOOKS = [
    (user_tags.gender, "gender", L.GENDER, "未知"),
    (user_tags.job, "job", L.JOB, "其他"),
    (user_tags.marriage, "marriage", L.MARRIAGE, "未知"),
    (user_tags.nationality, "nationality", L.NATIONALITY, "未知"),
    (user_tags.political_face, "politicalFace", L.POLITICAL_FACE, "未知"),
]


@pytest.mark.parametrize("make,column,book,default", BOOKS, ids=[b[1] for b in BOOKS])
def test_code_books(spark, make, column, book, default):
    codes = [*book, "99", "", None]
    assert user_tag(spark, make(), column, codes) == [*book.values(), default, default, default]


def test_home_city_codes(spark):
    got = evaluate(spark, ladders.decode("v", L.HOME_CITY, L.HOME_CITY_DEFAULT), ["161", "716", "62", "999", "", None])
    assert got == ["江西南昌", "北京市", "内蒙古呼和浩特", "null", "null", "null"]
    assert len(L.HOME_CITY) == 24


def test_map_decode_equals_positions(spark):
    codes = [*L.HOME_CITY, "x", None]
    positions = evaluate(spark, ladders.decode_position("v", L.HOME_CITY), codes)
    assert positions == [*range(24), 24, 24]


def test_brand_groups(spark):
    got = evaluate(spark, ladders.decode_many("v", L.BRAND_GROUP, L.BRAND_GROUP_DEFAULT),
                   ["297", "301", "0", "298", "299", "303", "5", "305", "7", None])
    assert got == ["1", "1", "1", "2", "3", "4", "4", "5", "0", "0"]


def test_age_range(spark):
    got = user_tag(spark, user_tags.age_range(), "birthday", [
        "1949-12-31", "1950-01-01", "1959-12-31", "1960-05-05", "1979-12-31", "1980-01-01", "1999-12-31",
        "2000-01-01", "2010-01-01", "2029-12-31", "2030-01-01", None, "bad"])
    assert got == ["未知", "50后", "50后", "60后", "70后", "80后", "90后", "00后", "10后", "20后", "未知", "未知", "未知"]


def test_constellation(spark):
    cuts = [("03-20", "双鱼座"), ("03-21", "白羊座"), ("04-20", "白羊座"), ("04-21", "金牛座"), ("05-20", "金牛座"),
            ("05-21", "双子座"), ("06-21", "双子座"), ("06-22", "巨蟹座"), ("07-23", "巨蟹座"), ("07-24", "狮子座"),
            ("08-23", "狮子座"), ("08-24", "处女座"), ("09-23", "处女座"), ("09-24", "天秤座"), ("10-23", "天秤座"),
            ("10-24", "天蝎座"), ("11-22", "天蝎座"), ("11-23", "人马座"), ("12-21", "人马座"), ("12-22", "摩羯座"),
            ("12-31", "摩羯座"), ("01-01", "摩羯座"), ("01-20", "摩羯座"), ("01-21", "水瓶座"), ("02-19", "水瓶座"),
            ("02-20", "双鱼座"), ("02-29", "双鱼座")]
    got = user_tag(spark, user_tags.constellation(), "birthday",
                   [f"2000-{day}" for day, _ in cuts] + [None, "bad"])
    assert got == [name for _, name in cuts] + ["未知", "未知"]


def test_latest_login(spark):
    now, day = 1706659200, 86400  # 2024-01-31
    ages = [(-1, "超过30天未登录"), (0, "超过30天未登录"), (1, "1天内"), (day, "1天内"), (day + 1, "7天内"), (7 * day, "7天内"),
            (7 * day + 1, "14天内"), (14 * day, "14天内"), (14 * day + 1, "30天内"), (30 * day, "30天内"),
            (30 * day + 1, "超过30天未登录")]
    tag = user_tags.latest_login("2024-01-31")
    assert user_tag(spark, tag, "lastLoginTime", [str(now - a) for a, _ in ages] + [None, "x"]) == [
        x for _, x in ages] + ["超过30天未登录"] * 2


def test_spend_ladders_keep_their_gaps(spark):
    assert labels(spark, L.SPEND_AVG, [998.9, 999, 1000, 2998, 2999, 3000, 4998.9, 4999, 4999.5, 5000, None], "未知") == [
        "1-999", "未知", "1000-2999", "1000-2999", "未知", "3000-4999", "3000-4999", "未知", "未知", ">5000", "未知"]
    assert labels(spark, L.SPEND_MAX, [9998, 9999, 10000, 29998, 29999, 30000, 49998, 49999, 50000, None], "未知") == [
        "1-9999", "未知", "10000-29999", "10000-29999", "未知", "30000-49999", "30000-49999", "未知", ">50000", "未知"]
    assert labels(spark, L.SPEND_TOTAL, [99999, 100000, 200000, 400000, 600000, 800000, 1000000, None], "未知") == [
        "很低", "低", "中下", "中", "中上", "高", "超高", "未知"]


def test_frequency_and_cycle_ladders(spark):
    assert labels(spark, L.PURCHASE_FREQUENCY, [0, 199, 200, 399, 400], "未知") == ["低", "低", "中", "中", "高"]
    assert labels(spark, L.CONSUMPTION_CYCLE, [0, 6.9, 7, 14, 30, 60, 90, 120, 150, None], "未知") == [
        "7日", "7日", "2周", "1月", "2月", "3月", "4月", "5月", "6月", "未知"]


def test_ratio_ladders(spark):
    assert labels(spark, L.ADVISORY, [0.0, 0.099, 0.1, 0.299, 0.3, 1.0, None], "未知") == ["低", "低", "中", "中", "高", "高", "未知"]
    assert labels(spark, L.REPLACEMENT, [0.0, 0.001, 0.299, 0.3, None], "未知") == ["低", "中", "中", "高", "未知"]
    assert labels(spark, L.RETURN, [0.0, 0.0049, 0.005, 0.0099, 0.01, None]) == ["低", "低", "中", "中", "高", None]
    assert labels(spark, L.DISCOUNT, [0.29, 0.3, 0.5, 0.8, 1.0, 1.01, None], "未知") == [
        "未知", "3折-4折", "5折-7折", "8折-9折", "8折-9折", "未知", "未知"]
    assert labels(spark, L.PRICE_SENSITIVITY, [-0.1, 0.0, 0.3, 0.6, 1.0, None], "未知") == [
        "极度不敏感", "不太敏感", "一般敏感", "比较敏感", "极度敏感", "未知"]


def test_share_cut_to_three_decimals(spark):
    pairs = [(0, 7), (1, 2000), (999, 10000), (1, 10), (2999, 10000), (3, 10), (7, 7), (2, 3), (0, 0)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").selectExpr(f"{text.share_3_decimals('a', 'b')} AS r")
    assert [r.r for r in df.collect()] == [0.0, 0.0, 0.099, 0.1, 0.299, 0.3, 1.0, 0.666, None]


def test_rfm_scores(spark):
    assert labels(spark, L.RFM_RECENCY, [0, 1, 3, 4, 6, 7, 9, 10, 15, 16, 900, None], kind="double") == [
        None, 5, 5, 4, 4, 3, 3, 2, 2, 1, 1, None]
    assert labels(spark, L.RFM_FREQUENCY, [0, 1, 49, 50, 99, 100, 149, 150, 199, 200]) == [None, 1, 1, 2, 2, 3, 3, 4, 4, 5]
    assert labels(spark, L.RFM_MONEY, [9999, 9999.5, 10000, 49999, 49999.5, 50000, 99999, 99999.5, 100000, 199999, 200000]) == [
        1, None, 2, 2, None, 3, 3, None, 4, 4, 5]


def test_casts(spark):
    values = ["12", "-12", "12.99", "-12.99", ".5", "7.", "ab", "1.a", "", " 5 ", "1e5", None, "9" * 18, "9" * 25, "12.99999999"]
    assert evaluate(spark, casting.to_long("v"), values) == [
        12, -12, 12, -12, 0, 7, None, None, None, 5, None, None, int("9" * 18), None, 12]
    assert evaluate(spark, casting.to_int("v"), ["12.9", "3000000000", "x", None]) == [12, None, None, None]
    assert evaluate(spark, casting.to_double("v"), ["1.5", "x", "", None]) == [1.5, None, None, None]


def test_suffix_ids(spark):
    values = ["000000012", "1000000950", "7", "abc", "12x", "", None]
    assert evaluate(spark, casting.suffix_id("v", 3), values) == [12, 950, 7, None, None, None, None]
    assert evaluate(spark, casting.suffix_id("v", None), values) == [12, 1000000950, 7, None, None, None, None]


def test_product_ids(spark):
    urls = ["http://x/product/12.html", "/product/.html", "a.html/product/3.html", "/product/12", "/product/ab.html",
            "/product/1/product/2.html", "/product/5.html?x=.html", None, ""]
    assert evaluate(spark, text.product_id("v"), urls) == ["12", "", None, None, "ab", "1/product/2", "5", None, None]


def test_devices_and_pages(spark):
    agents = ["Mozilla (Windows NT)", "Mozilla (iPhone; CPU iPhone OS 12_0 like Mac OS X)", "(iPhone; CPU iPhone OS 12_0)",
              "Android 9", "X11", None]
    assert evaluate(spark, ladders.text_ladder("v", L.DEVICE, L.DEVICE_DEFAULT), agents) == [
        "Windows", "Mac", "IOS", "Android", "Linux", "Linux"]
    pages = ["http://x/product/login.html", "http://www.eshop.com/", "http://m.eshop.com/", "http://m.eshop.com/x",
             "http://x/index.php", "/c/9", "/product/1.html", "my/order/5", None]
    assert evaluate(spark, ladders.text_ladder("v", L.PAGE_TYPE, L.PAGE_TYPE_DEFAULT), pages) == [
        "登录页", "首页", "首页", "其他", "首页", "分类页", "商品页", "我的订单页", "其他"]


def logs(spark, rows):
    schema = "id bigint, global_user_id string, log_time string, loc_url string, ref_url string, user_agent string"
    return log_tags.logs_with_id(spark.createDataFrame(rows, schema))


def test_watch_time(spark):
    spans = [0, 59, 60, 119, 120, 299, 300, 359, 360]
    rows = []
    for user, span in enumerate(spans):
        for at in {0, span}:
            rows.append((len(rows), str(user), f"2024-01-01 00:{at // 60:02d}:{at % 60:02d}", None, None, None))
    rows.append((99, "99", None, None, None, None))
    got = {r.id: r.WatchTime for r in single_tag(logs(spark, rows), log_tags.watch_time()).collect()}
    assert [got[u] for u in range(len(spans))] == [
        "1分钟内", "1分钟内", None, None, "1-5分钟", "1-5分钟", "1-5分钟", "1-5分钟", "5分钟以上"]
    assert got[99] is None


def test_read_period_and_ties(spark):
    hours = {0: "22点-24点", 1: "1点-7点", 7: "1点-7点", 8: "8点-12点", 12: "8点-12点", 13: "13点-17点", 17: "13点-17点",
             18: "18点-21点", 21: "18点-21点", 22: "22点-24点", 23: "22点-24点"}
    rows = [(h, str(h), f"2024-01-01 {h:02d}:30:00", None, None, None) for h in hours]
    rows += [(50, "50", None, None, None, None)]
    rows += [(60, "60", "2024-01-01 13:00:00", None, None, None), (61, "60", "2024-01-01 09:00:00", None, None, None)]
    got = {r.id: r.ReadedTime_Browser for r in single_tag(logs(spark, rows), log_tags.read_period()).collect()}
    assert {h: got[h] for h in hours} == hours
    assert got[50] == "22点-24点"
    assert got[60] == "13点-17点"  # a tie: the smaller text


def test_newest_device(spark):
    rows = [
        (1, "1", "2024-01-01 00:00:00", None, None, "Windows"), (2, "1", "2024-01-02 00:00:00", None, None, "Android"),
        (3, "2", "2024-01-01 00:00:00", None, None, "Android"), (4, "2", "2024-01-01 00:00:00", None, None, "Windows"),
        (5, "3", None, None, None, "Mac OS"), (6, "3", "1969-01-01 00:00:00", None, None, "X11"),
        (7, "4", None, None, None, None), (8, "x", "2024-01-01 00:00:00", None, None, "Windows"),
        (9, "5", "9999-12-31 23:59:59", None, None, "Windows"), (10, "5", "2024-01-01 00:00:00", None, None, "Android")]
    got = {r.id: r.device for r in single_tag(logs(spark, rows), log_tags.device()).collect()}
    assert got == {1: "Android", 2: "Windows", 3: "Linux", 4: "Linux", 5: "Windows"}


def test_login_frequency(spark):
    counts = {1: 1, 2: 2, 3: 3, 4: 10, 5: 0}
    rows = []
    for user, n in counts.items():
        rows += [(len(rows) + i, str(user), None, "login", None, None) for i in range(n)] or [(900, str(user), None, "x", None, None)]
    tag = log_tags.login_frequency(population=4)  # average 16 / 4 = 4
    got = {r.id: r.LoginFrequency for r in single_tag(logs(spark, rows), tag).collect()}
    assert got == {1: "较少", 2: "较少", 3: "一般", 4: "经常"}


def lines(spark, rows):
    schema = "id bigint, productName string, productAmount string, price string, number string, shippingFee string, " \
             "activityPrice string, couponAmount string, orderPromotionAmount string"
    from tagloom.operators.joining import line_values
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({n: F.expr(sql) for n, sql in line_values().items()})


def line(user, paid, price, number="1", fee="0", name="n", coupons=("0.00", "0.00", "0.00")):
    return (user, name, paid, price, number, fee, *coupons)


def test_discount_and_sensitivity(spark):
    rows = [line(1, "100", "100"), line(2, "80", "100"), line(3, "50", "100"), line(4, "30", "100"), line(5, "29", "100"),
            line(6, "120", "100"), line(7, "100", None), line(8, "99.9", "100.7"), line(9, "100", "100"), line(9, "50", "100"),
            line(10, "200", "100"), line(10, "90", "100")]
    df = lines(spark, rows)
    got = {r.id: r.discount for r in single_tag(df, line_tags.discount()).collect()}
    assert got == {1: "8折-9折", 2: "8折-9折", 3: "5折-7折", 4: "3折-4折", 5: "未知", 6: "未知", 7: "未知", 8: "8折-9折",
                   9: "5折-7折", 10: "未知"}
    psm = {r.id: r.PriceSensitivity for r in single_tag(df, line_tags.price_sensitivity()).collect()}
    # 9: 1/2 + (50/1)/(200/2) + 50/200 = 1.25; 10: 1/2 + (-90/1)/(200/2) - 90/200 = -0.85
    assert psm[1] == "未知" and psm[6] == "未知" and psm[7] == "未知"
    assert psm[9] == "极度敏感" and psm[2] == "极度敏感" and psm[10] == "极度不敏感"


def test_coupon_texts(spark):
    rows = [line(1, "1", "1", coupons=c) for c in [("0.00", "0", "0.0"), (None, "5.00", None), ("9", "0.00", "3")]]
    got = single_tag(lines(spark, rows), line_tags.coupons()).collect()[0]
    assert (got.activity, got.coupon, got.promotion) == ("1", "2", "2")


def test_mode_prefers_the_smaller_value_on_a_tie(spark):
    rows = [(1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, None), (3, "c"), (3, "c"), (3, "a")]
    df = spark.createDataFrame(rows, "id bigint, paymentCode string")
    got = {r.id: r.paymentCode for r in single_tag(df, order_tags.payment()).collect()}
    assert got == {1: "a", 2: None, 3: "c"}


def test_sub_day_recency_is_calendar_days(spark):
    sql = timing.recency_days("2024-01-02", "v")
    assert evaluate(spark, sql, [1704067199, 1704067200, 1704153599, 1704240000, None], "bigint") == [2, 1, 1, -1, None]


def test_user_value_without_scores_is_unknown(spark):
    rows = [("1001", str(1704067200), "1", "5"), ("1002", "bad", "1", "5"), ("1003", str(1704067200), "1", "500000")]
    orders = spark.createDataFrame(rows, "memberId string, finishTime string, orderSn string, orderAmount string")
    scores = rfm.rfm_scores(rfm.rfm_metrics(orders, "2024-01-03"))
    model = rfm.fit_segments(scores, {"k": 2, "seed": 100, "maxIter": 2})
    got = {r.id: r.userValue for r in rfm.user_value(scores, rfm.Segments(model, {"0": "a", "1": "b"}), 3).collect()}
    assert set(got) == {1, 2, 3} and got[2] == "未知" and got[1] != got[3] and "未知" not in (got[1], got[3])


def test_latest_takes_every_bigint_time(spark):
    from tagloom.operators.metrics import aggregate, latest, latest_label
    rows = [(1, 4 * 10**17, 0), (1, 5 * 10**17, 1), (2, -2**63, 2), (2, None, 0), (3, 2**63 - 1, 1), (3, 2**63 - 2, 0), (4, None, 2), (5, 7, 2), (5, 7, 1)]
    df = spark.createDataFrame(rows, "id long, t long, p int")
    labels = ["a", "b", "c"] + [str(i) for i in range(22)]
    found = aggregate(df, "id", {"last": latest("t", "p", len(labels))}).selectExpr("id", f"{latest_label('last', labels)} AS label")
    assert sorted(map(tuple, found.collect())) == [(1, "b"), (2, "c"), (3, "b"), (4, "c"), (5, "b")]


def test_scratch_removes_what_is_not_kept(spark):
    from tagloom.operators.staging import scratch, stage

    with scratch(spark):
        inner = stage(spark.range(5), "inner")
        outer = stage(inner.selectExpr("id + 1 AS id"), "outer", kept=True)
    assert outer.count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND|FILE_NOT_EXIST"):
        spark.read.parquet(inner.inputFiles()[0] if inner.inputFiles() else "gone").count()


def test_a_cluster_needs_a_shared_folder():
    from tagloom.session import reaches_one_machine_only
    assert reaches_one_machine_only("yarn", "file:/home/me/spark-warehouse") and reaches_one_machine_only("spark://h:7077", "/tmp/warehouse")
    assert not reaches_one_machine_only("yarn", "hdfs://n/warehouse") and not reaches_one_machine_only("local[8]", "file:/x")
