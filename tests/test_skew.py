"""One key with a third of all rows, against brute force in Python."""

from collections import Counter, defaultdict

import pytest

from tagloom.operators.grouping import dedup_by_key, last_per_key, mode_per_key, set_join, set_join_ranged, set_pieces
from tagloom.operators.joining import lookup, order_lines
from tagloom.operators.ranking import top_n_per_key
from tagloom.plans import recommend as R
from tagloom.plans.line_tags import line_tags
from tagloom.plans.tag import aggregate_tags


@pytest.fixture(scope="module")
def data():
    rows = []
    for i in range(3000):
        key = 0 if i % 3 == 0 else i % 50 + 1
        rows.append((key, f"v{(i * 7919) % (11 if key else 97)}", i))
    return rows


@pytest.fixture(scope="module")
def df(spark, data):
    return spark.createDataFrame(data, "k bigint, v string, n bigint").repartition(16)


def grouped(data):
    out = defaultdict(list)
    for k, v, n in data:
        out[k].append((v, n))
    return out


def test_set_join(df, data):
    got = {r.k: r.s for r in set_join(df, "k", "v", "s").collect()}
    assert got == {k: ",".join(sorted({v for v, _ in rows})) for k, rows in grouped(data).items()}


def test_set_join_ranged(df, data):
    got = {r.k: r.s for r in set_join_ranged(df, "k", "v", "s").collect()}
    assert got == {k: ",".join(sorted({v for v, _ in rows})) for k, rows in grouped(data).items()}


def test_set_join_ranged_splits_a_hot_key(spark):
    """A key with a third of all distinct values lies on many pieces; nulls and empty texts as in set_join."""
    wide = spark.range(30_000).selectExpr("IF(id % 3 = 0, 0, id % 500) AS k", "concat('v', id % 20011) AS v")
    odd = spark.createDataFrame([(0, None), (0, ""), (-1, None), (-2, ""), (-2, None), (None, "a"), (None, "B"), (-3, "é"), (-3, "z")], "k bigint, v string")
    both = wide.unionByName(odd).repartition(16)
    largest = max(r["values"] for r in set_pieces(both, "k", "v", pieces=24).collect())
    assert largest < 2 * both.distinct().count() / 24
    want = {r.k: r.s for r in set_join(both, "k", "v", "s").collect()}
    assert {r.k: r.s for r in set_join_ranged(both, "k", "v", "s", pieces=24).collect()} == want
    assert set_join_ranged(both.limit(0), "k", "v", "s").count() == 0


def test_mode(df, data):
    got = {r.k: r.m for r in mode_per_key(df, "k", "v", "m").collect()}
    want = {k: min(Counter(v for v, _ in rows).items(), key=lambda c: (-c[1], c[0]))[0] for k, rows in grouped(data).items()}
    assert got == want


def test_last(df, data):
    got = {r.k: r.v for r in last_per_key(df, "k", ["n"], ["v"]).collect()}
    assert got == {k: max(rows, key=lambda r: r[1])[0] for k, rows in grouped(data).items()}


def test_dedup(df, data):
    got = {r.k: r.v for r in dedup_by_key(df, "k", ["v"]).collect()}
    assert got == {k: min(v for v, _ in rows) for k, rows in grouped(data).items()}


def test_top_n(df, data):
    got = defaultdict(list)
    for r in sorted(top_n_per_key(df, "k", [df.n.desc()], 4).collect(), key=lambda r: (r.k, r["rank"])):
        got[r.k].append(r.n)
    assert got == {k: sorted((n for _, n in rows), reverse=True)[:4] for k, rows in grouped(data).items()}


def test_hot_order_and_hot_customer(spark):
    """A third of the lines on one order, a third of the orders on one customer."""
    orders = [(i, f"1{0 if i % 3 == 0 else i:09d}", str(i)) for i in range(90)]
    lines = [(i, str(0 if i % 3 == 0 else i % 90), f"p{i % 13}", str(i), "10", "2", "1", "0.00", "5.00", "0.00") for i in range(2700)]
    o = spark.createDataFrame(orders, "id bigint, memberId string, orderSn string")
    g = spark.createDataFrame(lines, "id bigint, cOrderSn string, productName string, productAmount string, price string, "
                                     "number string, shippingFee string, activityPrice string, couponAmount string, orderPromotionAmount string")
    got = {r.id: r for r in aggregate_tags(order_lines(o, g, 9), line_tags().values()).collect()}
    owner = {sn: int(member[-9:]) for _, member, sn in orders}
    want = defaultdict(list)
    for line in lines:
        want[owner[line[1]]].append(line)
    assert set(got) == set(want)
    for customer, rows in want.items():
        assert got[customer].coupon == str(len(rows)) and got[customer].activity == "0"
        assert got[customer].purchaseGoods == ",".join(sorted({r[2] for r in rows}))


# ---- hot products: the joins must be split, not only right -------------------------

@pytest.fixture
def low_thresholds(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="module")
def goods(spark):
    return spark.range(2000).selectExpr("CAST(id % 400 AS STRING) AS productId", "concat('n', id % 400) AS productName").repartition(8)


@pytest.fixture(scope="module")
def hot(spark):
    """Two thirds of the rows on one product."""
    return spark.range(60000).selectExpr("id AS userId", "id", "if(id % 3 > 0, 7, id % 400) AS product", "CAST(id % 9 AS INT) AS rank", "id % 5 + 1 AS rating").repartition(16)


def is_split(df):
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_lookup_splits_a_hot_product(low_thresholds, hot, goods):
    named = lookup(hot.selectExpr("id", "CAST(product AS STRING) AS productId"), "productId", R.catalogue(goods), "productId")
    assert len(named.collect()) == 60000 and is_split(named)


def test_line_copies_split_a_hot_product(low_thresholds, hot, goods):
    joined = R.with_line_copies(hot.selectExpr("userId", "product AS productId", "rating"), goods)
    found = joined.collect()
    assert len(found) == 60000 and {r.copies for r in found} == {5} and is_split(joined)


def test_ranked_names_split_a_hot_product(low_thresholds, hot, goods):
    wide = R.names_by_rank(hot.selectExpr("id", "CAST(product AS STRING) AS productId", "rank"), goods)
    assert len(wide.collect()) == 60000 and is_split(wide)
