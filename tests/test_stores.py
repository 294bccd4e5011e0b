"""Co-bucketed orders, grouped profiles, kept states, versions."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from checks.settings import ID_DIGITS, PROFILE
from tagloom.operators.cells import sorted_cells, to_cells
from tagloom.operators.metrics import Metric
from tagloom.plans import partial_state as S
from tagloom.plans import profile as P
from tagloom.plans.line_tags import line_tags
from tagloom.plans.log_tags import log_tags, logs_with_id
from tagloom.plans.profile_groups import ProfileGroups
from tagloom.plans.recommend import view_ratings
from tagloom.plans.tag import aggregate_tags
from tagloom.sources.catalog import TableSpec, clone_version
from tagloom.sources.order_store import OrderStore
from tagloom.sources.versions import Versions


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=str)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="tagloom-test-")


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ---- orders and their lines ---------------------------------------------------------

def test_stored_order_lines_join_without_a_shuffle(spark, sources, folder, no_broadcast):
    store = OrderStore(spark, f"{folder}/orders", 8)
    store.write(sources.orders, sources.goods)
    stored = store.open(sources.users, sources.logs)
    near = stored.order_lines(ID_DIGITS)
    below = plan(near.select("id", "paid")).split("Union")[1]
    first_join = below[below.index("SortMergeJoin"):below.index("SortMergeJoin", below.index("SortMergeJoin") + 1)]
    assert "Exchange" not in first_join and first_join.count("FileScan") == 2
    assert rows(aggregate_tags(near, line_tags().values())) == rows(aggregate_tags(sources.order_lines(ID_DIGITS), line_tags().values()))
    assert stored.orders.count() == sources.orders.count() and stored.goods.count() == sources.goods.count()


def test_hot_and_missing_order_numbers_are_stored_apart(spark, sources, folder, no_broadcast):
    orders = spark.createDataFrame([(i, str(i % 9), None if i % 7 == 6 else str(0 if i % 3 == 0 else i)) for i in range(60)], "id long, memberId string, orderSn string")
    columns = "productAmount string, price string, number string, shippingFee string, activityPrice string, couponAmount string, orderPromotionAmount string"
    goods = spark.createDataFrame([(i, None if i % 5 == 4 else str(0 if i % 3 else i % 60), *["1"] * 7) for i in range(900)], f"id long, cOrderSn string, {columns}")
    store = OrderStore(spark, f"{folder}/orders", 4, hot_rows=50)
    store.write(orders, goods)
    stored = store.open(sources.users, sources.logs)
    near, apart = stored.parts
    assert near["goods"].where("cOrderSn = '0' OR cOrderSn IS NULL").isEmpty() and apart["goods"].where("cOrderSn = '0'").count() == goods.where("cOrderSn = '0'").count()
    assert rows(stored.goods) == rows(goods) and rows(stored.orders) == rows(orders)
    from tagloom.operators.joining import order_lines
    assert rows(stored.order_lines(None)) == rows(order_lines(orders, goods, None))


def test_more_lines_are_stored_in_more_buckets(spark, sources, folder, no_broadcast):
    """A task sorts one bucket: its rows must not grow with the tables."""
    orders = spark.range(60).selectExpr("id", "CAST(id % 9 AS STRING) AS memberId", "CAST(id AS STRING) AS orderSn")
    columns = ["productAmount", "price", "number", "shippingFee", "activityPrice", "couponAmount", "orderPromotionAmount"]
    goods = spark.range(900).selectExpr("id", "IF(id % 50 = 0, NULL, CAST(id % 60 AS STRING)) AS cOrderSn", *[f"'1' AS {c}" for c in columns])
    for rows_in_one, least, wanted in ((100, 2, 9), (100, 16, 16), (1_000_000, 2, 2)):
        store = OrderStore(spark, f"{folder}/orders", least, bucket_rows=rows_in_one)
        store.write(orders, goods)
        stored = store.open(sources.users, sources.logs)
        near = plan(stored.parts[0]["goods"].join(stored.parts[0]["orders"], F.col("cOrderSn") == F.col("orderSn")))
        assert near.count(f"out of {wanted}") == 2 and "Exchange" not in near
        assert rows(stored.goods) == rows(goods) and rows(stored.orders) == rows(orders)


def test_a_profile_of_stored_orders_is_the_same(spark, sources, folder):
    store = OrderStore(spark, f"{folder}/orders", 8)
    store.write(sources.orders, sources.goods)
    stored = store.open(sources.users, sources.logs)
    frames = [P.source_frames(s, PROFILE)[2] for s in (stored, sources)]
    assert rows(frames[0]) == rows(frames[1])


# ---- groups of profile columns --------------------------------------------------------

GROUPS = {"person": ["gender", "job"], "money": ["spent"], "web": ["device", "page"]}


def test_an_upsert_writes_its_groups_only(spark, folder):
    store = ProfileGroups(spark, folder, GROUPS, 4)
    assert store.read() is None and store.snapshot() == {}
    first = store.upsert(spark.createDataFrame([(1, "m", "a", "low"), (2, "f", "b", "high"), (None, "x", "x", "x")], "id long, gender string, job string, spent string"))
    second = store.upsert(spark.createDataFrame([(2, None), (3, "tablet")], "id long, device string"))
    assert store.snapshot(first) == {"person": 1, "money": 1} and store.snapshot(second) == {"person": 1, "money": 1, "web": 1}
    third = store.upsert(spark.createDataFrame([(2, None), (5, "c")], "id long, job string"))
    assert store.snapshot(third) == {"person": 2, "money": 1, "web": 1} and store.store("money").versions() == [1]
    assert rows(store.read().select("id", "gender", "job", "spent", "device")) == rows(spark.createDataFrame(
        [(1, "m", "a", "low", None), (2, "f", None, "high", None), (3, None, None, None, "tablet"), (5, None, "c", None, None)], "id long, gender string, job string, spent string, device string"))
    assert rows(store.read(version=first)) == rows(spark.createDataFrame([(1, "m", "a", "low"), (2, "f", "b", "high")], "id long, gender string, job string, spent string"))
    some = store.read(["spent", "page"])
    assert some.columns == ["id", "spent", "page"] and some.count() == 4
    with pytest.raises(ValueError):
        store.upsert(spark.createDataFrame([(1, "x")], "id long, other string"))
    with pytest.raises(ValueError):
        ProfileGroups(spark, folder, {"a": ["x"], "b": ["x"]}, 4)


def test_writers_of_different_groups_both_win(spark, folder):
    """The second writer ends between the first one's rows and its manifest."""
    store = ProfileGroups(spark, folder, GROUPS, 4)
    money = spark.createDataFrame([(1, "low")], "id long, spent string")

    class Slow(ProfileGroups):
        def commit(self, written):
            if "person" in written:
                store.upsert(money)
            return super().commit(written)
    Slow(spark, folder, GROUPS, 4).upsert(spark.createDataFrame([(1, "m")], "id long, gender string"))
    assert store.snapshot() == {"person": 1, "money": 1} and store.store("person").versions() == [1]
    assert rows(store.read(["gender", "spent"])) == [("m", 1, "low")]


def test_groups_come_together_by_their_ids_alone(spark, folder, no_broadcast):
    store = ProfileGroups(spark, folder, GROUPS, 8)
    store.upsert(spark.range(500).selectExpr("id", "CAST(id AS STRING) AS gender", "CAST(-id AS STRING) AS spent"))
    store.upsert(spark.range(300, 700).selectExpr("id", "'x' AS device"))
    whole = store.read()
    assert len(whole.collect()) == 700 == store.read(["device"]).count()
    tree = whole._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert len(re.findall(r"Exchange ", tree)) == 1 and tree.count("SortMergeJoin") == 3  # the ids' one
    for line in tree.splitlines():
        if "FileScan" in line and "ReadSchema: struct<id:bigint>" not in line:
            assert "SelectedBucketsCount: 8 out of 8" in line
    text = plan(store.read(["spent"]))
    assert "gender" not in text and "device" not in text


# ---- kept states ------------------------------------------------------------------------

def test_days_add_up_to_one_pass(spark, sources, folder):
    logs = sources.logs.withColumn("part", F.pmod(F.dayofmonth("log_time"), F.lit(3)))
    state = S.log_tag_state(spark, f"{folder}/tags", 8)
    views = S.view_state(spark, f"{folder}/views", 8)
    assert state.read() is None and state.days() == []
    for day in (2, 0, 1):  # late days
        S.add_log_day(state, f"day-{day}", logs.where(F.col("part") == day))
        S.add_view_day(views, f"day-{day}", logs.where(F.col("part") == day))
    assert S.add_log_day(state, "day-0", logs.where("part = 0")) == 3 and state.days() == ["day-0", "day-1", "day-2"]
    assert rows(S.tags_of_state(state.read())) == rows(aggregate_tags(logs_with_id(sources.logs), log_tags().values()))
    assert rows(views.read()) == rows(view_ratings(sources.logs))
    assert state.read(1).count() <= state.read().count() and state.days(1) == ["day-2"]


def test_a_day_shuffles_only_itself(spark, folder, no_broadcast):
    state = S.PartialState(spark, folder, ["id"], {"rows": Metric("count", "id"), "most": Metric("max", "x"), "least": Metric("min", "x")}, 8)
    state.add("a", spark.range(1000).selectExpr("id % 100 AS id", "id AS x"))
    fresh = state.partial(spark.range(50).selectExpr("id", "-id AS x")).repartition(8, "id")
    merged = state.merged(state.read(), fresh)
    assert {r.id: (r.rows, r.most, r.least) for r in merged.collect()} == {i: (11 if i < 50 else 10, i + 900, -i if i < 50 else i) for i in range(100)}
    stored = plan(merged).split("SortMergeJoin")[1].split("FileScan")[0]
    assert "Exchange" not in stored and "Bucketed: true" in plan(merged)


def test_modes_of_counts(spark, folder):
    state = S.value_state(spark, folder, "code", 4)
    state.add("a", spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "z"), (3, None)], "id long, code string"))
    state.add("b", spark.createDataFrame([(1, "y"), (2, "a")], "id long, code string"))
    assert rows(S.mode_of_state(state.read(), "code", "code")) == [("a", 2), ("y", 1)]


# ---- versions -----------------------------------------------------------------------------

def test_cells_and_clones_as_versions(spark, sources, folder):
    cells = to_cells(sources.users.limit(20))
    out = Versions(spark, f"{folder}/cells")
    out.put_table(sorted_cells(cells))
    held = out.read_table()
    out.put_table(sorted_cells(cells.where("column = 'job'")))
    assert rows(held) == rows(cells) and rows(out.read_table()) == rows(cells.where("column = 'job'"))
    spec = TableSpec.of("t", "id", "job")
    spark.range(9).selectExpr("id", "'x' AS job").write.parquet(f"{folder}/source")
    copies = Versions(spark, f"{folder}/copy")
    assert [clone_version(spark, f"{folder}/source", copies, spec, spec) for _ in range(2)] == [1, 2]
    assert copies.read_table(1).count() == copies.read_table().count() == 9


def test_a_read_keeps_its_version_while_the_output_is_replaced(spark, folder):
    out = Versions(spark, folder)
    with pytest.raises(FileNotFoundError):
        out.read_table()
    assert out.put_table(spark.range(5)) == 1
    held = out.read_table()
    assert out.put_table(spark.range(7)) == 2
    assert held.count() == 5 and out.read_table().count() == 7 and out.read_table(1).count() == 5
    with pytest.raises(Exception):
        out.put_table(spark.range(3).withColumn("x", F.raise_error(F.lit("boom")).cast("long")))
    assert out.numbers() == [1, 2] and out.read_table().count() == 7
