"""Fitted models: repeatable, whole, without null ids."""

from itertools import permutations

import numpy as np
import pytest

from checks.model_queries import scores, segments
from checks.settings import FREQUENCY, ID_DIGITS, MONEY, RECENCY
from tagloom.plans import recommend as R
from tagloom.plans import rfm as V


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def member_scores(spark, sources):
    return scores(sources).cache()


@pytest.fixture(scope="module")
def brand_model(sources):
    return R.fit_als(R.brand_ratings(R.bought_items(sources.orders, sources.goods, ID_DIGITS)), "brand", {"rank": 4, "maxIter": 3, "regParam": 1.0, "alpha": 10.0})


def test_segments_are_repeatable(spark, member_scores):
    first, second = V.fit_segments(member_scores), V.fit_segments(member_scores.repartition(5))
    assert V.segment_centers(first) == V.segment_centers(second)
    assert len(V.segment_centers(first)) == 7


def test_every_member_gets_the_nearest_center(spark, member_scores):
    model = V.fit_segments(member_scores)
    centers = V.segment_centers(model)
    for r in V.assign_segments(member_scores, model, (RECENCY, FREQUENCY, MONEY)).collect():
        point = (r.recency, r.frequency, r.money)
        if None in point:
            assert r.cluster is None
            continue
        distance = [sum((a - b) ** 2 for a, b in zip(point, c[1:])) for c in centers]
        assert distance[r.cluster] == pytest.approx(min(distance))


def test_points_keep_every_member(member_scores):
    complete = member_scores.dropna(subset=V.SCORES).count()
    assert sum(r.members for r in V.score_points(member_scores).collect()) == complete


def test_user_value_covers_every_customer(sources, member_scores):
    values = V.user_value(member_scores, segments(member_scores), ID_DIGITS)
    assert values.count() == sources.orders.select("memberId").distinct().count()
    assert values.where("id IS NULL OR userValue IS NULL").count() == 0


def test_top_lists(spark, sources, brand_model):
    top = R.top_items(brand_model, 4)
    counts = {r["count"] for r in top.groupBy("id").count().collect()}
    assert counts == {4}
    assert rows(top.select("rank").distinct()) == [(0,), (1,), (2,), (3,)]
    users = sources.users.selectExpr("CAST(id AS INT) AS userId").where("userId < 20")
    some = R.top_items(brand_model, 4, users)
    assert rows(some) == rows(top.where("id < 20"))


def test_fit_is_repeatable(sources):
    items = R.bought_items(sources.orders, sources.goods, ID_DIGITS)
    a, b = R.favourite_brands(items), R.favourite_brands(items)
    assert rows(a) == rows(b)
    assert a.where("id IS NULL OR favorBrandName IS NULL OR favorBrandName = ''").count() == 0


def test_copies_count_the_many_to_many_join(spark, sources):
    ratings = R.view_ratings(sources.logs)
    compact = R.with_line_copies(ratings, sources.goods)
    joined = ratings.join(sources.goods.selectExpr("CAST(productId AS INT) AS productId", "1 AS one"), "productId")
    assert compact.selectExpr("coalesce(sum(copies), 0)").collect()[0][0] == joined.count()


def test_page_view_favourites(sources):
    wide = R.page_view_favourites(R.fit_page_views(R.view_ratings(sources.logs), sources.goods), sources.goods)
    assert wide.columns == ["id", *[f"productName{k}" for k in range(9)]]
    assert wide.count() == wide.select("id").distinct().count() > 0


def test_counted_items_give_the_same_ratings(sources):
    items = R.bought_items(sources.orders, sources.goods, ID_DIGITS)
    counted = R.counted_items(items)
    assert rows(R.order_ratings(items)) == rows(R.order_ratings(counted))
    assert rows(R.brand_ratings(items)) == rows(R.brand_ratings(counted))


def test_no_favourite_is_lost_to_the_width_or_spelling_of_ids(spark):
    views = [(20000000001, 3000000000, 4), (20000000001, 7, 2), (5, 7, 3), (5, 3000000000, 1)]
    ratings = spark.createDataFrame(views, "userId long, productId long, rating long")
    goods = spark.createDataFrame([("3000000000", "far", "t1"), ("007", "spy", "t2")], "productId string, productName string, productType string")
    found = {r.id: r.favorProducts for r in R.favourite_products(ratings, goods).collect()}
    assert found == {20000000001: "far,spy", 5: "far,spy"}
    wide = {r.id: {r.productName0, r.productName1} for r in R.page_view_favourites(R.fit_page_views(ratings, goods), goods).collect()}
    assert wide == {20000000001: {"far", "spy"}, 5: {"far", "spy"}}
    pairs = spark.createDataFrame([("20000000001", "007"), ("20000000001", "7")], "id string, productId string")
    assert rows(R.order_ratings(pairs)) == [(20000000001, 7, 2)]


def test_more_ids_than_ints_are_refused(spark, monkeypatch):
    monkeypatch.setattr(R.L, "MOST_NUMBER", 1)
    with pytest.raises(ValueError, match="different values of userId"):
        R.dense_numbers(spark.range(3).withColumnRenamed("id", "userId"), "userId")


def test_factor_blocks_follow_the_ratings(spark, monkeypatch):
    monkeypatch.setattr(R.L, "ALS_BLOCK_ROWS", 100, raising=False)
    ratings = spark.range(60 * 50).selectExpr("id % 60 AS userId", "id DIV 60 AS productId", "1 + id % 3 AS rating")
    fitted = R.fit_als(ratings, "productId", {"rank": 3, "maxIter": 2, "regParam": 1.0, "alpha": 10.0})
    assert [f.rdd.getNumPartitions() for f in (fitted.model.userFactors, fitted.model.itemFactors)] == [30, 30]
    assert rows(R.top_items(fitted, 4).groupBy("id").count()) == rows(spark.range(60).selectExpr("id", "4L"))
    monkeypatch.setattr(R.L, "ALS_BLOCK_ROWS", 1 << 21)
    small = R.fit_als(ratings, "productId", {"rank": 3, "maxIter": 2, "regParam": 1.0, "alpha": 10.0})
    assert [f.rdd.getNumPartitions() for f in (small.model.userFactors, small.model.itemFactors)] == [16, 8]


def test_a_few_brands_of_many_buyers_are_not_one_block(spark, monkeypatch):
    monkeypatch.setattr(R.L, "ALS_BLOCK_ROWS", 100, raising=False)
    fits = []
    monkeypatch.setattr(R, "fit_als", lambda *a, fit=R.fit_als, **k: fits.append(fit(*a, **k)) or fits[-1])
    items = spark.range(900).selectExpr("id % 200 AS id", "id % 6 AS brand")
    assert R.favourite_brands(items).count() == 200
    blocks = fits[0].model.itemFactors.rdd.glom().map(len).collect()
    assert sum(blocks) == 6 and max(blocks) == 1


def test_segments_go_with_their_book(spark, member_scores, tmp_path):
    fitted = segments(member_scores)
    fitted.save(spark, str(tmp_path))
    assert V.Segments.load(spark, str(tmp_path)).book == fitted.book
    with pytest.raises(ValueError):
        V.Segments(fitted.model, {"0": "a"})
    with pytest.raises(TypeError):
        V.user_value(member_scores, fitted.model, ID_DIGITS)
    refit = V.fit_segments(member_scores, {"k": 7, "seed": 3, "maxIter": 1, "initMode": "random"})
    assert V.segment_centers(refit) != V.segment_centers(fitted.model)
    refit.write().overwrite().save(f"{tmp_path}/model")
    with pytest.raises(ValueError):
        V.Segments.load(spark, str(tmp_path))


def test_every_rankable_user_gets_a_whole_list(brand_model):
    top = R.top_items(brand_model, 4).groupBy("id").count()
    assert rows(top) == rows(brand_model.user_factors().selectExpr("id", "4L"))


def test_least_cost_against_all_permutations():
    draw = np.random.default_rng(4)
    for k in range(1, 8):
        for costs in (draw.random((k, k)), draw.integers(0, 4, (k, k)).astype(float), np.zeros((k, k))):
            columns = V.least_cost(costs)
            assert sorted(columns) == list(range(k))
            best = min(sum(costs[i, j] for i, j in enumerate(p)) for p in permutations(range(k)))
            assert sum(costs[i, j] for i, j in enumerate(columns)) == pytest.approx(best)


def test_names_survive_a_refit(spark, member_scores):
    fitted = segments(member_scores)
    centres = [c for _, *c in V.segment_centers(fitted.model)]
    book = {str(i): f"name {i}" for i in range(len(centres))}
    order = [3, 0, 6, 1, 5, 2, 4]
    moved = [[x + .01 * (i + 1) for x in centres[i]] for i in order]
    assert V.names_after_refit(book, centres, moved, 0.5) == {str(n): f"name {i}" for n, i in enumerate(order)}
    with pytest.raises(ValueError, match="further than"):
        V.names_after_refit(book, centres, [[x + 9 for x in moved[0]], *moved[1:]], 0.5)
    with pytest.raises(ValueError, match="the refit has"):
        V.names_after_refit(book, centres, moved[:-1], 0.5)
    again = fitted.refitted(V.fit_segments(member_scores.repartition(3)), 1e-9)
    assert again.book == fitted.book
    assert rows(V.user_value(member_scores, again, ID_DIGITS)) == rows(V.user_value(member_scores, fitted, ID_DIGITS))
