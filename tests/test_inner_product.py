"""The pruned top-N search against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.fixtures import sources as open_sources
from checks.settings import ID_DIGITS
from tagloom.operators import inner_product
from tagloom.operators.inner_product import _exact, best_lists, ranked
from tagloom.plans import recommend as R


def brute(users, items, n):
    """(id, rank, item, score) from all pairs, scores summed in component order."""
    out = []
    for i, u in users:
        x, y = np.tile(np.float32(u).astype(float), (len(items), 1)), np.float32([v for _, v in items]).astype(float).reshape(len(items), -1)
        scores = _exact(x, y)
        best = sorted(zip(-scores, [item for item, _ in items]))[:n]
        out += [(i, rank, item, -s + 0.0) for rank, (s, item) in enumerate(best)]
    return sorted(out)


def frames(spark, users, items):
    return spark.createDataFrame(users, "id long, features array<float>").repartition(3), spark.createDataFrame(items, "item long, features array<float>").repartition(2)


def found(lists):
    return sorted((r.id, r.rank, r.item, r.score + 0.0) for r in ranked(lists, "item").collect())


def vectors(n, width, seed, spread):
    draw = np.random.default_rng(seed)
    return [(int(i) * 3, [float(c) for c in np.float32(v * np.exp(spread * s))]) for i, v, s in zip(draw.permutation(n), draw.normal(size=(n, width)), draw.normal(size=n))]


@pytest.mark.parametrize("slice_items", [150, 1 << 18])
@pytest.mark.parametrize("n", [1, 7])
def test_same_lists_as_all_pairs(spark, n, slice_items):
    users, items = vectors(230, 5, 1, 1.0), vectors(900, 5, 2, 1.5)
    u, i = frames(spark, users, items)
    assert found(best_lists(u, i, n, slice_items)) == brute(users, items, n)


def test_ties_zeros_and_short_catalogues(spark):
    users = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [-1.0, -1.0]), (4, [1e-30, 1e30])]
    items = [(9, [2.0, 0.0]), (3, [2.0, 0.0]), (5, [2.0, 5.0]), (7, [0.0, 0.0]), (8, [1.0, 1.0]), (4, [-1.0, -1.0])]
    u, i = frames(spark, users, items)
    for n in (1, 2, 3, 10):
        for slice_items in (1, 2, 100):
            assert found(best_lists(u, i, n, slice_items)) == brute(users, items, n)
    assert best_lists(u, i.limit(0), 3).select("id", "items").count() == 4
    assert best_lists(u.limit(0), i, 3).count() == 0


def test_most_pairs_are_never_scored(spark):
    """Lengths that spread as those of popular items do: users stop early, and the slices that no one
    needs are not read."""
    users, items = vectors(300, 8, 3, 0.5), vectors(20_000, 8, 4, 1.2)
    u, i = frames(spark, users, items)
    lists = best_lists(u, i, 10, 4096)
    assert lists.agg(F.sum("scored")).first()[0] < 0.3 * len(users) * len(items)
    assert len(lists.inputFiles()) and found(lists) == brute(users, items, 10)


def test_lists_of_a_fitted_model(spark):
    """All users of the larger test tables, against all pairs of the fitted factors."""
    s = open_sources(spark, "/root/testdata/sf0.01")
    fitted = R.fit_als(R.order_ratings(R.bought_items(s.orders, s.goods, ID_DIGITS)), "productId", R.L.ALS_FAVOURITES)
    lists = R.top_lists(fitted, 10)
    users = [(r.id, r.features) for r in fitted.user_factors().collect()]
    items = [(r.item, r.features) for r in fitted.item_factors().collect()]
    assert found(lists) == brute(users, items, 10)
    share = lists.agg(F.sum("scored")).first()[0] / (len(users) * len(items))
    print(f"{share:.3f} of {len(users)} x {len(items)} pairs scored")
    assert share <= 1


def test_no_shuffle_and_no_join_of_users_and_items(spark):
    u, i = frames(spark, vectors(20, 3, 5, 1.0), vectors(30, 3, 6, 1.0))
    plan = best_lists(u, i, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_a_full_list_is_looked_up_only_where_an_item_passes_it(monkeypatch):
    """Blocks after the first neither select per user nor merge the lists of users that found nothing there."""
    draw = np.random.default_rng(5)
    x, y = draw.normal(size=(40, 4)), draw.normal(size=(2560, 4))
    y /= np.sqrt((y * y).sum(1))[:, None]  # equal lengths: no user can stop
    selected, merged = [], []
    select, enter = np.partition, inner_product.Lists._enter
    monkeypatch.setattr(inner_product.np, "partition", lambda a, *args, **named: selected.append(len(a)) or select(a, *args, **named))
    monkeypatch.setattr(inner_product.Lists, "_enter", lambda self, users, *found: merged.append(len(users)) or enter(self, users, *found))
    lists = inner_product.Lists(x, 3)
    for first in range(0, len(y), 256):
        assert lists.visit(np.arange(first, first + 256), y[first:first + 256], 1.0)
    assert selected == [40] and merged[0] == 40 and sum(merged) < 40 * len(merged)
    want = [sorted(zip(-_exact(np.tile(u, (len(y), 1)), y), range(len(y))))[:3] for u in x]
    assert [list(zip(-s, i)) for s, i in zip(lists.scores, lists.items)] == want
