"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry
from checks.settings import ID_DIGITS, PROFILE
from conftest import SMALL
from tagloom.operators.joining import orders_with_id
from tagloom.plans import profile as P
from tagloom.operators.metrics import Metric, ModeOf, SetOf, aggregate
from tagloom.operators.staging import stage
from tagloom.plans.line_tags import line_tags
from tagloom.plans.log_tags import log_tags, logs_with_id
from tagloom.plans.order_tags import order_tags
from tagloom.plans.tag import aggregate_tags

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(SQL))
def test_native_expressions_and_equi_joins_only(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for node in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_fused_order_tags_scan_orders_once(spark, sources):
    df = aggregate_tags(orders_with_id(sources.orders, ID_DIGITS), order_tags().values())
    assert plan(df).count("FileScan") == 1


def test_fused_order_tags_shuffle_the_orders_once(spark, sources):
    df = aggregate_tags(orders_with_id(sources.orders, ID_DIGITS), order_tags().values())
    assert plan(df).count("Exchange") == 1


def test_modes_and_sets_beside_metrics_keep_their_ties_and_nulls(spark):
    """Ties go to the smaller value, nulls count zero; a key of nothing but nulls has a null mode and an empty set."""
    rows = [(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, None), (1, None), (1, None), (2, None), (3, "é"), (3, "z"), (3, ""), (None, "x")]
    df = spark.createDataFrame(rows, "k long, v string").repartition(4)
    for named in ({"m": ModeOf("v")}, {"m": ModeOf("v"), "n": Metric("count", "1")}):
        assert {r.k: r.m for r in aggregate(df, "k", named).collect()} == {1: "a", 2: None, 3: "", None: "x"}
    for named in ({"s": SetOf("v")}, {"s": SetOf("v"), "n": Metric("count", "1")}):
        assert {r.k: r.s for r in aggregate(df, "k", named).collect()} == {1: "a,b", 2: "", 3: ",z,é", None: "x"}


def test_single_column_tags_read_single_columns(spark):
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(QUERIES["tag_spend_total"](spark, SMALL))).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} <= {"o_custkey", "o_totalprice"}


def test_fused_line_tags_shuffle_the_joined_lines_once(spark, sources):
    """Lines are dealt by customer alone: not by customer and name first, with all metrics, and then again."""
    text = plan(aggregate_tags(sources.order_lines(ID_DIGITS), line_tags().values()))
    above_the_join = text[:text.index("Join")]
    assert above_the_join.count("Exchange hashpartitioning(id#") == 1 and above_the_join.count("Exchange") == 1


def test_names_of_a_line_are_joined_last(spark, sources):
    """Only numbers of a line are shuffled to its order, and the lines of a product lie together when its names come."""
    text = plan(sources.goods.select("productId", "productName"))
    assert text.index("o_orderkey") > text.index("p_name")


def test_parts_of_the_profile_meet_without_a_shuffle(spark, sources):
    text = plan(P.assemble(P.source_frames(sources, PROFILE)))
    assert "Exchange" not in text.split("Union")[0]


def test_totals_read_the_stored_metrics_without_a_shuffle(spark, sources):
    """Only the rows that join the profile are dealt by id again, not what the averages read."""
    df = aggregate_tags(logs_with_id(sources.logs), log_tags().values(), stage=lambda per_id: stage(per_id, "metrics"))
    text = plan(df)
    assert text.count("REPARTITION_BY_COL") == 1 and "hashpartitioning" not in text.split("Subquery")[1].split("REPARTITION_BY_COL")[0]


def test_totals_reuse_the_aggregation(spark):
    df = QUERIES["tag_login_frequency"](spark, SMALL)
    df.collect()
    assert "ReusedExchange" in plan(df).split("Initial Plan")[0]


@pytest.mark.parametrize("name", ["tag_purchase_goods", "tag_view_goods", "agg_set_join", "op_dedup_key"])
def test_repeats_are_removed_before_collecting(spark, name):
    """The distinct step must survive the optimizer: an aggregation by key and value."""
    text = plan(QUERIES[name](spark, SMALL))
    assert "collect_set" not in text
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", text)
    assert any(k.count("#") >= 2 for k in keys)


@pytest.mark.parametrize("name", ["tag_purchase_goods_ranged", "tag_view_goods_ranged", "agg_set_join_ranged"])
def test_ranged_sets_are_sorted_by_pieces(spark, name):
    """Values are dealt by ranges; what is dealt by key alone are texts of pieces."""
    text = plan(QUERIES[name](spark, SMALL))
    assert "rangepartitioning" in text and re.search(r"collect_list\(struct\(piece", text)


def test_top_n_is_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["topn_names_wide"](spark, SMALL))


def test_metrics_of_logs_stay_hash_aggregated(spark):
    assert "SortAggregate" not in plan(QUERIES["tag_page_type"](spark, SMALL))
