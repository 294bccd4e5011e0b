"""Profile: assembly, upsert, store, cells, catalogue, export options."""

import tempfile

import pytest

from checks.settings import ID_DIGITS, LADDERS, PROFILE
from tagloom.operators.cells import from_cells, to_cells, write_cells
from tagloom.operators.joining import order_lines, orders_with_id
from tagloom.plans import profile as P
from tagloom.plans.line_tags import line_tags
from tagloom.plans.log_tags import log_tags, logs_with_id
from tagloom.plans.order_tags import order_tags
from tagloom.plans.tag import aggregate_tags, single_tag
from tagloom.sources import jdbc
from tagloom.sources.catalog import USERS, TableSpec, clone_table, scan


def rows(df, *order):
    return sorted(map(tuple, df.select(*(order or df.columns)).collect()), key=str)


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="tagloom-test-")


def test_assemble_keeps_every_id(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id bigint, a string")
    b = spark.createDataFrame([(2, "y", "z"), (3, "w", None)], "id bigint, b string, c string")
    assert rows(P.assemble([a, b])) == [(1, "x", None, None), (2, None, "y", "z"), (3, None, "w", None)]


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", "b2")], "id bigint, a string, b string")
    new = spark.createDataFrame([(2, None, "c2"), (3, "a3", "c3"), (None, "x", "y")], "id bigint, a string, c string")
    expected = [(1, "a1", "b1", None), (2, None, "b2", "c2"), (3, "a3", None, "c3")]
    once = P.upsert(old, new)
    assert rows(once, "id", "a", "b", "c") == expected
    assert rows(P.upsert(once, new), "id", "a", "b", "c") == expected


@pytest.mark.parametrize("buckets", [None, 4])
def test_store_versions(spark, folder, buckets):
    store = P.ProfileStore(spark, f"{folder}/profile", buckets)
    assert store.read() is None
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, gender string")
    assert store.upsert(first) == 1
    assert store.upsert(spark.createDataFrame([(2, "x"), (5, "y")], "id bigint, job string")) == 2
    assert rows(store.read(), "id", "gender", "job") == [(1, "a", None), (2, "b", "x"), (5, None, "y")]
    assert store.versions() == [1, 2]


def test_bucketed_store_is_not_shuffled_on_upsert(spark, folder):
    store = P.ProfileStore(spark, f"{folder}/profile", 8)
    store.upsert(spark.range(1000).selectExpr("id", "CAST(id AS STRING) AS gender"))
    update = spark.range(500, 1500).selectExpr("id", "CAST(id AS STRING) AS job")
    joined = P.upsert(store.read(), update)
    assert joined.count() == 1500
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("buckets", [None, 8])
def test_two_writers_lose_no_update(spark, folder, buckets, monkeypatch):
    first, second = (P.ProfileStore(spark, f"{folder}/profile", buckets) for _ in range(2))
    first.upsert(spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, gender string"))
    written, others = P.ProfileStore._written, []

    def between(store, rows):
        run = written(store, rows)
        if store is first and not others:  # the other program is faster
            others.append(second.upsert(spark.createDataFrame([(2, "x")], "id bigint, job string")))
        return run
    monkeypatch.setattr(P.ProfileStore, "_written", between)
    assert first.upsert(spark.createDataFrame([(1, "m")], "id bigint, city string")) == 3 and others == [2]
    assert rows(first.read(), "id", "gender", "job", "city") == [(1, "a", None, "m"), (2, "b", "x", None)]


def test_a_root_made_anew_with_other_buckets(spark, folder):
    import shutil
    P.ProfileStore(spark, f"{folder}/profile", 8).upsert(spark.range(100).selectExpr("id", "'a' AS gender"))
    shutil.rmtree(f"{folder}/profile")
    store = P.ProfileStore(spark, f"{folder}/profile", 4)
    store.upsert(spark.range(50).selectExpr("id", "'b' AS gender"))
    assert store.read().where("gender = 'b'").count() == 50 and store.read().where("id = 7").count() == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("profile_")]


def test_store_ignores_an_unfinished_version(spark, folder):
    import os
    store = P.ProfileStore(spark, folder)
    store.write(spark.range(3).selectExpr("id", "'a' AS gender"))
    os.makedirs(f"{folder}/version=00000002")
    assert store.versions() == [1] and store.read().count() == 3


def test_missing_columns_read_as_null(spark):
    view = P.export_view(spark.createDataFrame([(1, "男")], "id bigint, gender string"))
    assert view.columns == ["id", "gender", "nationality", "politicalFace", "paymentCode", "ageRange", "constellation", "LatestLogin"]
    assert tuple(view.collect()[0]) == (1, "男", None, None, None, None, None, None)


def test_cells_round_trip(spark, sources, folder):
    names = ["gender", "job", "birthday", "lastLoginTime"]
    users = sources.users.select("id", *names)
    cells = to_cells(users, columns=names)
    write_cells(cells, f"{folder}/cells")
    write_cells(cells, f"{folder}/cells")  # a rerun replaces
    stored = spark.read.parquet(f"{folder}/cells")
    assert stored.count() == cells.count()
    back = from_cells(stored.selectExpr("*", "1 AS ts"), names)
    assert rows(back, "id", *names) == rows(users, "id", *names)


def test_cells_include_the_key_and_skip_nulls(spark):
    df = spark.createDataFrame([(1, "x", None)], "id bigint, b string, a string")
    assert rows(to_cells(df)) == [(1, "b", "x"), (1, "id", "1")]


def test_catalog_maps_cells_to_names(spark, folder):
    spark.createDataFrame([(1, "p", "12")], "rk bigint, paymentCode string, n string").write.parquet(f"{folder}/t")
    spec = TableSpec.from_json("""{"table": {"namespace": "d", "name": "t"}, "rowkey": "rk", "columns": {
        "id": {"cf": "rowkey", "col": "rk", "type": "LONG"}, "payTime": {"cf": "cf", "col": "paymentCode", "type": "string"},
        "n": {"cf": "cf", "col": "n", "type": "int"}, "gone": {"cf": "cf", "col": "gone", "type": "string"}}}""")
    assert rows(scan(spark, spec, f"{folder}/t")) == [(1, "p", 12, None)]
    with pytest.raises(ValueError):
        TableSpec.from_json('{"table": {"name": "t"}, "rowkey": "rk", "columns": {}}')


def test_clone_projects_and_drops_null_keys(spark, folder):
    spark.createDataFrame([(1, "a", "x"), (None, "b", "y")], "id bigint, username string, gender string").write.parquet(f"{folder}/u")
    two = TableSpec.of("tbl_users", "id", "username")
    clone_table(spark, f"{folder}/u", f"{folder}/clone", USERS, two)
    assert rows(spark.read.parquet(f"{folder}/clone")) == [(1, "a")]


@pytest.mark.parametrize("source", ["orders", "lines", "logs"])
def test_fused_equals_each_tag_alone(spark, sources, source):
    frames = {
        "orders": (orders_with_id(sources.orders, ID_DIGITS), order_tags(LADDERS)),
        "lines": (order_lines(sources.orders, sources.goods, ID_DIGITS), line_tags()),
        "logs": (logs_with_id(sources.logs), log_tags()),
    }
    df, tags = frames[source]
    fused = aggregate_tags(df, tags.values()).cache()
    for tag in tags.values():
        names = list(tag.columns)
        present = fused if tag.present is None else fused.where(f"{names[0]} IS NOT NULL")
        assert rows(present, "id", *names) == rows(single_tag(df, tag), "id", *names)
    fused.unpersist()


def test_profile_with_and_without_staging(spark, sources):
    plain = P.assemble(P.source_frames(sources, PROFILE))
    staged = P.assemble(P.source_frames(sources, PROFILE, stage=P.checkpointed(spark) or (lambda df: df)))
    assert rows(plain) == rows(staged)
    assert plain.where("id IS NULL").count() == 0
    assert plain.count() == plain.select("id").distinct().count()


def test_jdbc_options():
    table = jdbc.JdbcTable("jdbc:db://h/x", "t", user="u", password="p")
    assert table.as_options() == {"url": "jdbc:db://h/x", "dbtable": "t", "user": "u", "password": "p"}
    assert jdbc.parallel_read_options("id", 0, 1000, 4)["numPartitions"] == "4"
    assert jdbc.export_options(8) == {"truncate": "true", "batchsize": "5000", "numPartitions": "8"}
    with pytest.raises(ValueError):
        jdbc.parallel_read_options("id", 5, 5, 4)
