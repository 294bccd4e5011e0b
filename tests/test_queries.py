"""Every query with SQL must give the same rows as DuckDB; the others must run whole."""

import pytest

import __spark_entry__ as entry
from checks.registry import with_blocks
from compare import compare, database
from conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SMALL), con, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(SQL))
def test_every_statement_parses(con, name):
    con.sql(f"EXPLAIN {SQL[name]}")


def test_words_in_literals_name_no_blocks():
    assert not with_blocks("SELECT 'e.g. fx_users''s' AS g1 FROM wide_").startswith("WITH")


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_gives_rows(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "id" and df.count() > 0
