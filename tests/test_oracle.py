"""Every registered query with SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL
from pagesift import catalog
from tools.check import compare, connect

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    right, text = compare(spark, con, SMALL, name, QUERIES[name], SQL.get(name))
    assert right, text


def test_entry_has_all_queries():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and sum(r["doc_input"] for r in rows) == 50
