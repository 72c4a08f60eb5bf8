"""The registered queries on the smallest tables, beside their SQL where there is one."""

import pytest

from conftest import SMALL
from pagesift.llm import catalog
from tools.check import compare, connect

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
PER_DOCUMENT = ("op1_language", "op2_lm", "op4_byte_bpe", "op5_suffix_dedup", "op7_near_dedup")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_names():
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    right, text = compare(spark, con, SMALL, name, QUERIES[name], SQL[name])
    assert right, text


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_for_each_document(spark, name):
    assert QUERIES[name](spark, SMALL).select("doc_id").distinct().count() == 200
