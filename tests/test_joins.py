import pytest
from pyspark.sql import functions as F

from pagesift.operators.joins import count_keys, lookup_join, salted_join


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 7 == 0 else f"k{i % 20}") for i in range(600)]
    keys = ["hot", *[f"k{i}" for i in range(0, 20, 2)], "unused"]
    return (
        spark.createDataFrame(rows, "id long, key string").repartition(4, "id"),
        spark.createDataFrame([(k, k.upper()) for k in keys], "key string, value string"),
    )


def ids(df):
    return sorted(map(tuple, df.select("id", *[c for c in ("value",) if c in df.columns]).collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [5, 50, 10_000])
def test_salted_join_equals_join(tables, how, limit):
    rows, lookup = tables
    got = salted_join(rows, lookup, ["key"], count_keys(rows, ["key"]), how, rows_per_task=limit)
    assert ids(got) == ids(rows.join(lookup, "key", how))


def test_hot_key_is_spread(tables):
    rows, lookup = tables
    joined = salted_join(rows, lookup.hint("merge"), ["key"], count_keys(rows, ["key"]), "inner", rows_per_task=20)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "explode(sequence" in plan


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_lookup_join_with_and_without_broadcast(tables, limit):
    rows, lookup = tables
    got = lookup_join(rows, lookup, "key", "left", broadcast_bytes=limit, rows_per_task=20)
    assert ids(got) == ids(rows.join(lookup, "key", "left"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert ("strategy=broadcast" in plan) == (limit > 0) or limit == 0


def test_two_keys(spark):
    rows = spark.range(100).select("id", (F.col("id") % 2).alias("a"), (F.col("id") % 5).alias("b"))
    lookup = spark.range(10).select((F.col("id") % 2).alias("a"), (F.col("id") % 5).alias("b"), F.col("id").alias("value"))
    got = salted_join(rows, lookup, ["a", "b"], count_keys(rows, ["a", "b"]), "inner", rows_per_task=3)
    assert ids(got) == ids(rows.join(lookup, ["a", "b"]))
