import pytest
from pyspark.sql import functions as F

from pagesift.operators import decontam as C


def index(spark, *pairs):
    return spark.createDataFrame(list(pairs), "gram string, task string")


def result(df):
    return {r["doc_id"]: (r["disposition"], r["contaminated_ngram"], r["contaminated_task"]) for r in df.collect()}


DOCS = [(1, "x A, b c d y"), (2, "nothing here at all"), (3, "a b"), (4, "q a b c d a b c e")]


def test_first_hit_and_last_task(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    idx = index(spark, ("a b c", "t1"), ("a b c", "t2"), ("b c d", "t9"))
    got = result(C.contam_filter(docs, idx, n=3))
    assert got == {
        1: ("contaminated", "a b c", "t2"), 2: ("kept", None, None), 3: ("kept", None, None),
        4: ("contaminated", "a b c", "t2"),
    }


def test_join_without_broadcast_gives_the_same(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    idx = index(spark, ("a b c", "t1"), ("b c d", "t9"))
    assert result(C.contam_filter(docs, idx, n=3, broadcast_bytes=0)) == result(C.contam_filter(docs, idx, n=3))


def test_punctuation_gram_ends_the_scan(spark):
    docs = spark.createDataFrame([(1, "- - - a b c"), (2, "a b c - - -")], "doc_id long, text string")
    idx = index(spark, ("a b c", "t"))
    kept = C.contam_filter(docs, idx, n=3, remove_punctuation=False)
    assert {k: v[0] for k, v in result(kept).items()} == {1: "kept", 2: "contaminated"}
    through = C.contam_filter(docs, idx, n=3, remove_punctuation=False, stop_at_punctuation=False)
    assert {k: v[0] for k, v in result(through).items()} == {1: "contaminated", 2: "contaminated"}
    always = C.contam_filter(docs, idx, n=3)
    assert {k: v[0] for k, v in result(always).items()} == {1: "contaminated", 2: "contaminated"}


def test_gold_lists_and_missing_fields(spark):
    tasks = spark.createDataFrame(
        [("t", "q", ["a", "b"]), ("t", None, ["c"]), ("t", "q2", None), ("t", "q3", [None])],
        "task string, query string, golds array<string>",
    )
    assert {tuple(r) for r in C.gold_explode(tasks).collect()} == {("t", "q", "a"), ("t", "q", "b")}


def test_query_guard(spark):
    rows = spark.createDataFrame([("t", None, "a")], "task string, query string, label string")
    with pytest.raises(Exception, match="no query"):
        C.check_queries(rows).collect()


def test_grams_of_query_label_and_overlap(spark):
    pairs = spark.createDataFrame([("t", "A B C D E", "F G H I J")], "task string, query string, label string")

    def grams(**options):
        return {r["gram"] for r in C.index_build(C.task_grams(pairs, 4, **options)).collect()}

    label, overlap = {"f g h i", "g h i j"}, {"c d e f", "d e f g", "e f g h"}
    assert grams() == label | overlap
    assert grams(overlap_ngrams=False) == label
    assert grams(query_ngrams=True) == label | overlap | {"a b c d", "b c d e"}


def test_counts_by_task_and_group(spark):
    hits = spark.createDataFrame([(1, "a:x"), (2, "a:y"), (3, "plain")], "doc_id long, contaminated_task string")
    assert {r["task"]: r["n_removed"] for r in C.contam_by_task(hits).collect()} == {"a:x": 1, "a:y": 1, "plain": 1}
    assert [tuple(r) for r in C.contam_by_group(hits).collect()] == [("a", 2)]


def test_one_gram_in_most_documents(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("w a b c w").alias("text"))
    hits = C.join_contamination(docs, index(spark, ("a b c", "t")), 3, broadcast_bytes=0)
    assert hits.count() == 500


def test_equal_keys_of_different_grams_give_no_hit(spark):
    docs = spark.createDataFrame([*DOCS, (5, "z a b c"), (6, None)], "doc_id long, text string")
    idx = index(spark, ("a b c", "t1"), ("b c d", "t9"), ("b c", "short"), ("a b c d", "long"))
    want = {r["doc_id"]: tuple(r) for r in C.join_contamination(docs, idx, 3).collect()}
    assert want == {1: (1, 1, "a b c", "t1"), 4: (4, 1, "a b c", "t1"), 5: (5, 1, "a b c", "t1")}
    planted = C.join_contamination(docs, idx, 3, mix=lambda *hashes: F.lit(7).cast("long"))
    assert {r["doc_id"]: tuple(r) for r in planted.collect()} == want


def test_keys_build_no_grams(spark):
    from pagesift.functions import text as T

    df = spark.createDataFrame([("a b c d",), ("a b",), ("",)], "text string")
    keys = [r[0] for r in df.select(C.gram_keys(T.words(F.col("text")), 3)).collect()]
    assert [len(k) for k in keys] == [2, 0, 0]
    plan = df.select(C.gram_keys(T.words(F.col("text")), 3))._jdf.queryExecution().optimizedPlan().toString()
    assert "concat_ws" not in plan
