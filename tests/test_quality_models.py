import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagesift.operators import models as M
from pagesift.operators import quality as Q


def test_lines(spark):
    text = "A full sentence stands here.\n12 likes\nHome\nNo end mark on this line\nPlease enable JavaScript now.\nHi there.\n\nThe last one is fine too!"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = Q.quality_lines(df).first()
    assert row["text"] == "A full sentence stands here.\nThe last one is fine too!"
    assert (row["n_lines"], row["n_removed"]) == (8, 6)
    relaxed = Q.quality_lines(df, Q.LineRules(min_words=1, terminal=False)).first()
    assert "No end mark" in relaxed["text"] and "likes" not in relaxed["text"]
    reasons = {r["reason"]: r["n_lines"] for r in Q.line_report(df).collect()}
    assert reasons == {"kept": 2, "counter": 1, "navigation": 1, "no_terminal": 1, "script": 1, "short": 2}


GOOD = " ".join(["wonderful animals and that creature have always been somewhere with everyone around to be"] * 5)


@pytest.mark.parametrize(
    "text, reason",
    [
        (GOOD, "kept"),
        ("short text", "too_short"),
        (" ".join(["abcdefghijklmnop"] * 60), "word_length"),
        (GOOD + " #" * 20, "symbols"),
        ("\n".join("- " + w for w in GOOD.split()), "bullets"),
        ("\n".join(w + " x..." for w in GOOD.split()[:25]) + "\n" + GOOD * 4, "ellipses"),
        ("\n".join([GOOD] * 3), "duplicate_lines"),
        (" ".join(["1234"] * 50 + ["the", "be"]), "not_alphabetic"),
        (" ".join(["chat"] * 60), "no_stop_words"),
    ],
)
def test_documents(spark, text, reason):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert Q.quality_docs(df).first()["disposition"] == reason


TRAIN = [(1, "x", "a a b"), (2, "x", "a"), (3, "y", "b c"), (4, None, "q q")]


def test_model_by_hand(spark):
    docs = spark.createDataFrame(TRAIN, "doc_id long, label string, text string")
    model = M.train_text_model(docs, "label")
    weights = {(r["token"], r["label"]): r["weight"] for r in M.model_rows(model).collect()}
    assert weights[("a", "x")] == pytest.approx(math.log(4 / 7))
    assert weights[("c", "x")] == pytest.approx(math.log(1 / 7))
    assert weights[("c", "y")] == pytest.approx(math.log(2 / 5))
    assert weights[(None, "x")] == pytest.approx(math.log(2 / 3))
    assert len(weights) == 8


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_scores(spark, limit):
    docs = spark.createDataFrame(TRAIN, "doc_id long, label string, text string")
    model = M.train_text_model(docs, "label")
    test = spark.createDataFrame([(1, "a a"), (2, "unknown words"), (3, ""), (4, "c")], "doc_id long, text string")
    scores = M.score_text(test, model, broadcast_bytes=limit, rows_per_task=1)
    x = {r["doc_id"]: r["s"] for r in M.class_score(scores, "x", "s").collect()}
    up, down = (2 / 3) * (4 / 7) ** 2, (1 / 3) * (1 / 5) ** 2
    assert x[1] == pytest.approx(up / (up + down))
    assert x[2] == pytest.approx(2 / 3) and x[3] == pytest.approx(2 / 3)
    assert {r["s"] for r in M.class_score(scores, "z", "s").collect()} == {0.0}
    assert {r["doc_id"]: r["lang"] for r in M.top_language(scores).collect()} == {1: "x", 2: "x", 3: "x", 4: "y"}
    ranked = M.top_language(scores, k=5)
    assert ranked.groupBy("doc_id").agg(F.sum("lang_score").alias("s")).where("abs(s - 1) > 1e-9").isEmpty()
    assert ranked.count() == 8


def test_scores_in_the_row(spark):
    docs = spark.createDataFrame(TRAIN, "doc_id long, label string, text string")
    model = M.train_row_model(docs, "label", features=1 << 20)
    test = spark.createDataFrame([(1, "a a"), (2, "unknown words"), (3, ""), (4, "c"), (5, None)], "doc_id long, text string")
    scored = test.withColumn("s", M.row_scores(model, F.col("text")))
    best = M.best_label(model, F.col("s"))
    rows = {r["doc_id"]: r for r in scored.select("doc_id", best["label"].alias("l"), M.label_score(model, F.col("s"), "x").alias("x"), M.label_score(model, F.col("s"), "z").alias("z")).collect()}
    up, down = (2 / 3) * (4 / 7) ** 2, (1 / 3) * (1 / 5) ** 2
    assert rows[1]["x"] == pytest.approx(up / (up + down)) and rows[2]["x"] == rows[3]["x"] == pytest.approx(2 / 3)
    assert {i: r["l"] for i, r in rows.items()} == {1: "x", 2: "x", 3: "x", 4: "y", 5: None}
    assert rows[1]["z"] == 0 and rows[5]["x"] is None


def test_thresholds(spark):
    df = spark.createDataFrame([(i, i / 10) for i in range(10)], "doc_id long, math_score double")
    assert M.math_filter(df).count() == 5
    assert tuple(M.score_threshold_report(df).first()) == (10, 5, 2)


def test_character_model_on_held_out_texts(spark):
    from pagesift.catalog import fixtures as X

    docs = X.documents(spark, "/root/testdata/sf0.01").where("lang is not null")
    held = docs.where("doc_id % 4 = 0")
    model = M.train_char_model(docs.where("doc_id % 4 <> 0"), "lang")
    tokens = M.train_row_model(docs.where("doc_id % 4 <> 0"), "lang")
    best = held.select("lang", M.best_label(model, M.char_scores(model, F.col("text")))["label"].alias("chars"),
                       M.best_label(tokens, M.row_scores(tokens, F.col("text")))["label"].alias("words"))
    chars, words = best.agg(F.avg((F.col("chars") == F.col("lang")).cast("int")), F.avg((F.col("words") == F.col("lang")).cast("int"))).first()
    assert chars >= 0.97 and chars >= words - 0.02
    short = spark.createDataFrame([("un éléphant où",), ("",), (None,)], "text string")
    scores = [r[0] for r in short.select(M.char_scores(model, F.col("text"))).collect()]
    assert scores[2] is None and all(abs(sum(s) - 1) < 1e-9 for s in scores[:2])


def test_character_hash_is_the_polynomial():
    want = [((1 * M.GRAM_BASE + c) % M.GRAM_PRIME) % M.FEATURES for c in (97, 98)]
    want.append((((2 * M.GRAM_BASE + 97) % M.GRAM_PRIME * M.GRAM_BASE + 98) % M.GRAM_PRIME) % M.FEATURES)
    assert M.char_grams("ab").tolist() == want


def test_prepared_texts_in_training_and_scoring(spark):
    rows = [(1, "VALUE 12", "a"), (2, "value 13", "a"), (3, "other", "b"), (4, "other 7 words", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, y string")
    model = M.train_row_model(df, "y", prepare=lambda t: F.regexp_replace(t, "[0-9]+", "number"))
    texts = spark.createDataFrame([("value 99",), ("words",), (None,), ("",)], "text string")
    found = M.with_scores(texts, model).select("text", M.best_label(model, F.col("scores"))["label"].alias("l"), "scores").collect()
    assert {r["text"]: r["l"] for r in found} == {"value 99": "a", "words": "b", None: None, "": found[3]["l"]}
    assert found[2]["scores"] is None and abs(sum(found[3]["scores"]) - 1) < 1e-9


def test_only_rare_tokens_of_texts_are_joined(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(i, "xy"[i % 2], f"{'common words here ' * (5 + i % 2)} rare{i}") for i in range(40)] + [(None, "x", "common"), (3, "y", None)],
        "doc_id long, label string, text string",
    )
    model = M.materialize(M.train_text_model(docs, "label"), "model")
    joined, join = [], M.lookup_join

    def counted(rows, lookup, *args, **options):
        joined.append(rows.count())
        return join(rows, lookup, *args, **options)

    monkeypatch.setattr(M, "lookup_join", counted)

    def found(limit):
        rows = M.score_rows(M.score_text(docs, model, broadcast_bytes=limit)).collect()
        return {(r["doc_id"], r["label"]): round(r["score"], 9) for r in rows}

    small = found(1000)
    assert joined == [40]  # the common words need no join
    assert found(0) == small == found(1 << 20) and joined[1:] == [40 + 3 * (5 * 20 + 6 * 20) + 1]
    assert len(small) == 2 * 41  # rows of one id are one text


def test_character_counts_of_a_batch_are_held_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "x", "abc " * 300), (2, "y", "xyz é"), (3, "x", None), (4, "y", "")], "doc_id long, label string, text string")
    whole = M.train_char_model(docs, "label", features=1 << 10)
    grams = M.char_grams
    monkeypatch.setattr(M, "COUNT_BYTES", 1)
    line = " " + "abc " * 300
    pieces = list(M.gram_pieces(line, features=1 << 10, most=100))
    assert sorted(np.concatenate(pieces).tolist()) == sorted(grams(line, features=1 << 10).tolist())
    assert max(map(len, pieces)) <= 100
    again = M.train_char_model(docs, "label", features=1 << 10)
    assert np.allclose(whole.weights.value[0], again.weights.value[0])
