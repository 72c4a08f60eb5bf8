import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from pagesift.catalog import fixtures as X
from pagesift.catalog import quality as Q
from pagesift.operators import listings as L
from pagesift.operators import models as M
from pagesift.operators import stats as S
from pagesift.plans import curation, extraction
from pagesift.session import materialize, shared_dir
from pagesift.sinks import writers as W
from pagesift.sources import warc as WA


@pytest.fixture(scope="module")
def job(spark):
    pages = X.pages(spark, SMALL)
    records = pages.select(
        F.concat(F.lit("a"), F.col("page_id") % 3).alias("cc_path"),
        F.col("page_id").alias("record_idx"),
        "url",
        F.when(F.col("page_id") == 7, F.lit(b"")).otherwise(F.encode("html", "UTF-8")).alias("body"),
    )
    models = M.train_row_model(X.documents(spark, SMALL), "lang"), M.train_row_model(Q._labelled(spark, SMALL), "quality")
    return extraction.extract_job(records, X.rules(spark, SMALL), *models, "1")


def test_counters_add_up(job):
    scored, _, counters = job
    rows = counters.collect()
    assert sum(r["doc_input"] for r in rows) == 50 == scored.count()
    for r in rows:
        assert r["doc_input"] == sum(r[c] for c in S.DROP_CLASSES) + r["doc_remaining"]
    assert sum(r["html_content_empty"] for r in rows) <= 1


def test_every_record_has_one_outcome(job):
    scored, _, _ = job
    assert {r[0] for r in scored.select("disposition").distinct().collect()} <= {*S.DROP_CLASSES, S.REMAINING}
    dropped = scored.where(F.col("disposition") == S.URL_FILTERED)
    assert dropped.where("text is not null or lang is not null").isEmpty()


def test_topic_records_have_text_and_html_of_the_same_keys(job):
    scored, topic, _ = job
    key = list(extraction.KEY)
    wanted = scored.where("lang = 'en' and lang_score >= 0.65 and math_score >= 0.5").select(*key)
    assert topic.select(*key).exceptAll(wanted).isEmpty() and wanted.exceptAll(topic.select(*key)).isEmpty()
    assert topic.where("html is null or html = ''").isEmpty()


def test_texts_and_html_are_not_shuffled(spark, monkeypatch):
    plans = []

    def noted(df, name="stage"):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return materialize(df, name)

    models = M.train_row_model(X.documents(spark, SMALL), "lang"), M.train_row_model(Q._labelled(spark, SMALL), "quality")
    rules = X.rules(spark, SMALL)
    monkeypatch.setattr(extraction, "materialize", noted)
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    records = pages.select(F.lit("a").alias("cc_path"), F.col("page_id").alias("record_idx"), "url", F.encode("html", "UTF-8").alias("body"))
    extraction.extract_job(records, rules, *models, "1")
    assert [name for name, _ in plans] == ["extracted", "scored"]
    assert not any("hashpartitioning" in plan or "SortMergeJoin" in plan for _, plan in plans)


def test_job_from_listing_to_files(spark, tmp_path):
    good = X.pages(spark, SMALL).limit(12).select("url", F.lit("2024-05-01T00:00:00Z").alias("date"), F.encode("html", "UTF-8").alias("body"))
    spark.dataSource.register(WA.WarcSource)
    good.coalesce(1).write.format("warc").mode("append").save(str(tmp_path / "in"))
    name = next((tmp_path / "in").glob("*.warc.gz")).name
    whole = (tmp_path / "in" / name).read_bytes()
    (tmp_path / "in" / "bad.warc.gz").write_bytes(whole[: len(whole) // 2] + b"\0" * 50 + whole[len(whole) // 2 :])
    models = M.train_row_model(X.documents(spark, SMALL), "lang"), M.train_row_model(Q._labelled(spark, SMALL), "quality")
    listing = spark.createDataFrame([(name,), ("bad.warc.gz",), ("gone.warc.gz",)], "cc_path string")
    counters = extraction.run_extraction(listing, str(tmp_path / "in"), str(tmp_path / "out"), X.rules(spark, SMALL), *models, "1").collect()
    assert [(r["file_path"], r["doc_input"]) for r in counters] == [(name, 12)]
    assert {r[0] for r in spark.read.text(str(tmp_path / "out" / "failed")).collect()} == {"bad.warc.gz", "gone.warc.gz"}
    count = lambda x: spark.read.schema(W.RECORD_SCHEMA).json(str(tmp_path / "out" / x)).count()
    assert count("english") == counters[0]["doc_remaining"] and count("math_text") == count("math_html") <= count("english")
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "stats")).count() == 1


def test_curated_corpus_is_a_part_of_the_input(spark):
    docs = X.documents(spark, SMALL)
    index = materialize(spark.createDataFrame([("none of this occurs", "t")], "gram string, task string"))
    out = curation.curate(docs, index)
    assert out.join(docs, "doc_id", "left_anti").isEmpty()
    assert out.groupBy("doc_id").count().where("count > 1").isEmpty()
    assert out.groupBy("text").count().where("count > 1").isEmpty()
    assert out.where("dup_count < 1").isEmpty()


def test_positions_in_a_large_archive(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "big").otherwise("small").alias("cc_path"), (F.col("id") * 7).alias("offset"))
    got = L.record_ordinal(df, span=100)
    want = F.when(F.col("cc_path") == "big", F.col("offset") / 7).otherwise(F.col("offset") / 7 - 900)
    assert got.where(F.col("record_idx") != want).isEmpty() and got.count() == 1000


def test_page_bodies_are_not_shuffled_by_url_rules(spark):
    from pagesift.operators.urls import url_disposition

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    plan = url_disposition(pages, X.rules(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_shared_folder_is_read_from_the_session(spark):
    class Conf:
        def get(self, key, default):
            return "hdfs:///shared/" if key == "spark.checkpoint.dir" else default

    class Session:
        conf = Conf()

    assert shared_dir(Session()) == "hdfs:///shared"
