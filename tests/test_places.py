"""Wide rows stay where they are when verdicts on them come back."""

import pytest
from pyspark.sql import functions as F

from pagesift.operators import decontam as C
from pagesift.operators import dedup as D
from pagesift.operators import places as P
from pagesift.operators import urls as R
from pagesift.session import materialize
from pagesift.sources import warc as WA

LIST = "category string, kind string, value string"


@pytest.fixture
def docs(spark):
    rows = [(i if i % 10 else None, f"text {i % 7} " + "x" * (i % 5), i) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string, n int").repartition(6)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [1, 1 << 20])
def test_placed_join_equals_a_join(spark, docs, how, limit):
    lookup = spark.createDataFrame([(i, f"v{i}") for i in range(0, 150, 3)], "doc_id long, v string")
    got = P.placed_join(docs, lookup, "doc_id", how, broadcast_bytes=limit)
    want = docs.join(lookup, ["doc_id"], how)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_lots_cover_all_files(spark, docs):
    table = P.placed(docs)
    results = table.narrow("n").where("n % 2 = 0")
    runs = P.lots(results, 300)
    assert len(runs) > 2 and runs[0][0] == 0 and all(a[1] == b[0] for a, b in zip(runs, runs[1:]))
    out = P.attached(table, results.select(P.PLACE, F.lit(1).alias("even")), then=lambda x: x.where("n > 5"), limit=300)
    assert {(r["n"], r["even"]) for r in out.collect()} == {(n, 1 if n % 2 == 0 else None) for n in range(6, 200)}


def plans_of(monkeypatch, modules):
    """Plans of all that is written while the test runs."""
    plans = []

    def noted(df, name="stage"):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return materialize(df, name)

    for module in modules:
        monkeypatch.setattr(module, "materialize", noted)
    return plans


def exchanged(plan, column):
    """Whether an Exchange with the column stands in a plan (a broadcast one does not count)."""
    lines = plan.split("\n")
    return any("Exchange hash" in line for line in lines) and any(f"{column}#" in line for line in lines)


def test_texts_are_not_shuffled_beyond_a_broadcast(spark, docs, monkeypatch):
    monkeypatch.setattr(P, "BROADCAST_BYTES", 1)
    plans = plans_of(monkeypatch, [P, D, C])
    docs = materialize(docs.where("doc_id is not null"))
    ids = docs.where("n % 3 = 0").select("doc_id")
    unique = D.exact_dedup(docs)
    removed = D.dup_removal(docs, ids.select(F.lit("f").alias("file"), "doc_id"), ids.limit(0).withColumn("dup_count", F.lit(1).cast("long")))
    results = [unique, removed, C.semi_contaminated(docs, ids), C.anti_contaminated(docs, ids)]
    assert unique.count() == docs.select("text").distinct().count()
    assert results[2].count() + results[3].count() == docs.count() == results[1].count() + ids.count()
    everything = plans + [("result", r._jdf.queryExecution().executedPlan().toString()) for r in results]
    for name, plan in everything:
        if "hashpartitioning" in plan and name not in ("repeated-texts",):
            scans = [line for line in plan.split("\n") if "FileScan" in line]
            assert not any("text#" in line for line in scans), (name, plan)


def test_url_rules_beyond_a_broadcast(spark, tmp_path, monkeypatch):
    """One scan of the archives, and no body in an Exchange."""
    spark.dataSource.register(WA.WarcSource)
    urls = ["http://good.com/a", "http://www.bad.com/b", "http://site.gov/papers/x/1", "http://site.gov/other", "http://ok.com/dice", "http://ok.com/"] * 30
    pages = spark.createDataFrame([(u, "2024-01-01T00:00:00Z", f"<p>{i}</p>") for i, u in enumerate(urls)], "url string, date string, html string")
    pages.select("url", "date", F.encode("html", "UTF-8").alias("body")).repartition(3).write.format("warc").mode("append").save(str(tmp_path))

    def table(*rows):
        return spark.createDataFrame([("c", *r) for r in rows], LIST)

    rules = R.UrlRules(
        allow=table(("domain", "good.com")), curated=table(("domain", "site.gov/papers")), block=table(("domain", "bad.com")),
        hard_words=table(("word", "dice")),
    )
    small = R.url_disposition(WA.scan_warc(spark, str(tmp_path)), rules)
    want = {(r["url"], r["url_disposition"], r["n"]) for r in small.groupBy("url", "url_disposition").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert {(u, d) for u, d, _ in want} == {
        ("http://good.com/a", "kept"), ("http://www.bad.com/b", "domain"), ("http://site.gov/papers/x/1", "curated"),
        ("http://site.gov/other", "kept"), ("http://ok.com/dice", "hard_word"), ("http://ok.com/", "kept"),
    }
    monkeypatch.setattr(R, "LIST_BROADCAST_BYTES", 1)
    plans = plans_of(monkeypatch, [R, P])
    out = R.url_disposition(WA.scan_warc(spark, str(tmp_path)), rules)
    plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    assert sum(plan.count("BatchScan") for _, plan in plans) == 1
    for name, plan in plans:
        if "hashpartitioning" in plan:
            assert "body#" not in plan, (name, plan)
    got = {(r["url"], r["url_disposition"], r["n"]) for r in out.groupBy("url", "url_disposition").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == want
