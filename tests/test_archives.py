"""Pruned scans, the index and ranged reads of archives."""

import gzip

import pytest
from pyspark.sql import functions as F

from pagesift.plans import extraction
from pagesift.sources import warc as WA
from test_sources_sinks import record

URLS = [f"http{'s' if i % 2 else ''}://h{i % 3}.com/{i}" for i in range(9)]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """An archive of a member per record, one plain, one of a single member, one cut short."""
    folder = tmp_path_factory.mktemp("archives")
    parts = [x for i, u in enumerate(URLS) for x in (record("request", b"GET", http=False), record("response", b"body %d" % i * 50, u))]
    plain = b"".join(gzip.decompress(p) for p in parts)
    (folder / "members.warc.gz").write_bytes(b"".join(parts))
    (folder / "plain.warc").write_bytes(plain)
    (folder / "single.warc.gz").write_bytes(gzip.compress(plain))
    (folder / "cut.warc.gz").write_bytes(b"".join(parts)[:-9])
    return folder


def listing(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "cc_path string")


def test_a_scan_reads_only_what_is_asked(spark, root):
    path = str(root / "members.warc.gz")
    found = WA.scan_warc(spark, path, ["url", "record_idx"]).where(F.col("url").startswith("https") & (F.col("record_idx") > 2))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "body" not in plan and "Filter (" not in plan and "+- Filter" not in plan
    assert sorted((r["record_idx"], r["url"]) for r in found.collect()) == [(i, u) for i, u in enumerate(URLS) if i % 2 and i > 2]
    some = WA.scan_warc(spark, path).where(F.col("url").isin(URLS[1], URLS[4]) & F.col("url").contains(".com") & F.col("url").endswith("4"))
    assert [(r["url"], bytes(r["body"])) for r in some.collect()] == [(URLS[4], b"body 4" * 50)]
    kept = WA.scan_warc(spark, path).where((F.col("url") != URLS[0]) & (F.col("url") < "https") & F.col("content_type").contains("html"))
    assert sorted(r["url"] for r in kept.collect()) == sorted(u for u in URLS[1:] if u < "https")


def test_filters_with_null(spark):
    from pyspark.sql import datasource as ds

    known, bare = WA.Record(0, "http://a.com/", None), WA.Record(1, None, None)
    equal = WA._test(ds.EqualTo(("url",), "http://a.com/"))
    assert equal(known) and not equal(bare)
    assert WA._test(ds.IsNull(("url",)))(bare) and WA._test(ds.Not(ds.IsNull(("url",))))(known)
    assert WA._test(ds.EqualNullSafe(("url",), None))(bare)
    assert WA._test(ds.Not(ds.EqualTo(("url",), "x"))) is None and WA._test(ds.EqualTo(("body",), b"x")) is None


def test_index_and_ranges(spark, root):
    names = ("members.warc.gz", "plain.warc", "single.warc.gz", "cut.warc.gz", "gone.warc.gz")
    index = WA.archive_index(listing(spark, *names), str(root)).cache()
    assert {r["cc_path"] for r in WA.failed_ledger(index).collect()} == {"cut.warc.gz", "gone.warc.gz"}
    rows = index.where("error is null").collect()
    assert len(rows) == 27 and {r["content_type"] for r in rows} == {"text/html; charset=latin1"}
    for r in rows:
        assert (r["offset"] is None) == (r["cc_path"] == "single.warc.gz")
        if r["offset"] is not None:
            data = (root / r["cc_path"]).read_bytes()[r["offset"] : r["offset"] + r["length"]]
            data = gzip.decompress(data) if r["cc_path"].endswith("gz") else data
            assert data.startswith(b"WARC/1.0") and data.rstrip().endswith(b"body %d" % r["record_idx"])
    wanted = index.where("record_idx in (1, 4, 8) or error is not null")
    found = WA.fetch_records(wanted, str(root), stretch=100)
    whole = WA.scan_archives(listing(spark, *names[:3]), str(root)).where("record_idx in (1, 4, 8)")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect())) and found.count() == 9


def test_wrong_ranges_are_errors_of_their_own(spark, root):
    index = WA.archive_index(listing(spark, "members.warc.gz"), str(root))
    wrong = index.withColumn("offset", F.when(F.col("record_idx") == 2, F.col("offset") + 1).otherwise(F.col("offset")))
    wrong = wrong.withColumn("url", F.when(F.col("record_idx") == 3, F.lit("http://other/")).otherwise(F.col("url")))
    found = {r["record_idx"]: r["error"] for r in WA.fetch_records(wrong, str(root)).collect()}
    assert {i for i, e in found.items() if e} == {2, 3} and "another record" in found[3]


def test_reextraction_moves_no_html(spark, root):
    index = WA.archive_index(listing(spark, "members.warc.gz", "single.warc.gz"), str(root)).cache()
    survivors = index.where("record_idx % 4 = 0").select("cc_path", "record_idx")
    out = extraction.reextract_by_range(survivors, index, str(root))
    assert {(r["cc_path"], r["record_idx"], r["text"]) for r in out.collect()} == {
        (n, i, "body %d" % i * 50) for n in ("members.warc.gz", "single.warc.gz") for i in (0, 4, 8)
    }
    plan = out._jdf.queryExecution().executedPlan().toString().split("\n")
    fetched = min(i for i, line in enumerate(plan) if "MapInArrow" in line)
    assert not any("Exchange" in line for line in plan[:fetched])
