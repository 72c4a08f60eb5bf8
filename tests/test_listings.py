import gzip

import pytest
from pyspark.sql import functions as F

from pagesift.operators import listings as L
from pagesift.sources import listings as SL

LINES = [f"crawl-data/CC-MAIN-2024-30/segments/{i:02d}/x.warc.gz" for i in range(23)]


@pytest.fixture(scope="module")
def listing(spark):
    return spark.createDataFrame([(i, v) for i, v in enumerate(LINES)], "pos long, value string").repartition(5)


def by_split(df):
    out = {}
    for r in df.orderBy("pos").collect():
        out.setdefault(r["split"], []).append(r["value"])
    return out


def test_consecutive(listing):
    got = by_split(L.split_consecutive(listing, 5))
    assert [len(got[i]) for i in range(5)] == [5, 5, 5, 4, 4]
    assert sum((got[i] for i in range(5)), []) == LINES


def test_more_splits_than_lines(listing):
    assert by_split(L.split_consecutive(listing, 50)) == {i: [v] for i, v in enumerate(LINES)}


def test_round_robin(listing):
    assert by_split(L.split_round_robin(listing, 5)) == {i: LINES[i::5] for i in range(5)}


def test_shuffled_is_a_repeatable_permutation(listing):
    first = [r["value"] for r in L.number_shuffled(listing, 1).orderBy("pos").collect()]
    again = [r["value"] for r in L.number_shuffled(listing, 1).orderBy("pos").collect()]
    other = [r["value"] for r in L.number_shuffled(listing, 2).orderBy("pos").collect()]
    assert first == again != other and sorted(first) == sorted(LINES) != first


def test_repeated_lines_all_stay(spark):
    same = spark.createDataFrame([(i, "x") for i in range(40)], "pos long, value string")
    got = L.number_shuffled(same, 3)
    assert sorted(r["pos"] for r in got.collect()) == list(range(40))


def test_scan_with_options(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n2\n\n3\n")
    (tmp_path / "sub").mkdir()
    with gzip.open(tmp_path / "sub" / "b.txt.gz", "wt") as f:
        f.write("4\r\n5")
    (tmp_path / "c.csv").write_text("no\n")

    def read(**options):
        return [r["value"] for r in SL.scan_listing(spark, str(tmp_path), glob="*.txt*", **options).orderBy("pos").collect()]

    assert read() == ["1", "2", "3", "4", "5"]
    assert read(recursive=False) == ["1", "2", "3"]
    assert read(skip=1, limit=3) == ["2", "3", "4"]
    assert sorted(read(shuffle_seed=5)) == ["1", "2", "3", "4", "5"]
    assert read(adapter=lambda df: df.withColumn("value", F.concat("value", F.lit("!"))))[0] == "1!"


def test_broken_file_keeps_its_first_lines(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\ntwo\nth\xffree\nfour\n")
    (tmp_path / "b.txt").write_bytes("fünf �\n".encode())
    got = [r["value"] for r in SL.scan_listing(spark, str(tmp_path)).orderBy("pos").collect()]
    assert got == ["one", "two", "fünf �"]


def test_several_listings_in_the_order_given(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1\n2\n")
    (tmp_path / "c.csv").write_text("no\n")
    with gzip.open(tmp_path / "b.gz", "wt") as f:
        f.write("3\n4\n")
    paths = [str(tmp_path / n) for n in ("b.gz", "c.csv", "a.txt")]
    got = [r["value"] for r in SL.scan_listing_multi(spark, paths).orderBy("pos").collect()]
    assert got == ["3", "4", "1", "2"]


def test_dumps(spark):
    links = spark.createDataFrame(
        [(f"https://data.example.org/crawl-data/{d}/index.html",) for d in ("CC-MAIN-2024-30", "CC-MAIN-2012", "CC-MAIN-2023-06")],
        "url string",
    )
    found = L.dump_paths(links)
    assert found.first()["listing_url"] == "https://data.example.org/crawl-data/CC-MAIN-2024-30/warc.paths.gz"
    there = spark.createDataFrame([("CC-MAIN-2023-06",)], "dump string")
    assert [r["dump"] for r in L.dump_filter(found, there).collect()] == ["CC-MAIN-2024-30"]


def test_output_paths(spark):
    df = spark.createDataFrame([("crawl-data/CC-MAIN-2024-30/segments/1/warc/a.warc.gz",)], "cc_path string")
    row = L.output_paths(df).first()
    assert row["en_text_path"] == "extracted/CC-MAIN-2024-30/segments_en/1/warc/a.warc.jsonl.gz"
    assert row["math_html_path"] == "math/CC-MAIN-2024-30/html_en/1/warc/a.warc.jsonl.gz"


def test_remaining_and_completed(spark):
    listing = spark.createDataFrame([(v,) for v in LINES], "cc_path string")
    done = listing.limit(20).union(listing.limit(3))
    assert L.remaining_files(listing, done).count() == 3
    assert [tuple(r) for r in L.completed_by_dump(done).collect()] == [("CC-MAIN-2024-30", 20)]
