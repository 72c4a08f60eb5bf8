import pytest
from pyspark.sql import functions as F

from pagesift.functions import urls as U
from pagesift.operators import suffixes as SX
from pagesift.operators import urls as R
from pagesift.sources import lists as L

LIST = "category string, kind string, value string"


@pytest.mark.parametrize(
    "url, host, domain",
    [
        ("https://WWW.Example.co.uk:8080/a?b", "www.example.co.uk", "example.co.uk"),
        ("http://user:pw@blog.example.com./x", "blog.example.com", "example.com"),
        ("http://192.168.1.20/x", "192.168.1.20", None),
        ("http://localhost/x", "localhost", None),
        ("http://com/x", "com", None),
        ("not a url", None, None),
    ],
)
def test_parts(spark, url, host, domain):
    row = R.url_parts(spark.createDataFrame([(url,)], "url string")).first()
    assert (row["host"], row["registered_domain"]) == (host, domain)
    assert row["fqdn"] == (host if domain else None)


def rules(spark, **options):
    def table(*rows):
        return spark.createDataFrame([("c", *r) for r in rows], LIST)

    return R.UrlRules(
        allow=table(("domain", "good.com"), ("domain", "sub.bad.com"), ("url", "http://bad.com/fine")),
        curated=table(("domain", "wiki.org"), ("domain", "site.gov/papers")),
        block=table(("domain", "bad.com"), ("domain", "x.mixed.com"), ("url", "http://ok.com/evil"), ("domain", "good.com")),
        strict_words=("casino",), hard_words=("dice",), soft_words=("win", "free"), **options,
    )


CASES = [
    ("http://good.com/casino", "kept"),
    ("http://sub.bad.com/a", "kept"),
    ("http://bad.com/fine", "kept"),
    ("http://en.wiki.org/a", "curated"),
    ("http://site.gov/papers/1", "curated"),
    ("http://site.gov/other", "kept"),
    ("http://www.bad.com/", "domain"),
    ("http://x.mixed.com/", "subdomain"),
    ("http://y.mixed.com/", "kept"),
    ("http://ok.com/evil", "url"),
    ("http://ok.com/ca-si-no", "strict_word"),
    ("http://ok.com/dice", "hard_word"),
    ("http://ok.com/dices", "kept"),
    ("http://ok.com/win-free", "soft_words"),
    ("http://ok.com/win-win", "kept"),
    ("broken url", "kept"),
    (None, "kept"),
]


@pytest.mark.parametrize("broadcast", [True, False])
def test_ordered_decision(spark, monkeypatch, broadcast):
    if not broadcast:
        from pagesift.operators import joins

        monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(joins.lookup_join, "__defaults__", ("inner", 0, 2, None))
    rows = [(i, u) for i, (u, _) in enumerate(CASES)]
    out = R.url_disposition(spark.createDataFrame(rows, "i int, url string"), rules(spark))
    got = {r["i"]: r["url_disposition"] for r in out.collect()}
    assert got == {i: want for i, (_, want) in enumerate(CASES)}


def test_curated_off_and_path_rules_off(spark):
    df = spark.createDataFrame([("http://site.gov/papers/1",)], "url string")
    assert R.url_disposition(df, rules(spark, path_rules=False)).first()["url_disposition"] == "kept"
    assert R.url_disposition(df, R.UrlRules()).first()["url_disposition"] == "kept"


def test_scheme_can_be_ignored(spark):
    df = R.url_parts(spark.createDataFrame([("http://a.com/x",)], "url string"))
    block = spark.createDataFrame([("c", "url", "a.com/x")], LIST)
    assert R.url_blocklist(df, block).first()["blocked"] is None
    assert R.url_blocklist(df, block, strip_scheme=True).first()["blocked"] == "url"


def test_list_files(spark, tmp_path):
    folder = tmp_path / "dating"
    folder.mkdir()
    (folder / "domains").write_text("# list\n a.com \nb.com\nb.com\n\n=======\nversion https://git-lfs.github.com/spec/v1\n")
    (folder / "usage").write_text("black\n")
    (tmp_path / "phishing").mkdir()
    (tmp_path / "phishing" / "urls").write_text("C.com/X-1\n")
    got = {tuple(r) for r in L.scan_lists(spark, str(tmp_path)).collect()}
    assert got == {("dating", "domain", "a.com"), ("dating", "domain", "b.com"), ("phishing", "url", "C.com/X-1")}
    normal = {r["value"] for r in L.scan_lists(spark, str(tmp_path), normalize=True).collect()}
    assert "ccomx1" in normal


def test_words(one):
    assert one(lambda: U.normalized(F.col("u")), u="http://A-b.c/?D=1") == "httpabcd1"
    assert one(lambda: U.count_words(F.col("u"), ("a", "b")), u="a-b-b") == 2


DEEP = "/".join(f"d{i}" for i in range(1, 13))


@pytest.mark.parametrize("limit", [1, 64 << 20])
def test_curated_paths_of_any_depth(spark, monkeypatch, limit):
    monkeypatch.setattr(R, "LIST_BROADCAST_BYTES", limit)
    entries = [("c", "domain", v) for v in ("a.org/x", "a.org/x/y/z/", f"b.org/{DEEP}", "c.org", "sub.d.org", "d.org/q")]
    urls = {
        "http://a.org/x": "a.org/x", "https://a.org/x/y?z#t": "a.org/x", "http://A.ORG:80/x/y/z/1": "a.org/x/y/z", "http://a.org/xy": None,
        "http://a.org/": None, "http://www.a.org/x": None, f"http://b.org/{DEEP}/more": f"b.org/{DEEP}", f"http://b.org/{DEEP[:-4]}": None,
        "http://e.c.org/1": "c.org", "http://sub.d.org/q": "sub.d.org", "http://d.org/q/": "d.org/q", "no url": None, None: None,
    }
    df = R.url_parts(spark.createDataFrame([(u, 1) for u in urls], "url string, n int"))
    out = R.url_curated(df, spark.createDataFrame(entries, LIST))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert {r["url"]: r["curated_by"] for r in out.collect()} == urls
    assert all(r["curated"] == (r["curated_by"] is not None) for r in out.collect())
    if limit > 1:  # domain, host and path
        assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan


def test_words_from_a_table(spark):
    words = spark.createDataFrame([("c", "word", "Dice"), ("c", "domain", "kept.com")], LIST)
    df = spark.createDataFrame([("http://a.com/dice",), ("http://kept.com/",)], "url string")
    got = [r["url_disposition"] for r in R.url_disposition(df, R.UrlRules(hard_words=words)).orderBy("url").collect()]
    assert got == ["hard_word", "kept"]


SUFFIXES = """// a comment
com
co.id
id
com.vn
*.ck
!www.ck

github.io  trailing words
*.kobe.jp
!city.kobe.jp
jp
"""


@pytest.mark.parametrize(
    "host, domain",
    [
        ("www.a.co.id", "a.co.id"), ("co.id", None), ("a.id", "a.id"), ("x.b.com.vn", "b.com.vn"), ("foo.ck", None),
        ("a.foo.ck", "a.foo.ck"), ("b.a.foo.ck", "a.foo.ck"), ("www.ck", "www.ck"), ("x.www.ck", "www.ck"), ("ck", None),
        ("me.github.io", "me.github.io"), ("a.me.github.io", "me.github.io"), ("github.io", None), ("a.b.unlisted", "b.unlisted"),
        ("x.kobe.jp", None), ("y.x.kobe.jp", "y.x.kobe.jp"), ("city.kobe.jp", "city.kobe.jp"), ("kobe.jp", "kobe.jp"),
        ("10.0.0.1", None), ("localhost", None), ("com", None), ("www.example.com", "example.com"),
    ],
)
def test_suffix_table(spark, trie, host, domain):
    row = R.url_parts(spark.createDataFrame([(f"http://{host}/x",)], "url string"), trie).first()
    assert (row["host"], row["registered_domain"]) == (host, domain)


@pytest.fixture(scope="module")
def trie(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("suffixes") / "list.dat"
    path.write_text(SUFFIXES)
    return SX.suffix_trie(SX.scan_suffixes(spark, str(path)))


def test_suffix_table_in_the_rules(spark, trie):
    df = spark.createDataFrame([("http://a.co.id/",), ("http://b.co.id/",)], "url string")
    block = spark.createDataFrame([("c", "domain", "a.co.id")], LIST)
    got = [r["url_disposition"] for r in R.url_disposition(df, R.UrlRules(block=block, suffixes=trie)).orderBy("url").collect()]
    assert got == ["domain", "kept"]
