import gzip
import json

from pyspark.sql import functions as F

from pagesift.functions import encoding as E
from pagesift.operators import stats as S
from pagesift.sinks import writers as W
from pagesift.sources import tasks as TK
from pagesift.sources import warc as WA
from pagesift.streaming.incremental import ingest_incremental


def record(kind, body, url="http://a.com/", http=True):
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin1\r\n\r\n" if http else b"") + body
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {url}\r\nWARC-Date: 2024-05-01T10:00:00Z\r\nContent-Length: {len(block)}\r\n\r\n"
    return gzip.compress(head.encode() + block + b"\r\n\r\n")


def archive(path, *records):
    path.write_bytes(b"".join(records))


def test_archive(spark, tmp_path):
    archive(
        tmp_path / "a.warc.gz", record("warcinfo", b"info", http=False), record("request", b"GET", http=False),
        record("response", b"caf\xe9"), record("metadata", b"x", http=False), record("response", b"", "http://b.com/"),
    )
    archive(tmp_path / "b.warc.gz", record("response", "né".encode()))
    (tmp_path / "notes.txt").write_text("no archive")
    rows = sorted(WA.scan_warc(spark, str(tmp_path)).collect(), key=lambda r: (r["cc_path"], r["record_idx"]))
    assert [(r["record_idx"], r["url"], bytes(r["body"])) for r in rows] == [
        (0, "http://a.com/", b"caf\xe9"), (1, "http://b.com/", b""), (0, "http://a.com/", "né".encode()),
    ]
    assert str(rows[0]["ts"]) == "2024-05-01 10:00:00"
    charset = E.declared_charset(F.col("body"), F.col("content_type"))
    texts = WA.scan_warc(spark, str(tmp_path)).select(charset.alias("c"), E.decode_body(F.col("body"), charset).alias("t"))
    assert sorted((r["c"], r["t"]) for r in texts.collect()) == [("latin1", ""), ("latin1", "café"), ("latin1", "né")]


def test_damaged_and_missing_archives_go_to_the_ledger(spark, tmp_path):
    archive(tmp_path / "good.warc.gz", record("response", b"ok"))
    whole = record("response", b"first") + record("response", b"second" * 5000)
    (tmp_path / "cut.warc.gz").write_bytes(whole[:-12])
    listing = spark.createDataFrame([("good.warc.gz",), ("cut.warc.gz",), ("gone.warc.gz",)], "cc_path string")
    records = WA.scan_archives(listing, str(tmp_path))
    assert {r["cc_path"] for r in WA.failed_ledger(records).collect()} == {"cut.warc.gz", "gone.warc.gz"}
    read = {(r["cc_path"], r["record_idx"]) for r in records.where("error is null").collect()}
    assert read == {("good.warc.gz", 0)}  # nothing of a failed archive, which runs again
    W.write_ledger(WA.failed_ledger(records), str(tmp_path / "ledger"))
    assert spark.read.text(str(tmp_path / "ledger")).count() == 2


def test_utf16_and_order_mark(spark):
    bodies = ["hé".encode("utf-16"), "hé".encode("utf-16-be"), b"\xef\xbb\xbfh\xc3\xa9"]
    df = spark.createDataFrame([(bodies[0], None), (bodies[1], "utf-16be"), (bodies[2], None)], "b binary, c string")
    assert [r[0] for r in df.select(E.decode_body(F.col("b"), F.col("c"))).collect()] == ["hé"] * 3


DOCS = "text string, html string, lang string, lang_score double, url string, timestamp string, cc_path string, record_idx long, math_score double, dump string"


def docs(spark):
    rows = [
        (f"text {i}\nline", f"<p>{i}</p>", "en" if i % 3 else "de", 0.5 + i / 20, "u", "t", "p", i, i / 10, f"d{i % 2}") for i in range(10)
    ]
    return spark.createDataFrame(rows, DOCS)


def test_record_files(spark, tmp_path):
    W.sink_english_text(docs(spark), str(tmp_path / "en"))
    lines = [line for f in tmp_path.glob("en/dump=*/*.json.gz") for line in gzip.open(f, "rt")]
    first = json.loads(lines[0])
    assert list(first) == ["text", "meta"]
    assert list(first["meta"]) == ["lang", "lang_score", "url", "timestamp", "cc-path", "record_idx", "math_score"]
    assert len(lines) == 4 and all(line.strip() for line in lines)


def test_text_and_html_have_the_same_keys(spark, tmp_path):
    W.sink_math_text(docs(spark), str(tmp_path / "text"))
    W.sink_math_html(docs(spark), str(tmp_path / "html"))

    def keys(name):
        back = W.from_records(spark.read.schema(W.RECORD_SCHEMA).json(str(tmp_path / name)))
        return {(r["cc_path"], r["record_idx"]) for r in back.collect()}

    assert keys("text") == keys("html") == {("p", 5), ("p", 7), ("p", 8)}


def test_blank_lines_are_no_records(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n{"text": "x", "meta": {"lang": "en"}}\n\n')
    assert W.from_records(spark.read.schema(W.RECORD_SCHEMA).json(str(tmp_path / "a.json"))).count() == 1


def test_overwrite_only_touches_written_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, k string")
    W.write_table(df, path, ("k",))
    W.write_table(df.where("k = 'a'"), path, ("k",))
    assert spark.read.parquet(path).count() == 2
    W.write_table(df, path, ("k",), overwrite=False)
    assert spark.read.parquet(path).count() == 4


def test_rejected_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "kept"), (2, "url"), (3, "domain")], "x int, disposition string")
    kept = W.excluded_writer(df, str(tmp_path / "out"))
    assert [r["x"] for r in kept.collect()] == [1]
    assert {r["x"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {2, 3}


def test_counters(spark, tmp_path):
    rows = [("a", d, 0.9) for d in (*S.DROP_CLASSES, S.REMAINING, S.REMAINING)] + [("b", S.REMAINING, 0.6)]
    df = spark.createDataFrame(rows, "file_path string, disposition string, math_score double")
    stats = S.funnel_stats(df, ["file_path"])
    assert stats.columns == ["file_path", *S.COUNTERS]
    for r in stats.collect():
        assert r["doc_input"] == sum(r[c] for c in S.DROP_CLASSES) + r["doc_remaining"]
    assert {r["file_path"]: r["math_retained"] for r in stats.collect()} == {"a": 2, "b": 0}
    W.sink_stats(stats, str(tmp_path / "s"))
    W.sink_stats(stats, str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).count() == 4


def test_tasks(spark, tmp_path):
    rows = {
        "asdiv": {"body": "b", "answer": "9 (apples)"},
        "gsm8k": {"question": "q", "cot": "c", "answer": "3"},
        "math": {"problem": "p", "solution": "s"},
        "mathqa": {"problem": "p", "options": "a ) 1", "rationale": '"why"'},
        "mawps": {"input": "i", "target": "t"},
        "mmlu_stem": {"question": "q", "options": ["w", "x", "y", "z"], "answer": "C"},
        "ocw": {"problem": "p", "solution": "s", "answer": "4"},
        "sat": {"question": "q", "options": "A) 1 B) 2", "Answer": "B"},
        "svamp": {"Body": "b", "Question": "q?", "Answer": "2.0"},
        "aime24": {"problem": "p", "solution": "s"},
        "aime25": {"problem": "p", "answer": "70"},
        "amc": {"problem": "p", "answer": 27.0},
    }
    for task, row in rows.items():
        (tmp_path / f"{task}.jsonl").write_text(json.dumps(row) + "\n")
    got = {r["task"]: (r["query"], r["golds"]) for r in TK.scan_tasks(spark, str(tmp_path)).collect()}
    assert got == {
        "asdiv": ("b", ["9 (apples)"]), "gsm8k": ("q", ["c 3"]), "math": ("p", ["s"]), "mathqa": ("p a ) 1", ["why"]),
        "mawps": ("i", ["t"]), "mmlu_stem": ("q", ["A: w B: x C: y D: z Answer: C"]), "ocw": ("p", ["s 4"]),
        "sat": ("q", ["A) 1 B) 2 B"]), "svamp": ("b q?", ["2.0"]), "aime24": ("p", ["s"]), "aime25": ("p", ["70"]),
        "amc": ("p", ["27.0"]),
    }


def test_only_new_files_are_ingested(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(*values):
        spark.createDataFrame([(v,) for v in values], "x int").coalesce(1).write.mode("append").parquet(source)

    def run():
        ingest_incremental(spark, source, target, state, "x int", lambda df: df.withColumn("y", F.col("x") * 2))
        return spark.read.parquet(target).count()

    arrive(1, 2)
    assert run() == 2
    arrive(3)
    assert run() == 3
    assert run() == 3


def test_declared_charsets_by_any_known_name(spark):
    cases = [("iso-8859-6", "سلام"), ("iso-8859-8", "שלום"), ("tis-620", "สวัสดี"), ("macintosh", "café"), ("cp866", "привет"), ("big5-hkscs", "香港"), ("euc_jis_2004", "日本")]
    rows = [(text.encode(name), name, text) for name, text in cases]
    rows += [(b"caf\xe9", "no-such-charset", "café"), (b"caf\xe9", None, "café"), (b"\\u0041\xe9", "unicode_escape", "\\u0041é"), (b"41\xe9", "hex", "41é")]
    df = spark.createDataFrame(rows, "b binary, c string, want string")
    found = df.select("want", E.decode_body(F.col("b"), F.col("c")).alias("t")).collect()
    assert [r["t"] for r in found] == [r["want"] for r in found]


def test_a_listing_is_read_and_numbered_in_splits(spark, tmp_path):
    from pagesift.sources import listings as SL

    lines = [f"crawl/{i:05d}.warc.gz" for i in range(4000)]
    (tmp_path / "a.txt").write_bytes("\r\n".join(lines).encode() + b"\n\n")
    (tmp_path / "b.txt").write_bytes(b"first\n\nsecond\nbro\xffken\nlost\n")
    with gzip.open(tmp_path / "c.gz", "wt") as out:
        out.write("x\ny\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        raw = SL._split_lines(spark.read, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 5
        found = SL.scan_listing(spark, str(tmp_path)).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["value"] for r in found] == [*lines, "first", "second", "x", "y"]
    assert [r["pos"] for r in found] == list(range(len(found)))
    assert [r["line_no"] for r in found if r["file"].endswith("b.txt")] == [0, 1]
    multi = SL.scan_listing_multi(spark, [str(tmp_path / "c.gz"), str(tmp_path / "b.txt"), str(tmp_path / "a.md")])
    assert [r["value"] for r in multi.orderBy("pos").collect()] == ["x", "y", "first", "second"]
