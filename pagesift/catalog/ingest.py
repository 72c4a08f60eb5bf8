"""Sources, sinks, listings and what is left to do."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesift.catalog import duck as K
from pagesift.catalog import fixtures as X
from pagesift.catalog import quality as Q
from pagesift.functions import encoding as E
from pagesift.functions.hashing import md5_31
from pagesift.operators import listings as L
from pagesift.operators import models as ML
from pagesift.operators import stats as S
from pagesift.operators import urls as R
from pagesift.plans import extraction as P
from pagesift.session import materialize, new_path
from pagesift.sinks import writers as W
from pagesift.sources import listings as SL
from pagesift.sources import tasks as TK
from pagesift.sources import warc as WA
from pagesift.sources.tables import scan, scan_pages as read_pages
from pagesift.streaming.incremental import ingest_incremental as ingest

# ---- listings ----


def _write_listing(listing, path, form="gzip"):
    """Text files whose names sort like their lines."""
    ranged = listing.select("value").repartitionByRange("value").sortWithinPartitions("value")
    ranged.write.option("compression", form).text(path)


def scan_listing(spark, sf):
    """Compressed listings under a folder, beside files of another kind, read with positions."""
    root = new_path(spark, "listing")
    _write_listing(X.listing(spark, sf), f"{root}/lines")
    X.listing(spark, sf).select("dump").distinct().write.csv(f"{root}/other")
    return SL.scan_listing(spark, root, glob="*.txt.gz").select("pos", "value")


def scan_listing_multi(spark, sf):
    """Two listings in the order given, one of them compressed; a third kind is ignored."""
    root = new_path(spark, "listings")
    lines = X.listing(spark, sf)
    old = F.col("dump").startswith("CC-MAIN-2013")
    _write_listing(lines.where(old), f"{root}/old.txt", "none")
    _write_listing(lines.where(~old), f"{root}/new.gz")
    return SL.scan_listing_multi(spark, [f"{root}/new.gz", f"{root}/ignored.csv", f"{root}/old.txt"]).select("pos", "value")


def _numbered(spark, sf):
    """The listing in order of its lines; the dump is the bucket."""
    return L.number_rows(X.listing(spark, sf).select("dump", "value"), F.col("dump"), [F.col("value")]).select("pos", "value")


def limit_skip(spark, sf):
    """A window of lines out of the middle, the reader's two options."""
    return L.limit_skip(_numbered(spark, sf), limit=100, skip=50)


def split_consecutive(spark, sf):
    return L.split_consecutive(_numbered(spark, sf), L.STAGE_SPLITS["local_dedup"])


def split_round_robin(spark, sf):
    return L.split_round_robin(_numbered(spark, sf), L.STAGE_SPLITS["quality"])


def split_shuffled(spark, sf):
    lines = _numbered(spark, sf)
    both = L.split_listing(lines, L.STAGE_SPLITS["text"], shuffle=True, consecutive=True, seed=7)
    return L.split_round_robin(both.withColumnRenamed("split", "run"), L.STAGE_SPLITS["hashes"])


def sink_listing_splits(spark, sf):
    path = new_path(spark, "splits")
    W.sink_listing_splits(split_round_robin(spark, sf), path)
    return spark.read.schema("value string, split string").text(path).select("value", F.col("split").cast("string").alias("split"))


def _links(spark, sf):
    return X.listing(spark, sf).select(F.concat(F.lit("https://data.example.org/crawl-data/"), "dump", F.lit("/index.html")).alias("url")).distinct()


def dump_paths(spark, sf):
    return L.dump_paths(_links(spark, sf))


def _existing(spark, sf):
    """Dumps that are there already: those of the first archives of every host."""
    return X.listing(spark, sf).groupBy("dump").agg(F.min("page_id").alias("first")).where("first < 4").select("dump")


def dump_filter(spark, sf):
    old = spark.range(1).select(F.explode(F.array(*[F.lit(d) for d in L.UNSUPPORTED_DUMPS])).alias("dump"))
    dumps = L.dump_paths(_links(spark, sf)).select("dump").unionByName(old)
    return L.dump_filter(dumps, _existing(spark, sf))


def except_dumps(spark, sf):
    return L.except_dumps(X.listing(spark, sf).select("dump").distinct(), _existing(spark, sf))


def output_paths(spark, sf):
    return L.output_paths(X.listing(spark, sf).withColumnRenamed("value", "cc_path"))


def _finished(spark, sf):
    """Archives whose page passed the URL rules."""
    judged = R.url_disposition(read_pages(spark, sf).select("page_id", "url"), X.rules(spark, sf))
    done = judged.where(F.col("url_disposition") == R.KEPT).select("page_id")
    return X.listing(spark, sf).join(done, "page_id").select(F.col("value").alias("cc_path"))


def remaining_files(spark, sf):
    return L.remaining_files(X.listing(spark, sf).withColumnRenamed("value", "cc_path"), _finished(spark, sf))


def record_ordinal(spark, sf):
    pages = X.pages(spark, sf).select("page_id", R.U.host(F.col("url")).alias("cc_path"), F.col("page_id").alias("offset"))
    return L.record_ordinal(pages, span=100).select("page_id", "cc_path", "record_idx")


# ---- archives ----


def scan_pages(spark, sf):
    return read_pages(spark, sf)


def _write_archives(spark, sf):
    """All pages as archives, every page also with a request record."""
    path = new_path(spark, "archives")
    spark.dataSource.register(WA.WarcSource)
    second = F.col("page_id") % 86_400
    clock = F.format_string("T%02d:%02d:%02dZ", F.floor(second / 3600), F.floor(second / 60) % 60, second % 60)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("page_id") / 86_400).cast("int"))
    date = F.concat(day.cast("string"), clock)
    pages = X.pages(spark, sf).select(
        "url", date.alias("date"), F.lit("text/html").alias("content_type"), F.encode("html", "UTF-8").alias("body")
    )
    pages.write.format("warc").mode("append").save(path)
    return path


def _utc(ts, form):
    """Text of a time in UTC, whatever the time zone of the session is."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), form)


def scan_warc(spark, sf):
    """Archives written from the pages and read back: URL, time, decoded body."""
    records = P.decode_records(WA.scan_warc(spark, _write_archives(spark, sf)))
    return records.select("url", _utc("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.md5("html").alias("html_md5"))


def scan_warc_ordinals(spark, sf):
    """In every archive the response records are numbered from 0 without a gap; counted over all archives."""
    records = WA.scan_warc(spark, _write_archives(spark, sf))
    per_file = records.groupBy("cc_path").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("record_idx").alias("d"), F.max("record_idx").alias("last")
    )
    good = (F.col("n") == F.col("d")) & (F.col("last") == F.col("n") - 1)
    return per_file.agg(F.sum("n").alias("n_records"), F.count_if(~good).alias("n_bad_files"))


def _archive_listing(spark, sf):
    """Listing of written archives and, for every dump, one path that does not exist; with their folder."""
    path = _write_archives(spark, sf)
    names = WA.scan_warc(spark, path).select(F.element_at(F.split("cc_path", "/"), -1).alias("cc_path")).distinct()
    missing = X.listing(spark, sf).select(F.concat("dump", F.lit(".warc.gz")).alias("cc_path")).distinct()
    return names.unionByName(missing), path


def failed_ledger(spark, sf):
    listing, path = _archive_listing(spark, sf)
    return WA.failed_ledger(WA.scan_archives(listing, path)).select("cc_path")


def scan_archives(spark, sf):
    """Archives by listing: every record of those that can be read."""
    listing, path = _archive_listing(spark, sf)
    records = WA.scan_archives(listing, path).where(F.col("error").isNull())
    return records.select("url", "date", F.octet_length("body").alias("n_bytes"))


def decode_body(spark, sf):
    """Pages as bytes, every other one in Latin-1 where its characters allow, decoded again."""
    latin = (F.col("page_id") % 2 == 1) & F.col("html").rlike(r"^[\x{00}-\x{ff}]*$")
    body = F.when(latin, F.encode("html", "ISO-8859-1")).otherwise(F.encode("html", "UTF-8"))
    pages = X.pages(spark, sf).select("page_id", body.alias("body"))
    charset = E.declared_charset(F.col("body"))
    return pages.select("page_id", charset.alias("charset"), E.decode_body(F.col("body"), charset).alias("html"))


# ---- tasks ----


def _raw_tasks(spark, sf):
    """Every task's own fields, filled from the question and answer pairs."""
    words = F.split("q", " ")
    values = {
        "body": "q", "Body": "q", "question": "q", "Question": "a", "problem": "q", "input": "q",
        "answer": "a", "Answer": "a", "cot": F.reverse("a"), "solution": "a", "rationale": F.concat(F.lit('"'), "a", F.lit('"')),
        "target": "a", "options": F.reverse("q"),
    }
    out = {}
    for task, schema in TK.SCHEMAS.items():
        columns = []
        for name, kind in (field.strip().split(" ") for field in schema.split(",")):
            value = values[name]
            if kind == "double":
                value = F.length("a").cast("double")
            elif kind != "string":
                value = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.get(words, i))
            columns.append((F.col(value) if isinstance(value, str) else value).alias(name))
        out[task] = X.chat_pairs(spark, sf).select(*columns)
    return out


def task_projection(spark, sf):
    parts = [TK.task_projection(raw, task) for task, raw in _raw_tasks(spark, sf).items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("task", "query", F.explode("golds").alias("label"))


def scan_tasks(spark, sf):
    """The same through files: JSON lines of every task, read with its schema."""
    root = new_path(spark, "tasks")
    for task, raw in _raw_tasks(spark, sf).items():
        raw.write.json(f"{root}/{task}.jsonl")
    return TK.scan_tasks(spark, root).select("task", "query", F.explode("golds").alias("label"))


# ---- sinks ----


def _scored(spark, sf):
    """Documents as scored records: language as given, topic score from the length of the text."""
    docs = X.documents(spark, sf)
    return docs.select(
        "doc_id", "text", F.concat(F.lit("<p>"), "text", F.lit("</p>")).alias("html"), "lang",
        ((F.col("n_chars") % 100) / 100 + 0.3).alias("lang_score"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id")).alias("url"),
        F.lit("2024-01-01T00:00:00Z").alias("timestamp"),
        F.concat(F.lit("crawl-data/CC-MAIN-2024-"), F.lit(10) + F.col("doc_id") % 3, F.lit("/"), "source").alias("cc_path"),
        F.col("doc_id").alias("record_idx"),
        ((F.col("n_chars") % 10) / 10).alias("math_score"),
    ).withColumn("dump", L.dump_of(F.col("cc_path")))


def _read_back(spark, path):
    docs = W.from_records(spark.read.schema(W.RECORD_SCHEMA).json(path))
    return docs.select(
        F.md5("text").alias("text_md5"), "lang", "lang_score", "url", "timestamp", "cc_path", "record_idx", "math_score"
    )


def sink_english_text(spark, sf):
    path = new_path(spark, "english")
    W.sink_english_text(_scored(spark, sf), path)
    return _read_back(spark, path)


def sink_math_text(spark, sf):
    path = new_path(spark, "math-text")
    W.sink_math_text(_scored(spark, sf), path)
    return _read_back(spark, path)


def sink_math_html(spark, sf):
    path = new_path(spark, "math-html")
    W.sink_math_html(_scored(spark, sf), path)
    return _read_back(spark, path)


def sink_stats(spark, sf):
    """Counters appended twice, as two runs do, and read back."""
    path = new_path(spark, "stats")
    scored = _scored(spark, sf).withColumn("disposition", F.when(F.col("lang") == "en", S.REMAINING).otherwise(S.LANGUAGE_FILTERED))
    stats = S.funnel_stats(scored, [F.col("cc_path").alias("file_path")])
    W.sink_stats(stats, path)
    W.sink_stats(stats, path)
    schema = "file_path string, " + ", ".join(f"{c} long" for c in S.COUNTERS)
    return spark.read.schema(schema).option("header", True).csv(path)


def overwrite_policy(spark, sf):
    """Write all, write one language again with overwrite, then append it: one language is there twice."""
    path = new_path(spark, "policy")
    docs = X.documents(spark, sf).select("doc_id", "n_chars", "lang")
    again = docs.where("lang = 'en'")
    W.write_table(docs, path, ("lang",))
    W.write_table(again, path, ("lang",))
    W.write_table(again, path, ("lang",), overwrite=False)
    return spark.read.parquet(path).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


def excluded_writer(spark, sf):
    """Rejected pages are written by reason; kept and rejected ones together are all pages."""
    path = new_path(spark, "excluded")
    judged = R.url_disposition(read_pages(spark, sf).select("page_id", "url"), X.rules(spark, sf))
    kept = W.excluded_writer(judged.withColumnRenamed("url_disposition", "disposition"), path).select("page_id", F.lit("kept").alias("disposition"))
    rejected = spark.read.parquet(path).select("page_id", F.col("disposition").cast("string"))
    return kept.unionByName(rejected)


# ---- whole job ----


def extraction_job(spark, sf):
    """Archives to counters: URL rules, decoding, extraction, language, topic, per minute of the record's time."""
    records = WA.scan_warc(spark, _write_archives(spark, sf)).withColumn("cc_path", _utc("ts", "yyyy-MM-dd HH:mm"))
    records = records.withColumn("record_idx", F.unix_timestamp("ts"))
    return P.extract_job(records, X.rules(spark, sf), *_row_models(spark, sf), "1")[2]


def _row_models(spark, sf):
    """Models of hashed tokens; MD5 so that SQL can hash alike."""
    labels = scan(spark, sf, "labels").select("doc_id", "quality")
    topic = X.documents(spark, sf).join(labels, "doc_id")
    return ML.train_row_model(X.documents(spark, sf), "lang", hash_fn=md5_31), ML.train_row_model(topic, "quality", hash_fn=md5_31)


def extraction_outputs(spark, sf):
    """The job from a listing to its files: every record of the topic, read back from the output with HTML."""
    listing, root = _archive_listing(spark, sf)
    out = new_path(spark, "extraction")
    P.run_extraction(listing, root, out, X.rules(spark, sf), *_row_models(spark, sf), "1")
    docs = W.from_records(spark.read.schema(W.RECORD_SCHEMA).json(f"{out}/math_html"))
    return docs.select("url", "timestamp", "lang", F.round("lang_score", 6).alias("lang_score"), F.round("math_score", 6).alias("math_score"), F.md5("text").alias("html_md5"))


def reextract_join(spark, sf):
    """Surviving keys joined back to their HTML and extracted again."""
    pages = X.pages(spark, sf).withColumn("cc_path", R.U.host(F.col("url"))).withColumn("record_idx", F.col("page_id"))
    judged = R.url_disposition(pages.select("cc_path", "record_idx", "url"), X.rules(spark, sf))
    survivors = judged.where(F.col("url_disposition") == R.KEPT)
    return P.reextract(survivors, pages).select("page_id", "text")


def scan_warc_urls(spark, sf):
    """A scan of two columns with a pushed filter: URLs of secure hosts, no body."""
    records = WA.scan_warc(spark, _write_archives(spark, sf), ["url", "date"])
    return records.where(F.col("url").startswith("https://")).select("url", _utc("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


def archive_index(spark, sf):
    """Index of all records; each range read again gives the record."""
    listing, path = _archive_listing(spark, sf)
    index = materialize(WA.archive_index(listing, path), "archive-index")
    records = WA.fetch_records(index, path, stretch=1 << 16)
    return records.select("url", F.octet_length("body").alias("n_bytes"), F.md5("body").alias("body_md5"))


def reextract_by_range(spark, sf):
    """Keys that the URL rules keep, their records fetched by range and extracted again."""
    listing, path = _archive_listing(spark, sf)
    index = materialize(WA.archive_index(listing, path), "archive-index")
    judged = R.url_disposition(index.where("error is null").select("cc_path", "record_idx", "url"), X.rules(spark, sf))
    return P.reextract_by_range(judged.where(F.col("url_disposition") == R.KEPT), index, path).select("url", "text")


def ingest_incremental(spark, sf):
    """Files arrive in two lots and are ingested in three runs; each row counts once."""
    source, target, state = (new_path(spark, name) for name in ("arrivals", "ingested", "state"))
    docs = X.documents(spark, sf).select("doc_id", "lang", "n_chars")
    schema = docs.schema
    late = F.col("lang").isin("de", "es")
    docs.where(~late).write.mode("append").parquet(source)
    ingest(spark, source, target, state, schema)
    docs.where(late).write.mode("append").parquet(source)
    ingest(spark, source, target, state, schema)
    ingest(spark, source, target, state, schema)
    return spark.read.schema(schema).parquet(target)


QUERIES = {
    f.__name__: f
    for f in (
        scan_listing, scan_listing_multi, scan_warc, scan_warc_urls, archive_index, reextract_by_range, scan_warc_ordinals, scan_archives, scan_pages, decode_body,
        scan_tasks, task_projection, limit_skip, split_consecutive, split_round_robin, split_shuffled,
        sink_listing_splits, dump_paths, dump_filter, except_dumps, output_paths, remaining_files, record_ordinal,
        failed_ledger, sink_english_text, sink_math_text, sink_math_html, sink_stats, overwrite_policy,
        excluded_writer, extraction_job, extraction_outputs, reextract_join, ingest_incremental,
    )
}

# ---- SQL ----

_L = f"WITH {X.LISTING}"
_POS = f"{_L}, numbered AS (SELECT row_number() OVER (ORDER BY value) - 1 AS pos, value FROM listing)"
_EXISTING = "existing AS (SELECT dump FROM listing GROUP BY dump HAVING min(page_id) < 4)"
_KEY = "md5('7:' || value || '#' || pos)"
_RAW_SQL = (
    ("asdiv", "q", "a"),
    ("gsm8k", "q", "reverse(a) || ' ' || a"),
    ("math", "q", "a"),
    ("mathqa", "q || ' ' || reverse(q)", "a"),
    ("mawps", "q", "a"),
    ("mmlu_stem", "q", "'A: ' || coalesce(w[1], 'None') || ' B: ' || coalesce(w[2], 'None') || ' C: ' || coalesce(w[3], 'None') || ' D: ' || coalesce(w[4], 'None') || ' Answer: ' || a"),
    ("ocw", "q", "a || ' ' || a"),
    ("sat", "q", "reverse(q) || ' ' || a"),
    ("svamp", "q || ' ' || a", "a"),
    ("aime24", "q", "a"),
    ("aime25", "q", "a"),
    ("amc", "q", "length(a) || '.0'"),
)
_TASKS = f"WITH {X.PAIRS}, cw AS (SELECT q, a, string_split(q, ' ') AS w FROM chat) " + " UNION ALL ".join(
    f"SELECT '{task}' AS task, {query} AS query, {label} AS label FROM cw" for task, query, label in _RAW_SQL
)
_DOCS = (
    "scored AS (SELECT doc_id, text, '<p>' || text || '</p>' AS html, lang, (n_chars % 100) / 100 + 0.3 AS lang_score, "
    "'https://example.org/' || doc_id AS url, '2024-01-01T00:00:00Z' AS timestamp, "
    "'crawl-data/CC-MAIN-2024-' || (10 + doc_id % 3) || '/' || source AS cc_path, doc_id AS record_idx, (n_chars % 10) / 10 AS math_score FROM documents)"
)
_RECORD = "lang, lang_score, url, timestamp, cc_path, record_idx, math_score FROM scored WHERE lang = 'en' AND lang_score >= 0.65"
_STATS = (
    "SELECT cc_path AS file_path, count(*) AS doc_input, 0::BIGINT AS url_filtered, 0::BIGINT AS html_content_empty, "
    "0::BIGINT AS html_decoding_failed, 0::BIGINT AS doc_extraction_failed, 0::BIGINT AS doc_extraction_empty, "
    "count(*) FILTER (lang <> 'en') AS language_filtered, count(*) FILTER (lang = 'en' AND math_score >= 0.8) AS math_retained, "
    "count(*) FILTER (lang = 'en') AS doc_remaining FROM scored GROUP BY cc_path"
)

_HASHED = f"list_transform({K.words('text')}, lambda t_: ({K.md5_31('t_')} % {ML.FEATURES})::VARCHAR)"
_JOB = (
    f"{X.JUDGED}, {K.extract_text_ctes('pages', 'page_id')}, "
    "page_texts AS (SELECT page_id AS doc_id, text FROM extracted JOIN judged USING (page_id) WHERE url_disposition = 'kept' AND text <> ''), "
    f"{Q.model_ctes('documents', 'lang', 'l_', _HASHED)}, {Q.score_ctes('page_texts', 'l_', _HASHED)}, "
    "langs AS (SELECT doc_id, max_by(label, round(score, 9) + 1e-12 * ascii(label)) AS lang, max(score) AS lang_score FROM l_scores GROUP BY doc_id), "
    "english AS (SELECT page_texts.* FROM page_texts JOIN langs USING (doc_id) WHERE lang = 'en' AND lang_score >= 0.65), "
    "labelled AS (SELECT documents.*, quality FROM documents JOIN labels USING (doc_id)), "
    f"{Q.model_ctes('labelled', 'quality', 'm_', _HASHED)}, {Q.score_ctes('english', 'm_', _HASHED)}, "
    "math AS (SELECT doc_id, max(score) AS math_score FROM m_scores WHERE label = '1' GROUP BY doc_id)"
)

SQL = {
    "scan_listing": f"{_POS} SELECT pos, value FROM numbered",
    "scan_listing_multi": f"{_L} SELECT row_number() OVER (ORDER BY dump LIKE 'CC-MAIN-2013%', value) - 1 AS pos, value FROM listing",
    "scan_warc": "SELECT url, strftime(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS ts, md5(html) AS html_md5 FROM pages",
    "scan_warc_ordinals": "SELECT count(*) AS n_records, 0::BIGINT AS n_bad_files FROM pages",
    "scan_warc_urls": "SELECT url, strftime(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S') AS ts FROM pages "
    "WHERE starts_with(url, 'https://')",
    "archive_index": "SELECT url, strlen(html) AS n_bytes, md5(html) AS body_md5 FROM pages",
    "reextract_by_range": f"WITH {X.JUDGED}, {K.extract_text_ctes('pages', 'page_id')} "
    "SELECT judged.url, text FROM extracted JOIN judged USING (page_id) WHERE url_disposition = 'kept'",
    "scan_archives": "SELECT url, strftime(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%SZ') AS date, strlen(html) AS n_bytes FROM pages",
    "scan_pages": "SELECT page_id, url, html FROM pages",
    "decode_body": "SELECT page_id, 'utf-8' AS charset, html FROM pages",
    "scan_tasks": _TASKS,
    "task_projection": _TASKS,
    "limit_skip": f"{_POS} SELECT pos, value FROM numbered WHERE pos >= 50 AND pos < 150",
    "split_consecutive": f"{_POS} SELECT pos, value, ntile(70) OVER (ORDER BY pos) - 1 AS split FROM numbered",
    "split_round_robin": f"{_POS} SELECT pos, value, pos % 20 AS split FROM numbered",
    "split_shuffled": f"{_POS}, sh AS (SELECT value, row_number() OVER (ORDER BY {_KEY}) - 1 AS pos FROM numbered) "
    "SELECT pos, value, ntile(200) OVER (ORDER BY pos) - 1 AS run, pos % 20 AS split FROM sh",
    "sink_listing_splits": f"{_POS} SELECT value, lpad((pos % 20)::VARCHAR, 3, '0') AS split FROM numbered",
    "dump_paths": f"{_L} SELECT DISTINCT 'https://data.example.org/crawl-data/' || dump || '/index.html' AS url, dump, "
    "'https://data.example.org/crawl-data/' || dump || '/warc.paths.gz' AS listing_url FROM listing",
    "dump_filter": f"{_L}, {_EXISTING} SELECT DISTINCT dump FROM listing WHERE dump NOT IN (SELECT dump FROM existing)",
    "except_dumps": f"{_L}, {_EXISTING} SELECT DISTINCT dump FROM listing WHERE dump NOT IN (SELECT dump FROM existing)",
    "output_paths": f"{_L}, o AS (SELECT value AS cc_path, replace(value, '.gz', '.jsonl.gz') AS p FROM listing) SELECT cc_path, "
    "replace(replace(p, 'crawl-data', 'extracted'), 'segments', 'segments_en') AS en_text_path, "
    "replace(replace(p, 'crawl-data', 'math'), 'segments', 'segments_en') AS math_text_path, "
    "replace(replace(p, 'crawl-data', 'math'), 'segments', 'html_en') AS math_html_path FROM o",
    "remaining_files": f"WITH {X.JUDGED}, {X.LISTING} SELECT value AS cc_path FROM listing WHERE value NOT IN "
    "(SELECT value FROM listing JOIN judged USING (page_id) WHERE url_disposition = 'kept')",
    "record_ordinal": f"SELECT page_id, {K.host('url')} AS cc_path, row_number() OVER (PARTITION BY {K.host('url')} ORDER BY page_id) - 1 AS record_idx FROM pages",
    "failed_ledger": f"{_L} SELECT DISTINCT dump || '.warc.gz' AS cc_path FROM listing",
    "sink_english_text": f"WITH {_DOCS} SELECT md5(text) AS text_md5, {_RECORD}",
    "sink_math_text": f"WITH {_DOCS} SELECT md5(text) AS text_md5, {_RECORD} AND math_score >= 0.5",
    "sink_math_html": f"WITH {_DOCS} SELECT md5(html) AS text_md5, {_RECORD} AND math_score >= 0.5",
    "sink_stats": f"WITH {_DOCS}, st AS ({_STATS}) SELECT * FROM st UNION ALL SELECT * FROM st",
    "overwrite_policy": "SELECT lang, count(*) * CASE WHEN lang = 'en' THEN 2 ELSE 1 END AS n, "
    "(sum(n_chars) * CASE WHEN lang = 'en' THEN 2 ELSE 1 END)::BIGINT AS chars FROM documents GROUP BY lang",
    "excluded_writer": f"WITH {X.JUDGED} SELECT page_id, url_disposition AS disposition FROM judged",
    "extraction_job": f"WITH {_JOB}, "
    "steps AS (SELECT strftime(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M') AS file_path, math_score, "
    "CASE WHEN url_disposition <> 'kept' THEN 'url_filtered' WHEN e.text = '' THEN 'doc_extraction_empty' "
    "WHEN english.doc_id IS NULL THEN 'language_filtered' ELSE 'doc_remaining' END AS disposition FROM judged JOIN extracted e USING (page_id) "
    "LEFT JOIN english ON english.doc_id = page_id LEFT JOIN math ON math.doc_id = page_id) "
    "SELECT file_path, count(*) AS doc_input, " + ", ".join(f"count(*) FILTER (disposition = '{c}') AS {c}" for c in S.DROP_CLASSES)
    + ", count(*) FILTER (disposition = 'doc_remaining' AND math_score >= 0.8) AS math_retained, "
    "count(*) FILTER (disposition = 'doc_remaining') AS doc_remaining FROM steps GROUP BY file_path",
    "extraction_outputs": f"WITH {_JOB} SELECT url, strftime(TIMESTAMP '2024-01-01' + page_id * INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%SZ') AS timestamp, "
    "'en' AS lang, round(lang_score, 6) AS lang_score, round(math_score, 6) AS math_score, md5(html) AS html_md5 "
    "FROM pages JOIN english ON english.doc_id = page_id JOIN langs USING (doc_id) JOIN math USING (doc_id) WHERE math_score >= 0.5",
    "reextract_join": f"WITH {X.JUDGED}, {K.extract_text_ctes('pages', 'page_id')} "
    "SELECT page_id, text FROM extracted JOIN judged USING (page_id) WHERE url_disposition = 'kept'",
    "ingest_incremental": "SELECT doc_id, lang, n_chars FROM documents",
}
