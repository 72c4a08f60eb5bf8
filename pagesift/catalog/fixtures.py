"""Inputs derived from the test tables, once in Spark and once in SQL.

Every derivation keeps all rows of its table, so the work of a query grows with
the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.catalog import duck as K
from pagesift.functions import urls as U
from pagesift.operators.urls import UrlRules
from pagesift.sources.tables import scan, scan_documents, scan_pages

# ---- listing: one archive path per page ----


def listing(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("page_id").cast("string")
    dump = F.format_string("CC-MAIN-%d-%02d", 2013 + F.col("page_id") % 3, 10 + 5 * (F.col("page_id") % 4))
    path = F.concat(
        F.lit("crawl-data/"), dump, F.lit("/segments/"), p, F.lit("/warc/CC-MAIN-"), F.lpad(p, 8, "0"), F.lit(".warc.gz")
    )
    return scan(spark, sf, "pages").select("page_id", dump.alias("dump"), path.alias("value"))


LISTING = (
    "listing AS (SELECT page_id, dump, 'crawl-data/' || dump || '/segments/' || page_id || '/warc/CC-MAIN-' || "
    "lpad(page_id::VARCHAR, 8, '0') || '.warc.gz' AS value FROM (SELECT page_id, 'CC-MAIN-' || (2013 + page_id % 3) "
    "|| '-' || lpad((10 + 5 * (page_id % 4))::VARCHAR, 2, '0') AS dump FROM pages))"
)

# ---- URL lists: hosts and URLs of the pages ----

STRICT_WORDS = ("pills", "adult")
HARD_WORDS = ("farm", "bets")
SOFT_WORDS = ("ref", "page", "fr", "de", "utm")


def word_entries(spark: SparkSession, words: tuple[str, ...]) -> DataFrame:
    """A word list as list entries."""
    return spark.createDataFrame([("words", "word", w) for w in words], "category string, kind string, value string")


#: Rules of a small suffix table, in the public list's format, and hosts made of a name under them.
SUFFIX_RULES = ("com", "id", "co.id", "vn", "com.vn", "*.ck", "!www.ck", "io", "github.io", "*.compute.example", "jp", "*.kobe.jp", "!city.kobe.jp")
SUFFIX_HOSTS = (
    "www.%s.co.id", "%s.com.vn", "a.b.%s.vn", "shop.%s.ck", "%s.ck", "a.www.ck", "www.ck", "blog.%s.github.io", "github.io",
    "x.%s.eu.compute.example", "%s.compute.example", "a.%s.kobe.jp", "a.city.kobe.jp", "%s.unlisted", "%s", "co.id",
)


def suffix_hosts(spark: SparkSession, sf: str) -> DataFrame:
    """A URL for every page: its host's letters as a name under each kind of suffix in turn."""
    pages = scan(spark, sf, "pages").select("page_id", F.regexp_replace(U.host(F.col("url")), "[^a-z]", "").alias("name"))
    form = F.element_at(F.array(*[F.lit(x) for x in SUFFIX_HOSTS]), (F.col("page_id") % len(SUFFIX_HOSTS) + 1).cast("int"))
    return pages.select("page_id", F.concat(F.lit("https://"), F.replace(form, F.lit("%s"), F.col("name")), F.lit("/x")).alias("url"))


def url_entries(spark: SparkSession, sf: str) -> DataFrame:
    """List entries ``(category, kind, value)`` taken from the pages' own hosts and URLs."""
    pages = scan(spark, sf, "pages").select("url", U.host(F.col("url")).alias("host"))
    return pages.select(F.explode(entry_array()).alias("e")).select("e.*").where("category is not null").distinct()


def entry_array() -> Column:
    host, url = F.col("host"), F.col("url")

    def entry(test: Column, category: str, kind: str, value: Column) -> Column:
        return F.struct(
            F.when(test, category).alias("category"), F.lit(kind).alias("kind"), value.alias("value")
        )

    return F.array(
        entry(host.startswith("blog."), "allow", "domain", host),
        entry(url.endswith("#top"), "allow", "url", url),
        entry(host.startswith("m."), "curated", "domain", host),
        entry(host.startswith("thther"), "curated", "domain", F.concat(host, F.lit("/en"))),
        entry(host.rlike("pills|bets"), "block", "domain", host),
        entry(host.rlike("^www.*net$"), "block", "domain", F.substring_index(host, ".", -2)),
        entry(url.contains("page=2"), "block", "url", url),
    )


ENTRIES = (
    f"hosts AS (SELECT page_id, url, {K.host('url')} AS host FROM pages), "
    "entries AS ("
    "SELECT 'allow' AS category, 'domain' AS kind, host AS value FROM hosts WHERE host LIKE 'blog.%' "
    "UNION SELECT 'allow', 'url', url FROM hosts WHERE url LIKE '%#top' "
    "UNION SELECT 'curated', 'domain', host FROM hosts WHERE host LIKE 'm.%' "
    "UNION SELECT 'curated', 'domain', host || '/en' FROM hosts WHERE host LIKE 'thther%' "
    "UNION SELECT 'block', 'domain', host FROM hosts WHERE regexp_matches(host, 'pills|bets') "
    "UNION SELECT 'block', 'domain', regexp_extract(host, '[^.]+[.][^.]+$') FROM hosts WHERE regexp_matches(host, '^www.*net$') "
    "UNION SELECT 'block', 'url', url FROM hosts WHERE url LIKE '%page=2%')"
)

PARTS = f"parts AS (SELECT page_id, url, host, {K.registered_domain('host')} AS rd FROM hosts)"


def rules(spark: SparkSession, sf: str) -> UrlRules:
    entries = url_entries(spark, sf)
    pick = lambda name: entries.where(F.col("category") == name)
    return UrlRules(
        allow=pick("allow"), curated=pick("curated"), block=pick("block"),
        strict_words=STRICT_WORDS, hard_words=HARD_WORDS, soft_words=SOFT_WORDS,
    )


def in_list(words: tuple[str, ...]) -> str:
    return "(" + ", ".join(K.q(w) for w in words) + ")"


def url_words_sql(url: str) -> str:
    return f"list_filter(string_split_regex(lower({url}), '[^a-z0-9]+'), lambda w_: w_ <> '')"


BAD_WORD_SQL = (
    f"CASE WHEN len(list_filter({url_words_sql('url')}, lambda x_: x_ IN {in_list(HARD_WORDS)})) > 0 THEN 'hard_word' "
    f"WHEN len(list_distinct(list_filter({url_words_sql('url')}, lambda x_: x_ IN {in_list(SOFT_WORDS)}))) >= 2 THEN 'soft_words' "
    f"WHEN regexp_matches(regexp_replace(lower(url), '[^a-z0-9]+', '', 'g'), '{'|'.join(STRICT_WORDS)}') THEN 'strict_word' END"
)

_IN = "IN (SELECT value FROM entries WHERE category = '{c}' AND kind = '{k}')"


def member(column: str, category: str, kind: str) -> str:
    return f"coalesce({column} {_IN.format(c=category, k=kind)}, false)"


FQDN = "CASE WHEN rd IS NOT NULL THEN host END"
ALLOWED_SQL = f"({member('rd', 'allow', 'domain')} OR {member(FQDN, 'allow', 'domain')} OR {member('url', 'allow', 'url')})"
CURATED_SQL = (
    f"({member('rd', 'curated', 'domain')} OR {member(FQDN, 'curated', 'domain')} OR "
    "coalesce(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), "
    "'^[^/]*/[^/]*') IN (SELECT value FROM entries WHERE category = 'curated' AND contains(value, '/')), false))"
)
BLOCKED_SQL = (
    f"CASE WHEN {member('rd', 'block', 'domain')} THEN 'domain' WHEN {member(FQDN, 'block', 'domain')} THEN 'subdomain' "
    f"WHEN {member('url', 'block', 'url')} THEN 'url' END"
)
DISPOSITION_SQL = (
    f"CASE WHEN url IS NULL OR {ALLOWED_SQL} THEN 'kept' WHEN {CURATED_SQL} THEN 'curated' "
    f"ELSE coalesce({BLOCKED_SQL}, {BAD_WORD_SQL}, 'kept') END"
)
JUDGED = f"{ENTRIES}, {PARTS}, judged AS (SELECT page_id, url, host, {DISPOSITION_SQL} AS url_disposition FROM parts)"

# ---- evaluation items: a benchmark text cut into query and label ----


def benchmark_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Rows ``(task, query, golds)``; task names with and without a group."""
    item = F.col("item_id")
    words = F.split("text", " ")
    half = F.floor(F.size(words) / 2).cast("int")
    task = (
        F.when(item % 4 == 0, F.lit("plain task"))
        .otherwise(F.format_string("suite%d:task%d", item % 2, item % 3))
    )
    base = scan(spark, sf, "benchmark").select(
        "item_id",
        task.alias("task"),
        F.array_join(F.slice(words, F.lit(1), half), " ").alias("query"),
        F.array_join(F.slice(words, half + 1, F.size(words)), " ").alias("label"),
    )
    # Some items have two accepted answers.
    golds = F.when(item % 5 == 0, F.array("label", F.concat(F.lit("so "), "label"))).otherwise(F.array("label"))
    return base.select("item_id", "task", "query", golds.alias("golds"))


TASKS = (
    "tasks AS (SELECT item_id, CASE WHEN item_id % 4 = 0 THEN 'plain task' ELSE 'suite' || (item_id % 2) || ':task' || "
    "(item_id % 3) END AS task, array_to_string(w[1:(len(w) // 2)], ' ') AS query, "
    "array_to_string(w[(len(w) // 2) + 1:], ' ') AS label FROM (SELECT item_id, string_split(text, ' ') AS w FROM benchmark)), "
    "pairs AS (SELECT item_id, task, query, label FROM tasks UNION ALL "
    "SELECT item_id, task, query, 'so ' || label FROM tasks WHERE item_id % 5 = 0), "
    f"pair_tokens AS (SELECT task, {K.words('query')} AS q, {K.words('label')} AS a FROM pairs)"
)


def index_ctes(n: int, query: bool = False) -> str:
    parts = f"SELECT task, unnest({K.ngrams('a', n)}) AS gram FROM pair_tokens UNION SELECT task, unnest({K.overlap('q', 'a', n)}) FROM pair_tokens"
    if query:
        parts += f" UNION SELECT task, unnest({K.ngrams('q', n)}) FROM pair_tokens"
    return f"{TASKS}, idx AS (SELECT DISTINCT task, gram FROM ({parts}))"


# ---- question and answer pairs of the conversations ----


def chat_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """A user turn with the assistant turn right after it."""
    turns = scan(spark, sf, "conversations")
    users = turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("q"))
    answers = turns.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("a"))
    return users.join(answers, ["conv_id", "turn"])


PAIRS = (
    "chat AS (SELECT u.conv_id, u.turn, u.text AS q, x.text AS a FROM conversations u JOIN conversations x "
    "ON u.conv_id = x.conv_id AND x.turn = u.turn + 1 AND u.role = 'user' AND x.role = 'assistant')"
)

# ---- pages with tables and formulas, one per part ----

def markup_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One page per part with a table, formulas and sub- and superscripts; the shape varies with the key."""
    return scan(spark, sf, "part", "p_partkey").selectExpr("p_partkey AS page_id", f"{_markup()} AS html")


def _markup() -> str:
    """SQL expression that both engines read alike."""
    table = (
        "CASE p_partkey % 6 "
        "WHEN 0 THEN concat('<table class=\"t\"><tr><th>Name</th><th>Brand</th><th>Size</th></tr><tr><td> ', p_name, ' </td><td>', p_brand, '</td><td>', p_size, '</td></tr><tr><td>', p_type, '</td><td>a&amp;b</td><td>&lt;', p_partkey, '&gt;</td></tr></table>') "
        "WHEN 1 THEN concat('<table><tr><td>', p_name, '</td><td>', p_brand, '\n(', p_size, ')</td></tr><tr><td> </td><td></td></tr></table>') "
        "WHEN 2 THEN concat('<TABLE border=1><TR><TH>Key</TH><TH>Type</TH></TR><TR><TD>', p_partkey, '</TD></TR><TR><TD>', p_type, '</TD><TD>x</TD></TR></TABLE>') "
        "WHEN 3 THEN concat('<table><tr><th>Outer</th></tr><tr><td><table><tr><td>', p_name, '</td></tr></table></td></tr></table>') "
        "WHEN 4 THEN concat('<table><tr><th>A</th><th>B</th></tr><tr><td>', p_name, '\n', p_type, '</td><td>', p_size, '</td></tr></table> between <table><tr><th>C</th><th>C</th></tr><tr><td>1</td><td>2</td></tr></table>') "
        "ELSE '' END"
    )
    formula = (
        "CASE p_partkey % 5 "
        "WHEN 0 THEN concat('<math alttext=\"y_', p_size, '\"><semantics><mrow><mi>x</mi></mrow><annotation encoding=\"application/x-tex\">{\\\\displaystyle x^', p_size, '&lt;y}</annotation></semantics></math>') "
        "WHEN 1 THEN concat('<math display=\"block\" alttext=\" k_', p_size, ' &gt; 1 \"><mi>k</mi></math>') "
        "WHEN 2 THEN concat('<math><mfrac><mi>α</mi><mn>', p_size, '</mn></mfrac><mo>⋯</mo><msup><mi>ℝ</mi><mn>2</mn></msup></math>') "
        "WHEN 3 THEN concat('<span class=\"katex\"><span class=\"katex-mathml\"><math><semantics><mrow><mi>z</mi></mrow><annotation encoding=\"application/x-tex\">z_', p_size, '</annotation></semantics></math></span><span class=\"katex-html\">z</span></span>') "
        "ELSE concat('<!--[if mathML]><mml:math xmlns:mml=\"http://www.w3.org/1998/Math/MathML\"><mml:mi>f</mml:mi><mml:mn>', p_size, '</mml:mn></mml:math><![endif]-->') END"
    )
    rest = (
        "concat('<p>m<sup>', p_size, '</sup> H<sub>2</sub>O <sup>^{', p_size, '}</sup> "
        "<span class=\"intbl\"><em>', p_size, '</em><strong>', p_partkey, '</strong></span> &#945;&#x3B2; end</p>')"
    )
    return f"concat('<html><head><title>', p_name, '</title></head><body><h1>', p_name, '</h1>', {table}, ' tail ', {formula}, {rest}, '</body></html>')"


def markup_sql() -> str:
    # In Spark SQL a backslash in a literal is written twice, and \n is an escape.
    return "markup AS (SELECT p_partkey AS page_id, " + _markup().replace("\\\\", "\\") + " AS html FROM part)"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return scan_documents(spark, sf)


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return scan_pages(spark, sf)
