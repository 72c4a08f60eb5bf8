"""URL rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesift.catalog import duck as K
from pagesift.catalog import fixtures as X
from pagesift.functions import urls as U
from pagesift.operators import suffixes as SX
from pagesift.operators import urls as R
from pagesift.session import new_path
from pagesift.sources import lists as L


def _parts(spark, sf):
    return R.url_parts(X.pages(spark, sf).select("page_id", "url"))


def url_parts(spark, sf):
    return _parts(spark, sf).select("page_id", "host", "registered_domain", "fqdn")


def url_normalize(spark, sf):
    return X.pages(spark, sf).select("page_id", U.normalized(F.col("url")).alias("normalized"))


def _list(spark, sf, name):
    return X.url_entries(spark, sf).where(F.col("category") == name)


def url_whitelist(spark, sf):
    return R.url_whitelist(_parts(spark, sf), _list(spark, sf, "allow")).select("page_id", "allowed")


def url_curated(spark, sf):
    return R.url_curated(_parts(spark, sf), _list(spark, sf, "curated")).select("page_id", "curated")


def url_blocklist(spark, sf):
    return R.url_blocklist(_parts(spark, sf), _list(spark, sf, "block")).select("page_id", "blocked")


def url_suffixes(spark, sf):
    """Registered domains by a suffix table with wildcards and exceptions."""
    trie = SX.suffix_trie(spark.createDataFrame([(r,) for r in X.SUFFIX_RULES], "rule string"))
    return R.url_parts(X.suffix_hosts(spark, sf), trie).select("page_id", "host", "registered_domain")


def url_curated_by(spark, sf):
    """The entry that makes a page a curated source; entries are prefixes of the pages' own paths, of any depth."""
    pages = X.pages(spark, sf).select("page_id", "url")
    return R.url_curated(R.url_parts(pages), _path_entries(pages)).select("page_id", "curated_by")


def _path_entries(pages):
    path = R.url_path(F.col("url"), U.host(F.col("url")))
    cut = F.expr("substring_index(path, '/', cast(page_id % 4 + 2 as int))")
    return pages.where("page_id % 5 < 2").withColumn("path", path).select(F.lit("curated").alias("category"), F.lit("domain").alias("kind"), cut.alias("value")).distinct()


def url_bad_words(spark, sf):
    reason = R.bad_words(F.col("url"), *[X.word_entries(spark, w) for w in (X.STRICT_WORDS, X.HARD_WORDS, X.SOFT_WORDS)])
    return X.pages(spark, sf).select("page_id", reason.alias("reason"))


def url_disposition(spark, sf):
    return R.url_disposition(X.pages(spark, sf).select("page_id", "url"), X.rules(spark, sf)).select(
        "page_id", "url_disposition"
    )


def join_url_lists(spark, sf):
    lists = {name: _list(spark, sf, name) for name in ("allow", "block")}
    return R.join_url_lists(_parts(spark, sf), **lists).select(
        "page_id", "domain_allow", "host_allow", "url_allow", "domain_block", "host_block", "url_block"
    )


def union_lists(spark, sf):
    extra = [("allow", "domain", "example.edu"), ("block", "word", "casino")]
    return L.union_lists(*[_list(spark, sf, n) for n in ("allow", "curated", "block")], extra=extra)


def scan_lists(spark, sf):
    """Write the entries as list files with comments and marker lines, then read them back."""
    root = new_path(spark, "lists")
    entries = X.url_entries(spark, sf)
    noise = [("# a comment",), ("<<<<<<< HEAD",), ("size 342",), ("  ",)]
    for category in ("allow", "curated", "block"):
        for file, kind in L.KINDS.items():
            rows = entries.where((F.col("category") == category) & (F.col("kind") == kind)).select("value")
            rows.union(spark.createDataFrame(noise, "value string")).write.text(f"{root}/{category}/{file}")
        spark.createDataFrame([("black",)], "value string").write.text(f"{root}/{category}/usage")
    return L.scan_lists(spark, root)


def url_rule_report(spark, sf):
    """Pages per rule and registered domain."""
    judged = R.url_disposition(_parts(spark, sf).select("page_id", "url", "registered_domain"), X.rules(spark, sf))
    return judged.groupBy("registered_domain", "url_disposition").agg(F.count(F.lit(1)).alias("n_pages"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_lists, url_parts, url_normalize, url_whitelist, url_curated, url_blocklist, url_bad_words,
        url_disposition, join_url_lists, union_lists, url_rule_report, url_suffixes, url_curated_by,
    )
}

_WITH = f"WITH {X.ENTRIES}, {X.PARTS} "
SQL = {
    "scan_lists": f"WITH {X.ENTRIES} SELECT category, kind, value FROM entries",
    "url_parts": f"{_WITH} SELECT page_id, host, rd AS registered_domain, {X.FQDN} AS fqdn FROM parts",
    "url_normalize": "SELECT page_id, lower(regexp_replace(url, '[^a-zA-Z0-9]+', '', 'g')) AS normalized FROM pages",
    "url_whitelist": f"{_WITH} SELECT page_id, {X.ALLOWED_SQL} AS allowed FROM parts",
    "url_curated": f"{_WITH} SELECT page_id, {X.CURATED_SQL} AS curated FROM parts",
    "url_blocklist": f"{_WITH} SELECT page_id, {X.BLOCKED_SQL} AS blocked FROM parts",
    "url_suffixes": "WITH rule AS (SELECT unnest(["
    + ", ".join(K.q(r) for r in X.SUFFIX_RULES)
    + "]) AS rule), form AS (SELECT ["
    + ", ".join(K.q(h) for h in X.SUFFIX_HOSTS)
    + f"] AS f), named AS (SELECT page_id, replace(f[page_id % {len(X.SUFFIX_HOSTS)} + 1], '%s', regexp_replace({K.host('url')}, '[^a-z]', '', 'g')) AS host "
    "FROM pages, form), labels_ AS (SELECT page_id, host, string_split(host, '.') AS l FROM named), "
    "tails AS (SELECT page_id, k, array_to_string(l[len(l) - k + 1:], '.') AS tail, array_to_string(l[len(l) - k + 2:], '.') AS rest "
    "FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS k FROM labels_)), "
    "best AS (SELECT page_id, coalesce(max(k - 1) FILTER (rule = '!' || tail), max(k) FILTER (rule <> '!' || tail)) AS n "
    "FROM tails JOIN rule ON rule = tail OR rule = '!' || tail OR (k > 1 AND rule = '*.' || rest) GROUP BY page_id) "
    "SELECT page_id, host, CASE WHEN len(l) > coalesce(n, 1) THEN array_to_string(l[len(l) - coalesce(n, 1):], '.') END AS registered_domain "
    "FROM labels_ LEFT JOIN best USING (page_id)",
    "url_curated_by": "WITH bare AS (SELECT page_id, string_split(regexp_replace(regexp_replace(url, '[?#].*$', ''), "
    "'^[a-zA-Z][a-zA-Z0-9+.-]*://', ''), '/') AS l FROM pages), "
    "entry AS (SELECT DISTINCT rtrim(array_to_string(l[1 : page_id % 4 + 2], '/'), '/') AS value FROM bare WHERE page_id % 5 < 2), "
    "cut AS (SELECT page_id, array_to_string(l[1 : k], '/') AS value, k FROM (SELECT page_id, l, unnest(range(1, len(l) + 1)) AS k FROM bare)) "
    "SELECT page_id, max_by(value, k) FILTER (entry.value IS NOT NULL) AS curated_by FROM cut LEFT JOIN entry USING (value) GROUP BY page_id",
    "url_bad_words": f"SELECT page_id, {X.BAD_WORD_SQL} AS reason FROM pages",
    "url_disposition": f"WITH {X.JUDGED} SELECT page_id, url_disposition FROM judged",
    "join_url_lists": f"{_WITH} SELECT page_id, "
    + ", ".join(
        f"{X.member(col, name, kind)} AS {part}_{name}"
        for name in ("allow", "block")
        for part, col, kind in (("domain", "rd", "domain"), ("host", X.FQDN, "domain"), ("url", "url", "url"))
    )
    + " FROM parts",
    "union_lists": f"WITH {X.ENTRIES} SELECT category, kind, value FROM entries UNION "
    "SELECT 'allow', 'domain', 'example.edu' UNION SELECT 'block', 'word', 'casino'",
    "url_rule_report": f"WITH {X.JUDGED} SELECT {K.registered_domain('host')} AS registered_domain, url_disposition, "
    "count(*) AS n_pages FROM judged GROUP BY ALL",
}
