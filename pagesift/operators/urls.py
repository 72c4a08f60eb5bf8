"""URL rules: white list, curated sources, block lists, bad words.

Lists are tables ``(category, kind, value)`` with kind ``domain``, ``url`` or ``word``.
Each rule adds columns; ``url_disposition`` takes the ordered decision.

Lists that fit in a broadcast are looked up in the row. Beyond that the rows are written once, and
only their distinct URLs go on: each one is expanded into all that a list may name (domain, host,
URL, prefixes of its path), one equi-join finds the entries, and one verdict for each URL that has
any comes back to the rows by place (``operators.places``). So the scan below runs once, and no
body is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.functions import urls as U
from pagesift.operators.joins import count_keys, lookup_join, row_bytes, salted_join, table_bytes
from pagesift.operators.places import PLACE, attached, placed
from pagesift.operators.suffixes import SuffixTrie, trie_domain
from pagesift.session import materialize

KEPT = "kept"
# Beyond this size lists meet the distinct URLs instead of the rows.
LIST_BROADCAST_BYTES = 64 << 20
# Words are part of an expression.
WORD_BYTES = 4 << 20


@dataclass(frozen=True)
class UrlRules:
    """Tables and words of one URL filter. ``None`` switches a rule off."""

    allow: DataFrame | None = None
    curated: DataFrame | None = None
    block: DataFrame | None = None
    strict_words: Sequence[str] | DataFrame = ()
    hard_words: Sequence[str] | DataFrame = ()
    soft_words: Sequence[str] | DataFrame = ()
    soft_limit: int = 2
    path_rules: bool = True
    strip_scheme: bool = False
    suffixes: Sequence[str] | SuffixTrie = U.PUBLIC_SUFFIXES


def url_parts(df: DataFrame, suffixes: Sequence[str] | SuffixTrie = U.PUBLIC_SUFFIXES, url: str = "url") -> DataFrame:
    """Add ``host``, ``registered_domain`` and ``fqdn``; ``suffixes`` is a short list or a trie of a suffix table."""
    df = df.withColumn("host", U.host(F.col(url)))
    if isinstance(suffixes, SuffixTrie):
        df = trie_domain(df, suffixes)
    else:
        df = df.withColumn("registered_domain", U.registered_domain(F.col("host"), suffixes))
    return df.withColumn("fqdn", F.when(F.col("registered_domain").isNotNull(), F.col("host")))


@dataclass(frozen=True)
class ListTable:
    """Entries ``(kind, value)`` of several lists with a boolean column for each, written and measured once.

    ``depth`` is the number of segments of the longest entry with a path, 0 if there is none.
    """

    flags: DataFrame
    names: tuple[str, ...]
    size: int
    depth: int

    @property
    def small(self) -> bool:
        return self.size <= LIST_BROADCAST_BYTES


def _is_path() -> Column:
    return (F.col("kind") == "domain") & F.col("value").contains("/")


def list_table(**lists: DataFrame) -> ListTable:
    names = tuple(lists)
    parts = [
        df.select("kind", "value", *[F.lit(n == name).alias(n) for n in names]) for name, df in lists.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    # A trailing slash of an entry with a path means nothing.
    value = F.when(_is_path(), F.rtrim("value", F.lit("/"))).otherwise(F.col("value"))
    merged = union.where("kind <> 'word'").withColumn("value", value).groupBy("kind", "value").agg(*[F.max(n).alias(n) for n in names])
    flags = materialize(merged, "url-lists")
    size, depth = flags.agg(F.sum(row_bytes(flags)), F.max(F.when(_is_path(), F.size(F.split("value", "/"))))).first()
    return ListTable(flags, names, int(size or 0), int(depth or 0))


def mark(df: DataFrame, table: ListTable, kind: str, key: str, prefix: str) -> DataFrame:
    """Add ``<prefix>_<list>`` for every list, which must fit in a broadcast: whether column ``key`` is one of its entries."""
    lookup = table.flags.where(F.col("kind") == kind).select(
        F.col("value").alias(key), *[F.col(n).alias(f"{prefix}_{n}") for n in table.names]
    )
    joined = lookup_join(df, lookup, key, "left", broadcast_bytes=LIST_BROADCAST_BYTES, size=table.size)
    filled = {f"{prefix}_{n}": F.coalesce(F.col(f"{prefix}_{n}"), F.lit(False)) for n in table.names}
    return joined.withColumns(filled)


def mark_lists(df: DataFrame, table: ListTable, strip_scheme: bool = False) -> DataFrame:
    if not table.small:
        return mark_by_place(df, table, strip_scheme)
    df = mark(df, table, "domain", "registered_domain", "domain")
    df = mark(df, table, "domain", "fqdn", "host")
    if strip_scheme:
        df = df.withColumn("_bare", U.without_scheme(F.col("url")))
        return mark(df, table, "url", "_bare", "url").drop("_bare")
    return mark(df, table, "url", "url", "url")


def url_path(url: Column, host: Column) -> Column:
    """Host and path, as entries with a path are written: no scheme, user, port, query or fragment."""
    return F.concat(host, F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1))


def path_prefixes(path: Column, depth: int) -> Column:
    """The prefixes of 2 to ``depth`` segments of host and path."""
    parts = F.split(path, "/")
    lengths = F.sequence(F.lit(2), F.least(F.size(parts), F.lit(depth)))
    prefixes = F.transform(lengths, lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    return F.when(F.size(parts) >= 2, prefixes).otherwise(F.array().cast("array<string>"))


def _path_hosts(table: ListTable) -> DataFrame:
    return table.flags.where(_is_path()).select(F.substring_index("value", "/", 1).alias("host")).distinct()


def url_marks(urls: DataFrame, table: ListTable, strip_scheme: bool = False, name: str | None = None) -> DataFrame:
    """List entries of distinct URLs by one equi-join: ``url``, the marks of ``mark_lists``, ``path_<list>`` and ``entry``.

    ``urls`` holds ``url``, ``host``, ``registered_domain`` and ``fqdn``. Only URLs with an entry are in the result.
    ``entry`` is the longest entry with a path of list ``name``. A frequent domain is spread over tasks.
    """
    url = U.without_scheme(F.col("url")) if strip_scheme else F.col("url")

    def named(part: str, kind: str, value: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), F.lit(kind).alias("kind"), value.alias("value"))

    parts = [named("domain", "domain", F.col("registered_domain")), named("host", "domain", F.col("fqdn")), named("url", "url", url)]
    asked = urls.select("url", F.inline(F.array(*parts)))
    if table.depth:
        below = lookup_join(urls, materialize(_path_hosts(table), "path-hosts"), "host", "left_semi")
        prefixes = path_prefixes(url_path(F.col("url"), F.col("host")), table.depth)
        asked = asked.unionByName(below.select("url", F.inline(F.transform(prefixes, lambda x: named("path", "domain", x)))))
    asked = materialize(asked.where(F.col("value").isNotNull()), "url-keys")
    keys = ["kind", "value"]
    found = salted_join(asked, table.flags, keys, materialize(count_keys(asked, keys), "key-sizes"))
    found = found.withColumn("part", F.when((F.col("part") == "host") & F.col("value").contains("/"), "path").otherwise(F.col("part")))
    marks = [F.max((F.col("part") == part) & F.col(n)).alias(f"{part}_{n}") for part in ("domain", "host", "url", "path") for n in table.names]
    is_path = (F.col("part") == "path") & (F.col(name) if name else F.lit(True))
    longest = F.max(F.when(is_path, F.struct(F.length("value"), "value")))["value"].alias("entry")
    return found.groupBy("url").agg(*marks, longest)


def mark_by_place(df: DataFrame, table: ListTable, strip_scheme: bool = False, name: str | None = None) -> DataFrame:
    """Marks of lists of any size: the rows are written once, their distinct URLs judged, the marks joined by place."""
    rows = placed(df, "url-rows")
    keyed = rows.narrow("url", "host", "registered_domain", "fqdn")
    urls = keyed.drop(PLACE).where(F.col("url").isNotNull()).distinct()
    marks = materialize(url_marks(materialize(urls, "distinct-urls"), table, strip_scheme, name), "url-marks")
    narrow = rows.narrow("url")
    found = salted_join(narrow, marks, ["url"], materialize(count_keys(narrow, ["url"]), "key-sizes")).drop("url")
    out = attached(rows, found, "left", name="url-marked", limit=max(LIST_BROADCAST_BYTES, 1))
    flags = [c for c in marks.columns if c not in ("url", "entry")]
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in flags})


def join_url_lists(df: DataFrame, strip_scheme: bool = False, **lists: DataFrame) -> DataFrame:
    """Membership of domain, host and URL in every list.

    Needs the columns of ``url_parts``. Adds ``domain_<list>``, ``host_<list>`` and ``url_<list>``. Lists that fit are
    broadcast for three lookups in the row; others meet the distinct URLs, see ``mark_by_place``.
    """
    table = list_table(**lists)
    return mark_lists(df, table, strip_scheme).drop("entry", *[f"path_{n}" for n in table.names])


def _drop_marks(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[f"{part}_{n}" for part in ("domain", "host", "url") for n in names])


def allowed_flag() -> Column:
    return F.col("domain_allow") | F.col("host_allow") | F.col("url_allow")


def block_reason() -> Column:
    return (
        F.when(F.col("domain_block"), "domain").when(F.col("host_block"), "subdomain").when(F.col("url_block"), "url")
    )


def url_whitelist(df: DataFrame, allow: DataFrame) -> DataFrame:
    """Flag ``allowed``: exact URL, registered domain or host in the white list."""
    return _drop_marks(join_url_lists(df, allow=allow).withColumn("allowed", allowed_flag()), "allow")


def url_blocklist(df: DataFrame, block: DataFrame, strip_scheme: bool = False) -> DataFrame:
    """Column ``blocked``: ``domain``, ``subdomain``, ``url`` or NULL."""
    return _drop_marks(join_url_lists(df, strip_scheme, block=block).withColumn("blocked", block_reason()), "block")


def url_curated(df: DataFrame, curated: DataFrame, path_rules: bool = True) -> DataFrame:
    """Flag ``curated``: sources that are taken from elsewhere, and ``curated_by``, the entry that says so.

    An entry with a path can never equal a domain. With ``path_rules`` such an entry matches the URLs at
    and below its path, whatever its depth; the longest one is named, before host and domain.
    """
    table = list_table(curated=curated)
    if table.small:
        marked = mark(mark(df, table, "domain", "registered_domain", "domain"), table, "domain", "fqdn", "host")
        marked = path_entry(marked, table, "curated")
    else:
        marked = mark_by_place(df, table, name="curated")
    named = [F.when(F.col("host_curated"), F.col("fqdn")), F.when(F.col("domain_curated"), F.col("registered_domain"))]
    if path_rules:
        named.insert(0, F.col("entry"))
    out = marked.withColumn("curated_by", F.coalesce(*named)).withColumn("curated", F.col("curated_by").isNotNull())
    return out.select(*df.columns, "curated", "curated_by")


def path_entry(df: DataFrame, table: ListTable, name: str) -> DataFrame:
    """Add ``entry``, the longest entry with a path of list ``name`` at or above the URL: one lookup of the host for all depths.

    The lists must fit in a broadcast. Needs ``host``.
    """
    if not table.depth:
        return df.withColumn("entry", F.lit(None).cast("string"))
    entries = table.flags.where(_is_path() & F.col(name)).select(F.substring_index("value", "/", 1).alias("host"), "value")
    entries = materialize(entries.groupBy("host").agg(F.collect_set("value").alias("_entries")), "path-entries")
    joined = lookup_join(df, entries, "host", "left", broadcast_bytes=LIST_BROADCAST_BYTES, size=table.size)
    hits = F.array_intersect(path_prefixes(url_path(F.col("url"), F.col("host")), table.depth), F.col("_entries"))
    # Prefixes rise in length, and the intersection keeps their order.
    return joined.withColumn("entry", F.when(F.col("_entries").isNotNull(), F.try_element_at(hits, F.lit(-1)))).drop("_entries")


def word_list(words: Sequence[str] | DataFrame) -> tuple[str, ...]:
    """Words as given, or the ``word`` rows of a list table, which must be of bounded size."""
    if not isinstance(words, DataFrame):
        return tuple(words)
    rows = materialize(words.where("kind = 'word'").select(F.lower("value").alias("value")).distinct(), "words")
    if table_bytes(rows) > WORD_BYTES:
        raise ValueError("word lists of URL rules must be small; use url entries for large lists")
    return tuple(sorted(r["value"] for r in rows.collect()))


def bad_words(
    url: Column, strict: Sequence[str] | DataFrame = (), hard: Sequence[str] | DataFrame = (),
    soft: Sequence[str] | DataFrame = (), soft_limit: int = 2,
) -> Column:
    """Reason ``hard_word``, ``soft_words`` or ``strict_word``, else NULL. Words are given or come from a list table."""
    strict, hard, soft = word_list(strict), word_list(hard), word_list(soft)
    return (
        F.when(U.has_word(url, hard), "hard_word")
        .when(U.count_words(url, soft) >= soft_limit, "soft_words")
        .when(U.has_subword(url, strict), "strict_word")
    )


def url_disposition(df: DataFrame, rules: UrlRules) -> DataFrame:
    """Add ``url_disposition``: ``kept`` or the first rule that drops the row.

    The white list overrides every rule. A row whose URL is missing or cannot
    be read is kept. Word tests, the costly part, come after the list lookups.
    """
    names = df.columns
    lists = {
        name: table
        for name, table in (("allow", rules.allow), ("curated", rules.curated), ("block", rules.block))
        if table is not None
    }
    df = url_parts(df, rules.suffixes)
    table = list_table(**lists) if lists else None
    no = F.lit(False)
    if table and table.small:
        df = mark_lists(df, table, rules.strip_scheme)
        df = path_entry(df, table, "curated") if rules.curated is not None else df
    elif table:
        df = mark_by_place(df, table, rules.strip_scheme, "curated" if rules.curated is not None else None)
    curated = no
    if rules.curated is not None:
        curated = F.col("domain_curated") | F.col("host_curated")
        curated = curated | F.col("entry").isNotNull() if rules.path_rules else curated
    df = df.withColumn("curated", curated)
    blocked = block_reason() if rules.block is not None else F.lit(None).cast("string")
    words = bad_words(F.col("url"), rules.strict_words, rules.hard_words, rules.soft_words, rules.soft_limit)
    decision = (
        F.when(F.col("url").isNull() | (allowed_flag() if rules.allow is not None else no), KEPT)
        .when(F.col("curated"), "curated")
        .otherwise(F.coalesce(blocked, words, F.lit(KEPT)))
    )
    return df.withColumn("url_disposition", decision).select(*names, "url_disposition")
