"""Parts of a URL and word tests on it."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns.
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\[\]@\s]+)"
IPV4 = r"^\d{1,3}(\.\d{1,3}){3}$"
NOT_ALNUM = r"[^a-zA-Z0-9]+"

# Common public suffixes. Pass the full public list for production.
PUBLIC_SUFFIXES = (
    "com", "net", "org", "edu", "gov", "mil", "int", "info", "biz", "name", "io", "co", "ai", "me", "tv",
    "ac.uk", "co.uk", "gov.uk", "org.uk", "uk", "com.au", "edu.au", "gov.au", "org.au", "au",
    "ac.jp", "co.jp", "go.jp", "or.jp", "jp", "com.br", "org.br", "br", "com.cn", "edu.cn", "cn",
    "co.in", "ac.in", "in", "co.nz", "ac.nz", "nz", "co.za", "za", "com.mx", "mx", "co.kr", "kr",
    "at", "be", "ca", "ch", "cz", "de", "dk", "es", "eu", "fi", "fr", "gr", "hu", "ie", "il", "it",
    "nl", "no", "pl", "pt", "ro", "ru", "se", "tr", "ua", "us",
)


def host(url: Column) -> Column:
    """Lower-case host name; NULL if the text is no absolute URL."""
    return F.nullif(F.rtrim(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(".")), F.lit(""))


def registered_domain(host_name: Column, suffixes: Sequence[str] = PUBLIC_SUFFIXES) -> Column:
    """The longest public suffix of the host and one label more.

    Where no suffix of the list fits, the last label is the suffix, as the public list's own rule says.
    """
    suffixes = list(suffixes)
    depth = max(s.count(".") for s in suffixes) + 1
    labels = F.size(F.split(host_name, r"\."))
    last = F.substring_index(host_name, ".", -1)
    out = F.when((labels > 1) & last.rlike("^[a-z][a-z0-9-]*$") & ~host_name.isin(suffixes), F.substring_index(host_name, ".", -2))
    for k in range(1, depth + 1):
        known = [s for s in suffixes if s.count(".") == k - 1]
        hit = (labels > k) & F.substring_index(host_name, ".", -k).isin(known)
        out = F.when(hit, F.substring_index(host_name, ".", -(k + 1))).otherwise(out)
    return F.when(~host_name.rlike(IPV4), out)


def normalized(url: Column) -> Column:
    return F.lower(F.regexp_replace(url, NOT_ALNUM, ""))


def without_scheme(url: Column) -> Column:
    return F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "")


def url_words(url: Column) -> Column:
    """Words of a URL: its runs of letters and digits."""
    return F.filter(F.split(F.lower(url), "[^a-z0-9]+"), lambda w: w != "")


def has_subword(url: Column, words: Sequence[str]) -> Column:
    """Whether a word occurs anywhere in the URL, separators ignored."""
    if not words:
        return F.lit(False)
    return normalized(url).rlike("|".join(re.escape(w) for w in words))


def has_word(url: Column, words: Sequence[str]) -> Column:
    if not words:
        return F.lit(False)
    return F.exists(url_words(url), lambda w: w.isin(list(words)))


def count_words(url: Column, words: Sequence[str]) -> Column:
    """How many different words of the list the URL has."""
    if not words:
        return F.lit(0)
    return F.size(F.array_distinct(F.filter(url_words(url), lambda w: w.isin(list(words)))))
