"""Bytes to text."""

from __future__ import annotations

import codecs

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns; names of charsets and the decoder of each. Latin-1 on the web means windows-1252.
META_CHARSET = r"(?i)<meta[^>]+charset\s*=\s*[\"']?\s*([a-zA-Z0-9_:-]+)"
HEADER_CHARSET = r"(?i)charset\s*=\s*[\"']?\s*([a-zA-Z0-9_:-]+)"
DECODERS = {
    "iso-8859-1": "windows-1252", "iso8859-1": "windows-1252", "latin1": "windows-1252", "latin-1": "windows-1252",
    "us-ascii": "windows-1252", "ascii": "windows-1252", "windows-1252": "windows-1252", "cp1252": "windows-1252",
    "windows-1250": "windows-1250", "windows-1251": "windows-1251", "cp1251": "windows-1251",
    "windows-1253": "windows-1253", "windows-1254": "windows-1254", "windows-1255": "windows-1255",
    "windows-1256": "windows-1256", "windows-1257": "windows-1257", "windows-1258": "windows-1258",
    "iso-8859-2": "iso-8859-2", "iso-8859-5": "iso-8859-5", "iso-8859-7": "iso-8859-7", "iso-8859-9": "windows-1254",
    "iso-8859-15": "iso-8859-15", "koi8-r": "koi8-r", "koi8-u": "koi8-u",
    "shift_jis": "shift_jis", "shift-jis": "shift_jis", "sjis": "shift_jis", "euc-jp": "euc_jp",
    "gb2312": "gb18030", "gbk": "gb18030", "gb18030": "gb18030", "big5": "big5",
    "euc-kr": "cp949", "ks_c_5601-1987": "cp949",
}
DEFAULT = "windows-1252"
# Decoders that are no charsets of web pages, or that a body that gets here has not.
NOT_CHARSETS = (
    "idna", "mbcs", "oem", "palmos", "punycode", "raw-unicode-escape", "undefined", "unicode-escape", "utf-7",
    "utf-8", "utf-8-sig", "utf-16", "utf-16-be", "utf-16-le",
)


def decoder(name: str | None) -> str:
    """The decoder of a declared charset: the web's reading of common names, else any text encoding of that name."""
    known = DECODERS.get(name or "")
    if known:
        return known
    try:
        found = codecs.lookup(name or "")
    except (LookupError, ValueError):
        return DEFAULT
    return found.name if found._is_text_encoding and found.name.replace("_", "-") not in NOT_CHARSETS else DEFAULT


def declared_charset(body: Column, content_type: Column | None = None) -> Column:
    """Charset named by the HTTP header, else by a ``meta`` tag; the whole body is searched."""
    found = F.regexp_extract(F.decode(body, "ISO-8859-1"), META_CHARSET, 1)
    if content_type is not None:
        header = F.regexp_extract(F.coalesce(content_type, F.lit("")), HEADER_CHARSET, 1)
        found = F.when(header != "", header).otherwise(found)
    return F.lower(F.when(found != "", found))


def _decoded(body: pd.Series, charset: pd.Series) -> pd.Series:
    """Bytes by the declared charset; a byte that has no meaning there becomes U+FFFD, or its code in windows-1252."""
    names = {x: decoder(x) for x in charset.unique()}

    def text(data: bytes | None, declared: str | None) -> str | None:
        if data is None:
            return None
        name = names[declared]
        out = bytes(data).decode(name, "surrogateescape" if name == DEFAULT else "replace")
        return out.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if name != DEFAULT else _latin(out)

    return pd.Series([text(x, y) for x, y in zip(body, charset)], dtype=object)


def _latin(text: str) -> str:
    """The five bytes that windows-1252 leaves open are control characters."""
    return text.translate({0xDC00 + i: i for i in (0x81, 0x8D, 0x8F, 0x90, 0x9D)})


def decode_body(body: Column, charset: Column) -> Column:
    """Text of the body: UTF-16 by mark or name, then valid UTF-8, then the declared charset; windows-1252 where none is declared or known.

    Only bodies that are neither UTF-8 nor UTF-16 are sent to a decoder, as Spark itself knows just those and Latin-1.
    """
    order_mark = F.hex(F.substring(body, 1, 2))
    even = F.octet_length(body) % 2 == 0
    little = ((order_mark == "FFFE") | (F.coalesce(charset, F.lit("")) == "utf-16le")) & even
    big = ((order_mark == "FEFF") | (F.coalesce(charset, F.lit("")) == "utf-16be")) & even
    # Text by one of the simple ways; NULL if none applies.
    simple = (
        F.when(F.octet_length(body) == 0, F.lit(""))
        .when(little, F.regexp_replace(F.decode(body, "UTF-16LE"), "^\ufeff", ""))
        .when(big, F.regexp_replace(F.decode(body, "UTF-16BE"), "^\ufeff", ""))
        .when(F.is_valid_utf8(body.cast("string")), F.regexp_replace(body.cast("string"), "^\ufeff", ""))
    )
    other = ~little & ~big & ~F.is_valid_utf8(body.cast("string"))
    return F.coalesce(simple, F.pandas_udf(_decoded, "string")(F.when(other, body), F.when(other, F.coalesce(charset, F.lit("")))))
