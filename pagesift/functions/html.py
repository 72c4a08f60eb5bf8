"""HTML to text by regular expressions on whole pages."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesift.functions.binding import let

# Patterns and entity names.
COMMENT = r"(?s)<!--.*?-->"
INVISIBLE = ("head", "script", "style", "noscript", "template")
BLOCK_TAG = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer"
    r"|form|h[1-6]|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|tfoot|thead|title|tr|ul)"
    r"(?:[\s/][^>]*)?>"
)
CELL_TAG = r"(?i)</t[dh]\s*>"
PREFORMATTED = r"(?is)<pre(?:\s[^>]*)?>.*?</pre\s*>"
ANY_TAG = r"<[a-zA-Z/!?][^>]*>"
REFERENCE = r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"
NUMBER = r"#[0-9]+;?|#[xX][0-9a-fA-F]+;?"
FREQUENT = ("amp;", "lt;", "gt;", "quot;", "apos;", "nbsp;", "copy;", "middot;")
MAX_CODE_POINT = 0x10FFFF


def _char(code: Column) -> Column:
    """Character of a code point; NULL for values that are no character."""

    def char(c: Column) -> Column:
        valid = ((c > 0) & (c < 0xD800)) | ((c > 0xDFFF) & (c <= MAX_CODE_POINT))
        return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))

    return let(code, char)


def replace_each(text: Column, pattern: str, target: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``target`` of it; NULL leaves it in place."""

    def replace(t: Column) -> Column:
        found = F.array_distinct(F.regexp_extract_all(t, F.lit(pattern), 0))
        return F.aggregate(found, t, lambda acc, e: F.replace(acc, e, F.coalesce(target(e), e)))

    return let(text, replace)


def replace_in_order(text: Column, pattern: str, target: Callable[[Column], Column]) -> Column:
    """Replace every match, each in its own place and once, by ``target`` of it (NULL keeps it)."""

    def rebuild(t: Column) -> Column:
        pair = F.struct(
            F.split(t, pattern, -1).alias("gaps"), F.regexp_extract_all(t, F.lit(pattern), 0).alias("found")
        )
        return let(
            pair,
            lambda p: F.array_join(
                F.transform(
                    p["gaps"],
                    lambda gap, i: F.concat(
                        gap, F.coalesce(let(F.get(p["found"], i), lambda f: F.coalesce(target(f), f)), F.lit(""))
                    ),
                ),
                "",
            ),
        )

    return let(text, rebuild)


@cache
def named_references() -> dict[str, str]:
    """The standard's named character references, frequent ones first; old names stand without a semicolon, too."""
    return {name: html5[name] for name in FREQUENT} | html5


@cache
def loose_reference() -> str:
    """A reference as browsers read it: an old name or a number may lack its semicolon, a name with one comes first."""
    old = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
    return f"&(?:{NUMBER}|[a-zA-Z][a-zA-Z0-9]*;|{'|'.join(old)})"


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal character references, in one pass: what one gives is not read again.

    A no-break space becomes a blank. Unknown names and numbers of no character stay.
    """
    pairs = "\u0001".join(f"&{name}\u0002{' ' if name in ('nbsp;', 'nbsp') else char}" for name, char in named_references().items())
    table = F.str_to_map(F.lit(pairs), F.lit("\u0001"), F.lit("\u0002"))

    def code(digits: Column, base: int, most: int) -> Column:
        bare = F.regexp_replace(digits, "^0+|;$", "")
        return _char(F.when(F.length(bare) <= most, F.conv(bare, base, 10).cast("long")))

    def char(e: Column) -> Column:
        return (
            F.when(~e.startswith("&#"), F.try_element_at(table, e))
            .when(F.lower(F.substring(e, 3, 1)) == "x", code(F.substring(e, F.lit(4), F.length(e)), 16, 6))
            .otherwise(code(F.substring(e, F.lit(3), F.length(e)), 10, 7))
        )

    return let(text, lambda t: F.when(t.contains("&"), replace_in_order(t, loose_reference(), char)).otherwise(t))


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, ANY_TAG, "")


def drop_invisible(html: Column) -> Column:
    out = F.regexp_replace(html, COMMENT, "")
    for tag in INVISIBLE:
        out = F.regexp_replace(out, rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>", "")
    return out


def extract_text(html: Column) -> Column:
    """Visible text: one line per block, no tags, no link targets, no alternative texts."""
    out = drop_invisible(html)
    out = F.regexp_replace(out, r"[ \t\r\n\f]+", " ")
    out = F.regexp_replace(out, BLOCK_TAG, "\n")
    out = F.regexp_replace(out, CELL_TAG, "\t")
    out = decode_entities(strip_tags(out))
    out = F.regexp_replace(out, r"[ \x{a0}]+", " ")
    out = F.regexp_replace(out, r" *\n[ \t\n]*", "\n")
    return F.regexp_replace(out, r"^[ \t\n]+|[ \t\n]+$", "")


def extract_preformatted_text(html: Column) -> Column:
    """``extract_text`` that keeps the line ends inside ``pre`` elements."""
    # Inside "pre", line ends and blanks are kept as control characters while the rest collapses.
    marked = replace_each(html, PREFORMATTED, lambda block: F.translate(block, "\n ", "\u0001\u0002"))
    marked = F.replace(marked, F.lit("<pre\u0002"), F.lit("<pre "))
    return F.translate(extract_text(marked), "\u0001\u0002", "\n ")
