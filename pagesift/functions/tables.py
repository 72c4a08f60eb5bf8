"""HTML tables as text, computed inside the row of their page."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesift.functions.binding import let
from pagesift.functions.formulas import strip
from pagesift.functions.hashing import md5_bucket
from pagesift.functions.html import decode_entities, escape, strip_tags

# Patterns and formats.
TABLE = r"(?is)<table(?:\s[^>]*)?>.*?</table\s*>"
ROW = r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr\s*>"
HEADER = r"(?is)<th(?:\s[^>]*)?>(.*?)</th\s*>"
CELL = r"(?is)<td(?:\s[^>]*)?>(.*?)</td\s*>"
NESTED = r"(?is)^<table.*<table[\s>]"
PRE_OPEN = '<pre class="converted-table">\n'
PRE_CLOSE = "\n</pre>"


def cell_text(cell: Column) -> Column:
    return strip(decode_entities(strip_tags(cell)))


def table_raws(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(TABLE), 0)


def is_nested(raw: Column) -> Column:
    return raw.rlike(NESTED)


def headers(raw: Column) -> Column:
    return F.transform(F.regexp_extract_all(raw, F.lit(HEADER), 1), cell_text)


def rows(raw: Column) -> Column:
    """Cells of every row that has data cells."""
    cells = lambda row: F.transform(F.regexp_extract_all(row, F.lit(CELL), 1), cell_text)
    return F.filter(F.transform(F.regexp_extract_all(raw, F.lit(ROW), 1), cells), lambda r: F.size(r) > 0)


def parse_table(raw: Column) -> Column:
    return F.struct(headers(raw).alias("headers"), rows(raw).alias("rows"))


def markdown(table: Column) -> Column:
    """Pipe table; rows of blank cells are left out; works without a header."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def render(t: Column) -> Column:
        head = F.when(
            F.size(t["headers"]) > 0,
            F.array(line(t["headers"]), line(F.transform(t["headers"], lambda h: F.lit("---")))),
        ).otherwise(F.array().cast("array<string>"))
        full = F.filter(t["rows"], lambda r: F.exists(r, lambda c: c != ""))
        flat = lambda c: strip(F.replace(c, F.lit("\n"), F.lit(" ")))
        body = F.transform(full, lambda r: line(F.transform(r, flat)))
        return F.array_join(F.concat(head, body), "\n")

    return let(table, render)


def ascii_possible(table: Column) -> Column:
    """A boxed table needs different headers and as many cells in every row."""

    def possible(t: Column) -> Column:
        n = F.size(t["headers"])
        return (
            (n > 0)
            & (F.size(F.array_distinct(t["headers"])) == n)
            & ~F.exists(t["rows"], lambda r: F.size(r) != n)
        )

    return let(table, possible)


def widths(table: Column) -> Column:
    """Longest line of each column, header included."""

    def longest(t: Column) -> Column:
        all_rows = F.concat(F.array(t["headers"]), t["rows"])
        column = lambda j: F.flatten(F.transform(all_rows, lambda r: F.split(F.get(r, j), "\n")))
        return F.transform(
            F.sequence(F.lit(0), F.size(t["headers"]) - 1),
            lambda j: F.array_max(F.transform(column(j), lambda c: F.length(c))),
        )

    return let(table, longest)


def _center(text: Column, width: Column) -> Column:
    """Centred; an odd blank goes left of text of even length and right of text of odd length."""

    def center(s: Column) -> Column:
        spare = width - F.length(s)
        odd = F.when((spare % 2 == 1) & (F.length(s) % 2 == 0), 1).otherwise(0)
        left = F.floor(spare / 2).cast("int") + odd
        return F.concat(F.repeat(F.lit(" "), left), s, F.repeat(F.lit(" "), spare - left))

    return let(text, center)


def ascii_box(table: Column) -> Column:
    """Boxed table; NULL where it cannot be drawn."""

    def draw(both: Column) -> Column:
        t, w = both["t"], both["w"]
        rule = F.concat(
            F.lit("+"), F.array_join(F.transform(w, lambda x: F.repeat(F.lit("-"), x + 2)), "+"), F.lit("+")
        )

        def line(r: Column, k: Column) -> Column:
            part = lambda x, j: F.concat(
                F.lit(" "), _center(F.coalesce(F.get(F.split(F.get(r, j), "\n"), k), F.lit("")), x), F.lit(" ")
            )
            return F.concat(F.lit("|"), F.array_join(F.transform(w, part), "|"), F.lit("|"))

        def row(r: Column) -> Column:
            height = F.array_max(F.transform(r, lambda c: F.size(F.split(c, "\n"))))
            return F.array_join(F.transform(F.sequence(F.lit(0), height - 1), lambda k: line(r, k)), "\n")

        lines = F.concat(F.array(rule, row(t["headers"]), rule), F.transform(t["rows"], row), F.array(rule))
        return F.array_join(lines, "\n")

    boxed = lambda t: F.when(
        ascii_possible(t), let(F.struct(t.alias("t"), widths(t).alias("w")), draw)
    )
    return let(table, boxed)


def format_choice(page_key: Column, table_no: Column) -> Column:
    """0 = boxed, 1 = pipes; decided by a hash, so a repeated run gives the same text."""
    return md5_bucket(F.concat_ws(":", page_key.cast("string"), table_no.cast("string")), 1) % 2


def table_outputs(html: Column, page_key: Column) -> Column:
    """Text of each table in its chosen format; NULL where a table cannot be converted."""

    def one(raw: Column, i: Column) -> Column:
        text = F.when(format_choice(page_key, i) == 0, ascii_box(parse_table(raw))).otherwise(markdown(parse_table(raw)))
        return F.when(~is_nested(raw), text)

    return F.transform(table_raws(html), one)


def table_replace(html: Column, page_key: Column) -> Column:
    """Tables replaced by their text in ``pre``; if one fails, the page stays as it is."""

    def page(h: Column) -> Column:
        outs = table_outputs(h, page_key)
        pair = F.struct(F.split(h, TABLE).alias("gaps"), outs.alias("outs"))

        def join(p: Column) -> Column:
            block = lambda o: F.concat(F.lit(PRE_OPEN), escape(o), F.lit(PRE_CLOSE))
            pieces = F.transform(
                p["gaps"], lambda gap, i: F.concat(gap, F.coalesce(block(F.get(p["outs"], i)), F.lit("")))
            )
            return F.when(F.forall(p["outs"], lambda o: o.isNotNull()), F.array_join(pieces, "")).otherwise(h)

        return let(pair, join)

    return let(html, page)
