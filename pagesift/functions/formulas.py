"""Formulas in HTML: finding, cleaning, and putting TeX in their place."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesift.functions.binding import let
from pagesift.functions.html import decode_entities, escape, replace_each, replace_in_order, strip_tags
from pagesift.functions.symbols import entity_to_latex, unicode_to_latex

# Patterns and formats.
MATH = r"(?is)<(?:mml:)?math(?:\s[^>]*)?>.*?</(?:mml:)?math\s*>"
MATHML_TAG = r"(?i)<(?:mml:)?(m[a-z]+)"
ANNOTATION = r"(?is)<annotation[^>]*encoding=\"application/x-tex\"[^>]*>(.*?)</annotation\s*>"
ANY_ANNOTATION = r"(?is)<annotation[^>]*>.*?</annotation[^>]*>"
ALTTEXT = r"(?is)^<(?:mml:)?math\s(?:[^>]*\s)?alttext=\"([^\"]*)\""
KATEX_SKIPPED = r"(?is)^<math[^>]*class=\"katex-mathml\""
STYLED = r"(?s)\$\{?\\(?:display|text)style\s*(.+?)\}?\$"
KATEX_RENDERED = re.compile(r"<span[^>]*class=\"katex-html\"[^>]*>", re.I)
KATEX_CONTAINER = (
    r"(?is)<span[^>]*class=\"katex\"[^>]*>\s*<span[^>]*class=\"katex-mathml\"[^>]*>\s*"
    r"(<math(?:\s[^>]*)?>.*?</math\s*>)\s*</span>\s*</span>"
)
SPAN = re.compile(r"<(/?)span\b[^>]*>", re.I)
BLOCK = r"<!--\[if mathML\]>(.*?)<!\[endif\]-->"
DISPLAY = "{\\displaystyle"
NAMESPACE = 'xmlns="http://www.w3.org/1998/Math/MathML"'
SPAN_OPEN = '<span class="math-text">'
SPAN_CLOSE = "</span>"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def formula_clean(tex: Column) -> Column:
    """Strip, take off one leading display style group, wrap in dollars; empty stays empty."""

    def clean(t: Column) -> Column:
        bare = F.replace(t, F.lit(DISPLAY), F.lit(""))
        bare = F.when(t.startswith(DISPLAY), F.regexp_replace(bare, r"\}$", "")).otherwise(t)
        return let(strip(bare), lambda b: F.when(b == "", "").otherwise(F.concat(F.lit("$"), b, F.lit("$"))))

    return let(strip(tex), clean)


def formula_destyle(tex: Column) -> Column:
    """Drop display and text style commands inside dollars."""

    def plain(match: Column) -> Column:
        inner = F.regexp_replace(F.regexp_extract(match, STYLED, 1), r"(?s)^\{(.+)\}$", "$1")
        return F.concat(F.lit("$"), inner, F.lit("$"))

    return replace_each(tex, STYLED, plain)


def mathml_clean(block: Column) -> Column:
    """Drop the XML prolog, repair a cut ``\\boldsymbol``, add the namespace."""
    broken = block.contains("oldsymbol{") & ~block.contains("boldsymbol{")
    out = F.when(broken, F.replace(block, F.lit("oldsymbol"), F.lit("\\boldsymbol"))).otherwise(block)
    out = F.regexp_replace(out, r"<\?xml[^>]+\?>\s*", "")

    def named(t: Column) -> Column:
        at = F.instr(t, "<math")
        added = F.concat(
            F.substring(t, F.lit(1), at + 4), F.lit(f" {NAMESPACE}"), F.substring(t, at + 5, F.length(t))
        )
        return F.when((at > 0) & ~t.contains(NAMESPACE), added).otherwise(t)

    return let(out, named)


def token_text(mathml: Column) -> Column:
    """Plain text of a formula's tokens in LaTeX symbols; structure is not converted."""
    bare = decode_entities(strip_tags(F.regexp_replace(mathml, ANY_ANNOTATION, "")))
    tex = entity_to_latex(unicode_to_latex(strip(F.regexp_replace(bare, r"\s+", " "))))
    return let(tex, lambda t: F.when(t == "", "").otherwise(F.concat(F.lit("$"), t, F.lit("$"))))


def formula_parts(formula: Column) -> Column:
    """``struct(kind, tex)``: TeX annotation first, then ``alttext``, else the token text."""

    def parts(f: Column) -> Column:
        annotation = F.regexp_extract(f, ANNOTATION, 1)
        kind = (
            F.when(f.rlike(KATEX_SKIPPED), "skipped")
            .when(annotation != "", "annotation")
            .when(f.rlike(ALTTEXT), "alttext")
            .otherwise("mathml")
        )
        tex = (
            F.when(f.rlike(KATEX_SKIPPED), F.lit(None).cast("string"))
            .when(annotation != "", formula_clean(decode_entities(annotation)))
            .when(f.rlike(ALTTEXT), formula_clean(decode_entities(F.regexp_extract(f, ALTTEXT, 1))))
            .otherwise(formula_destyle(token_text(mathml_clean(f))))
        )
        return F.struct(kind.alias("kind"), tex.alias("tex"))

    return let(formula, parts)


def formula_mark(html: Column) -> Column:
    """Every formula replaced by its TeX in a ``span``; one without a result stays."""
    marked = lambda f: F.concat(F.lit(SPAN_OPEN), escape(formula_parts(f)["tex"]), F.lit(SPAN_CLOSE))
    return replace_in_order(html, MATH, marked)


def without_rendered(html: str) -> str:
    """Drop the rendered copies of KaTeX formulas, spans in spans to any depth; one that never ends stays."""
    out, at = [], 0
    while found := KATEX_RENDERED.search(html, at):
        depth, end = 1, found.end()
        for tag in SPAN.finditer(html, found.end()):
            depth += -1 if tag[1] else 1
            end = tag.end()
            if depth == 0:
                break
        out.append(html[at : found.start() if depth == 0 else found.end()])
        at = end if depth == 0 else found.end()
    return "".join([*out, html[at:]])


def _without_rendered(html: pd.Series) -> pd.Series:
    return html.map(lambda x: None if x is None else without_rendered(x))


def katex_choose(html: Column) -> Column:
    """Rendered KaTeX containers replaced by the MathML they embed.

    Matching tags to any depth is beyond regular expressions; only pages with such a container go to Python.
    """
    rendered = html.contains("katex-html")
    bare = F.when(rendered, F.pandas_udf(_without_rendered, "string")(F.when(rendered, html))).otherwise(html)
    return F.regexp_replace(bare, KATEX_CONTAINER, "$1")


def collapse_blank_lines(text: Column) -> Column:
    once = F.replace(text, F.lit("\n\n"), F.lit("\n"))
    return F.replace(once, F.lit("\n\n"), F.lit("\n"))


SUP_SUB = (("sup", "^"), ("sub", "_"))
SUP_SUB_TEXT = r"(?:[^<]|<(?!/?su[bp]\b))*+"


def sup_sub_patterns() -> list[tuple[str, str]]:
    """Innermost elements that are marked already, and others, with what they become (``\\1`` is the text)."""
    out = []
    for tag, sign in SUP_SUB:
        out.append((rf"(?is)<{tag}(?:\s[^>]*)?>(\{sign}\{{{SUP_SUB_TEXT})</{tag}\s*>", r"\1"))
        out.append((rf"(?is)<{tag}(?:\s[^>]*)?>({SUP_SUB_TEXT})</{tag}\s*>", rf"{sign}{{\1}}"))
    return out


def _all_levels(html: pd.Series) -> pd.Series:
    patterns = [(re.compile(p), to) for p, to in sup_sub_patterns()]

    def whole(page: str | None) -> str | None:
        before = None
        while page is not None and page != before:
            before = page
            for pattern, to in patterns:
                page = pattern.sub(to, page)
        return page

    return html.map(whole)


def sup_sub(html: Column, depth: int = 4) -> Column:
    """Superscripts as ``^{x}`` and subscripts as ``_{x}``, but not twice; innermost first, to any depth.

    ``depth`` levels are done by expressions; only pages with more go to Python.
    """

    def marked(h: Column) -> Column:
        out = h
        for _ in range(depth):
            for pattern, to in sup_sub_patterns():
                out = F.regexp_replace(out, pattern, to.replace("\\1", "$1"))
        return F.when(h.rlike("(?i)<su[bp]"), out).otherwise(h)

    nested = r"(?is)<(su[bp])(?:\s[^>]*)?>" + SUP_SUB_TEXT + r"</\1\s*>"
    once = let(html, marked)
    deeper = html.rlike("(?i)<su[bp]") & once.rlike(nested)
    return F.when(deeper, F.pandas_udf(_all_levels, "string")(F.when(deeper, once))).otherwise(once)


def fraction_span(html: Column) -> Column:
    """Stacked ``intbl`` spans as ``\\frac{a}{b}``, tags inside the parts dropped."""
    part = lambda tag: rf"<{tag}\b[^>]*>((?:[^<]|<(?!/?{tag}\b))*+)</{tag}\s*>"
    pattern = (
        rf"(?is)<span[^>]*class=\"[^\"]*intbl[^\"]*\"[^>]*>[^<]*{part('em')}[^<]*(?:<br\s*/?>)?[^<]*"
        rf"{part('strong')}[^<]*</span\s*>"
    )

    def frac(match: Column) -> Column:
        parts = [strip_tags(F.regexp_extract(match, pattern, i)) for i in (1, 2)]
        return F.concat(F.lit("\\frac{"), parts[0], F.lit("}{"), parts[1], F.lit("}"))

    return let(html, lambda h: F.when(h.contains("intbl"), replace_in_order(h, pattern, frac)).otherwise(h))


def improve_formulas(html: Column) -> Column:
    """All formula steps of a page, in order."""
    return fraction_span(sup_sub(formula_mark(katex_choose(html))))
