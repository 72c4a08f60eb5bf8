"""Pages to text, tables, formulas, and the counters of every drop."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesift.catalog import duck as K
from pagesift.catalog import fixtures as X
from pagesift.functions import formulas as M
from pagesift.functions import html as H
from pagesift.operators import extract as E
from pagesift.operators import stats as S
from pagesift.operators import urls as R
from pagesift.operators.listings import completed_by_dump as finished_per_dump


def extract_text(spark, sf):
    return E.extract_text(X.pages(spark, sf)).select("page_id", "text")


def extract_page(spark, sf):
    """Formulas, tables and text of pages that hold all kinds of markup."""
    return E.extract_page(X.markup_pages(spark, sf), "page_id").select("page_id", "text")


def extract_tables(spark, sf):
    return E.extract_tables(X.markup_pages(spark, sf))


def table_markdown(spark, sf):
    return E.table_texts(X.markup_pages(spark, sf)).select("page_id", "table_no", "markdown")


def table_ascii(spark, sf):
    return E.table_texts(X.markup_pages(spark, sf)).select("page_id", "table_no", "boxed")


def table_widths(spark, sf):
    return E.table_widths(E.extract_tables(X.markup_pages(spark, sf)))


def table_replace(spark, sf):
    return E.table_replace(X.markup_pages(spark, sf))


def extract_formulas(spark, sf):
    return E.extract_formulas(X.markup_pages(spark, sf))


def formula_mark(spark, sf):
    return X.markup_pages(spark, sf).select("page_id", M.formula_mark(F.col("html")).alias("html"))


def katex_choose(spark, sf):
    return X.markup_pages(spark, sf).select("page_id", M.katex_choose(F.col("html")).alias("html"))


def mathml_blocks(spark, sf):
    return E.mathml_blocks(X.markup_pages(spark, sf))


def blank_lines(spark, sf):
    """Double line ends collapsed twice, in the documents with every line end doubled twice."""
    spaced = F.replace(F.col("text"), F.lit("\n"), F.lit("\n\n\n\n"))
    return X.documents(spark, sf).select("doc_id", M.collapse_blank_lines(spaced).alias("text"))


def mathml_profile(spark, sf):
    return E.mathml_profile(X.markup_pages(spark, sf))


def mathml_profile_by_page(spark, sf):
    return E.mathml_profile(X.markup_pages(spark, sf), "page_id")


_FORMULA = (
    "concat(CASE p_partkey % 4 WHEN 0 THEN concat(' {{\\displaystyle x_', p_size, '}} ') "
    "WHEN 1 THEN concat('a + ', p_size) WHEN 2 THEN '  ' ELSE concat('{{\\displaystyle {{\\displaystyle y', p_size, '}}}}') END)"
).replace("{{", "{").replace("}}", "}")


def _part_formulas(spark, sf, expression):
    return X.scan(spark, sf, "part").selectExpr("p_partkey", expression.replace("\\", "\\\\") + " AS t")


def formula_clean(spark, sf):
    return _part_formulas(spark, sf, _FORMULA).select("p_partkey", M.formula_clean(F.col("t")).alias("tex"))


_STYLED = (
    "CASE p_partkey % 4 WHEN 0 THEN concat('see $\\displaystyle x_', p_size, '$ and $\\textstyle b$') "
    "WHEN 1 THEN concat('${\\displaystyle y^', p_size, '}$') WHEN 2 THEN concat('${\\textstyle {z', p_size, '}}$ end') "
    "ELSE concat('$plain_', p_size, '$') END"
)


def formula_destyle(spark, sf):
    return _part_formulas(spark, sf, _STYLED).select("p_partkey", M.formula_destyle(F.col("t")).alias("tex"))


_BLOCK = (
    "CASE p_partkey % 3 WHEN 0 THEN concat('<?xml version=\"1.0\"?> <math><mi>oldsymbol{x}</mi><mn>', p_size, '</mn></math>') "
    "WHEN 1 THEN concat('<math xmlns=\"http://www.w3.org/1998/Math/MathML\"><mi>\\boldsymbol{x}</mi><mn>', p_size, '</mn></math>') "
    "ELSE concat('<math display=\"block\"><mn>', p_size, '</mn></math><math/>') END"
)


def mathml_clean(spark, sf):
    return _part_formulas(spark, sf, _BLOCK).select("p_partkey", M.mathml_clean(F.col("t")).alias("block"))


def sup_sub(spark, sf):
    return X.markup_pages(spark, sf).select("page_id", M.sup_sub(F.col("html")).alias("html"))


def fraction_span(spark, sf):
    return X.markup_pages(spark, sf).select("page_id", M.fraction_span(F.col("html")).alias("html"))


def decode_entities(spark, sf):
    return X.pages(spark, sf).select("page_id", H.decode_entities(F.col("html")).alias("html"))


# ---- counters ----


def _funnel(spark, sf):
    """Pages with the class in which they drop out of the first part of the job, and their archive."""
    judged = R.url_disposition(X.pages(spark, sf), X.rules(spark, sf))
    text = F.when(F.col("url_disposition") == R.KEPT, H.extract_text(F.col("html")))
    staged = judged.withColumn("text", text)
    step = (
        F.when(F.col("url_disposition") != R.KEPT, S.URL_FILTERED)
        .when(F.coalesce("html", F.lit("")) == "", S.BODY_EMPTY)
        .when(F.col("text") == "", S.EXTRACTION_EMPTY)
        .otherwise(S.REMAINING)
    )
    archives = X.listing(spark, sf).select("page_id", F.concat(F.lit("crawl-data/"), "dump", F.lit("/"), F.col("page_id") % 25).alias("file_path"))
    return staged.withColumn("disposition", step).join(archives, "page_id")


def funnel_stats(spark, sf):
    return S.funnel_stats(_funnel(spark, sf), ["file_path"])


def funnel_rollup(spark, sf):
    return S.funnel_rollup(S.funnel_stats(_funnel(spark, sf), ["file_path"]))


def completed_by_dump(spark, sf):
    return finished_per_dump(X.listing(spark, sf).select(F.col("value").alias("cc_path")))


QUERIES = {
    f.__name__: f
    for f in (
        extract_text, extract_page, extract_tables, table_markdown, table_ascii, table_widths, table_replace,
        extract_formulas, formula_mark, katex_choose, mathml_blocks, blank_lines, mathml_profile,
        mathml_profile_by_page, formula_clean, formula_destyle, mathml_clean, sup_sub, fraction_span,
        decode_entities, funnel_stats, funnel_rollup, completed_by_dump,
    )
}

# ---- SQL ----

_TABLE = r"(?is)<table(?:\s[^>]*)?>.*?</table\s*>"
_ROW = r"(?is)<tr(?:\s[^>]*)?>(.*?)</tr\s*>"
_TH = r"(?is)<th(?:\s[^>]*)?>(.*?)</th\s*>"
_TD = r"(?is)<td(?:\s[^>]*)?>(.*?)</td\s*>"


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^\s+|\s+$', '', 'g')"


def tables_ctes(source: str = "markup") -> str:
    """Ends in ``tabs(page_id, table_no, raw, nested)`` and ``cells(..., row_no, is_header, col_no, cell)``."""
    found = f"regexp_extract_all(html, {K.q(_TABLE)})"
    tr, th, td = (f"regexp_extract_all({c}, {K.q(p)}, 1)" for c, p in (("raw", _ROW), ("raw", _TH), ("r", _TD)))
    keys = "page_id, table_no, row_no, col_no"
    return (
        f"tabs AS MATERIALIZED (SELECT page_id, generate_subscripts({found}, 1) - 1 AS table_no, unnest({found}) AS raw FROM {source}), "
        f"trs AS (SELECT page_id, table_no, generate_subscripts({tr}, 1) AS i, unnest({tr}) AS r FROM tabs), "
        f"trs2 AS (SELECT page_id, table_no, r, row_number() OVER (PARTITION BY page_id, table_no ORDER BY i) - 1 AS row_no "
        f"FROM trs WHERE len({td}) > 0), "
        f"c0 AS (SELECT page_id, table_no, row_no, generate_subscripts({td}, 1) - 1 AS col_no, unnest({td}) AS t FROM trs2 "
        f"UNION ALL SELECT page_id, table_no, -1, generate_subscripts({th}, 1) - 1, unnest({th}) FROM tabs), "
        f"cs AS (SELECT {keys}, regexp_replace(t, '<[a-zA-Z/!?][^>]*>', '', 'g') AS t FROM c0), "
        f"{K.decode_ctes('cs', keys, 'cd')}, "
        f"cells AS (SELECT {keys}, row_no < 0 AS is_header, {_strip('t')} AS cell FROM cd4)"
    )


_NESTED = r"regexp_matches(raw, '(?is)^<table.*<table[\s>]')"
_MARKDOWN = (
    "mrows AS (SELECT page_id, table_no, row_no, '| ' || string_agg(CASE WHEN row_no < 0 THEN cell ELSE "
    + _strip("replace(cell, chr(10), ' ')")
    + " END, ' | ' ORDER BY col_no) || ' |' || CASE WHEN row_no < 0 THEN chr(10) || '| ' || string_agg('---', ' | ') || ' |' ELSE '' END AS line, "
    "bool_or(cell <> '') AS filled FROM cells GROUP BY page_id, table_no, row_no), "
    "md AS (SELECT page_id, table_no, string_agg(line, chr(10) ORDER BY row_no) AS markdown FROM mrows WHERE filled OR row_no < 0 GROUP BY ALL), "
    "markdowns AS (SELECT page_id, table_no, coalesce(markdown, '') AS markdown FROM tabs LEFT JOIN md USING (page_id, table_no) WHERE NOT "
    + _NESTED + ")"
)
_LEFT = "(w - length(s)) // 2 + CASE WHEN (w - length(s)) % 2 = 1 AND length(s) % 2 = 0 THEN 1 ELSE 0 END"
_BOXED = (
    "sz AS (SELECT page_id, table_no, row_no, count(*) AS n, count(DISTINCT cell) AS d FROM cells GROUP BY ALL), "
    "hd AS (SELECT * FROM sz WHERE row_no < 0 AND n = d), "
    "fit AS (SELECT hd.page_id, hd.table_no FROM hd JOIN tabs USING (page_id, table_no) WHERE NOT " + _NESTED
    + " AND NOT EXISTS (SELECT 1 FROM sz WHERE sz.page_id = hd.page_id AND sz.table_no = hd.table_no AND sz.n <> hd.n)), "
    "ln AS (SELECT page_id, table_no, row_no, col_no, unnest(string_split(cell, chr(10))) AS s, "
    "generate_subscripts(string_split(cell, chr(10)), 1) - 1 AS k FROM cells JOIN fit USING (page_id, table_no)), "
    "wd AS (SELECT page_id, table_no, col_no, max(length(s)) AS w FROM ln GROUP BY ALL), "
    "ht AS (SELECT page_id, table_no, row_no, unnest(range(max(k) + 1)) AS k FROM ln GROUP BY page_id, table_no, row_no), "
    "grid AS (SELECT ht.page_id, ht.table_no, ht.row_no, ht.k, wd.col_no, wd.w, coalesce(ln.s, '') AS s FROM ht "
    "JOIN wd USING (page_id, table_no) LEFT JOIN ln ON ln.page_id = ht.page_id AND ln.table_no = ht.table_no "
    "AND ln.row_no = ht.row_no AND ln.k = ht.k AND ln.col_no = wd.col_no), "
    f"bl AS (SELECT page_id, table_no, row_no, k, '|' || string_agg(' ' || repeat(' ', {_LEFT}) || s || "
    f"repeat(' ', (w - length(s)) - ({_LEFT})) || ' ', '|' ORDER BY col_no) || '|' AS line FROM grid GROUP BY ALL), "
    "ru AS (SELECT page_id, table_no, '+' || string_agg(repeat('-', w + 2), '+' ORDER BY col_no) || '+' AS rule FROM wd GROUP BY ALL), "
    "bx AS (SELECT page_id, table_no, rule || chr(10) || string_agg(CASE WHEN row_no < 0 THEN line END, chr(10) ORDER BY k) || chr(10) || rule || "
    "coalesce(chr(10) || string_agg(CASE WHEN row_no >= 0 THEN line END, chr(10) ORDER BY row_no, k), '') || chr(10) || rule AS boxed "
    "FROM bl JOIN ru USING (page_id, table_no) GROUP BY page_id, table_no, rule), "
    "boxes AS (SELECT page_id, table_no, boxed FROM tabs LEFT JOIN bx USING (page_id, table_no) WHERE NOT " + _NESTED + ")"
)
_ESCAPED = "replace(replace(replace({t}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def replaced_ctes(source: str = "markup") -> str:
    """Ends in ``replaced(page_id, html)``."""
    segments = f"string_split_regex(html, {K.q(_TABLE)})"
    choice = "('0x' || substr(md5(page_id || ':' || table_no), 1, 1))::INT % 2"
    return (
        f"{tables_ctes(source)}, {_MARKDOWN}, {_BOXED}, "
        f"outs AS (SELECT tabs.page_id, tabs.table_no, CASE WHEN {choice.replace('page_id', 'tabs.page_id').replace('table_no', 'tabs.table_no')} = 0 "
        "THEN boxed ELSE markdown END AS o FROM tabs LEFT JOIN markdowns USING (page_id, table_no) LEFT JOIN boxes USING (page_id, table_no)), "
        "good AS (SELECT page_id, bool_and(o IS NOT NULL) AS ok FROM outs GROUP BY ALL), "
        f"segs AS (SELECT page_id, generate_subscripts({segments}, 1) - 1 AS i, unnest({segments}) AS seg FROM {source}), "
        "built AS (SELECT segs.page_id, string_agg(seg || coalesce('<pre class=\"converted-table\">' || chr(10) || "
        f"{_ESCAPED.format(t='o')} || chr(10) || '</pre>', ''), '' ORDER BY i) AS html FROM segs LEFT JOIN outs "
        "ON outs.page_id = segs.page_id AND outs.table_no = segs.i GROUP BY segs.page_id), "
        f"replaced AS (SELECT s.page_id, CASE WHEN coalesce(ok, true) THEN built.html ELSE s.html END AS html FROM {source} s "
        "JOIN built USING (page_id) LEFT JOIN good USING (page_id))"
    )


_MATH = r"(?is)<(?:mml:)?math(?:\s[^>]*)?>.*?</(?:mml:)?math\s*>"
_KATEX = (
    r"(?is)<span[^>]*class=\"katex\"[^>]*>\s*<span[^>]*class=\"katex-mathml\"[^>]*>\s*(<math(?:\s[^>]*)?>.*?</math\s*>)\s*</span>"
    r"(?:\s*<span[^>]*class=\"katex-html\"[^>]*>[^<]*</span>)?\s*</span>"
)
_BLANKS = r"\s+"
_ANNOTATION = r'(?is)<annotation[^>]*encoding="application/x-tex"[^>]*>(.*?)</annotation\s*>'
_ALTTEXT = r'(?is)^<(?:mml:)?math\s(?:[^>]*\s)?alttext="([^"]*)"'


def _clean_sql(t: str) -> str:
    """``t`` must be a column that is stripped already."""
    bare = (
        rf"CASE WHEN starts_with({t}, '{{\displaystyle') THEN regexp_replace(replace({t}, '{{\displaystyle', ''), '\}}$', '') ELSE {t} END"
    )
    return f"CASE WHEN {_strip(bare)} = '' THEN '' ELSE '$' || {_strip(bare)} || '$' END"


def formula_ctes(source: str, katex: bool) -> str:
    """Ends in ``formulas(page_id, formula_no, kind, tex)``."""
    html = K.rx("html", _KATEX, r"\1") if katex else "html"
    found = f"regexp_extract_all(h, {K.q(_MATH)})"
    keys = "page_id, formula_no, kind"
    symbols = "".join(f"WHEN '{c}' THEN '{x}' " for c, x in (("α", r"\alpha "), ("⋯", r"\cdots "), ("ℝ", r"\mathbb{R}")))
    return (
        f"fh AS (SELECT page_id, {html} AS h FROM {source}), "
        f"fr AS MATERIALIZED (SELECT page_id, generate_subscripts({found}, 1) - 1 AS formula_no, unnest({found}) AS raw FROM fh), "
        f"fk AS (SELECT page_id, formula_no, raw, CASE WHEN regexp_matches(raw, '(?is)^<math[^>]*class=\"katex-mathml\"') THEN 'skipped' "
        f"WHEN regexp_extract(raw, {K.q(_ANNOTATION)}, 1) <> '' THEN 'annotation' WHEN regexp_matches(raw, {K.q(_ALTTEXT)}) THEN 'alttext' ELSE 'mathml' END AS kind FROM fr), "
        f"ft AS (SELECT {keys}, CASE kind WHEN 'annotation' THEN regexp_extract(raw, {K.q(_ANNOTATION)}, 1) WHEN 'alttext' THEN regexp_extract(raw, {K.q(_ALTTEXT)}, 1) "
        f"ELSE {K.rx(K.rx('raw', r'(?is)<annotation[^>]*>.*?</annotation[^>]*>'), '<[a-zA-Z/!?][^>]*>')} END AS t FROM fk), "
        f"{K.decode_ctes('ft', keys, 'fd')}, "
        f"fs AS (SELECT {keys}, CASE WHEN kind = 'mathml' THEN {_strip(K.rx('t', _BLANKS, ' '))} ELSE {_strip('t')} END AS t FROM fd4), "
        f"fm AS (SELECT {keys}, CASE WHEN kind = 'mathml' THEN replace(array_to_string(list_transform(regexp_extract_all(t, '(?s).'), lambda c_: CASE c_ {symbols} ELSE c_ END), ''), ' }}', '}}') ELSE t END AS t FROM fs), "
        f"formulas AS (SELECT {keys}, CASE kind WHEN 'skipped' THEN NULL WHEN 'mathml' THEN CASE WHEN t = '' THEN '' ELSE '$' || t || '$' END "
        f"ELSE {_clean_sql('t')} END AS tex FROM fm)"
    )


def _sup_sub_sql(html: str) -> str:
    out = html
    for tag, sign in (("sup", "^"), ("sub", "_")):
        out = K.rx(out, rf"(?is)<{tag}(?:\s[^>]*)?>(\{sign}\{{.*?)</{tag}\s*>", r"\1")
        out = K.rx(out, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}\s*>", rf"{sign}{{\1}}")
    return out


_FRACTION = (
    r'(?is)<span[^>]*class="[^"]*intbl[^"]*"[^>]*>[^<]*<em[^>]*>([^<]*)</em\s*>[^<]*(?:<br\s*/?>)?[^<]*'
    r"<strong[^>]*>([^<]*)</strong\s*>[^<]*</span\s*>"
)


def _fraction_sql(html: str) -> str:
    return K.rx(html, _FRACTION, r"\\frac{\1}{\2}")


def marked_ctes(source: str, katex: bool) -> str:
    """Ends in ``marked(page_id, html)``."""
    gaps = f"string_split_regex(h, {K.q(_MATH)})"
    return (
        f"{formula_ctes(source, katex)}, "
        f"fg AS (SELECT page_id, generate_subscripts({gaps}, 1) - 1 AS i, unnest({gaps}) AS gap FROM fh), "
        "marked AS (SELECT fg.page_id, string_agg(gap || coalesce('<span class=\"math-text\">' || "
        f"{_ESCAPED.format(t='tex')} || '</span>', raw, ''), '' ORDER BY i) AS html FROM fg "
        "LEFT JOIN formulas f ON f.page_id = fg.page_id AND f.formula_no = fg.i "
        "LEFT JOIN fr ON fr.page_id = fg.page_id AND fr.formula_no = fg.i GROUP BY fg.page_id)"
    )


_M = f"WITH {X.markup_sql()}"
_TAGS = (
    f"tags AS (SELECT page_id, unnest(regexp_extract_all(array_to_string(regexp_extract_all(html, {K.q(_MATH)}), ''), "
    "'(?i)<(?:mml:)?(m[a-z]+)', 1)) AS tag FROM markup)"
)
_COUNTERS = ", ".join(
    ["count(*) AS doc_input"]
    + [f"count(*) FILTER (disposition = '{c}') AS {c}" for c in S.DROP_CLASSES]
    + ["0::BIGINT AS math_retained", "count(*) FILTER (disposition = 'doc_remaining') AS doc_remaining"]
)
_FUNNEL = (
    f"{X.JUDGED}, {X.LISTING}, {K.extract_text_ctes('pages', 'page_id')}, "
    "steps AS (SELECT 'crawl-data/' || dump || '/' || (page_id % 25) AS file_path, CASE WHEN url_disposition <> 'kept' THEN 'url_filtered' "
    "WHEN coalesce(html, '') = '' THEN 'html_content_empty' WHEN text = '' THEN 'doc_extraction_empty' ELSE 'doc_remaining' END AS disposition "
    "FROM judged JOIN pages USING (page_id) JOIN extracted USING (page_id) JOIN listing USING (page_id)), "
    f"funnel AS (SELECT file_path, {_COUNTERS} FROM steps GROUP BY ALL)"
)
_PRE_TEXT = (
    # Text of pages whose "pre" blocks keep their line ends: blanks there are control characters meanwhile.
    "pieces AS (SELECT page_id, generate_subscripts({s}, 1) - 1 AS i, unnest({s}) AS gap FROM improved), "
    "pres AS (SELECT page_id, generate_subscripts({f}, 1) - 1 AS i, unnest({f}) AS pre FROM improved), "
    "kept AS (SELECT pieces.page_id, string_agg(gap || coalesce(replace(translate(pre, chr(10) || ' ', chr(1) || chr(2)), '<pre' || chr(2), '<pre '), ''), '' ORDER BY pieces.i) AS html "
    "FROM pieces LEFT JOIN pres ON pres.page_id = pieces.page_id AND pres.i = pieces.i GROUP BY pieces.page_id)"
)
_PRE = r"(?is)<pre(?:\s[^>]*)?>.*?</pre\s*>"

SQL = {
    "extract_text": f"WITH {K.extract_text_ctes('pages', 'page_id')} SELECT page_id, text FROM extracted",
    "extract_tables": f"{_M}, {tables_ctes()} SELECT page_id, table_no, row_no, is_header, col_no, cell FROM cells",
    "table_markdown": f"{_M}, {tables_ctes()}, {_MARKDOWN} SELECT page_id, table_no, markdown FROM markdowns",
    "table_ascii": f"{_M}, {tables_ctes()}, {_BOXED} SELECT page_id, table_no, boxed FROM boxes",
    "table_widths": f"{_M}, {tables_ctes()} SELECT page_id, table_no, col_no, max(length(cell)) AS width FROM cells GROUP BY ALL",
    "table_replace": f"{_M}, {replaced_ctes()} SELECT page_id, html FROM replaced",
    "extract_formulas": f"{_M}, {formula_ctes('markup', True)} SELECT page_id, formula_no, kind, tex FROM formulas",
    "formula_mark": f"{_M}, {marked_ctes('markup', False)} SELECT page_id, html FROM marked",
    "katex_choose": f"{_M} SELECT page_id, " + K.rx("html", _KATEX, r"\1") + " AS html FROM markup",
    "mathml_blocks": f"{_M}, b AS (SELECT page_id, regexp_extract_all(html, '<!--\\[if mathML\\]>(.*?)<!\\[endif\\]-->', 1) AS b FROM markup) "
    "SELECT page_id, generate_subscripts(b, 1) - 1 AS block_no, unnest(b) AS block FROM b",
    "blank_lines": "SELECT doc_id, replace(text, chr(10), chr(10) || '') AS text FROM documents",
    "mathml_profile": f"{_M}, {_TAGS} SELECT lower(tag) AS tag, count(*) AS n FROM tags GROUP BY 1",
    "mathml_profile_by_page": f"{_M}, {_TAGS} SELECT page_id, lower(tag) AS tag, count(*) AS n FROM tags GROUP BY 1, 2",
    "formula_clean": f"WITH f AS (SELECT p_partkey, {_strip(_FORMULA)} AS t FROM part) SELECT p_partkey, {_clean_sql('t')} AS tex FROM f",
    "formula_destyle": "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'see $x_' || p_size || '$ and $b$' "
    "WHEN 1 THEN '$y^' || p_size || '$' WHEN 2 THEN '$z' || p_size || '$ end' ELSE '$plain_' || p_size || '$' END AS tex FROM part",
    "mathml_clean": "SELECT p_partkey, CASE p_partkey % 3 "
    "WHEN 0 THEN '<math xmlns=\"http://www.w3.org/1998/Math/MathML\"><mi>\\boldsymbol{x}</mi><mn>' || p_size || '</mn></math>' "
    "WHEN 1 THEN '<math xmlns=\"http://www.w3.org/1998/Math/MathML\"><mi>\\boldsymbol{x}</mi><mn>' || p_size || '</mn></math>' "
    "ELSE '<math xmlns=\"http://www.w3.org/1998/Math/MathML\" display=\"block\"><mn>' || p_size || '</mn></math><math/>' END AS block FROM part",
    "sup_sub": f"{_M} SELECT page_id, {_sup_sub_sql('html')} AS html FROM markup",
    "fraction_span": f"{_M} SELECT page_id, {_fraction_sql('html')} AS html FROM markup",
    "decode_entities": f"WITH src AS (SELECT page_id, html AS t FROM pages), {K.decode_ctes('src', 'page_id', 'd')} SELECT page_id, t AS html FROM d4",
    "extract_page": f"{_M}, {marked_ctes('markup', True)}, "
    f"mk AS (SELECT page_id, {_fraction_sql(_sup_sub_sql('html'))} AS html FROM marked), "
    f"{replaced_ctes('mk')}, improved AS (SELECT * FROM replaced), "
    + _PRE_TEXT.format(s=f"string_split_regex(html, {K.q(_PRE)})", f=f"regexp_extract_all(html, {K.q(_PRE)})")
    + f", {K.extract_text_ctes('kept', 'page_id')} SELECT page_id, translate(text, chr(1) || chr(2), chr(10) || ' ') AS text FROM extracted",
    "funnel_stats": f"WITH {_FUNNEL} SELECT * FROM funnel",
    "funnel_rollup": f"WITH {_FUNNEL}, tagged AS (SELECT regexp_extract(file_path, '(CC-MAIN-[0-9]{{4}}-[0-9]+)', 1) AS dump, * FROM funnel) "
    "SELECT dump, file_path, " + ", ".join(f"sum({c})::BIGINT AS {c}" for c in S.COUNTERS) + " FROM tagged GROUP BY ROLLUP (dump, file_path)",
    "completed_by_dump": f"WITH {X.LISTING} SELECT dump, count(DISTINCT value) AS n_files FROM listing GROUP BY dump",
}
