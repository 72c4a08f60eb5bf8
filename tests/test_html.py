import pytest
from pyspark.sql import functions as F

from pagesift.functions import formulas as M
from pagesift.functions import html as H
from pagesift.functions import tables as X
from pagesift.operators import extract as E


def h(fn):
    return lambda: fn(F.col("t"))


@pytest.mark.parametrize(
    "html, text",
    [
        ("<p>a <b>b</b></p><p>c</p>", "a b\nc"),
        ("<html><head><title>x</title></head><body>hi<!-- no --></body></html>", "hi"),
        ("<script>var a='</p>';</script><STYLE>p{}</STYLE>text", "text"),
        ("a<br>b<br/>c", "a\nb\nc"),
        ("<ul><li>1</li><li>2</li></ul>", "1\n2"),
        ("<a href='x'>link</a> <img alt='no'>", "link"),
        ("1 &lt; 2 &amp;&amp; x&nbsp;y &#8594; &#x41;", "1 < 2 && x y → A"),
        ("&amp;lt;", "&lt;"),
        ("&#0;&#xD800;&#99999999;", "&#0;&#xD800;&#99999999;"),
        ("", ""),
        ("<div> </div>", ""),
    ],
)
def test_extract_text(one, html, text):
    assert one(h(H.extract_text), t=html) == text


def test_preformatted_text_keeps_its_lines(one):
    assert one(h(H.extract_preformatted_text), t="<p>a\n  b</p><pre class='x'>1\n  2</pre>c") == "a b\n1\n  2\nc"


TABLE = "<table><tr><th>Name</th><th>No</th></tr><tr><td> a </td><td>12</td></tr><tr><td></td><td> </td></tr><tr><td>b\nc</td><td>&lt;3</td></tr></table>"


def test_markdown(one):
    assert one(lambda: X.markdown(X.parse_table(F.col("t"))), t=TABLE) == (
        "| Name | No |\n| --- | --- |\n| a | 12 |\n| b c | <3 |"
    )
    assert one(lambda: X.markdown(X.parse_table(F.col("t"))), t="<table><tr><td>1</td></tr></table>") == "| 1 |"


def test_boxed(one):
    assert one(lambda: X.ascii_box(X.parse_table(F.col("t"))), t=TABLE) == "\n".join(
        [
            "+------+----+",
            "| Name | No |",
            "+------+----+",
            "|  a   | 12 |",
            "|      |    |",
            "|  b   | <3 |",
            "|  c   |    |",
            "+------+----+",
        ]
    )


@pytest.mark.parametrize(
    "html",
    [
        "<table><tr><td>1</td></tr></table>",
        "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td></tr></table>",
        "<table><tr><th>a</th><th>a</th></tr><tr><td>1</td><td>2</td></tr></table>",
    ],
)
def test_no_box_for_uneven_tables(one, html):
    assert one(lambda: X.ascii_box(X.parse_table(F.col("t"))), t=html) is None


def test_replace_keeps_the_text_around(one):
    got = one(lambda: X.table_replace(F.col("t"), F.lit("k")), t=f"before {TABLE} after")
    assert got.startswith('before <pre class="converted-table">\n') and got.endswith("\n</pre> after")
    assert "&lt;3" in got and "<table" not in got


def test_one_bad_table_leaves_the_page(one):
    nested = f"{TABLE}<table><tr><td><table><tr><td>x</td></tr></table></td></tr></table>"
    assert one(lambda: X.table_replace(F.col("t"), F.lit("k")), t=nested) == nested


def test_both_formats_occur(spark):
    pages = spark.createDataFrame([(i, TABLE) for i in range(40)], "page_id long, html string")
    got = [r["html"] for r in E.table_replace(pages).collect()]
    assert 5 < sum("+------+" in g for g in got) < 35


@pytest.mark.parametrize(
    "tex, clean",
    [
        (r" {\displaystyle x^2} ", "$x^2$"),
        (r"{\displaystyle }", ""),
        ("  ", ""),
        (" a ", "$a$"),
        (r"{\displaystyle a}{\displaystyle b}", "$a} b$"),
    ],
)
def test_formula_clean(one, tex, clean):
    assert one(h(M.formula_clean), t=tex) == clean


@pytest.mark.parametrize(
    "tex, plain",
    [
        (r"$\displaystyle x$", "$x$"),
        (r"${\textstyle x}$", "$x$"),
        (r"${\displaystyle {x}}$", "$x$"),
        (r"$a$ and $\displaystyle b$", "$a$ and $b$"),
        (r"$\displaystyle {x}$", "${x$"),
        ("$plain$", "$plain$"),
    ],
)
def test_formula_destyle(one, tex, plain):
    assert one(h(M.formula_destyle), t=tex) == plain


ANNOTATED = '<math alttext="no"><mi>x</mi><annotation encoding="application/x-tex">{\\displaystyle x&lt;y}</annotation></math>'


@pytest.mark.parametrize(
    "html, kind, tex",
    [
        (ANNOTATED, "annotation", "$x<y$"),
        ('<math display="block" alttext="k &gt; 1"><mi>k</mi></math>', "alttext", "$k > 1$"),
        ('<math alttext=""><mi>k</mi></math>', "alttext", ""),
        ("<math><mi>α</mi> <mo>⋮</mo></math>", "mathml", r"$\alpha  \vdots $"),
        ("<math><mspace/></math>", "mathml", ""),
        ('<math class="katex-mathml"><mi>k</mi></math>', "skipped", None),
    ],
)
def test_formula_parts(one, html, kind, tex):
    got = one(h(M.formula_parts), t=html)
    assert (got["kind"], got["tex"]) == (kind, tex)


def test_formula_mark_in_place(one):
    page = f"<p>a {ANNOTATED} b <math class=\"katex-mathml\"><mi>k</mi></math> c</p>"
    assert one(h(M.formula_mark), t=page) == (
        '<p>a <span class="math-text">$x&lt;y$</span> b <math class="katex-mathml"><mi>k</mi></math> c</p>'
    )


def test_katex_container(one):
    page = '<b/><span class="katex"><span class="katex-mathml"><math><mi>z</mi></math></span><span class="katex-html">z</span></span>!'
    assert one(h(M.katex_choose), t=page) == "<b/><math><mi>z</mi></math>!"


def test_mathml_clean(one):
    assert one(h(M.mathml_clean), t='<?xml version="1.0"?>\n<math><mi>oldsymbol{x}</mi></math><math/>') == (
        '<math xmlns="http://www.w3.org/1998/Math/MathML"><mi>\\boldsymbol{x}</mi></math><math/>'
    )


def test_sup_sub_and_fraction(one):
    assert one(h(M.sup_sub), t="x<sup>2</sup><sub>i</sub><sup>^{3}</sup>") == "x^{2}_{i}^{3}"
    assert one(h(M.fraction_span), t='<span class="intbl"><em>a</em><strong>b</strong></span>') == r"\frac{a}{b}"
    assert one(h(M.fraction_span), t='<span class="intbl"><em>a</em></span>') == '<span class="intbl"><em>a</em></span>'


def test_blocks_and_profile(spark):
    page = "t <!--[if mathML]><mml:math><mml:mi>f</mml:mi><mml:mfrac></mml:mfrac></mml:math><![endif]--> u"
    pages = spark.createDataFrame([(1, page), (2, "none")], "page_id long, html string")
    assert [tuple(r) for r in E.mathml_blocks(pages).collect()] == [
        (1, 0, "<mml:math><mml:mi>f</mml:mi><mml:mfrac></mml:mfrac></mml:math>")
    ]
    assert {r["tag"]: r["n"] for r in E.mathml_profile(pages).collect()} == {"math": 1, "mi": 1, "mfrac": 1}


def test_cells(spark):
    pages = spark.createDataFrame([(1, TABLE)], "page_id long, html string")
    cells = E.extract_tables(pages)
    assert cells.where("is_header").count() == 2 and cells.where("not is_header").count() == 6
    widths = {r["col_no"]: r["width"] for r in E.table_widths(cells).collect()}
    assert widths == {0: 4, 1: 2}


def test_whole_page(spark):
    page = f"<html><body><h1>T</h1>{ANNOTATED}{TABLE}x<sup>2</sup></body></html>"
    got = E.extract_page(spark.createDataFrame([("a", page)], "k string, html string"), "k").first()["text"]
    lines = got.split("\n")
    assert lines[0] == "T" and lines[1] == "$x<y$" and lines[-1] == "x^{2}" and "Name" in got


def test_references_without_semicolon(one):
    decode = lambda text: one(lambda: H.decode_entities(F.col("t")), t=text)
    assert decode("&copy 2020 &copy2020 &nbsp&lt;b&gt &#169 &#xA9 x &notin; &notit &hellip &unknown &amp;copy") == "© 2020 ©2020  <b> © © x ∉ ¬it &hellip &unknown &copy"


def test_any_depth_of_sup_and_sub(one):
    def nested(n):
        return "a" if n == 0 else f"a<sub>{nested(n - 1)}</sub>"

    def want(n):
        return "a" if n == 0 else f"a_{{{want(n - 1)}}}"

    for n in (1, 4, 6, 12):
        assert one(lambda: M.sup_sub(F.col("t")), t=nested(n) + " x<sup>2</sup>") == want(n) + " x^{2}"
    assert one(lambda: M.sup_sub(F.col("t")), t="x<sup>open") == "x<sup>open"
