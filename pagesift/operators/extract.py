"""Page-level jobs: text, tables and formulas as tables of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.functions import formulas as M
from pagesift.functions import html as H
from pagesift.functions import tables as X


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add ``text``; empty text is its own drop class downstream."""
    return pages.withColumn("text", H.extract_text(F.col(html)))


def extract_page(pages: DataFrame, key: str, html: str = "html", out: str = "text") -> DataFrame:
    """Formulas, then tables, then text: the whole extraction of a page.

    The costly steps run only on pages that contain the markup they work on.
    """
    raw = F.col(html)
    has_formula = raw.rlike(r"(?i)<(?:mml:)?math[\s>]|katex|<su[bp][\s>]|intbl")
    staged = pages.withColumn("_marked", F.when(has_formula, M.improve_formulas(raw)).otherwise(raw))
    marked = F.col("_marked")
    has_table = marked.rlike(r"(?i)<table[\s>]")
    staged = staged.withColumn("_tables", F.when(has_table, X.table_replace(marked, F.col(key))).otherwise(marked))
    return staged.withColumn(out, H.extract_preformatted_text(F.col("_tables"))).drop("_marked", "_tables")


def page_tables(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per table: ``key``, ``table_no``, ``raw``."""
    return pages.select(key, F.posexplode(X.table_raws(F.col(html))).alias("table_no", "raw"))


def extract_tables(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per cell ``(key, table_no, row_no, col_no, is_header, cell)``; header cells are row -1."""
    parsed = page_tables(pages, key, html).select(key, "table_no", X.parse_table(F.col("raw")).alias("t"))
    grid = F.concat(
        F.when(F.size("t.headers") > 0, F.array(F.struct(F.lit(-1).alias("row_no"), F.col("t.headers").alias("cells")))).otherwise(
            F.array().cast("array<struct<row_no:int,cells:array<string>>>")
        ),
        F.transform("t.rows", lambda r, i: F.struct(i.alias("row_no"), r.alias("cells"))),
    )
    lines = parsed.select(key, "table_no", F.explode(grid).alias("g"))
    return lines.select(
        key,
        "table_no",
        F.col("g.row_no").alias("row_no"),
        (F.col("g.row_no") < 0).alias("is_header"),
        F.posexplode("g.cells").alias("col_no", "cell"),
    )


def table_texts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Both text forms of every table that has no table inside."""
    raws = page_tables(pages, key, html).where(~X.is_nested(F.col("raw")))
    parsed = raws.select(key, "table_no", X.parse_table(F.col("raw")).alias("t"))
    return parsed.select(
        key, "table_no", X.markdown(F.col("t")).alias("markdown"), X.ascii_box(F.col("t")).alias("boxed")
    )


def table_widths(cells: DataFrame, key: str = "page_id") -> DataFrame:
    """Width of each column of each table: its longest cell."""
    return cells.groupBy(key, "table_no", "col_no").agg(F.max(F.length("cell")).alias("width"))


def table_replace(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return pages.withColumn(html, X.table_replace(F.col(html), F.col(key)))


def extract_formulas(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per formula: ``key``, ``formula_no``, ``kind``, ``tex``."""
    found = F.regexp_extract_all(M.katex_choose(F.col(html)), F.lit(M.MATH), 0)
    formulas = pages.select(key, F.posexplode(found).alias("formula_no", "raw"))
    return formulas.select(key, "formula_no", M.formula_parts(F.col("raw")).alias("p")).select(
        key, "formula_no", "p.kind", "p.tex"
    )


def mathml_blocks(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Conditional-comment MathML blocks: ``key``, ``block_no``, ``block``."""
    blocks = F.regexp_extract_all(F.col(html), F.lit(M.BLOCK), 1)
    return pages.select(key, F.posexplode(blocks).alias("block_no", "block"))


def mathml_profile(pages: DataFrame, key: str | None = None, html: str = "html") -> DataFrame:
    """How often each MathML element opens, per page or (``key=None``) in the corpus."""
    inside = F.array_join(F.regexp_extract_all(F.col(html), F.lit(M.MATH), 0), "")
    tags = F.transform(F.regexp_extract_all(inside, F.lit(M.MATHML_TAG), 1), lambda t: F.lower(t))
    group = [key] if key else []
    return (
        pages.select(*group, F.explode(tags).alias("tag"))
        .groupBy(*group, "tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )
