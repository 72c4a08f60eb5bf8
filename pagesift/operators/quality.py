"""Line and document quality rules after published web-corpus recipes. All numbers are parameters."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.functions import text as T

KEPT = "kept"
# Rules on lines, and words that running English text has.
TERMINAL = r"[.!?\"”…]\s*$"
COUNTER_LINE = r"(?i)^\s*[0-9][0-9.,]*\s*(?:likes?|shares?|comments?|views?|retweets?|followers?)?\s*$"
NAVIGATION_LINE = r"(?i)^\s*(?:home|menu|search|log ?in|sign ?(?:in|up|out)|share|read more|next|previous|back to top)\s*$"
SCRIPT_LINE = r"(?i)javascript|cookies? policy|lorem ipsum"
STOP_WORDS = ("the", "be", "to", "of", "and", "that", "have", "with")


@dataclass(frozen=True)
class LineRules:
    min_words: int = 3
    terminal: bool = True


@dataclass(frozen=True)
class DocRules:
    min_words: int = 50
    max_words: int = 100_000
    min_mean_length: float = 3.0
    max_mean_length: float = 10.0
    max_symbol_ratio: float = 0.1
    max_bullet_share: float = 0.9
    max_ellipsis_share: float = 0.3
    max_duplicate_line_share: float = 0.3
    min_alpha_share: float = 0.8
    min_stop_words: int = 2
    stop_words: Sequence[str] = STOP_WORDS


def line_reason(line: Column, rules: LineRules = LineRules()) -> Column:
    """First rule that removes a line, else ``kept``."""
    words = F.size(T.split_blanks(T.one_line(line)))
    reason = (
        F.when(line.rlike(COUNTER_LINE), "counter")
        .when(line.rlike(NAVIGATION_LINE), "navigation")
        .when(line.rlike(SCRIPT_LINE), "script")
        .when(words < rules.min_words, "short")
    )
    if rules.terminal:
        reason = reason.when(~line.rlike(TERMINAL), "no_terminal")
    return reason.otherwise(KEPT)


def quality_lines(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """Remove bad lines inside each row; adds ``n_lines`` and ``n_removed``. No shuffle."""
    names = [c for c in docs.columns if c != text]
    lines = docs.select(*names, F.split(F.col(text), "\n").alias("_lines"))
    kept = F.filter("_lines", lambda line: line_reason(line, rules) == KEPT)
    staged = lines.select(*names, F.size("_lines").alias("n_lines"), kept.alias("_kept"))
    return staged.select(
        *names,
        F.array_join("_kept", "\n").alias(text),
        "n_lines",
        (F.col("n_lines") - F.size("_kept")).alias("n_removed"),
    )


def line_report(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """Lines per rule."""
    reasons = F.transform(F.split(F.col(text), "\n"), lambda line: line_reason(line, rules))
    return docs.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_lines"))


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def quality_stats(docs: DataFrame, text: str = "text", stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    """Columns of document statistics."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: F.trim(x) != "")
    staged = docs.withColumns({"_words": T.split_blanks(T.one_line(F.col(text))), "_lines": lines})
    words, n = F.col("_words"), F.size("_words")
    n_lines = F.size("_lines")
    return staged.withColumns(
        {
            "n_words": n,
            "mean_length": _share(F.length(F.array_join("_words", "")), n),
            "symbol_ratio": _share(F.size(F.regexp_extract_all(F.col(text), F.lit(r"#|\.\.\.|…"), 0)), n),
            "alpha_share": _share(F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))), n),
            "stop_words": F.size(
                F.array_intersect(F.transform(words, lambda w: F.lower(w)), F.array(*[F.lit(w) for w in stop_words]))
            ),
            "bullet_share": _share(F.size(F.filter("_lines", lambda x: x.rlike(r"^\s*[-*•]"))), n_lines),
            "ellipsis_share": _share(F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))), n_lines),
            "duplicate_line_share": _share(n_lines - F.size(F.array_distinct("_lines")), n_lines),
        }
    ).drop("_words", "_lines")


def quality_reason(rules: DocRules = DocRules()) -> Column:
    """First rule that drops a document, from the columns of ``quality_stats``."""
    return (
        F.when(F.col("n_words") < rules.min_words, "too_short")
        .when(F.col("n_words") > rules.max_words, "too_long")
        .when(~F.col("mean_length").between(rules.min_mean_length, rules.max_mean_length), "word_length")
        .when(F.col("symbol_ratio") > rules.max_symbol_ratio, "symbols")
        .when(F.col("bullet_share") > rules.max_bullet_share, "bullets")
        .when(F.col("ellipsis_share") > rules.max_ellipsis_share, "ellipses")
        .when(F.col("duplicate_line_share") > rules.max_duplicate_line_share, "duplicate_lines")
        .when(F.col("alpha_share") < rules.min_alpha_share, "not_alphabetic")
        .when(F.col("stop_words") < rules.min_stop_words, "no_stop_words")
        .otherwise(KEPT)
    )


def quality_docs(docs: DataFrame, rules: DocRules = DocRules(), text: str = "text") -> DataFrame:
    """Add the statistics and ``disposition``."""
    return quality_stats(docs, text, rules.stop_words).withColumn("disposition", quality_reason(rules))
