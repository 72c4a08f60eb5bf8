"""Counters: what every archive lost at which step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.operators.listings import dump_of

# Drop classes and the order of the counters.
URL_FILTERED, BODY_EMPTY, DECODING_FAILED = "url_filtered", "html_content_empty", "html_decoding_failed"
EXTRACTION_FAILED, EXTRACTION_EMPTY, LANGUAGE_FILTERED = "doc_extraction_failed", "doc_extraction_empty", "language_filtered"
REMAINING = "doc_remaining"
DROP_CLASSES = (
    URL_FILTERED, BODY_EMPTY, DECODING_FAILED, EXTRACTION_FAILED, EXTRACTION_EMPTY, LANGUAGE_FILTERED,
)
COUNTERS = ("doc_input", *DROP_CLASSES, "math_retained", REMAINING)


def funnel_stats(docs: DataFrame, by: Sequence[Column | str], math_threshold: float = 0.80) -> DataFrame:
    """The nine counters per group, from ``disposition`` and (if present) ``math_score``."""
    is_math = F.lit(False)
    if "math_score" in docs.columns:
        is_math = (F.col("disposition") == REMAINING) & (F.col("math_score") >= math_threshold)
    counts = [F.count(F.lit(1)).alias("doc_input")]
    counts += [F.count_if(F.col("disposition") == name).alias(name) for name in DROP_CLASSES]
    counts += [F.count_if(is_math).alias("math_retained"), F.count_if(F.col("disposition") == REMAINING).alias(REMAINING)]
    return docs.groupBy(*by).agg(*counts)


def funnel_rollup(stats: DataFrame, path: str = "file_path") -> DataFrame:
    """Totals per archive, per dump and overall; a total row has NULL where it sums up."""
    tagged = stats.withColumn("dump", dump_of(F.col(path)))
    return tagged.rollup("dump", path).agg(*[F.sum(c).alias(c) for c in COUNTERS])
