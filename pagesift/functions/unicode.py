"""Unicode normal form, the one text step without a Spark function."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pagesift.functions.text import classifier_line, cut_lines, one_line


@F.pandas_udf(StringType())
def nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


def classifier_text(text):
    """Whole preprocessing before the topic classifier."""
    return cut_lines(classifier_line(one_line(nfkc(text))))
