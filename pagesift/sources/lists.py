"""Domain, URL and word lists: one folder per category, one file per kind."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.functions.urls import normalized

# File names that are read, and lines left behind by version control.
KINDS = {"domains": "domain", "urls": "url", "words": "word"}
LIST_FILE = r"/([^/]+)/(domains|urls|words)(?:/[^/]+)?$"
MARKER_LINE = r"^(<<<<<<<|=======|>>>>>>>|version https://git-lfs|oid sha256:|size \d+$)"


def list_entries(lines: DataFrame, normalize: bool = False) -> DataFrame:
    """Lines ``(category, kind, value)`` without comments, blanks and marker lines."""
    value: Column = F.trim(F.col("value"))
    entry = normalized(value) if normalize else value
    return (
        lines.where(~F.col("value").startswith("#") & (value != "") & ~value.rlike(MARKER_LINE))
        .select("category", "kind", entry.alias("value"))
        .distinct()
    )


def scan_lists(spark: SparkSession, root: str, normalize: bool = False) -> DataFrame:
    """Read ``<root>/<category>/{domains,urls,words}``, as a file or as a folder of part files.

    A missing file is an empty list. Other files, such as usage tags, are not read.
    """
    path = F.col("_metadata.file_path")
    lines = (
        spark.read.option("recursiveFileLookup", True).text(root)
        .where(path.rlike(LIST_FILE))
        .select("value", F.regexp_extract(path, LIST_FILE, 1).alias("category"), F.regexp_extract(path, LIST_FILE, 2).alias("file"))
    )
    kind = F.lit(None).cast("string")
    for name, label in KINDS.items():
        kind = F.when(F.col("file") == name, label).otherwise(kind)
    return list_entries(lines.select("category", kind.alias("kind"), "value"), normalize)


def union_lists(*lists: DataFrame, extra: Iterable[tuple[str, str, str]] = ()) -> DataFrame:
    """Union of lists with extra entries, each entry once."""
    out = lists[0]
    for other in lists[1:]:
        out = out.unionByName(other)
    rows = list(extra)
    if rows:
        schema = "category string, kind string, value string"
        out = out.unionByName(out.sparkSession.createDataFrame(rows, schema))
    return out.distinct()
