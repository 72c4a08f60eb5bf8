"""Listings: text files with one archive path per line."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from pagesift.operators.joins import lookup_join
from pagesift.operators.listings import limit_skip, number_rows
from pagesift.session import materialize

# Suffixes that are read.
SUFFIXES = (".txt", ".gz")


def scan_listing(
    spark: SparkSession,
    folder: str,
    glob: str | None = None,
    recursive: bool = True,
    skip: int = 0,
    limit: int = -1,
    shuffle_seed: int | None = None,
    adapter: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Lines of all matching files: ``file``, ``line_no``, ``value``, ``pos``.

    Compression follows the file name. Files are taken in order of their name,
    or in a repeatable random order with ``shuffle_seed``. A file with broken
    UTF-8 gives its lines before the first broken one.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    order = F.col("file") if shuffle_seed is None else F.md5(F.concat_ws(":", F.lit(str(shuffle_seed)), "file"))
    lines = numbered_lines(_split_lines(reader, folder))
    lines = limit_skip(number_rows(lines, order, inside=F.col("line_no")), limit, skip)
    return lines.transform(adapter) if adapter else lines


def _split_lines(reader: DataFrameReader, path: str) -> DataFrame:
    """Lines with file and block, as the splits of the files give them."""
    value = F.regexp_replace("value", "\r$", "")
    lines = reader.option("lineSep", "\n").text(path)
    return lines.select(
        value.alias("value"), (~F.is_valid_utf8("value")).alias("broken"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
    )


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Number the lines that are not blank, in each file up to its first broken one: ``file``, ``line_no``, ``value``.

    A file is read in splits. Lines are numbered inside theirs and written once; the counts of the blocks
    of a file are summed up, so a file of any size is read and numbered by many tasks.
    """
    names = [c for c in lines.columns if c not in ("broken", "block")]
    written = materialize(lines.where("value <> ''").withColumn("_at", F.monotonically_increasing_id()), "lines")
    blocks = written.groupBy("file", "block").agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"), F.min(F.when(F.col("broken"), F.col("_at"))).alias("_bad")
    )
    of_file = Window.partitionBy("file")
    before = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    blocks = blocks.withColumn("_shift", shift)
    blocks = blocks.select("file", "block", "_shift", F.min(F.col("_bad") + F.col("_shift")).over(of_file).alias("_stop"))
    joined = lookup_join(written, materialize(blocks, "line-blocks"), ["file", "block"])
    numbered = joined.withColumn("line_no", (F.col("_at") + F.col("_shift")).cast("int"))
    return numbered.where(F.col("_stop").isNull() | (F.col("line_no") < F.col("_stop"))).select(*names, "line_no")


def scan_listing_multi(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Listings one after the other in the order given; other suffixes are ignored."""
    wanted = [p for p in paths if p.endswith(SUFFIXES)]
    parts = [_split_lines(spark.read, p).withColumn("file_no", F.lit(i)) for i, p in enumerate(wanted)]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    # A path may be a folder of part files; they follow each other by name.
    return number_rows(numbered_lines(lines), F.struct("file_no", "file"), inside=F.col("line_no")).drop("file_no")
