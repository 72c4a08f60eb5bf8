"""Documents re-organised by duplicate count and dump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.operators.dedup import dup_interval
from pagesift.operators.joins import lookup_join
from pagesift.operators.listings import MERGE_SPLITS

ROWS_PER_FILE = 200_000


def tag_intervals(docs: DataFrame, count: str = "dup_count") -> DataFrame:
    return docs.withColumn("dup_interval", dup_interval(F.col(count)))


def merge_splits(docs: DataFrame, dump: str = "dump", key: str = "doc_id", rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Add ``split``: the output file of a document inside its interval and dump.

    An interval has at least its usual number of files; a folder with many
    documents gets as many as keep each below ``rows_per_file``.
    """
    usual = F.lit(1)
    for name, n in MERGE_SPLITS.items():
        usual = F.when(F.col("dup_interval") == name, n).otherwise(usual)
    folders = docs.groupBy("dup_interval", dump).agg(F.count(F.lit(1)).alias("_n"))
    files = folders.select(
        "dup_interval", dump, F.greatest(usual, F.ceil(F.col("_n") / rows_per_file)).cast("int").alias("_files")
    )
    joined = lookup_join(docs, files, ["dup_interval", dump], "left")
    return joined.withColumn("split", F.pmod(F.xxhash64(key), F.coalesce("_files", F.lit(1))).cast("int")).drop("_files")


def write_reorganized(
    docs: DataFrame, path: str, dump: str = "dump", mode: str = "overwrite", rows_per_file: int = ROWS_PER_FILE
) -> None:
    """One write replaces splitting and merging: a folder per interval and dump."""
    tagged = merge_splits(tag_intervals(docs), dump, rows_per_file=rows_per_file)
    (
        tagged.repartition("dup_interval", dump, "split")
        .drop("split")
        .write.mode(mode)
        .partitionBy("dup_interval", dump)
        .parquet(path)
    )
