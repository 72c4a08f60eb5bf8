"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread_small(df: DataFrame, path: str, key: str) -> DataFrame:
    """Use all cores for a table that is no larger than one scan split.

    Such a table is read by a single task. A larger one already has a task for
    every split and is left alone, so no large table is shuffled here.
    """
    spark = df.sparkSession
    split_bytes = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    if size > split_bytes:
        return df
    return df.repartition(spark.sparkContext.defaultParallelism, key)


def _bytes(text: str) -> int:
    units = {"k": 10, "m": 20, "g": 30}
    text = text.strip().lower().removesuffix("b")
    return int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)


def scan(spark: SparkSession, folder: str, name: str, spread_by: str | None = None) -> DataFrame:
    path = f"{folder.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    return spread_small(df, path, spread_by) if spread_by else df


def scan_pages(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "pages", "page_id").select("page_id", "url", "html")


def scan_documents(spark: SparkSession, folder: str) -> DataFrame:
    return scan(spark, folder, "documents", "doc_id")
