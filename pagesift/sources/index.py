"""Contamination index as a partitioned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.operators.decontam import index_lookup


def scan_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per n-gram with its task; of several tasks the last by name counts."""
    index = spark.read.option("basePath", path).parquet(path)
    return index_lookup(index.select("gram", F.col("task").cast("string")))
