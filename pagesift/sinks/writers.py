"""Writers of documents, counters, indexes and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.operators.models import MATH_THRESHOLD, lang_filter, math_filter
from pagesift.session import materialize

# Field order of the metadata; one field has a hyphen in the files.
META = ("lang", "lang_score", "url", "timestamp", "cc_path", "record_idx", "math_score")
FILE_NAMES = {"cc_path": "cc-path"}


def to_records(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``text``, ``meta`` as they stand in the files, with columns to partition by."""
    meta = F.struct(*[F.col(name).alias(FILE_NAMES.get(name, name)) for name in META])
    return docs.select(F.col(text).alias("text"), meta.alias("meta"), *keep)


def from_records(records: DataFrame) -> DataFrame:
    """Documents of written records; rows without a text (blank lines) are left out."""
    meta = [F.col("meta").getField(FILE_NAMES.get(name, name)).alias(name) for name in META]
    return records.where(F.col("text").isNotNull()).select("text", *meta)


RECORD_SCHEMA = (
    "text string, meta struct<lang string, lang_score double, url string, timestamp string, `cc-path` string, "
    "record_idx bigint, math_score double>"
)


def write_table(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), form: str = "parquet", overwrite: bool = True
) -> None:
    """Replace what is there, only in the partitions that are written, or append."""
    writer = df.write.mode("overwrite" if overwrite else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    if form in ("json", "text", "csv"):
        writer = writer.option("compression", "gzip")
    writer.format(form).save(path)


def sink_english_text(docs: DataFrame, path: str, partition_by: tuple[str, ...] = ("dump",), overwrite: bool = True) -> None:
    """All English documents as compressed JSON lines."""
    write_table(to_records(lang_filter(docs), "text", partition_by), path, partition_by, "json", overwrite)


def sink_math_text(
    docs: DataFrame, path: str, threshold: float = MATH_THRESHOLD, partition_by: tuple[str, ...] = ("dump",), overwrite: bool = True
) -> None:
    """English documents of the wanted topic, extracted text."""
    chosen = math_filter(lang_filter(docs), threshold)
    write_table(to_records(chosen, "text", partition_by), path, partition_by, "json", overwrite)


def sink_math_html(
    docs: DataFrame, path: str, threshold: float = MATH_THRESHOLD, partition_by: tuple[str, ...] = ("dump",), overwrite: bool = True
) -> None:
    """The same documents with their original HTML."""
    chosen = math_filter(lang_filter(docs), threshold)
    write_table(to_records(chosen, "html", partition_by), path, partition_by, "json", overwrite)


def sink_stats(stats: DataFrame, path: str) -> None:
    """Append counters as CSV with a header."""
    stats.write.mode("append").option("header", True).csv(path)


def sink_index(index: DataFrame, path: str, overwrite: bool = True) -> None:
    """One folder per task; blanks in a task name become underscores."""
    named = index.withColumn("task", F.replace("task", F.lit(" "), F.lit("_")))
    write_table(named, path, ("task",), "parquet", overwrite)


def sink_listing_splits(splits: DataFrame, path: str, value: str = "value", compress: bool = False) -> None:
    """One folder per split, lines as text."""
    rows = splits.select(F.col(value).alias("value"), F.format_string("%03d", "split").alias("split"))
    writer = rows.repartition("split").write.mode("overwrite").partitionBy("split")
    writer.option("compression", "gzip" if compress else "none").text(path)


def excluded_writer(docs: DataFrame, path: str, kept: str = "kept") -> DataFrame:
    """Write rejected rows, a folder per reason, and return the kept ones. The verdict is computed once."""
    docs = materialize(docs, "judged")
    rejected = docs.where(F.col("disposition") != kept)
    write_table(rejected, path, ("disposition",))
    return docs.where(F.col("disposition") == kept).drop("disposition")


def write_ledger(failed: DataFrame, path: str) -> None:
    """Append the paths of failed archives."""
    failed.select(F.col("cc_path").alias("value")).write.mode("append").text(path)
