"""A training corpus from ``documents``: the stages, in their order, and the whole run.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept; its
result is written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``documents``.

Every stage keeps all columns of its rows, whatever their names, takes an empty table to an empty one, and
treats rows that are equal in all columns alike. What it does with nulls and ties stands with it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.llm import exact_dedup, language, near_dedup, packing, substring_dedup
from pagesift.llm.common import hinted, table, text_of
from pagesift.session import new_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels teach; those without letters, null and empty texts among them, go.

    Null labels teach nothing. Where no label teaches anything, no document has a language, and all go.
    """
    model = language.fitted(docs.where(~language.held_out("doc_id")))
    found = language.identified(docs, model)
    return found.where(F.col("lang_pred") != language.UNKNOWN).select("row.*")


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the smallest id. Null counts as empty."""
    return exact_dedup.grace_distinct(docs)


def unused(name: str, docs: DataFrame) -> str:
    """The name, with as many underscores before it as no column of ``docs`` has."""
    while name in docs.columns:
        name = "_" + name
    return name


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id; a null id is the largest.

    A text without words is like no other and stays.
    """
    found = near_dedup.near_classes(docs).where(~F.col("kept"))
    gone_id, gone_t = unused("gone_id", docs), unused("gone_t", docs)
    gone = found.select(F.col("doc_id").alias(gone_id), F.col("t").alias(gone_t))
    same = F.col("doc_id").eqNullSafe(F.col(gone_id)) & (F.xxhash64(text_of("text")) == F.col(gone_t))
    return docs.join(hinted(gone, F.lit(32)), same, "left_anti")


def no_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere, too; a text that loses all goes.

    A cut may fall inside a character; what is left of one is dropped. Null and empty texts lose nothing and stay.
    """
    found = substring_dedup.without_repeats(docs).where("n_removed = 0 or octet_length(kept) > 0")
    text = F.when(F.col("n_removed") == 0, F.col("row.text")).otherwise(F.col("kept_text"))
    columns = [text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    kept = found.select(*columns)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences with the mixture of the sources. A null text is empty, a null source the empty one."""
    pieces = packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language", known_language),
    ("exact_dedup", no_copies),
    ("near_dedup", no_near_copies),
    ("suffix_dedup", no_repeated_passages),
    ("packing", packed),
]

#: Cross-parsing, sampling, suffixes and tokenising are beyond SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
