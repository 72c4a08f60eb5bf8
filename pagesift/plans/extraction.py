"""From archive records to English and topic documents, with counters for every drop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.functions import encoding as E
from pagesift.operators import models as ML
from pagesift.operators import stats as S
from pagesift.operators.extract import extract_page
from pagesift.operators.joins import lookup_join
from pagesift.operators.listings import dump_of
from pagesift.operators.places import placed_join
from pagesift.operators.urls import KEPT, UrlRules, url_disposition
from pagesift.session import materialize
from pagesift.sinks import writers as W
from pagesift.sources.warc import failed_ledger, fetch_records, scan_archives

KEY = ("cc_path", "record_idx")


def decode_records(records: DataFrame) -> DataFrame:
    """Add ``html``; the body stays only for the counters of empty bodies."""
    content_type = F.col("content_type") if "content_type" in records.columns else None
    charset = E.declared_charset(F.col("body"), content_type)
    return records.withColumn("html", E.decode_body(F.col("body"), charset))


def extract_records(records: DataFrame, rules: UrlRules) -> DataFrame:
    """All records with ``text`` and ``disposition`` up to extraction, written once.

    Records that a URL rule drops are neither decoded nor extracted.
    """
    judged = url_disposition(records, rules)
    kept = F.col("url_disposition") == KEPT
    body = F.when(kept, F.col("body"))
    charset = E.declared_charset(body, F.col("content_type") if "content_type" in records.columns else None)
    decoded = judged.withColumn("html", F.when(kept, E.decode_body(body, charset)))
    keyed = decoded.withColumn("_key", F.concat_ws("#", *[F.col(k).cast("string") for k in KEY]))
    text = extract_page(keyed, "_key").drop("_key")
    step = (
        F.when(~kept, S.URL_FILTERED)
        .when(F.col("body").isNull() | (F.octet_length("body") == 0), S.BODY_EMPTY)
        .when(F.coalesce(F.col("html"), F.lit("")) == "", S.DECODING_FAILED)
        .when(F.col("text").isNull(), S.EXTRACTION_FAILED)
        .when(F.col("text") == "", S.EXTRACTION_EMPTY)
    )
    staged = text.withColumn("step", step).drop("body")
    return materialize(staged, "extracted")


def score_records(extracted: DataFrame, lang_model: ML.RowModel, math_model: ML.RowModel, math_label: str) -> DataFrame:
    """Add language, topic score and the final ``disposition``, each row where it lies.

    Only documents that are still there are scored, and only English ones get a
    topic score. Nothing is shuffled: the models are of fixed size.
    """
    alive = F.col("step").isNull()
    scored = extracted.withColumn("_lang", ML.row_scores(lang_model, F.when(alive, F.col("text"))))
    best = ML.best_label(lang_model, F.col("_lang"))
    scored = scored.withColumn("_best", best).select("*", F.col("_best.label").alias("lang"), F.col("_best.score").alias("lang_score"))
    is_english = (F.col("lang") == ML.ENGLISH) & (F.col("lang_score") >= ML.LANG_THRESHOLD)
    scored = scored.withColumn("_math", ML.row_scores(math_model, F.when(is_english, F.col("text"))))
    disposition = (
        F.when(F.col("step").isNotNull(), F.col("step"))
        .when(is_english, S.REMAINING)
        .otherwise(S.LANGUAGE_FILTERED)
    )
    scored = scored.withColumn("math_score", ML.label_score(math_model, F.col("_math"), math_label))
    scored = scored.withColumn("disposition", disposition)
    return materialize(scored.drop("step", "_lang", "_best", "_math"), "scored")


def extract_job(
    records: DataFrame, rules: UrlRules, lang_model: ML.RowModel, math_model: ML.RowModel, math_label: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scored records with their HTML, those of the wanted topic, and counters per archive."""
    scored = score_records(extract_records(records, rules), lang_model, math_model, math_label)
    topic = ML.math_filter(ML.lang_filter(scored))
    counters = S.funnel_stats(scored, [F.col("cc_path").alias("file_path")])
    return scored, topic, counters


def run_extraction(
    listing: DataFrame, root: str, out: str, rules: UrlRules, lang_model: ML.RowModel, math_model: ML.RowModel,
    math_label: str,
) -> DataFrame:
    """Archives of a listing to three outputs, counters and the ledger of failed archives, under ``out``.

    Archives are read once. All outputs are filters of one written table. Gives the counters back.
    """
    extracted = extract_records(scan_archives(listing, root), rules)
    W.write_ledger(failed_ledger(extracted), f"{out}/failed")
    scored = score_records(extracted.where(F.col("error").isNull()), lang_model, math_model, math_label)
    docs = scored.withColumns({"timestamp": F.col("date"), "dump": dump_of(F.col("cc_path"))})
    W.sink_english_text(docs, f"{out}/english")
    W.sink_math_text(docs, f"{out}/math_text")
    W.sink_math_html(docs, f"{out}/math_html")
    counters = materialize(S.funnel_stats(scored, [F.col("cc_path").alias("file_path")]), "counters")
    W.sink_stats(counters, f"{out}/stats")
    return counters


def reextract(survivors: DataFrame, html_records: DataFrame) -> DataFrame:
    """Extract again from the HTML of surviving keys, which is not shuffled."""
    keys = materialize(survivors.select(*KEY).distinct(), "survivors")
    again = placed_join(html_records, keys, list(KEY), "left_semi")
    keyed = again.withColumn("_key", F.concat_ws("#", *[F.col(k).cast("string") for k in KEY]))
    return extract_page(keyed, "_key").drop("_key")


def reextract_by_range(survivors: DataFrame, index: DataFrame, root: str) -> DataFrame:
    """Extract again from the archives: an index of them gives the place of each surviving key's record.

    Keys meet the narrow index; each task then reads its records by range, and neither bodies nor HTML are shuffled.
    """
    keys = materialize(survivors.select(*KEY).distinct(), "survivors")
    wanted = lookup_join(index, keys, list(KEY), "left_semi")
    records = decode_records(fetch_records(wanted, root).where(F.col("error").isNull()))
    keyed = records.withColumn("_key", F.concat_ws("#", *[F.col(k).cast("string") for k in KEY]))
    return extract_page(keyed.drop("body"), "_key").drop("_key")
