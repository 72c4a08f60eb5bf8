"""Queries opN_<name> over the test tables, each over whole tables, and their SQL for DuckDB."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from pagesift.llm import (
    byte_bpe, exact_dedup, hard_negatives, language, line_dedup, lm, merkle, near_dedup, phrase_index, substring_dedup, topk, warc,
)
from pagesift.llm.common import table
from pagesift.session import new_path

WHITE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def op1_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.fitted(docs.where(~language.held_out("doc_id")))
    found = language.identified(docs.withColumn("held_out", language.held_out("doc_id")), model, columns=["doc_id", "held_out"])
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op2_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.scored(table(spark, folder, "documents"), lm.held_out("doc_id"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    place = new_path(spark, "archives")
    warc.write_archives(table(spark, folder, "pages"), place)

    def number(identifier: str) -> F.Column:
        return F.regexp_extract(identifier, "^<urn:page:(-?[0-9]*):", 1).try_cast("long")

    return warc.read_pages(spark, place).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"), "error",
    )


OP3_SQL = """
WITH payload AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), led AS (
  SELECT page_id, html, n, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS leader FROM payload
)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN leader IS NOT NULL AND page_id IS DISTINCT FROM leader THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM leader THEN leader END AS refers_to, CAST(NULL AS VARCHAR) AS error
FROM led
"""


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.round_trip(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op5_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(docs).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.packed(spark, table(spark, folder, "documents"), folder)


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, folder, "documents")).drop("t")


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


OP8_SQL = """
WITH good AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), wide AS (
  SELECT r, vec_id, v, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM good
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM wide q JOIN wide c ON q.d = c.d AND len(q.v) = len(c.v) AND q.r <> c.r
  WHERE q.vec_id % 20 = 0
  GROUP BY q.r, q.vec_id, c.r, c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.grace_groups(table(spark, folder, "documents"))


OP9_SQL = """
WITH normal AS (
  SELECT doc_id, coalesce(text, '') AS whole,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare
  FROM documents
), ranked AS (
  SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
         first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place
  FROM normal
  WINDOW best AS (PARTITION BY bare ORDER BY length(whole) DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(bare) AS text_sha256 FROM ranked
"""


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


OP10_SQL = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT doc_id, line, pos, translate(trim(line, {WHITE_SQL}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM line
), held AS (
  SELECT *, min(doc_id) OVER (PARTITION BY key) AS first FROM keyed
), judged AS (
  SELECT *, length(key) >= 10 AND doc_id > first AS late FROM held
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (late) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT late), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(table(spark, folder, "embeddings"), F.col("id") % 100 == 0, label)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


OP11_SQL = """
WITH good AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), wide AS (
  SELECT r, vec_id, label, len(v) AS n, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM good
), scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, c.r AS c, c.vec_id, a.label = c.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
  FROM wide a JOIN wide c ON a.d = c.d AND a.n = c.n AND a.r <> c.r
  WHERE a.vec_id % 100 = 0
  GROUP BY ALL
), positive AS (
  SELECT a, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) AS place
  FROM scored WHERE same
  QUALIFY place <= 5
), negative AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         CAST(row_number() OVER (PARTITION BY a, place ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM positive JOIN (SELECT a, vec_id, score FROM scored WHERE NOT same) USING (a)
  WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= 10
"""

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    found = merkle.verified(docs, FIELDS, "lang", "doc_id", tampered, merkle.lower_ascii(F.col("text")))
    return found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        "folded_root", "verified",
    )


LEVELS = 12


def _merkle_sql() -> str:
    """Trees of up to 8 ** 12 leaves, level by level; a tree of one node stays as it is."""
    field = "coalesce(strlen({0}) || ':' || {0}, '-')"
    before = "".join(f"|| {field.format(f'CAST({c} AS VARCHAR)')}" for c in FIELDS[:-1])[2:]
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    out = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t
), leaf AS (
  SELECT doc_id, lang, sha256({before} || {field.format("text")}) AS leaf, sha256({before} || {field.format(lower)}) AS changed,
         xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1]), 4294967295)) % 3 = 0 AS tampered
  FROM documents, crc_table
), a0 AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h,
         coalesce(CASE WHEN tampered THEN changed END, leaf) AS f, '' AS p
  FROM leaf
)"""
    level = """, {0}n AS (
  SELECT DISTINCT {3} AS g, i, h FROM {1}
), {0}m AS (
  SELECT *, count(*) OVER (PARTITION BY g) AS n FROM {0}n
), {0}r AS (
  SELECT g, i // 8 AS i, list(h ORDER BY i) AS hs, any_value(n) AS n FROM {0}m GROUP BY ALL
), {2} AS (
  SELECT x.* EXCLUDE (i, h, f, p), x.i // 8 AS i,
         CASE WHEN r.n = 1 THEN x.h ELSE sha256(list_aggregate(r.hs, 'string_agg', '')) END AS h,
         CASE WHEN r.n = 1 THEN x.f ELSE sha256(
           coalesce(list_aggregate(r.hs[1:x.i % 8], 'string_agg', ''), '') || x.f
           || coalesce(list_aggregate(r.hs[x.i % 8 + 2:], 'string_agg', ''), '')) END AS f,
         CASE WHEN r.n = 1 THEN x.p ELSE x.p || coalesce(list_aggregate(r.hs[1:x.i % 8], 'string_agg', ''), '')
           || coalesce(list_aggregate(r.hs[x.i % 8 + 2:], 'string_agg', ''), '') END AS p
  FROM {1} x JOIN {0}r r ON r.g IS NOT DISTINCT FROM {4} AND r.i = x.i // 8
)"""
    for k in range(LEVELS):
        out += level.format(f"b{k}", f"a{k}", f"a{k + 1}", "lang", "x.lang")
    out += f""", t0 AS (
  SELECT * EXCLUDE (i), h AS subroot, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM a{LEVELS}
)"""
    for k in range(LEVELS // 3):
        out += level.format(f"u{k}", f"t{k}", f"t{k + 1}", "0", "0")
    return out + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(p) AS proof_sha256, f AS folded_root, f = h AS verified FROM t{LEVELS // 3}
"""


def op13_decontam(spark: SparkSession, folder: str) -> DataFrame:
    found = phrase_index.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


OP13_SQL = """
WITH word AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), asked AS (
  SELECT DISTINCT item_id, n, w[s : s + n - 1] AS v
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM item WHERE len(w) > 0)
), held AS (
  SELECT r, n, s, w[s : s + n - 1] AS v
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM word, (SELECT DISTINCT n FROM asked))
), hit AS (
  SELECT DISTINCT r, n, s, item_id FROM held JOIN asked USING (n, v)
), place AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM word LEFT JOIN place USING (r) LEFT JOIN named USING (r)
"""


def queries() -> dict:
    return {
        "op1_language": op1_language,
        "op2_lm": op2_lm,
        "op3_warc": op3_warc,
        "op4_byte_bpe": op4_byte_bpe,
        "op5_suffix_dedup": op5_suffix_dedup,
        "op6_packing": op6_packing,
        "op7_near_dedup": op7_near_dedup,
        "op8_top_k": op8_top_k,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_line_dedup": op10_line_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_merkle": op12_merkle,
        "op13_decontam": op13_decontam,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc": OP3_SQL, "op8_top_k": OP8_SQL, "op9_exact_dedup": OP9_SQL, "op10_line_dedup": OP10_SQL,
        "op11_hard_negatives": OP11_SQL, "op12_merkle": _merkle_sql(), "op13_decontam": OP13_SQL,
    }
