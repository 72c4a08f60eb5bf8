"""Quality rules and text models on the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesift.catalog import decontam as C
from pagesift.catalog import dedup as D
from pagesift.catalog import duck as K
from pagesift.catalog import fixtures as X
from pagesift.catalog import text as TX
from pagesift.functions.hashing import md5_31
from pagesift.functions.unicode import classifier_text
from pagesift.operators import models as M
from pagesift.operators import quality as Q
from pagesift.plans.curation import CurationRules, curate
from pagesift.session import materialize
from pagesift.sources.tables import scan


def quality_lines(spark, sf):
    return Q.quality_lines(X.documents(spark, sf)).select("doc_id", "text", "n_lines", "n_removed")


def quality_line_report(spark, sf):
    return Q.line_report(X.documents(spark, sf))


def quality_docs(spark, sf):
    out = Q.quality_docs(X.documents(spark, sf))
    shares = [
        F.round(c, 6).alias(c)
        for c in ("mean_length", "symbol_ratio", "alpha_share", "bullet_share", "ellipsis_share", "duplicate_line_share")
    ]
    return out.select("doc_id", "n_words", "stop_words", *shares, "disposition")


def quality_report(spark, sf):
    out = Q.quality_docs(X.documents(spark, sf))
    return out.groupBy("lang", "disposition").agg(F.count(F.lit(1)).alias("n_docs"))


def _labelled(spark, sf):
    """Documents with their quality label where there is one."""
    return X.documents(spark, sf).join(scan(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")


def _lang_model(spark, sf):
    return materialize(M.train_text_model(X.documents(spark, sf), "lang"), "lang-model")


def _math_model(spark, sf):
    return materialize(M.train_text_model(_labelled(spark, sf), "quality"), "topic-model")


def train_text_model(spark, sf):
    model = M.model_rows(M.train_text_model(X.documents(spark, sf), "lang"))
    return model.select("token", "label", F.round("weight", 6).alias("weight"))


def class_probabilities(spark, sf):
    scores = M.score_rows(M.score_text(X.documents(spark, sf), _math_model(spark, sf)))
    return scores.select("doc_id", "label", F.round("score", 6).alias("score"))


def _langs(spark, sf):
    return M.score_lang(X.documents(spark, sf), _lang_model(spark, sf))


def score_lang(spark, sf):
    return _langs(spark, sf).select("doc_id", "lang", F.round("lang_score", 6).alias("lang_score"))


def top_language(spark, sf):
    """The three best languages per document."""
    scores = M.score_text(X.documents(spark, sf), _lang_model(spark, sf))
    top = M.top_language(scores, k=3)
    return top.select("doc_id", F.col("rank").cast("long"), "lang", F.round("lang_score", 6).alias("lang_score"))


def lang_filter(spark, sf):
    return M.lang_filter(_langs(spark, sf)).select("doc_id")


def _math(spark, sf):
    return M.score_math(X.documents(spark, sf), _math_model(spark, sf), "1")


def score_math(spark, sf):
    return _math(spark, sf).select("doc_id", F.round("math_score", 6).alias("math_score"))


def score_lang_chars(spark, sf):
    """Language by hashed character n-grams, each text scored where it lies."""
    docs = X.documents(spark, sf)
    model = M.train_char_model(docs, "lang")
    best = M.best_label(model, M.char_scores(model, F.col("text")))
    return docs.select("doc_id", best.alias("b")).select("doc_id", F.col("b.label").alias("lang"), F.round("b.score", 6).alias("lang_score"))


def score_math_prepared(spark, sf):
    """Topic score of texts that went through the classifier's preprocessing."""
    docs, model = X.documents(spark, sf), M.train_row_model(_labelled(spark, sf), "quality", hash_fn=md5_31, prepare=classifier_text)
    scored = M.with_scores(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.round(M.label_score(model, F.col("scores"), "1"), 6).alias("math_score"))


def class_score(spark, sf):
    """Score of a label the model knows, and of one it does not."""
    scores = M.score_text(X.documents(spark, sf), _math_model(spark, sf))
    known = M.class_score(scores, "0", "zero")
    return known.join(M.class_score(scores, "unknown", "missing"), "doc_id").select(
        "doc_id", F.round("zero", 6).alias("zero"), "missing"
    )


def math_filter(spark, sf):
    return M.math_filter(_math(spark, sf)).select("doc_id")


def score_threshold_report(spark, sf):
    scored = _math(spark, sf).join(X.documents(spark, sf).select("doc_id", "source"), "doc_id")
    return M.score_threshold_report(scored, ["source"])


def curated_corpus(spark, sf):
    """The whole chain: lines, documents, exact and near duplicates, contamination, intervals."""
    out = curate(X.documents(spark, sf), C.written_index(spark, sf), CurationRules(hash_fn=md5_31))
    return out.select("doc_id", "dup_count", "dup_interval", F.md5("text").alias("text_md5"))


QUERIES = {
    f.__name__: f
    for f in (
        quality_lines, quality_line_report, quality_docs, quality_report, train_text_model, class_probabilities,
        score_lang, score_lang_chars, score_math_prepared, top_language, lang_filter, score_math, class_score, math_filter, score_threshold_report,
        curated_corpus,
    )
}

# ---- SQL ----

_LINE_REASON = (
    "CASE WHEN regexp_matches(line, '(?i)^\\s*[0-9][0-9.,]*\\s*(?:likes?|shares?|comments?|views?|retweets?|followers?)?\\s*$') THEN 'counter' "
    "WHEN regexp_matches(line, '(?i)^\\s*(?:home|menu|search|log ?in|sign ?(?:in|up|out)|share|read more|next|previous|back to top)\\s*$') THEN 'navigation' "
    "WHEN regexp_matches(line, '(?i)javascript|cookies? policy|lorem ipsum') THEN 'script' "
    f"WHEN len({K.split_blanks(K.one_line('line'))}) < 3 THEN 'short' "
    "WHEN NOT regexp_matches(line, '[.!?\"”…]\\s*$') THEN 'no_terminal' ELSE 'kept' END"
)
_LINES = (
    "raw AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM documents), "
    f"judged AS MATERIALIZED (SELECT doc_id, i, line, {_LINE_REASON} AS reason FROM raw)"
)


def quality_ctes(source: str) -> str:
    """Ends in ``quality`` with the statistics and ``disposition`` of ``source(doc_id, text, ...)``."""
    stop = "(" + ", ".join(K.q(w) for w in Q.STOP_WORDS) + ")"
    return (
        f"qw AS MATERIALIZED (SELECT *, {K.split_blanks(K.one_line('text'))} AS w, "
        f"list_filter(string_split(text, chr(10)), lambda l_: trim(l_) <> '') AS l FROM {source}), "
        "qs AS (SELECT * EXCLUDE (w, l), len(w) AS n_words, length(array_to_string(w, '')) / greatest(len(w), 1) AS mean_length, "
        "len(regexp_extract_all(text, '#|\\.\\.\\.|…')) / greatest(len(w), 1) AS symbol_ratio, "
        "len(list_filter(w, lambda x_: regexp_matches(x_, '\\p{L}'))) / greatest(len(w), 1) AS alpha_share, "
        f"len(list_distinct(list_filter(list_transform(w, lambda x_: lower(x_)), lambda x_: x_ IN {stop}))) AS stop_words, "
        "len(list_filter(l, lambda x_: regexp_matches(x_, '^\\s*[-*•]'))) / greatest(len(l), 1) AS bullet_share, "
        "len(list_filter(l, lambda x_: regexp_matches(x_, '(\\.\\.\\.|…)\\s*$'))) / greatest(len(l), 1) AS ellipsis_share, "
        "(len(l) - len(list_distinct(l))) / greatest(len(l), 1) AS duplicate_line_share FROM qw), "
        "quality AS MATERIALIZED (SELECT *, CASE WHEN n_words < 50 THEN 'too_short' WHEN n_words > 100000 THEN 'too_long' "
        "WHEN mean_length NOT BETWEEN 3 AND 10 THEN 'word_length' WHEN symbol_ratio > 0.1 THEN 'symbols' WHEN bullet_share > 0.9 THEN 'bullets' "
        "WHEN ellipsis_share > 0.3 THEN 'ellipses' WHEN duplicate_line_share > 0.3 THEN 'duplicate_lines' WHEN alpha_share < 0.8 THEN 'not_alphabetic' "
        "WHEN stop_words < 2 THEN 'no_stop_words' ELSE 'kept' END AS disposition FROM qs)"
    )


def model_ctes(source: str, label: str, p: str = "", words: str = K.words("text")) -> str:
    """Ends in ``<p>weights(token, label, weight)`` and ``<p>priors(label, prior)``."""
    return (
        f"{p}lt AS MATERIALIZED (SELECT doc_id, {label}::VARCHAR AS label, {words} AS w FROM {source} WHERE {label} IS NOT NULL), "
        f"{p}tc AS MATERIALIZED (SELECT label, token, count(*) AS n FROM (SELECT label, unnest(w) AS token FROM {p}lt) GROUP BY ALL), "
        f"{p}tot AS (SELECT label, sum(n) AS total FROM {p}tc GROUP BY label), {p}voc AS (SELECT count(DISTINCT token) AS v FROM {p}tc), "
        f"{p}priors AS (SELECT label, ln(count(*) / (SELECT count(*) FROM {p}lt)) AS prior FROM {p}lt GROUP BY label), "
        f"{p}weights AS MATERIALIZED (SELECT t.token, p.label, ln((coalesce(c.n, 0) + 1) / (coalesce(tot.total, 0) + (SELECT v FROM {p}voc))) AS weight "
        f"FROM (SELECT DISTINCT token FROM {p}tc) t CROSS JOIN {p}priors p LEFT JOIN {p}tc c ON c.token = t.token AND c.label = p.label "
        f"LEFT JOIN {p}tot tot ON tot.label = p.label)"
    )


def score_ctes(source: str, p: str = "", words: str = K.words("text")) -> str:
    """Ends in ``<p>scores(doc_id, label, score)`` for the texts of ``source``."""
    return (
        f"{p}st AS MATERIALIZED (SELECT doc_id, {words} AS w FROM {source}), "
        f"{p}hit AS (SELECT doc_id, label, sum(weight) AS s FROM (SELECT doc_id, unnest(w) AS token FROM {p}st) JOIN {p}weights USING (token) GROUP BY ALL), "
        f"{p}lg AS (SELECT doc_id, p.label, p.prior + coalesce(s, 0) AS lg FROM {p}st CROSS JOIN {p}priors p LEFT JOIN {p}hit USING (doc_id, label)), "
        f"{p}ex AS (SELECT doc_id, label, exp(lg - max(lg) OVER (PARTITION BY doc_id)) AS e FROM {p}lg), "
        f"{p}scores AS MATERIALIZED (SELECT doc_id, label, e / sum(e) OVER (PARTITION BY doc_id) AS score FROM {p}ex)"
    )


_SCORES = score_ctes("documents")
_LANG = f"{model_ctes('documents', 'lang')}, {_SCORES}"
_RANKED = "ranked AS (SELECT doc_id, label AS lang, score AS lang_score, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, label DESC) AS rank FROM scores)"
_TOPIC = f"labelled AS (SELECT documents.*, quality FROM documents LEFT JOIN labels USING (doc_id)), {model_ctes('labelled', 'quality')}, {_SCORES}"
_MATH = f"{_TOPIC}, math AS (SELECT doc_id, coalesce(max(score) FILTER (label = '1'), 0) AS math_score FROM scores GROUP BY doc_id)"

# The curated corpus: every step's SQL, with the cleaned documents under the name of the table.
_CLEAN = (
    f"{_LINES.replace('FROM documents', 'FROM main.documents')}, "
    "cleaned AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (reason = 'kept'), '') AS text FROM judged GROUP BY doc_id), "
    f"{quality_ctes('cleaned')}, "
    "good AS (SELECT doc_id, text FROM quality WHERE disposition = 'kept'), "
    "documents AS MATERIALIZED (SELECT good.doc_id, good.text, source, copies FROM good "
    "JOIN (SELECT min(doc_id) AS doc_id, count(*) AS copies FROM good GROUP BY text) USING (doc_id) JOIN main.documents USING (doc_id))"
)
_HASHED = f"list_transform({K.words('text')}, lambda t_: ({K.md5_31('t_')} % {M.FEATURES})::VARCHAR)"
_PREPARED = (
    f"prep AS MATERIALIZED ({TX.SQL['math_preprocess']}), "
    "pdocs AS (SELECT d.doc_id, prep.line AS text, quality FROM main.documents d JOIN prep USING (doc_id) LEFT JOIN labels USING (doc_id)), "
    f"{model_ctes('pdocs', 'quality', '', _HASHED)}, {score_ctes('pdocs', '', _HASHED)}"
)


def _gram_sql(n: int) -> str:
    value = str(n)
    for k in range(n):
        value = f"(({value} * {M.GRAM_BASE}::BIGINT + c[i_ + {k}]) % {M.GRAM_PRIME})"
    return f"SELECT doc_id, lang, unnest(list_transform(range(1, len(c) - {n} + 2), lambda i_: {value} % {M.FEATURES})) AS f FROM codes"


_CHARS = (
    f"codes AS MATERIALIZED (SELECT doc_id, lang, list_transform(string_split(' ' || {K.one_line('lower(text)')} || ' ', ''), "
    "lambda x_: unicode(x_)::BIGINT) AS c FROM documents), "
    f"own AS MATERIALIZED (SELECT doc_id, lang, f, count(*) AS n FROM ({' UNION ALL '.join(_gram_sql(n) for n in M.GRAM_SIZES)}) GROUP BY ALL), "
    "known AS (SELECT lang AS label, f, sum(n) AS m FROM own WHERE lang IS NOT NULL GROUP BY ALL), "
    "total AS (SELECT label, sum(m) AS t FROM known GROUP BY label), "
    "prior AS (SELECT lang AS label, ln(count(*) / sum(count(*)) OVER ()) AS p FROM documents WHERE lang IS NOT NULL GROUP BY lang), "
    "seen AS (SELECT doc_id, label, sum(n * ln(m + 1)) AS s FROM own JOIN known USING (f) GROUP BY ALL), "
    "size AS (SELECT doc_id, sum(n) AS n FROM own GROUP BY doc_id), "
    f"lg AS (SELECT doc_id, label, p + coalesce(s, 0) - n * ln(t + {M.FEATURES}) AS lg FROM size CROSS JOIN prior JOIN total USING (label) LEFT JOIN seen USING (doc_id, label)), "
    "ex AS (SELECT doc_id, label, exp(lg - max(lg) OVER (PARTITION BY doc_id)) AS e FROM lg), "
    "scores AS MATERIALIZED (SELECT doc_id, label, e / sum(e) OVER (PARTITION BY doc_id) AS score FROM ex)"
)
SQL = {
    "score_lang_chars": f"WITH {_CHARS}, {_RANKED} SELECT doc_id, lang, round(lang_score, 6) AS lang_score FROM ranked WHERE rank = 1",
    "score_math_prepared": f"WITH {_PREPARED} SELECT doc_id, round(coalesce(max(score) FILTER (label = '1'), 0), 6) AS math_score FROM scores GROUP BY doc_id",
    "curated_corpus": f"WITH RECURSIVE {_CLEAN}, {D.verified(0.8)}{D.COMPONENTS}, {C.FULL_HITS}, "
    "sums AS (SELECT cluster_id AS doc_id, sum(copies)::BIGINT AS n FROM clusters JOIN documents USING (doc_id) GROUP BY cluster_id), "
    "kept AS (SELECT doc_id, greatest(coalesce(n, 1), copies) AS dup_count, text FROM documents LEFT JOIN sums USING (doc_id) "
    "WHERE doc_id NOT IN (SELECT doc_id FROM clusters WHERE doc_id <> cluster_id) AND doc_id NOT IN (SELECT doc_id FROM hits)) "
    f"SELECT doc_id, dup_count, {D.INTERVAL} AS dup_interval, md5(text) AS text_md5 FROM kept",
    "quality_lines": f"WITH {_LINES} SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (reason = 'kept'), '') AS text, "
    "count(*) AS n_lines, count(*) FILTER (reason <> 'kept') AS n_removed FROM judged GROUP BY doc_id",
    "quality_line_report": f"WITH {_LINES} SELECT reason, count(*) AS n_lines FROM judged GROUP BY reason",
    "quality_docs": f"WITH {quality_ctes('documents')} SELECT doc_id, n_words, stop_words, "
    + ", ".join(
        f"round({c}, 6) AS {c}"
        for c in ("mean_length", "symbol_ratio", "alpha_share", "bullet_share", "ellipsis_share", "duplicate_line_share")
    )
    + ", disposition FROM quality",
    "quality_report": f"WITH {quality_ctes('documents')} SELECT lang, disposition, count(*) AS n_docs FROM quality GROUP BY ALL",
    "train_text_model": f"WITH {model_ctes('documents', 'lang')} SELECT token, label, round(weight, 6) AS weight FROM weights "
    "UNION ALL SELECT NULL, label, round(prior, 6) FROM priors",
    "class_probabilities": f"WITH {_TOPIC} SELECT doc_id, label, round(score, 6) AS score FROM scores",
    "score_lang": f"WITH {_LANG}, {_RANKED} SELECT doc_id, lang, round(lang_score, 6) AS lang_score FROM ranked WHERE rank = 1",
    "top_language": f"WITH {_LANG}, {_RANKED} SELECT doc_id, rank, lang, round(lang_score, 6) AS lang_score FROM ranked WHERE rank <= 3",
    "lang_filter": f"WITH {_LANG}, {_RANKED} SELECT doc_id FROM ranked WHERE rank = 1 AND lang = 'en' AND lang_score >= 0.65",
    "score_math": f"WITH {_MATH} SELECT doc_id, round(math_score, 6) AS math_score FROM math",
    "class_score": f"WITH {_TOPIC} SELECT doc_id, round(max(score) FILTER (label = '0'), 6) AS zero, 0.0::DOUBLE AS missing FROM scores GROUP BY doc_id",
    "math_filter": f"WITH {_MATH} SELECT doc_id FROM math WHERE math_score >= 0.5",
    "score_threshold_report": f"WITH {_MATH} SELECT source, count(*) AS n_docs, count(*) FILTER (math_score >= 0.5) AS n_retained, "
    "count(*) FILTER (math_score >= 0.8) AS math_retained FROM math JOIN documents USING (doc_id) GROUP BY source",
}
