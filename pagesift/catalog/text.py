"""Word-level text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesift.catalog import duck as K
from pagesift.catalog import fixtures as X
from pagesift.functions import symbols as S
from pagesift.functions import text as T
from pagesift.functions.hashing import OF_BYTES, md5_31
from pagesift.functions.minhash import run_hashes
from pagesift.functions.unicode import classifier_text
from pagesift.sources.tables import scan

N = 12
CUT = 64


def tokenize_wordpunct(spark, sf):
    tokens = T.word_punct_tokens(F.col("text"))
    return X.documents(spark, sf).select("doc_id", F.posexplode(tokens).alias("pos", "token"))


def math_normalize(spark, sf):
    return X.documents(spark, sf).select("doc_id", T.classifier_line(T.one_line(F.col("text"))).alias("line"))


def math_preprocess(spark, sf):
    """The whole preprocessing, normal form included; its SQL has no normal form, as the test texts need none."""
    return X.documents(spark, sf).select("doc_id", classifier_text(F.col("text")).alias("line"))


def line_cut(spark, sf):
    """End-of-line marks after every 64 tokens, a size that most texts reach."""
    line = T.classifier_line(T.one_line(F.col("text")))
    return X.documents(spark, sf).select("doc_id", T.cut_lines(line, CUT).alias("line"))


def simplify_text(spark, sf):
    return X.documents(spark, sf).select(
        "doc_id",
        T.simplify(F.col("text")).alias("simple"),
        T.simplify(F.col("text"), remove_punctuation=False, norm_numbers=True).alias("with_punctuation"),
    )


def ngrams(spark, sf):
    grams = T.ngrams(T.words(F.col("text")), N)
    return X.documents(spark, sf).select("doc_id", F.posexplode(grams).alias("pos", "gram"))


def query_ngrams(spark, sf):
    grams = T.ngrams(T.words(F.col("q")), N)
    return X.chat_pairs(spark, sf).select("conv_id", "turn", F.posexplode(grams).alias("pos", "gram"))


def overlap_ngrams(spark, sf):
    grams = T.overlap_ngrams(T.words(F.col("q")), T.words(F.col("a")), N)
    return X.chat_pairs(spark, sf).select("conv_id", "turn", F.posexplode(grams).alias("pos", "gram"))


def gram_hash(spark, sf):
    """Hashed 5-word runs of the whole texts, as the near-duplicate job uses them."""
    texts = X.documents(spark, sf).select("doc_id", T.half_simple(F.col("text")).alias("text"))
    return run_hashes(texts, "doc_id", 5, OF_BYTES[md5_31]).select("doc_id", F.posexplode("hashes").alias("pos", "hash"))


def _symbol_text(spark, sf, symbols):
    """One line per part with three symbols out of the table."""
    every = F.lit("".join(symbols))
    pick = lambda k: F.substring(every, (F.col("p_partkey") * k % len(symbols) + 1).cast("int"), F.lit(1))
    return scan(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("$ "), pick(1), F.col("p_name"), pick(7), F.lit(" } é \\textcolor[rgb]{0,1,0}"), pick(31)).alias("t"),
    )


def unicode_to_latex(spark, sf):
    rows = _symbol_text(spark, sf, list(S.unicode_symbols()))
    return rows.select("p_partkey", S.unicode_to_latex(F.col("t")).alias("tex"))


def entity_to_latex(spark, sf):
    rows = _symbol_text(spark, sf, list(S.entity_symbols()))
    return rows.select(
        "p_partkey",
        S.entity_to_latex(F.col("t")).alias("tex"),
        S.text_entity_to_latex(F.concat(F.col("t"), F.lit("50% & #1_a\u2003b"))).alias("text_tex"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        tokenize_wordpunct, math_normalize, math_preprocess, line_cut, simplify_text, ngrams, query_ngrams,
        overlap_ngrams, gram_hash, unicode_to_latex, entity_to_latex,
    )
}

_TOKENS = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s\p{Z}\x{1c}-\x{1f}\x{85}]+"


_DIGITS = r"\p{Nd}+"


def _line_sql(source: str) -> str:
    """CTE chain ending in ``lines(doc_id, line)``."""
    return (
        f"tk AS MATERIALIZED (SELECT doc_id, list_transform(regexp_extract_all({source}, {K.q(_TOKENS)}), "
        "lambda t_: lower(t_)) AS w FROM documents), "
        r"num AS (SELECT doc_id, list_filter(list_transform(w, lambda t_: CASE WHEN regexp_full_match(t_, '\p{Nd}+') "
        "THEN '<NUM>' ELSE t_ END), lambda t_: length(t_) <= 100) AS w FROM tk), "
        r"lines AS (SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(array_to_string(w, ' '), '[-_]+', ' ', 'g'), "
        r"'[^a-zA-Z0-9\s<>]', '', 'g'), '\s+', ' ', 'g')) AS line FROM num)"
    )


def _cut_sql(size: int) -> str:
    return (
        f"WITH {_line_sql(K.one_line('text'))}, sp AS MATERIALIZED (SELECT doc_id, {K.split_blanks('line')} AS w FROM lines) "
        f"SELECT doc_id, array_to_string(list_transform(range(0, greatest(len(w), 1), {size}), "
        f"lambda i_: array_to_string(w[i_ + 1:i_ + {size}], ' ')), ' <EOS> ') AS line FROM sp"
    )


def _grams(source: str, keys: str, tokens: str, expression: str) -> str:
    return (
        f"WITH {source}tk AS MATERIALIZED (SELECT {keys}, {tokens} AS w FROM {{table}}), "
        f"g AS (SELECT {keys}, {expression} AS g FROM tk) "
        f"SELECT {keys}, generate_subscripts(g, 1) - 1 AS pos, unnest(g) AS gram FROM g"
    )


def _symbols_sql(symbols: dict[str, str]) -> str:
    every = K.q("".join(symbols))
    pick = lambda k: f"substr({every}, (p_partkey * {k} % {len(symbols)} + 1)::INT, 1)"
    return (
        f"src AS MATERIALIZED (SELECT p_partkey, '$ ' || {pick(1)} || p_name || {pick(7)} || ' }} é \\textcolor[rgb]{{0,1,0}}' || {pick(31)} AS t FROM part), "
        "sym(c, x) AS (VALUES " + ", ".join(f"({K.q(c)}, {K.q(x)})" for c, x in symbols.items()) + "), "
        "ch AS (SELECT p_partkey, unnest(regexp_extract_all(t, '(?s).')) AS c, generate_subscripts(regexp_extract_all(t, '(?s).'), 1) AS i FROM src), "
        "mapped AS (SELECT p_partkey, string_agg(coalesce(x, ch.c), '' ORDER BY i) AS t FROM ch LEFT JOIN sym ON sym.c = ch.c GROUP BY p_partkey)"
    )


def _text_entities(text: str) -> str:
    out = K.rep(text, "\\", "")
    for char, tex in S.TEXT_ENTITIES.items():
        out = K.rep(out, char, tex)
    return out


SQL = {
    "tokenize_wordpunct": f"WITH tk AS (SELECT doc_id, regexp_extract_all(text, {K.q(_TOKENS)}) AS w FROM documents) "
    "SELECT doc_id, generate_subscripts(w, 1) - 1 AS pos, unnest(w) AS token FROM tk",
    "math_normalize": f"WITH {_line_sql(K.one_line('text'))} SELECT doc_id, line FROM lines",
    "math_preprocess": _cut_sql(1024),
    "line_cut": _cut_sql(CUT),
    "simplify_text": f"SELECT doc_id, {K.simplify('text')} AS simple, "
    f"{K.one_line(K.rx('lower(text)', _DIGITS, '0'))} AS with_punctuation FROM documents",
    "ngrams": _grams("", "doc_id", K.words("text"), K.ngrams("w", N)).replace("{table}", "documents"),
    "query_ngrams": _grams(X.PAIRS + ", ", "conv_id, turn", K.words("q"), K.ngrams("w", N)).replace("{table}", "chat"),
    "overlap_ngrams": f"WITH {X.PAIRS}, tk AS MATERIALIZED (SELECT conv_id, turn, {K.words('q')} AS q, {K.words('a')} AS a FROM chat), "
    f"g AS (SELECT conv_id, turn, {K.overlap('q', 'a', N)} AS g FROM tk) "
    "SELECT conv_id, turn, generate_subscripts(g, 1) - 1 AS pos, unnest(g) AS gram FROM g",
    "gram_hash": f"WITH tk AS MATERIALIZED (SELECT doc_id, {K.words('text')} AS w FROM documents), "
    f"g AS (SELECT doc_id, {K.ngrams('w', 5)} AS g FROM tk), "
    "x AS (SELECT doc_id, generate_subscripts(g, 1) - 1 AS pos, unnest(g) AS gram FROM g) "
    f"SELECT doc_id, pos, {K.md5_31('gram')} AS hash FROM x",
    "unicode_to_latex": f"WITH {_symbols_sql(S.unicode_symbols())} SELECT p_partkey, replace(replace(regexp_replace("
    r"regexp_replace(t, '\\textcolor\[rgb\]\{[0-9.,]+\}', '', 'g'), '^\$ ', '$'), '{\ }', '\ '), ' }', '}') AS tex FROM mapped",
    "entity_to_latex": f"WITH {_symbols_sql(S.entity_symbols())} SELECT p_partkey, mapped.t AS tex, "
    f"{_text_entities('src.t || ' + K.q('50% & #1_a' + chr(0x2003) + 'b'))} AS text_tex FROM mapped JOIN src USING (p_partkey)",
}
