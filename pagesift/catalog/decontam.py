"""N-gram decontamination of the documents against the benchmark items."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesift.catalog import duck as K
from pagesift.catalog import fixtures as X
from pagesift.functions.hashing import md5_31
from pagesift.operators import decontam as C
from pagesift.session import materialize, new_path
from pagesift.sinks.writers import sink_index as write_index
from pagesift.sources.index import scan_index as read_index

N = 12


def _pairs(spark, sf):
    return C.gold_explode(X.benchmark_tasks(spark, sf))


def _index(spark, sf, **options):
    return C.index_build(C.task_grams(_pairs(spark, sf), N, **options))


def written_index(spark, sf):
    """The index as the filter gets it: a written table."""
    return materialize(_index(spark, sf, query_ngrams=True), "index")


def _hits(spark, sf):
    return C.join_contamination(X.documents(spark, sf), written_index(spark, sf), N)


def gold_explode(spark, sf):
    return _pairs(spark, sf)


def index_build(spark, sf):
    return _index(spark, sf)


def index_with_query(spark, sf):
    return _index(spark, sf, query_ngrams=True)


def index_hashes(spark, sf):
    """Hashed index: hash of every n-gram and its task."""
    return _index(spark, sf).select("task", md5_31(F.col("gram")).alias("hash"))


def union_index(spark, sf):
    """Index of the benchmark united with that of the question and answer pairs."""
    chat = X.chat_pairs(spark, sf).select(F.lit("input").alias("task"), F.col("q").alias("query"), F.col("a").alias("label"))
    documents = C.index_build(C.task_grams(C.check_queries(chat), N))
    return C.union_index(_index(spark, sf), documents)


def sink_index(spark, sf):
    """Write the index by task and read it back as a plain table."""
    path = new_path(spark, "index")
    write_index(_index(spark, sf), path)
    return spark.read.parquet(path).select("gram", F.col("task").cast("string").alias("task"))


def scan_index(spark, sf):
    path = new_path(spark, "index")
    write_index(_index(spark, sf, query_ngrams=True), path)
    return read_index(spark, path)


def join_contamination(spark, sf):
    return _hits(spark, sf)


def first_contaminated_gram(spark, sf):
    return _hits(spark, sf).select("doc_id", "contaminated_ngram")


def contam_filter(spark, sf):
    docs = X.documents(spark, sf)
    out = C.contam_filter(docs, written_index(spark, sf), n=N)
    return out.select("doc_id", "disposition", "contaminated_ngram", "contaminated_task")


def contam_filter_punctuation(spark, sf):
    """Punctuation kept in the n-grams: the scan of a document ends at its first all-punctuation n-gram."""
    index = materialize(
        C.index_build(C.task_grams(_pairs(spark, sf), 5, query_ngrams=True, remove_punctuation=False)), "index"
    )
    out = C.contam_filter(X.documents(spark, sf), index, n=5, remove_punctuation=False)
    return out.select("doc_id", "disposition", "contaminated_ngram", "contaminated_task")


def semi_contaminated(spark, sf):
    return C.semi_contaminated(X.documents(spark, sf), _hits(spark, sf)).select("doc_id", "lang", "n_chars")


def anti_contaminated(spark, sf):
    return C.anti_contaminated(X.documents(spark, sf), _hits(spark, sf)).select("doc_id", "lang", "n_chars")


def contam_by_task(spark, sf):
    return C.contam_by_task(_hits(spark, sf))


def contam_by_group(spark, sf):
    return C.contam_by_group(_hits(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        gold_explode, index_build, index_with_query, index_hashes, union_index, sink_index, scan_index,
        join_contamination, first_contaminated_gram, contam_filter, contam_filter_punctuation, semi_contaminated,
        anti_contaminated, contam_by_task, contam_by_group,
    )
}

_INDEX = X.index_ctes(N)
_FULL = X.index_ctes(N, query=True)


def hit_ctes(index: str, tokens: str, n: int, before_stop: str = "true") -> str:
    """Ends in ``hits(doc_id, pos, contaminated_ngram, contaminated_task)``."""
    return (
        f"{index}, lookup AS (SELECT gram, max(task) AS task FROM idx GROUP BY gram), "
        f"dt AS MATERIALIZED (SELECT doc_id, {tokens} AS w FROM documents), "
        f"dg AS (SELECT doc_id, {K.ngrams('w', n)} AS g FROM dt), "
        "dx AS (SELECT doc_id, generate_subscripts(g, 1) - 1 AS pos, unnest(g) AS gram FROM dg), "
        "stops AS (SELECT doc_id, min(pos) AS stop FROM dx WHERE NOT regexp_matches(gram, '[\\p{L}\\p{N}]') GROUP BY doc_id), "
        "found AS (SELECT dx.doc_id, pos, gram, task, row_number() OVER (PARTITION BY dx.doc_id ORDER BY pos) AS r "
        f"FROM dx JOIN lookup USING (gram) LEFT JOIN stops USING (doc_id) WHERE {before_stop}), "
        "hits AS (SELECT doc_id, pos, gram AS contaminated_ngram, task AS contaminated_task FROM found WHERE r = 1)"
    )


FULL_HITS = _HITS = hit_ctes(_FULL, K.words("text"), N)
_PUNCT_INDEX = X.index_ctes(5, query=True).replace(
    f"pair_tokens AS (SELECT task, {K.words('query')} AS q, {K.words('label')} AS a FROM pairs)",
    f"pair_tokens AS (SELECT task, {K.words('query', True)} AS q, {K.words('label', True)} AS a FROM pairs)",
)
_PUNCT_HITS = hit_ctes(_PUNCT_INDEX, K.words("text", True), 5, "stop IS NULL OR pos < stop")
_FILTERED = (
    " SELECT doc_id, CASE WHEN contaminated_task IS NULL THEN 'kept' ELSE 'contaminated' END AS disposition, "
    "contaminated_ngram, contaminated_task FROM documents LEFT JOIN hits USING (doc_id)"
)

SQL = {
    "gold_explode": f"WITH {X.TASKS} SELECT task, query, label FROM pairs",
    "index_build": f"WITH {_INDEX} SELECT task, gram FROM idx",
    "index_with_query": f"WITH {_FULL} SELECT task, gram FROM idx",
    "index_hashes": f"WITH {_INDEX} SELECT task, {K.md5_31('gram')} AS hash FROM idx",
    "union_index": f"WITH {_INDEX}, {X.PAIRS}, ct AS MATERIALIZED (SELECT {K.words('q')} AS q, {K.words('a')} AS a FROM chat) "
    f"SELECT task, gram FROM idx UNION SELECT 'input', unnest({K.ngrams('a', N)}) FROM ct UNION SELECT 'input', unnest({K.overlap('q', 'a', N)}) FROM ct",
    "sink_index": f"WITH {_INDEX} SELECT replace(task, ' ', '_') AS task, gram FROM idx",
    "scan_index": f"WITH {_FULL} SELECT gram, max(replace(task, ' ', '_')) AS task FROM idx GROUP BY gram",
    "join_contamination": f"WITH {_HITS} SELECT * FROM hits",
    "first_contaminated_gram": f"WITH {_HITS} SELECT doc_id, contaminated_ngram FROM hits",
    "contam_filter": f"WITH {_HITS}{_FILTERED}",
    "contam_filter_punctuation": f"WITH {_PUNCT_HITS}{_FILTERED}",
    "semi_contaminated": f"WITH {_HITS} SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM hits)",
    "anti_contaminated": f"WITH {_HITS} SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM hits)",
    "contam_by_task": f"WITH {_HITS} SELECT contaminated_task AS task, count(*) AS n_removed FROM hits GROUP BY 1",
    "contam_by_group": f"WITH {_HITS} SELECT string_split(contaminated_task, ':')[1] AS task_group, count(*) AS n_removed "
    "FROM hits WHERE contains(contaminated_task, ':') GROUP BY 1",
}
