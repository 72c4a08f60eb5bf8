"""Exact and near duplicates of the documents, removal, metadata, intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesift.catalog import duck as K
from pagesift.catalog import fixtures as X
from pagesift.functions.hashing import PRIME31
from pagesift.functions.minhash import BUCKETS, HASHES, coefficients
from pagesift.operators import dedup as D
from pagesift.operators import reorganize as R
from pagesift.operators.joins import lookup_join
from pagesift.operators.listings import split_consecutive
from pagesift.session import materialize, new_path

SPLITS = 7


def _with_split(spark, sf):
    """Documents with the split of their file: the files in order of their number, cut into runs."""
    docs = X.documents(spark, sf)
    number = F.regexp_extract("source", r"([0-9]+)$", 1).cast("long")
    files = docs.select("source").distinct().select("source", number.alias("pos"))
    return lookup_join(docs, split_consecutive(files, SPLITS).drop("pos"), "source")


def exact_dedup(spark, sf):
    return D.exact_dedup(_with_split(spark, sf), ["split"]).select("doc_id", "source", "split")


def exact_dedup_global(spark, sf):
    return D.exact_dedup(X.documents(spark, sf)).select("doc_id", "source")


def keep_first_duplicate(spark, sf):
    return D.exact_groups(X.documents(spark, sf)).select(F.col("first_id").alias("doc_id"), "copies")


def _edges(spark, sf):
    return D.minhash_pairs(D.minhash_signature(X.documents(spark, sf)))


def minhash_signature(spark, sf):
    return D.minhash_signature(X.documents(spark, sf))


def minhash_pairs(spark, sf):
    return _edges(spark, sf)


def jaccard_scores(spark, sf):
    scored = D.jaccard_scores(_edges(spark, sf), X.documents(spark, sf), 0.5)
    return scored.select("u", "v", F.round("jaccard", 6).alias("jaccard"))


def jaccard_verify(spark, sf):
    """Clusters of the verified links of a strict threshold, which many buckets' own centers fail."""
    return D.verified_clusters(_edges(spark, sf), X.documents(spark, sf), 0.9)


def _clusters(spark, sf):
    return materialize(D.dup_clusters(_edges(spark, sf)), "clusters")


def dup_clusters(spark, sf):
    return D.dup_clusters(_edges(spark, sf))


def merge_clusters(spark, sf):
    """Clusters of the links of half of the documents, and the other links merged into them."""
    edges = materialize(_edges(spark, sf), "edges")
    forest = materialize(D.dup_clusters(edges.where("u % 2 = 0")), "forest")
    return D.merge_clusters(forest, edges.where("u % 2 = 1"))


def dup_remove_list(spark, sf):
    return D.dup_remove_list(_clusters(spark, sf), X.documents(spark, sf))


def dup_metadata(spark, sf):
    return D.dup_metadata(_clusters(spark, sf), X.documents(spark, sf))


def dup_sources(spark, sf):
    return D.dup_sources(_clusters(spark, sf), X.documents(spark, sf))


def merge_dup_results(spark, sf):
    """Remove lists of near and of exact duplicates, which overlap, as one."""
    docs = X.documents(spark, sf)
    near = D.dup_remove_list(_clusters(spark, sf), docs)
    firsts = D.exact_groups(docs).select(F.col("first_id").alias("doc_id"))
    exact = docs.join(firsts, "doc_id", "left_anti").select(F.col("source").alias("file"), "doc_id")
    return D.merge_dup_results(near, exact)


def merge_remove_meta(spark, sf):
    clusters = _clusters(spark, sf)
    docs = X.documents(spark, sf)
    return D.merge_remove_meta(D.dup_remove_list(clusters, docs), D.dup_metadata(clusters, docs).select("doc_id", "dup_count"))


def _kept(spark, sf):
    clusters = _clusters(spark, sf)
    docs = X.documents(spark, sf)
    return D.dup_removal(docs, D.dup_remove_list(clusters, docs), D.dup_metadata(clusters, docs))


def dup_removal(spark, sf):
    return _kept(spark, sf).select("doc_id", "lang", "n_chars", "dup_count")


def _file(docs):
    """Smaller files than ``source``: a file per source and thousand characters."""
    return F.concat_ws("/", "source", F.floor(F.col("n_chars") / 1000).cast("string"))


def files_without_dups(spark, sf):
    docs = X.documents(spark, sf).withColumn("file", _file(None))
    removed = docs.join(_clusters(spark, sf).select("doc_id"), "doc_id", "left_semi")
    return D.files_without_dups(docs, removed)


def dup_distribution(spark, sf):
    return D.dup_distribution(_kept(spark, sf))


def dup_intervals(spark, sf):
    return R.tag_intervals(_kept(spark, sf)).select("doc_id", "dup_count", "dup_interval")


def dup_intervals_by_count(spark, sf):
    """Intervals of other counts: line items per part and flag."""
    counts = X.scan(spark, sf, "lineitem").groupBy("l_partkey", "l_returnflag").agg(F.count(F.lit(1)).alias("dup_count"))
    return R.tag_intervals(counts).groupBy("dup_interval").agg(F.count(F.lit(1)).alias("n_groups"), F.sum("dup_count").alias("n_rows"))


def reorganize(spark, sf):
    """Write kept documents by interval and dump, and read the result back."""
    path = new_path(spark, "reorganized")
    kept = _kept(spark, sf).withColumn("dump", F.concat(F.lit("CC-MAIN-2024-"), F.lit(10) + F.col("doc_id") % 3))
    R.write_reorganized(kept.select("doc_id", "text", "dup_count", "dump"), path)
    return spark.read.parquet(path).select("doc_id", "dup_count", "dup_interval", "dump", F.md5("text").alias("text_md5"))


QUERIES = {
    f.__name__: f
    for f in (
        exact_dedup, exact_dedup_global, keep_first_duplicate, minhash_signature, minhash_pairs, jaccard_scores, jaccard_verify,
        dup_clusters, merge_clusters, dup_remove_list, dup_metadata, dup_sources, merge_dup_results, merge_remove_meta, dup_removal,
        files_without_dups, dup_distribution, dup_intervals, dup_intervals_by_count, reorganize,
    )
}

_SHINGLES = (
    f"tk AS MATERIALIZED (SELECT doc_id, {K.words('text')} AS w FROM documents), "
    f"sg AS (SELECT doc_id, {K.ngrams('w', 5)} AS g FROM tk), "
    "sh AS MATERIALIZED (SELECT DISTINCT doc_id, gram FROM (SELECT doc_id, unnest(g) AS gram FROM sg)), "
)
_PAIRS = coefficients(BUCKETS * HASHES)
_SIGNATURES = (
    f"{_SHINGLES}hs AS MATERIALIZED (SELECT doc_id, {K.md5_31('gram')} AS h FROM sh), "
    "mins AS MATERIALIZED (SELECT doc_id, "
    + ", ".join(f"min((h * {a}::BIGINT + {b}) % {PRIME31}) AS m{k}" for k, (a, b) in enumerate(_PAIRS))
    + " FROM hs GROUP BY doc_id), "
    "sigs AS MATERIALIZED ("
    + " UNION ALL ".join(
        f"SELECT doc_id, {b} AS bucket, md5(concat_ws('-', {', '.join(f'm{b * HASHES + i}' for i in range(HASHES))})) AS bucket_key FROM mins"
        for b in range(BUCKETS)
    )
    + ")"
)
EDGES = (
    f"{_SIGNATURES}, firsts AS (SELECT bucket, bucket_key, min(doc_id) AS u FROM sigs GROUP BY ALL), "
    "edges AS MATERIALIZED (SELECT DISTINCT u, doc_id AS v FROM sigs JOIN firsts USING (bucket, bucket_key) WHERE doc_id > u)"
)
COMPONENTS = (
    ", both_ways AS (SELECT u AS a, v AS b FROM edges UNION SELECT v, u FROM edges), "
    "reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a), "
    "labels_ AS (SELECT a AS doc_id, least(a, min(b)) AS cluster_id FROM reach GROUP BY a), "
    "clusters AS MATERIALIZED (SELECT doc_id, cluster_id, count(*) OVER (PARTITION BY cluster_id) AS dup_count FROM labels_)"
)


def verified(threshold: float) -> str:
    """``edges`` replaced by all pairs of a star's members that have enough shingles in common."""
    return (
        EDGES.replace("edges AS MATERIALIZED", "stars AS MATERIALIZED")
        + ", member AS (SELECT u AS g, v AS d FROM stars UNION SELECT u, u FROM stars), "
        "pair AS MATERIALIZED (SELECT DISTINCT a.d AS u, b.d AS v FROM member a JOIN member b ON a.g = b.g AND a.d < b.d), "
        "sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id), "
        "common AS (SELECT u, v, count(*) AS c FROM pair JOIN sh x ON x.doc_id = u JOIN sh y ON y.doc_id = v AND y.gram = x.gram GROUP BY u, v), "
        "edges AS MATERIALIZED (SELECT u, v FROM common JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v "
        f"WHERE c / (a.n + b.n - c) >= {threshold})"
    )


_CLUSTERS = f"RECURSIVE {EDGES}{COMPONENTS}"
_REMOVE = "removed AS (SELECT source AS file, doc_id FROM clusters JOIN documents USING (doc_id) WHERE doc_id <> cluster_id)"
_META = (
    "meta AS (SELECT cluster_id AS doc_id, count(*) AS dup_count, count(DISTINCT source) AS n_files, min(source) AS first_file, "
    "max(source) AS last_file FROM clusters JOIN documents USING (doc_id) GROUP BY cluster_id)"
)
_KEPT = (
    f"{_CLUSTERS}, {_REMOVE}, {_META}, kept AS (SELECT d.*, coalesce(meta.dup_count, 1) AS dup_count FROM documents d "
    "LEFT JOIN meta USING (doc_id) WHERE doc_id NOT IN (SELECT doc_id FROM removed))"
)
INTERVAL = (
    "CASE WHEN dup_count = 1 THEN '1-1' WHEN dup_count BETWEEN 2 AND 5 THEN '2-5' WHEN dup_count BETWEEN 6 AND 10 THEN '6-10' "
    "WHEN dup_count BETWEEN 11 AND 100 THEN '11-100' WHEN dup_count BETWEEN 101 AND 1000 THEN '101-1000' ELSE '1001-inf' END"
)
_SPLIT = (
    "files AS (SELECT source, ntile(7) OVER (ORDER BY regexp_extract(source, '([0-9]+)$', 1)::INT) - 1 AS split "
    "FROM (SELECT DISTINCT source FROM documents))"
)

SQL = {
    "exact_dedup": f"WITH {_SPLIT}, r AS (SELECT doc_id, source, split, row_number() OVER (PARTITION BY split, sha256(text) ORDER BY doc_id) AS r "
    "FROM documents JOIN files USING (source)) SELECT doc_id, source, split FROM r WHERE r = 1",
    "exact_dedup_global": "SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)",
    "keep_first_duplicate": "SELECT min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text",
    "minhash_signature": f"WITH {_SIGNATURES} SELECT doc_id, bucket, bucket_key FROM sigs",
    "minhash_pairs": f"WITH {EDGES} SELECT u, v FROM edges",
    "jaccard_verify": f"WITH RECURSIVE {verified(0.9)}{COMPONENTS} SELECT doc_id, cluster_id, dup_count FROM clusters",
    "jaccard_scores": f"WITH {EDGES}, sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id), "
    "common AS (SELECT u, v, count(*) AS c FROM edges JOIN sh x ON x.doc_id = u JOIN sh y ON y.doc_id = v AND y.gram = x.gram GROUP BY u, v) "
    "SELECT u, v, round(c / (a.n + b.n - c), 6) AS jaccard FROM common JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v "
    "WHERE c / (a.n + b.n - c) >= 0.5",
    "dup_clusters": f"WITH {_CLUSTERS} SELECT doc_id, cluster_id, dup_count FROM clusters",
    "merge_clusters": f"WITH {_CLUSTERS} SELECT doc_id, cluster_id, dup_count FROM clusters",
    "dup_remove_list": f"WITH {_CLUSTERS}, {_REMOVE} SELECT file, doc_id FROM removed",
    "dup_metadata": f"WITH {_CLUSTERS}, {_META} SELECT * FROM meta",
    "dup_sources": f"WITH {_CLUSTERS} SELECT cluster_id AS doc_id, source AS file, count(*) AS copies FROM clusters JOIN documents USING (doc_id) GROUP BY 1, 2",
    "merge_dup_results": f"WITH {_CLUSTERS}, {_REMOVE} SELECT file, doc_id FROM removed UNION "
    "SELECT source, doc_id FROM documents WHERE doc_id NOT IN (SELECT min(doc_id) FROM documents GROUP BY text)",
    "merge_remove_meta": f"WITH {_CLUSTERS}, {_REMOVE}, {_META} SELECT doc_id, removed.doc_id IS NOT NULL AS to_remove, dup_count "
    "FROM removed FULL JOIN meta USING (doc_id)",
    "dup_removal": f"WITH {_KEPT} SELECT doc_id, lang, n_chars, dup_count FROM kept",
    "files_without_dups": f"WITH {_CLUSTERS}, f AS (SELECT doc_id, source || '/' || (n_chars // 1000) AS file FROM documents) "
    "SELECT DISTINCT file FROM f WHERE file NOT IN (SELECT file FROM f WHERE doc_id IN (SELECT doc_id FROM clusters))",
    "dup_distribution": f"WITH {_KEPT} SELECT {INTERVAL} AS dup_interval, count(*) AS n_docs, sum(dup_count)::BIGINT AS n_copies FROM kept GROUP BY 1",
    "dup_intervals": f"WITH {_KEPT} SELECT doc_id, dup_count, {INTERVAL} AS dup_interval FROM kept",
    "dup_intervals_by_count": "WITH c AS (SELECT count(*) AS dup_count FROM lineitem GROUP BY l_partkey, l_returnflag) "
    f"SELECT {INTERVAL} AS dup_interval, count(*) AS n_groups, sum(dup_count)::BIGINT AS n_rows FROM c GROUP BY 1",
    "reorganize": f"WITH {_KEPT} SELECT doc_id, dup_count, {INTERVAL} AS dup_interval, 'CC-MAIN-2024-' || (10 + doc_id % 3) AS dump, md5(text) AS text_md5 FROM kept",
}
