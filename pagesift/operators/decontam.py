"""N-gram decontamination: an index of evaluation n-grams, and the documents that hit it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.functions import text as T
from pagesift.functions.binding import let
from pagesift.operators.joins import BROADCAST_BYTES, lookup_join, table_bytes
from pagesift.operators.places import placed_join
from pagesift.session import materialize

N = 12


def gold_explode(tasks: DataFrame) -> DataFrame:
    """One row per gold label of ``(task, query, golds)``; rows without label or query are skipped."""
    return tasks.where(F.col("query").isNotNull()).select("task", "query", F.explode("golds").alias("label")).where(
        F.col("label").isNotNull()
    )


def check_queries(pairs: DataFrame) -> DataFrame:
    """Raise if a row lacks the query that overlap n-grams need."""
    missing = F.assert_true(F.col("query").isNotNull(), F.lit("find_query_ngrams is off but a document has no query"))
    return pairs.withColumn("_ok", missing).where(F.col("_ok").isNull()).drop("_ok")


def task_grams(
    pairs: DataFrame, n: int = N, query_ngrams: bool = False, overlap_ngrams: bool = True, **norm
) -> DataFrame:
    """N-grams ``(task, gram)`` of label, across query and label, and if asked of the query."""
    tokens = pairs.select(
        "task", T.words(F.col("query"), **norm).alias("q"), T.words(F.col("label"), **norm).alias("a")
    )
    none = F.array().cast("array<string>")
    parts = [T.ngrams(F.col("a"), n)]
    if query_ngrams:
        parts.append(F.coalesce(T.ngrams(F.col("q"), n), none))
    if overlap_ngrams:
        parts.append(F.coalesce(T.overlap_ngrams(F.col("q"), F.col("a"), n), none))
    return tokens.select("task", F.explode(F.concat(*parts)).alias("gram"))


def index_build(grams: DataFrame) -> DataFrame:
    """Distinct n-grams per task. Runs on any number of workers."""
    return grams.select("task", "gram").distinct()


def union_index(*indexes: DataFrame) -> DataFrame:
    out = indexes[0]
    for other in indexes[1:]:
        out = out.unionByName(other)
    return out.distinct()


def index_lookup(index: DataFrame) -> DataFrame:
    """One task per n-gram: of several tasks the last by name."""
    return index.groupBy("gram").agg(F.max("task").alias("task"))


def _grams_before_stop(text: Column, n: int, remove_punctuation: bool, stop_at_punctuation: bool) -> Column:
    """N-grams of a text, up to the first one that is nothing but punctuation."""
    grams = T.ngrams(T.words(text, remove_punctuation=remove_punctuation), n)
    if remove_punctuation or not stop_at_punctuation:
        return grams
    blank = lambda g: T.simplify(g) == ""

    def cut(g: Column) -> Column:
        stop = F.array_position(F.transform(g, blank), F.lit(True))
        return F.when(stop > 0, F.slice(g, F.lit(1), (stop - 1).cast("int"))).otherwise(g)

    return let(grams, cut)


def doc_grams(
    docs: DataFrame,
    n: int = N,
    hash_fn: Callable[[Column], Column] | None = F.xxhash64,
    remove_punctuation: bool = True,
    stop_at_punctuation: bool = True,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows ``(id, pos, key)`` for the n-grams of each document; the key is a hash or the n-gram."""
    grams = _grams_before_stop(F.col(text), n, remove_punctuation, stop_at_punctuation)
    if hash_fn is not None:
        grams = let(grams, lambda g: F.transform(g, lambda x: hash_fn(x)))
    return docs.select(id_col, F.posexplode(grams).alias("pos", "key"))


def gram_keys(words: Column, n: int, mix: Callable[..., Column] = F.xxhash64) -> Column:
    """64-bit keys of all runs of ``n`` words, from the words' own hashes: no run is ever built as a text."""

    def keys(hashes: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(hashes) - n)
        runs = F.transform(places, lambda i: mix(*[F.get(hashes, i + k) for k in range(n)]))
        return F.when(F.size(hashes) >= n, runs).otherwise(F.array().cast("array<bigint>"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), keys)


def join_contamination(
    docs: DataFrame,
    index: DataFrame,
    n: int = N,
    remove_punctuation: bool = True,
    stop_at_punctuation: bool = True,
    broadcast_bytes: int = BROADCAST_BYTES,
    id_col: str = "doc_id",
    text: str = "text",
    mix: Callable[..., Column] = F.xxhash64,
) -> DataFrame:
    """The first hit of each contaminated document: ``(id, pos, contaminated_ngram, contaminated_task)``.

    Documents send only ``(id, pos, 64-bit key)`` into the join, where the key is made of the words' hashes. Where a
    key meets one of the index, the n-gram is built from the document's words and compared, so equal keys of
    different n-grams (``mix`` makes the key) give no hit. Index n-grams of other lengths than ``n`` meet nothing.
    """
    whole = materialize(index_lookup(index), "index-lookup")
    if not remove_punctuation and stop_at_punctuation:
        return _hits_by_text(docs, whole, n, remove_punctuation, stop_at_punctuation, broadcast_bytes, id_col, text)
    tokens = F.split("gram", " ")
    keyed = whole.select(F.explode(gram_keys(tokens, n, mix)).alias("key"), "gram", "task", F.size(tokens).alias("n"))
    keyed = materialize(keyed.where(F.col("n") == n).drop("n"), "index-keys")
    words = T.words(F.col(text), remove_punctuation=remove_punctuation)
    rows = docs.select(id_col, F.posexplode(gram_keys(words, n, mix)).alias("pos", "key"))
    found = materialize(lookup_join(rows, keyed.select("key").distinct(), "key", "left_semi", broadcast_bytes), "gram-candidates")
    # Few documents have candidates; their words at those places are looked at, each text once.
    places = found.groupBy(id_col).agg(F.sort_array(F.collect_set("pos")).alias("_places"))
    named = placed_join(docs.select(id_col, text), materialize(places, "gram-places"), id_col)

    def grams(w: Column) -> Column:
        return F.transform("_places", lambda p: F.struct(p.alias("pos"), F.array_join(F.slice(w, p + 1, n), " ").alias("gram")))

    built = named.select(id_col, F.inline(let(T.words(F.col(text), remove_punctuation=remove_punctuation), grams)))
    hits = lookup_join(materialize(built, "gram-texts"), whole, "gram", "inner", broadcast_bytes)
    return _first_hits(hits, id_col)


def _first_hits(hits: DataFrame, id_col: str) -> DataFrame:
    first = hits.groupBy(id_col).agg(F.min(F.struct("pos", "gram", "task")).alias("first"))
    return first.select(
        id_col, F.col("first.pos").alias("pos"), F.col("first.gram").alias("contaminated_ngram"),
        F.col("first.task").alias("contaminated_task"),
    )


def _hits_by_text(docs, whole, n, remove_punctuation, stop_at_punctuation, broadcast_bytes, id_col, text) -> DataFrame:
    """Hits where a text ends at its first n-gram of punctuation, which takes the n-grams themselves to find."""
    lookup = whole.select(F.xxhash64("gram").alias("key"), "gram", "task")
    rows = docs.select(id_col, F.posexplode(_grams_before_stop(F.col(text), n, remove_punctuation, stop_at_punctuation)).alias("pos", "gram"))
    rows = rows.withColumn("key", F.xxhash64("gram"))
    keys = lookup.select("key").distinct()
    found = materialize(lookup_join(rows, keys, "key", "left_semi", broadcast_bytes), "gram-candidates")
    return _first_hits(lookup_join(found.drop("key"), whole, "gram", "inner", broadcast_bytes), id_col)


def contam_filter(docs: DataFrame, index: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """All documents with ``disposition`` (``kept`` or ``contaminated``) and the first hit.

    The hits are written and measured. They come back by broadcast or by place, so the texts are not shuffled.
    """
    hits = materialize(join_contamination(docs, index, id_col=id_col, **options).drop("pos"), "hits")
    return placed_join(docs, hits, id_col, "left").withColumn(
        "disposition", F.when(F.col("contaminated_task").isNotNull(), "contaminated").otherwise("kept")
    )


def semi_contaminated(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return placed_join(docs, materialize(hits.select(id_col), "hits"), id_col, "left_semi")


def anti_contaminated(docs: DataFrame, hits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return placed_join(docs, materialize(hits.select(id_col), "hits"), id_col, "left_anti")


def contam_by_task(hits: DataFrame) -> DataFrame:
    return hits.groupBy(F.col("contaminated_task").alias("task")).agg(F.count(F.lit(1)).alias("n_removed"))


def contam_by_group(hits: DataFrame) -> DataFrame:
    """Counts per task group, the part of the name before ``:``; names without it are not counted."""
    grouped = hits.where(F.col("contaminated_task").contains(":"))
    return grouped.groupBy(F.substring_index("contaminated_task", ":", 1).alias("task_group")).agg(
        F.count(F.lit(1)).alias("n_removed")
    )
