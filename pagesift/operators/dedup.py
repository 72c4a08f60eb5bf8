"""Exact and near duplicates, their removal, and their metadata.

No step collects the members of a group. Groups are reduced to one row (their
smallest id and their size) by aggregations that combine before the shuffle,
and members meet that row again in a join that spreads large groups.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.functions import text as T
from pagesift.functions.binding import let
from pagesift.functions.hashing import OF_BYTES, md5_31
from pagesift.functions.minhash import BUCKETS, HASHES, signatures
from pagesift.operators.joins import ROWS_PER_TASK, count_keys, lookup_join, salted_join
from pagesift.operators.places import placed_join
from pagesift.session import materialize

SHINGLE_WORDS = 5
NEAR = 0.8
#: Centers of a group in a round for one in the round before; members still to be compared per center, up to which all are centers.
GROWTH = 8
#: Centers of a group that is compared whole, for each of its slots.
SLOT_CENTERS = 64
#: Labels that merge in a round are broadcast up to so many bytes.
LABEL_BYTES = 8 << 20

# Lower and upper bound of every duplicate-count interval.
INTERVALS = ((1, 1), (2, 5), (6, 10), (11, 100), (101, 1000), (1001, None))


# ---- exact ----


def exact_dedup(
    df: DataFrame, within: Sequence[str] = (), id_col: str = "doc_id", text: str = "text", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Keep the row with the smallest id among equal texts.

    ``within`` limits the comparison to rows of the same split; empty means
    global. Only digests and ids are shuffled to find the copies; the texts
    then lose the copies' ids, without a shuffle of theirs.
    """
    return remove_ids(df, exact_copies(df, within, id_col, text, rows_per_task), id_col)


def exact_copies(
    df: DataFrame, within: Sequence[str] = (), id_col: str = "doc_id", text: str = "text", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Ids of all rows whose text stands in a row with a smaller id."""
    keys = [*within, "digest"]
    repeated = materialize(exact_groups(df, within, id_col, text).where("copies > 1"), "repeated-texts")
    sizes = repeated.select(*keys, F.col("copies").alias("n"))
    members = salted_join(_digests(df, within, id_col, text), repeated.drop("copies"), keys, sizes, "inner", rows_per_task)
    return members.where(F.col(id_col) != F.col("first_id")).select(id_col)


def remove_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Documents without the listed ids. The ids are written once and measured; the texts are never shuffled."""
    return placed_join(docs, materialize(ids.select(id_col), "ids"), id_col, "left_anti")


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return placed_join(docs, materialize(ids.select(id_col), "ids"), id_col, "left_semi")


def _digests(df: DataFrame, within: Sequence[str], id_col: str, text: str) -> DataFrame:
    return df.select(*within, F.unhex(F.sha2(F.col(text), 256)).alias("digest"), id_col)


def exact_groups(df: DataFrame, within: Sequence[str] = (), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per distinct text: ``within``, ``digest``, ``first_id``, ``copies``."""
    return (
        _digests(df, within, id_col, text)
        .groupBy(*within, "digest")
        .agg(F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("copies"))
    )


# ---- near ----


def shingle_hashes(text: Column, n: int = SHINGLE_WORDS, hash_fn: Callable[[Column], Column] = md5_31) -> Column:
    """Hashes of all runs of ``n`` words."""
    return let(T.ngrams(T.words(text), n), lambda grams: F.transform(grams, hash_fn))


def minhash_signature(
    df: DataFrame,
    buckets: int = BUCKETS,
    hashes: int = HASHES,
    n: int = SHINGLE_WORDS,
    seed: int = 1,
    hash_fn: Callable[[Column], Column] = md5_31,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Rows ``(id, bucket, bucket_key)``; texts shorter than ``n`` words have none."""
    if hash_fn in OF_BYTES:
        lines = df.select(id_col, T.simplify(F.col(text)).alias("line"))
        signed = signatures(lines, id_col, buckets, hashes, seed, n, OF_BYTES[hash_fn])
    else:
        shingles = df.select(id_col, shingle_hashes(F.col(text), n, hash_fn).alias("shingles"))
        signed = signatures(shingles, id_col, buckets, hashes, seed)
    rows = signed.select(id_col, F.posexplode("minima").alias("bucket", "values"))
    return rows.select(id_col, "bucket", F.md5(F.array_join("values", "-")).alias("bucket_key"))


def minhash_pairs(signed: DataFrame, id_col: str = "doc_id", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Distinct edges ``(u, v)``, u < v, from the smallest id of a bucket to its other members.

    A bucket of n documents gives n - 1 edges, never all pairs.
    """
    keys = ["bucket", "bucket_key"]
    signed = materialize(signed, "signatures")
    shared = materialize(
        signed.groupBy(*keys)
        .agg(F.min(id_col).alias("u"), F.count(F.lit(1)).alias("n"))
        .where("n > 1"),
        "shared-buckets",
    )
    sizes = shared.select(*keys, "n")
    members = salted_join(signed, shared.drop("n"), keys, sizes, "inner", rows_per_task)
    return members.where(F.col(id_col) > F.col("u")).select("u", F.col(id_col).alias("v")).distinct()


def _shingle_sets(docs: DataFrame, edges: DataFrame, n: int, id_col: str, text: str) -> DataFrame:
    """Sets of 64-bit shingle hashes ``(id, s)`` of the documents that edges name, written once."""
    ends = edges.select(F.col("u").alias(id_col)).unionAll(edges.select(F.col("v").alias(id_col))).distinct()
    hashes = let(T.ngrams(T.words(F.col(text)), n), lambda g: F.array_distinct(F.transform(g, lambda x: F.xxhash64(x))))
    return materialize(keep_ids(docs, ends, id_col).select(id_col, hashes.alias("s")), "shingle-sets")


def _scored(edges: DataFrame, sets: DataFrame, threshold: float, id_col: str, rows_per_task: int) -> DataFrame:
    out = edges
    for end in ("u", "v"):
        side = sets.select(F.col(id_col).alias(end), F.col("s").alias(f"s{end}"))
        out = salted_join(out, side, [end], count_keys(edges, [end]), "inner", rows_per_task)
    both = F.size(F.array_intersect("su", "sv"))
    score = both / (F.size("su") + F.size("sv") - both)
    # As a generator the test uses the value computed once; a filter would compute it again.
    return out.select("u", "v", F.explode(F.filter(F.array(score), lambda x: x >= threshold)).alias("jaccard"))


def jaccard_scores(
    edges: DataFrame, docs: DataFrame, threshold: float = 0.0, n: int = SHINGLE_WORDS, id_col: str = "doc_id",
    text: str = "text", rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The given edges with the exact Jaccard similarity of their shingle sets, at or above ``threshold``.

    A document with many edges is repeated over several tasks by the salted join.
    """
    edges = materialize(edges, "edges")
    return _scored(edges, _shingle_sets(docs, edges, n, id_col, text), threshold, id_col, rows_per_task)


def jaccard_verify(
    edges: DataFrame, docs: DataFrame, threshold: float = 0.0, n: int = SHINGLE_WORDS, id_col: str = "doc_id",
    text: str = "text", rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Links ``(u, v, jaccard)`` at or above ``threshold`` inside the groups that star edges name.

    A group is a center ``u`` and all its ``v``. Its members are compared with the center, and then, as long
    as some that were no center yet belong to different clusters of links, with new centers: the smallest such member in
    each of 1, 8, 64 ... hash slots of the group. A group with at most eight such members for each slot is compared whole,
    so one of n members needs at most log8(n) + 1 rounds. A pair is tested only if no links join it already and the
    sizes of its sets allow the threshold, so copies settle in the first round. The clusters of the result
    are those of all pairs of a group at or above the threshold; an unlike center loses nothing.

    The driver's memory grows with the jobs it has run and with what it broadcasts. So members keep their labels from
    round to round, a round without new links makes no clusters, and nothing of the size of the clusters is broadcast.
    """
    return _verified(edges, docs, threshold, n, id_col, text, rows_per_task)[0]


def verified_clusters(edges: DataFrame, docs: DataFrame, threshold: float, **options) -> DataFrame:
    """``dup_clusters`` of the links of ``jaccard_verify``."""
    defaults = {"n": SHINGLE_WORDS, "id_col": "doc_id", "text": "text", "rows_per_task": ROWS_PER_TASK}
    return _verified(edges, docs, threshold, **{**defaults, **options})[1]


def _verified(edges, docs, threshold, n, id_col, text, rows_per_task) -> tuple[DataFrame, DataFrame]:
    edges = materialize(edges.select("u", "v").where("u <> v").distinct(), "edges")
    sets = _shingle_sets(docs, edges, n, id_col, text)
    links = materialize(_scored(edges, sets, threshold, id_col, rows_per_task), "verified")
    clusters = materialize(dup_clusters(links, rows_per_task), "clusters")
    # Members that were no center yet. The first centers are settled, and so are stars whose members are all like theirs.
    failed = materialize(edges.join(links.select("u", "v").hint("merge"), ["u", "v"], "left_anti"), "failed-edges")
    unlike = failed.groupBy(F.col("u").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    members = edges.select(F.col("u").alias("g"), F.col("v").alias("id"))
    sizes = edges.groupBy(F.col("u").alias("g")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    wanted = materialize(unlike.select("g").join(sizes, "g"), "unlike-stars")
    waiting = salted_join(members, wanted.select("g"), ["g"], wanted, "left_semi", rows_per_task)
    # The least and the most shingles of an id, which may stand in several rows.
    widths = sets.select(F.col(id_col).alias("id"), F.size("s").alias("w")).groupBy("id").agg(F.min("w").alias("low"), F.max("w").alias("high"))
    labels = clusters.select(F.col("doc_id").alias("id"), F.col("cluster_id").alias("label"))
    waiting = waiting.join(widths.hint("merge"), "id").join(labels.hint("merge"), "id", "left")
    waiting = materialize(waiting.select("g", "id", F.coalesce("label", "id").alias("label"), "low", "high"), "waiting")
    found, slots = [], 1
    while True:
        groups = waiting.groupBy("g").agg(F.min("label").alias("first"), F.max("label").alias("last"), F.count(F.lit(1)).alias("n"))
        whole = F.col("n") <= slots * GROWTH
        parts = F.when(whole, F.ceil(F.col("n") / SLOT_CENTERS)).otherwise(F.lit(slots)).cast("int")
        unsettled = materialize(groups.where("first <> last").select("g", "n", whole.alias("whole"), parts.alias("slots")), "unsettled")
        if unsettled.isEmpty():
            break
        labelled = salted_join(waiting, unsettled.drop("n"), ["g"], unsettled.select("g", "n"), "inner", rows_per_task)
        labelled = materialize(labelled.withColumn("slot", F.pmod(F.xxhash64("g", "id"), F.col("slots")).cast("int")), "waiting")
        member = F.struct("id", "label", "low", "high")
        centers = labelled.where("not whole").groupBy("g", "slot").agg(F.min(member).alias("c"))
        centers = materialize(centers.unionByName(labelled.where("whole").select("g", "slot", member.alias("c"))), "centers")
        every = F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot")
        met = salted_join(
            labelled.select("g", "id", "label", "low", "high", "whole", every), centers, ["g", "slot"], unsettled.select("g", "n", every),
            "inner", rows_per_task,
        )
        met = met.where("label <> c.label and (not whole or id < c.id)")
        met = met.where(F.try_divide(F.least("high", "c.high"), F.greatest("low", "c.low")) >= threshold)
        pairs = met.select(F.least("id", "c.id").alias("u"), F.greatest("id", "c.id").alias("v"))
        new = materialize(_scored(materialize(pairs.distinct(), "pairs"), sets, threshold, id_col, rows_per_task), "verified")
        waiting = labelled.where("not whole").select("g", "id", "label", "low", "high")
        waiting = waiting.join(centers.select("g", F.col("c.id").alias("id")).hint("merge"), ["g", "id"], "left_anti")
        if not new.isEmpty():
            found.append(new)
            ends = labelled.select("id", "label").distinct()
            joined = new.select("u", "v")
            for end in ("u", "v"):
                joined = joined.join(ends.select(F.col("id").alias(end), F.col("label").alias(f"label_{end}")).hint("merge"), end)
            merged = dup_clusters(joined.select(F.col("label_u").alias("u"), F.col("label_v").alias("v")), rows_per_task)
            merged = materialize(merged.select(F.col("doc_id").alias("label"), F.col("cluster_id").alias("root")), "merged-labels")
            waiting = lookup_join(materialize(waiting, "waiting"), merged, "label", "left", LABEL_BYTES, rows_per_task)
            waiting = waiting.select("g", "id", F.coalesce("root", "label").alias("label"), "low", "high")
        waiting = materialize(waiting, "waiting")
        slots *= GROWTH
    if not found:
        return links, clusters
    for new in found:
        links = links.unionByName(new)
    links = materialize(links, "verified")
    return links, materialize(dup_clusters(links, rows_per_task), "clusters")


# ---- components ----


def _star(edges: DataFrame, center: str, leaf: str, best: str, rows_per_task: int) -> DataFrame:
    """Join each ``center`` with the smallest value of ``leaf`` around it, as column ``best``."""
    groups = materialize(edges.groupBy(center).agg(F.min(leaf).alias(best), F.count(F.lit(1)).alias("n")), "stars")
    return salted_join(edges, groups.drop("n"), [center], groups.select(center, "n"), "inner", rows_per_task)


def _differ(a: DataFrame, b: DataFrame, keys: list[str]) -> bool:
    """Whether two tables of distinct rows differ, by their size and a combined hash of their rows."""
    mark = [F.count(F.lit(1)), F.bit_xor(F.xxhash64(*keys)), F.sum(F.pmod(F.xxhash64(F.lit("row"), *keys), F.lit(1 << 31)))]
    both = a.select(F.lit(0).alias("_side"), *keys).unionAll(b.select(F.lit(1).alias("_side"), *keys))
    marks = both.groupBy("_side").agg(*mark).drop("_side").collect()
    return bool(marks) and (len(marks) == 1 or marks[0] != marks[1])


def dup_clusters(edges: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Connected components: ``(doc_id, cluster_id, dup_count)``, cluster id = smallest member.

    Alternates two steps until nothing changes: link the larger neighbours of
    every node to its smallest neighbour, then link all smaller neighbours to
    the smallest. The number of rounds grows with the logarithm of the longest
    path. Every round is written to the shared folder, so the plan stays short.
    """
    links = materialize(
        edges.where("u <> v").select(F.greatest("u", "v").alias("hi"), F.least("u", "v").alias("lo")).distinct(),
        "links",
    )
    while True:
        both = links.select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionAll(
            links.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
        )
        larger = _star(both, "a", "b", "m", rows_per_task).where("b > a")
        larger = materialize(larger.select(F.col("b").alias("hi"), F.least("m", "a").alias("lo")).distinct(), "links")
        smaller = _star(larger, "hi", "lo", "m", rows_per_task)
        # Every row gives the link of its larger end, and that of its smaller end if it is not the root.
        moves = F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
        )
        after = smaller.select(F.explode(moves).alias("e")).select("e.*").where("hi <> lo").distinct()
        after = materialize(after, "links")
        if not _differ(after, links, ["hi", "lo"]):
            break
        links = after
    # Now every node points at the root of its component.
    sizes = after.groupBy(F.col("lo").alias("cluster_id")).agg((F.count(F.lit(1)) + 1).alias("n"))
    counts = sizes.select("cluster_id", F.col("n").alias("dup_count"))
    members = after.select(F.col("hi").alias("doc_id"), F.col("lo").alias("cluster_id"))
    counted = salted_join(members, counts, ["cluster_id"], sizes, "inner", rows_per_task)
    roots = counts.select(F.col("cluster_id").alias("doc_id"), "cluster_id", "dup_count")
    return counted.select("doc_id", "cluster_id", "dup_count").unionAll(roots)


def merge_clusters(forest: DataFrame, links: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Clusters ``(doc_id, cluster_id, dup_count)`` of a forest of labels and new links ``(u, v)``, without the old links.

    Each end of a new link is replaced by the root of its old cluster, so only the links between roots run through
    ``dup_clusters``: their number grows with the new dump. Clusters that none of them touches stay as they are. The
    result equals the clusters of all links together.
    """
    links = materialize(links.where("u <> v").select("u", "v").distinct(), "new-links")
    ends = links.select(F.col("u").alias("doc_id")).unionAll(links.select(F.col("v").alias("doc_id"))).distinct()
    known = ends.join(forest.select("doc_id", "cluster_id"), "doc_id", "left")
    known = materialize(known.withColumn("is_new", F.col("cluster_id").isNull()).withColumn("cluster_id", F.coalesce("cluster_id", "doc_id")), "link-ends")
    contracted = links
    for end in ("u", "v"):
        root = known.select(F.col("doc_id").alias(end), F.col("cluster_id").alias(f"root_{end}"))
        contracted = salted_join(contracted, root, [end], count_keys(links, [end]), "inner", rows_per_task)
    moved = dup_clusters(contracted.select(F.col("root_u").alias("u"), F.col("root_v").alias("v")), rows_per_task)
    moved = materialize(moved.select(F.col("doc_id").alias("cluster_id"), F.col("cluster_id").alias("merged")), "moved-roots")
    fresh = known.where("is_new").select("doc_id", "cluster_id", F.lit(1).cast("long").alias("dup_count"))
    nodes = forest.select("doc_id", "cluster_id", F.col("dup_count").cast("long").alias("dup_count")).unionByName(fresh)
    nodes = materialize(lookup_join(nodes, moved, "cluster_id", "left", rows_per_task=rows_per_task), "relabelled")
    stay = nodes.where("merged is null").select("doc_id", "cluster_id", "dup_count")
    changed = nodes.where("merged is not null").select("doc_id", F.col("merged").alias("cluster_id"))
    sizes = materialize(count_keys(changed, ["cluster_id"]), "merged-sizes")
    counted = salted_join(changed, sizes.select("cluster_id", F.col("n").alias("dup_count")), ["cluster_id"], sizes, "inner", rows_per_task)
    return stay.unionByName(counted.select("doc_id", "cluster_id", "dup_count"))


# ---- results ----


def dup_remove_list(clusters: DataFrame, docs: DataFrame, file: str = "source") -> DataFrame:
    """Per file the documents to remove, in long form ``(file, doc_id)``."""
    extra = clusters.where("doc_id <> cluster_id").select("doc_id")
    return docs.select("doc_id", F.col(file).alias("file")).join(extra, "doc_id").select("file", "doc_id")


def dup_metadata(clusters: DataFrame, docs: DataFrame, file: str = "source") -> DataFrame:
    """For the kept member of each cluster: how many copies, from how many files, first and last file."""
    tagged = clusters.join(docs.select("doc_id", F.col(file).alias("file")), "doc_id")
    per_file = tagged.groupBy("cluster_id", "file").agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy(F.col("cluster_id").alias("doc_id")).agg(
        F.sum("n").alias("dup_count"),
        F.count(F.lit(1)).alias("n_files"),
        F.min("file").alias("first_file"),
        F.max("file").alias("last_file"),
    )


def dup_sources(clusters: DataFrame, docs: DataFrame, file: str = "source") -> DataFrame:
    """The files of each cluster in long form ``(doc_id, file, copies)``, keyed by the kept member."""
    tagged = clusters.join(docs.select("doc_id", F.col(file).alias("file")), "doc_id")
    return tagged.groupBy(F.col("cluster_id").alias("doc_id"), "file").agg(F.count(F.lit(1)).alias("copies"))


def merge_dup_results(*parts: DataFrame) -> DataFrame:
    """Merge partial remove lists ``(file, doc_id)`` whose files and ids overlap."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union.select("file", "doc_id").distinct()


def merge_remove_meta(remove: DataFrame, meta: DataFrame) -> DataFrame:
    """Both results under one key: ``doc_id``, ``to_remove``, ``dup_count`` (NULL without metadata)."""
    flagged = remove.select("doc_id").distinct().withColumn("to_remove", F.lit(True))
    return flagged.join(meta, "doc_id", "full_outer").withColumn(
        "to_remove", F.coalesce("to_remove", F.lit(False))
    )


def dup_removal(docs: DataFrame, remove: DataFrame, meta: DataFrame) -> DataFrame:
    """Documents without the listed ones; survivors get ``dup_count`` (1 if alone).

    Both results go into one lookup, so the documents take part in one join.
    """
    results = materialize(merge_remove_meta(remove, meta.select("doc_id", "dup_count")), "dup-results")
    joined = placed_join(docs, results, "doc_id", "left")
    kept = joined.where(~F.coalesce("to_remove", F.lit(False))).drop("to_remove")
    return kept.withColumn("dup_count", F.coalesce("dup_count", F.lit(1).cast("long")))


def files_without_dups(files: DataFrame, results: DataFrame, file: str = "file") -> DataFrame:
    """Files that no duplicate result names; they are passed on unchanged."""
    return files.select(file).distinct().join(results.select(file).distinct(), file, "left_anti")


def interval_name(low: int, high: int | None) -> str:
    return f"{low}-{'inf' if high is None else high}"


def dup_interval(count: Column, intervals: Sequence[tuple[int, int | None]] = INTERVALS) -> Column:
    """Name of the interval that holds a duplicate count."""
    out = F.lit(None).cast("string")
    for low, high in intervals:
        inside = count >= low if high is None else count.between(low, high)
        out = F.when(inside, interval_name(low, high)).otherwise(out)
    return out


def dup_distribution(docs: DataFrame, count: str = "dup_count") -> DataFrame:
    """Kept documents and original documents per interval of the duplicate count."""
    return docs.groupBy(dup_interval(F.col(count)).alias("dup_interval")).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(count).alias("n_copies")
    )
