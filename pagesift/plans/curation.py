"""From documents to a filtered, deduplicated, decontaminated corpus."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.functions.hashing import xx_31
from pagesift.operators import decontam as C
from pagesift.operators import dedup as D
from pagesift.operators import quality as Q
from pagesift.operators.places import placed_join
from pagesift.operators.reorganize import tag_intervals
from pagesift.session import materialize


@dataclass(frozen=True)
class CurationRules:
    lines: Q.LineRules = field(default_factory=Q.LineRules)
    docs: Q.DocRules = field(default_factory=Q.DocRules)
    ngram: int = C.N
    hash_fn: Callable[[Column], Column] = xx_31
    near: float = D.NEAR


def near_duplicates(docs: DataFrame, hash_fn: Callable[[Column], Column] = xx_31, threshold: float = D.NEAR) -> DataFrame:
    """Clusters of documents that share a MinHash bucket and have at least ``threshold`` of their shingles in common.

    A shared bucket only names the pairs to compare.
    """
    edges = D.minhash_pairs(D.minhash_signature(docs, hash_fn=hash_fn))
    return D.verified_clusters(edges, docs, threshold)


def curate(docs: DataFrame, index: DataFrame, rules: CurationRules = CurationRules()) -> DataFrame:
    """Documents ``(doc_id, text, source, dup_count, dup_interval)`` that pass every step.

    ``dup_count`` counts exact and near copies. Large stages are written to the
    shared folder: their results feed several joins.
    """
    cleaned = Q.quality_lines(docs, rules.lines).drop("n_lines", "n_removed")
    # A filter on a computed column is pushed below it and computes it, and the cleaned text in it,
    # again. So the verdict is written first; rejected texts are not.
    kept = F.col("disposition") == Q.KEPT
    judged = Q.quality_docs(cleaned, rules.docs).withColumn("text", F.when(kept, F.col("text")))
    good = materialize(judged.select(*docs.columns, "disposition"), "quality").where(kept).drop("disposition")
    repeated = materialize(D.exact_groups(good).where("copies > 1"), "repeated")
    copies = repeated.select(F.col("first_id").alias("doc_id"), "copies")
    unique = placed_join(D.exact_dedup(good), copies, "doc_id", "left")
    unique = materialize(unique.withColumn("copies", F.coalesce("copies", F.lit(1).cast("long"))), "exact")
    clusters = near_duplicates(unique, rules.hash_fn, rules.near)
    remove = D.dup_remove_list(clusters, unique)
    copies = (
        clusters.join(unique.select("doc_id", "copies"), "doc_id")
        .groupBy(F.col("cluster_id").alias("doc_id"))
        .agg(F.sum("copies").alias("dup_count"))
    )
    kept = D.dup_removal(unique, remove, copies)
    kept = kept.withColumn("dup_count", F.greatest("dup_count", "copies")).drop("copies")
    hits = C.join_contamination(kept, index, rules.ngram)
    return tag_intervals(C.anti_contaminated(kept, hits))
