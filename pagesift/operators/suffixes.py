"""Registered domains by a table of public suffixes.

The table has the rules of the public list: ``co.uk``, wildcards such as ``*.ck`` (every label
below ``ck`` is a suffix) and exceptions such as ``!www.ck``. It becomes a trie of reversed labels: a
node is the labels from the right, and says whether a rule ends there, whether any label
below it is a suffix, and whether an exception ends there. A host walks down the trie from its last label as far
as there are nodes, one lookup per level; the number of levels is that of the longest rule (five in the public list) and
does not grow with the data. Nodes are measured before they are broadcast.

An exception decides first; its suffix is the rule without its first label. Else the longest rule wins. Where no
rule fits, the last label is the suffix. A host that is a suffix itself, an address or a single label has no domain.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.functions.urls import IPV4
from pagesift.operators.joins import lookup_join, row_bytes
from pagesift.session import materialize

LABEL = "^[a-z][a-z0-9-]*$"
COMMENT = "//"


@dataclass(frozen=True)
class SuffixTrie:
    """Nodes ``(node, depth, ends, wild, excepted)``, written and measured once."""

    nodes: DataFrame
    depth: int
    size: int


def scan_suffixes(spark: SparkSession, path: str) -> DataFrame:
    """Rules ``(rule)`` of a file in the public list's format: comments and blank lines go, a rule ends at white space."""
    lines = spark.read.text(path).select(F.split(F.trim("value"), r"\s+")[0].alias("rule"))
    return lines.where((F.col("rule") != "") & ~F.col("rule").startswith(COMMENT)).distinct()


def suffix_trie(rules: DataFrame, rule: str = "rule") -> SuffixTrie:
    """The trie of a column of rules."""
    text = F.lower(F.regexp_replace(F.trim(F.col(rule)), r"^\.", ""))
    excepted, wild = text.startswith("!"), text.startswith("*.")
    end = F.when(excepted | wild, F.regexp_replace(text, r"^(!|\*\.)", "")).otherwise(text)
    whole = rules.select(end.alias("end"), (~excepted & ~wild).alias("ends"), wild.alias("wild"), excepted.alias("excepted"))
    whole = whole.where(F.col("end") != "").withColumn("labels", F.size(F.split("end", r"\.")))
    # Every node on the way to a rule is there, so that a walk can stop where the trie does.
    step = whole.withColumn("depth", F.explode(F.sequence(F.lit(1), F.col("labels"))))
    last = F.col("depth") == F.col("labels")
    nodes = step.withColumn("node", F.expr("substring_index(end, '.', -depth)")).groupBy("node", "depth").agg(
        *[F.max(F.col(c) & last).alias(c) for c in ("ends", "wild", "excepted")]
    )
    nodes = materialize(nodes, "suffixes")
    size, depth = nodes.agg(F.sum(row_bytes(nodes)), F.max("depth")).first()
    return SuffixTrie(nodes, int(depth or 0), int(size or 0))


def trie_domain(df: DataFrame, trie: SuffixTrie, host: str = "host") -> DataFrame:
    """Add ``registered_domain``: the suffix of column ``host`` and one label more."""
    names, labels = df.columns, F.size(F.split(F.col(host), r"\."))
    rule, exception = F.lit(None).cast("int"), F.lit(None).cast("int")
    out = df.withColumn("_alive", ~F.col(host).rlike(IPV4))
    for k in range(1, trie.depth + 1):
        level = trie.nodes.where(F.col("depth") == k).select(
            F.col("node").alias("_tail"), *[F.col(c).alias(f"_{c}_{k}") for c in ("ends", "wild", "excepted")]
        )
        tail = F.when(F.col("_alive") & (labels >= k), F.substring_index(F.col(host), ".", -k))
        out = lookup_join(out.withColumn("_tail", tail), level, "_tail", "left", size=trie.size).drop("_tail")
        out = out.withColumn("_alive", F.col(f"_ends_{k}").isNotNull())
        rule = F.when(F.col(f"_wild_{k}") & (labels > k), k + 1).when(F.col(f"_ends_{k}"), k).otherwise(rule)
        exception = F.when(F.col(f"_excepted_{k}"), k - 1).otherwise(exception)
    known = F.substring_index(F.col(host), ".", -1).rlike(LABEL)
    suffix = F.coalesce(exception, rule, F.when(known, 1))
    domain = F.when(~F.col(host).rlike(IPV4) & (labels > suffix), _last_labels(F.col(host), suffix + 1))
    return out.withColumn("registered_domain", domain).select(*names, "registered_domain")


def _last_labels(host: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split(host, r"\."), -n, n), ".")
