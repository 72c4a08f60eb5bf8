"""Merkle manifest of a dataset, with inclusion proofs by pointer jumping.

A row is a leaf: the digest of its fields. The leaves of a group, in their order, form a tree: runs
of ``FAN`` consecutive nodes become the digest of the run, until one node is left, the group's
subroot. The subroots, ordered by group, form a tree in the same way; its last node is the root.

A proof lists, from leaf to root, the digests left and right of the node in each run. It is made by
pointer jumping: at first each node above the leaves holds a segment of one step, the siblings
in its run, and points to its parent. In each round the table of nodes is joined with itself: a
node that points to an ancestor takes that one's segment behind its own, and its pointer.
So the distance doubles, and all nodes reach the root after log2(depth) rounds. A leaf holds
the step inside its run and takes the whole segment of its parent in the last join; so proofs of all
leaves are never kept, only those of the nodes above, an eighth of their number.

Positions come from a sort by ranges of (group, order): a group of any size lies in many
partitions, each numbered by itself, and the counts of the partitions are summed up. Runs hold at most
``FAN`` rows. Many nodes share an ancestor; ``lookup_join`` broadcasts a measured table or
splits such keys.

Defined cases: a null field is ``-``, another one its count of UTF-8 bytes, ``:``, and its value. Null
groups and nulls in the order come first; rows equal in the order go by their digest, and equal rows
are leaves of their own. A group with one row has that leaf as its subroot, and one group's subroot is the
root. A run of one node becomes a digest, too, with nothing beside it in the proof. An empty
table gives no rows. Other columns are carried where asked for and play no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagesift.llm.common import col, partitions
from pagesift.operators.joins import lookup_join
from pagesift.session import materialize

FAN = 8
#: Names of the trees: the top one, a null group, any other group behind a sign. Their bytes sort in this order.
TOP, NULL, NAMED = "", "-", "="
STEP = "array<struct<left:string,right:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return digest(*[field(x) for x in fields])


def lower_ascii(value: Column) -> Column:
    return F.translate(value, UPPER, LOWER)


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``idx``, the place inside ``tree`` by ``order``, and ``n``, the size of the tree; written once."""
    by = [F.asc_nulls_first(c) for c in ("tree", *order)]
    sorted_rows = rows.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by)
    placed = materialize(sorted_rows.withColumn("at", F.monotonically_increasing_id()), "merkle-rows")
    placed = placed.withColumn("part", F.shiftright("at", 33))
    parts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("size"))
    earlier = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        "tree", "part", F.sum("size").over(W.partitionBy("tree")).alias("n"),
        (F.coalesce(F.sum("size").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    offsets = materialize(offsets, "merkle-offsets")
    return lookup_join(placed, offsets, ["tree", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def runs_of(nodes: DataFrame, largest: int) -> DataFrame | None:
    """All runs of the trees above ``nodes`` (tree, n, idx, h): tree, n, level, idx, hs, h. A tree of one node has none."""
    made, level, below = [], 0, nodes.select("tree", "n", "idx", "h")
    while FAN**level < largest:
        level += 1
        members = F.sort_array(F.collect_list(F.struct("idx", "h")))
        run = (
            below.where(F.col("n") > FAN ** (level - 1))
            .groupBy("tree", "n", F.expr(f"idx div {FAN}").alias("idx")).agg(F.transform(members, lambda x: x["h"]).alias("hs"))
            .select("tree", "n", F.lit(level).alias("level"), "idx", "hs", F.sha2(F.array_join("hs", ""), 256).alias("h"))
        )
        below = materialize(run, "merkle-runs")
        made.append(below)
    out = made[0] if made else None
    for other in made[1:]:
        out = out.unionByName(other)
    return out


def _reaches(level: Column) -> Column:
    """Whether a node of this level is the last of its tree."""
    return F.pow(F.lit(float(FAN)), level) >= F.col("n")


def beside(hs: str, i: Column) -> Column:
    """The step of member ``i`` of a run: what stands left and right of it."""
    left, right = F.slice(hs, F.lit(1), i), F.slice(hs, i + 2, F.lit(FAN))
    return F.struct(F.array_join(left, "").alias("left"), F.array_join(right, "").alias("right"))


@dataclass
class Manifest:
    """leaves: tree, n, idx, h and carried columns; runs and top_runs; groups: tree, rank, subroot."""

    leaves: DataFrame
    groups: DataFrame
    paths: DataFrame
    root: str | None


def manifest(rows: DataFrame, leaf: Column, group: str, order: Sequence[str], carry: dict[str, Column]) -> Manifest:
    """The trees over ``rows`` and the path of every node above the leaves."""
    value = col(group).cast("string")
    tree = F.when(value.isNull(), F.lit(NULL)).otherwise(F.concat(F.lit(NAMED), value))
    keys = [col(c).alias(f"order_{i}") for i, c in enumerate(order)]
    narrow = rows.select(tree.alias("tree"), *keys, leaf.alias("h"), *[c.alias(name) for name, c in carry.items()])
    # Written before the sort, which looks at its rows twice: the texts are read and hashed once.
    narrow = materialize(narrow, "merkle-leaves")
    leaves = numbered(narrow, [*(f"order_{i}" for i in range(len(order))), "h"])
    largest = int(leaves.agg(F.max("n")).first()[0] or 0)
    runs = runs_of(leaves, largest)

    subroots = leaves.where("n = 1").select("tree", F.col("h").alias("subroot"))
    if runs is not None:
        subroots = subroots.unionByName(runs.where((F.col("idx") == 0) & _reaches(F.col("level"))).select("tree", F.col("h").alias("subroot")))
    listed = subroots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("group"), F.col("subroot").alias("h"))
    ranked = materialize(numbered(listed, ["group"]), "merkle-subroots")
    groups = ranked.select(F.col("group").alias("tree"), F.col("idx").alias("rank"), F.col("h").alias("subroot"))
    n_groups = int(ranked.agg(F.max("n")).first()[0] or 0)
    top_runs = runs_of(ranked, n_groups)
    last = ranked.select("h", F.lit(0).alias("level")) if top_runs is None else top_runs.select("h", "level")
    last = last.orderBy(F.desc("level")).first()
    paths = _jumped(_steps(runs, top_runs, groups, rows.sparkSession), _depth(largest) + _depth(n_groups))
    return Manifest(leaves, groups, paths, last["h"] if last else None)


def _depth(n: int) -> int:
    depth = 0
    while FAN**depth < n:
        depth += 1
    return depth


def _steps(runs: DataFrame | None, top_runs: DataFrame | None, groups: DataFrame, spark) -> DataFrame:
    """Nodes above the leaves with the step to their parent: tree, level, idx, to_tree, to_level, to_idx, path."""
    schema = f"tree string, level int, idx long, to_tree string, to_level int, to_idx long, path {STEP}"
    out = spark.createDataFrame([], schema)

    def members(table: DataFrame) -> DataFrame:
        places = F.sequence(F.lit(0), F.size("hs") - 1)
        return table.withColumn("i", F.explode(places)).withColumn("path", F.array(beside("hs", F.col("i"))))

    if runs is not None:
        # A subroot is the leaf of its group's rank in the top tree.
        linked = lookup_join(members(runs.where("level > 1")), groups.select("tree", "rank"), "tree")
        is_last = _reaches(F.col("level"))
        out = out.unionByName(linked.select(
            "tree", (F.col("level") - 1).alias("level"), (F.col("idx") * FAN + F.col("i")).alias("idx"),
            F.when(is_last, F.lit(TOP)).otherwise(F.col("tree")).alias("to_tree"),
            F.when(is_last, F.lit(0)).otherwise(F.col("level")).alias("to_level"),
            F.when(is_last, F.col("rank")).otherwise(F.col("idx")).alias("to_idx"), "path",
        ))
    if top_runs is not None:
        out = out.unionByName(members(top_runs).select(
            "tree", (F.col("level") - 1).alias("level"), (F.col("idx") * FAN + F.col("i")).alias("idx"),
            F.col("tree").alias("to_tree"), F.col("level").alias("to_level"), F.col("idx").alias("to_idx"), "path",
        ))
    return out


def _jumped(steps: DataFrame, depth: int) -> DataFrame:
    """Every node's whole path to the root: the pointers' distance doubles in each round."""
    nodes, distance = materialize(steps, "merkle-steps"), 1
    here, there = ("tree", "level", "idx"), ("to_tree", "to_level", "to_idx")
    while distance < depth:
        # What a pointer of this distance can reach lies at least so high, or in the top tree.
        reached = nodes.where((F.col("level") > distance) | (F.col("tree") == TOP)).select(
            *[F.col(c).alias(t) for c, t in zip(here, there)],
            *[F.col(t).alias("next_" + t) for t in there], F.col("path").alias("next_path"),
        )
        joined = lookup_join(nodes, reached, there, "left")
        nodes = materialize(
            joined.select(
                *here, *[F.coalesce("next_" + t, t).alias(t) for t in there],
                F.when(F.col("next_path").isNull(), F.col("path")).otherwise(F.concat("path", "next_path")).alias("path"),
            ),
            "merkle-paths",
        )
        distance *= 2
    return nodes


def proofs(made: Manifest, carried: Sequence[str]) -> DataFrame:
    """Per leaf: the carried columns, leaf, subroot, root and proof (steps from leaf to root)."""
    paths = made.paths.select(F.col("tree").alias("to_tree"), F.col("level").alias("to_level"), F.col("idx").alias("to_idx"), "path")
    member = F.struct("idx", F.col("h").alias("leaf"), *carried)
    runs = (
        made.leaves.groupBy("tree", "n", F.expr(f"idx div {FAN}").alias("run")).agg(F.sort_array(F.collect_list(member)).alias("of"))
    )
    lone, is_last = F.col("n") == 1, F.col("n") <= FAN
    runs = lookup_join(runs, made.groups, "tree").select(
        "of", "subroot", lone.alias("lone"), F.transform("of", lambda x: x["leaf"]).alias("hs"),
        F.when(is_last, F.lit(TOP)).otherwise(F.col("tree")).alias("to_tree"),
        F.when(is_last, F.lit(0)).otherwise(F.lit(1)).alias("to_level"),
        F.when(is_last, F.col("rank")).otherwise(F.col("run")).alias("to_idx"),
    )
    none = F.expr(f"cast(array() as {STEP})")
    rows = runs.join(paths, ["to_tree", "to_level", "to_idx"], "left").select("*", F.posexplode("of").alias("i", "one"))
    own = F.when(F.col("lone"), none).otherwise(F.array(beside("hs", F.col("i"))))
    return rows.select(
        *[F.col("one." + c).alias(c) for c in carried], F.col("one.leaf").alias("leaf"), "subroot", F.lit(made.root).alias("root"),
        F.concat(own, F.coalesce("path", none)).alias("proof"),
    )


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda h, step: F.sha2(F.concat(step["left"], h, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def verified(docs: DataFrame, names: Sequence[str], group: str, order: str, tampered: Column, changed: Column) -> DataFrame:
    """Proofs of all rows, folded again from the rows as they are now.

    The leaf of a row for which ``tampered`` holds is recomputed with ``changed`` for the last of ``names``.
    """
    now = F.when(tampered, leaf_digest([*[col(c) for c in names[:-1]], changed]))
    made = manifest(docs, leaf_digest([col(c) for c in names]), group, [order], {"key": col(order), "now": now})
    found = proofs(made, ["key", "now"])
    return (
        found.withColumn("folded_root", folded(F.coalesce("now", "leaf"), F.col("proof")))
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
