"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds.

Vectors are quantised to integers. For each anchor the ``n_positives`` rows of its label with
the highest inner products are its positives. Each positive opens a window of scores, from
``low / base`` to ``high / base`` times the positive's; the ``n_negatives`` best rows of other
labels inside it are returned.

Both searches are one threshold join. Rows lie in blocks, ordered by label and then by a hash, so a
frequent label fills many blocks and a block holds few labels. For a block and the anchors that
meet it:

* Dimensions are ordered by their energy. A row's entries are indexed only up to the place
  where the norm of its suffix times the anchors' largest norm falls below the least
  threshold; a row without indexed entries is never touched. Rows are ordered by the length of
  their indexed prefix, so the posting list of a dimension is a run of rows.
* Partial scores are accumulated dimension group by dimension group over the posting lists.
  The partial score plus the norms of what remains of the row and of the anchor bounds the
  score; rows whose bound is below the threshold are pruned, the others are completed.
* The threshold of a window starts near its upper end and is lowered until the window holds as many
  rows as asked for, or has been searched to its lower end.

A first join lets every anchor meet only the block that it lies in. The score of the last
row that fills a window there is a valid threshold for the second join with all other blocks.

Rows and anchors meet on an equal (block, part) key; nothing is broadcast but tables whose size was
measured, and a task holds one block of rows and one part of the anchors.

Defined cases: rows with a null id, a null label, or a vector that is null, empty or holds null or
non-finite components take no part. Rows that are equal in all are different rows: an anchor is
compared with every row but itself, ties go to the smaller id, and equal anchors each give
their rows. Vectors of other lengths are not compared. Scores times ``base`` must fit in 64 bits; below 2^52 they
are computed in floating point, which is exact there, else in 64-bit integers. A positive with a negative score has
an empty window. An empty table, or one without anchors, gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagesift.llm.common import col
from pagesift.session import materialize

SCALE = 256
ROWS = 16_384
ANCHORS = 2_048
#: Blocks that one task pairs with a part of the anchors.
LOT = 64
#: Anchors whose partial scores are held at once; posting lists added by one matrix product.
AT_ONCE, GROUP = 128, 16
LOWEST, HIGHEST = -(1 << 62), 1 << 62
EXACT = float(1 << 52)
#: A threshold is lowered to these shares of its window.
STEPS = (1 / 16, 1 / 4, 1.0)
FOUND = "row long, window int, id long, score long"


def quantised(vectors: DataFrame, id_name: str, label: Column, vector_name: str, scale: float) -> DataFrame:
    """id, label (string), dim and v (array of long) of the rows that take part."""
    vector = col(vector_name)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = col(id_name).isNotNull() & label.isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & finite
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.where(good).select(
        col(id_name).cast("long").alias("id"), label.cast("string").alias("label"), F.size(vector).alias("dim"), whole.alias("v")
    )


def blocks_of(rows: DataFrame, n_rows: int, most: int) -> DataFrame:
    """The rows with ``block`` and a number ``row``, written once."""
    dealt = rows.repartitionByRange(max(1, -(-n_rows // most)), "dim", "label", F.xxhash64("id", "v"))
    return materialize(
        dealt.withColumn("block", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()), "negatives-rows"
    )


class Index:
    """Postings of a block's rows for the thresholds of some anchors."""

    def __init__(self, values: np.ndarray, anchors: np.ndarray, least: float):
        self.order = np.argsort(-(values.astype(np.float64) ** 2).sum(axis=0), kind="stable")
        self.whole = values[:, self.order]
        table = self.whole.astype(np.float64)
        self.anchors_whole = anchors[:, self.order]
        self.anchors = self.anchors_whole.astype(np.float64)
        self.suffix = suffix_norms(table)
        self.anchor_suffix = suffix_norms(self.anchors)
        self.exact = float(self.suffix[:, 0].max(initial=0)) * float(self.anchor_suffix[:, 0].max(initial=0)) < EXACT
        # Entries from here on are covered: what they can add stays below the least threshold.
        covered = widened(self.suffix * self.anchor_suffix.max(axis=0, initial=0)[None, :]) < least
        n_dims = table.shape[1]
        length = np.where(covered.any(axis=1), covered.argmax(axis=1), n_dims)
        self.rows = np.argsort(-length, kind="stable")[: int((length > 0).sum())]
        self.length = length[self.rows]
        self.whole, table = self.whole[self.rows], table[self.rows]
        held = np.arange(n_dims)[None, :] < self.length[:, None]
        self.postings = np.where(held, table, 0.0)
        self.rest = np.where(held, 0.0, table)
        self.rest_norm = np.take_along_axis(self.suffix[self.rows], self.length[:, None], axis=1)[:, 0]
        self.n_postings = [int((self.length > d).sum()) for d in range(n_dims)]

    def partial(self, which: slice) -> tuple[np.ndarray, np.ndarray]:
        """Partial scores, and what the rest of a row may add, by anchor and row."""
        sums = np.zeros((len(self.rows), len(self.anchors[which])))
        for first in range(0, self.anchors.shape[1], GROUP):
            n, dims = self.n_postings[first], slice(first, first + GROUP)
            if n:
                sums[:n] += self.postings[:n, dims] @ self.anchors[which, dims].T
        rest = self.rest_norm[:, None] * self.anchor_suffix[which][:, self.length].T
        return sums.T, widened(rest).T

    def completed(self, anchor: int, partial: np.ndarray, rows: np.ndarray) -> np.ndarray:
        if not self.exact:
            return self.whole[rows] @ self.anchors_whole[anchor]
        return np.rint(partial[rows] + self.rest[rows] @ self.anchors[anchor]).astype(np.int64)


def suffix_norms(table: np.ndarray) -> np.ndarray:
    """Norm of each row from each dimension on; a last column of zeros."""
    squares = np.cumsum((table**2)[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([squares, np.zeros((len(table), 1))], axis=1))


def widened(bound: np.ndarray) -> np.ndarray:
    """A bound beyond all rounding."""
    return bound * (1 + 1e-9) + 1e-6


def fill(low: int, high: int, k: int, ids, upper, lower, usable, complete) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best rows with low <= score <= high, by falling thresholds."""
    open_rows = np.flatnonzero(usable & (upper >= low) & (lower <= high))
    if not len(open_rows):
        return open_rows, open_rows.astype(np.int64)
    bounds = upper[open_rows]
    top = min(float(high), float(bounds.max()))
    floor = max(float(low), float(bounds.min()))
    places, scores = open_rows[:0], np.zeros(0, dtype=np.int64)
    for step in STEPS:
        threshold = top - (top - floor) * step if step < 1 else -np.inf
        now = bounds >= threshold
        rows = open_rows[now]
        score = complete(rows)
        fits = (score >= low) & (score <= high)
        places, scores = np.concatenate([places, rows[fits]]), np.concatenate([scores, score[fits]])
        if int((scores >= threshold).sum()) >= k:
            break
        open_rows, bounds = open_rows[~now], bounds[~now]
    best = np.lexsort((ids[places], -scores))[:k]
    return places[best], scores[best]


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    return pc.list_flatten(table.column("v").combine_chunks()).to_numpy(zero_copy_only=False).reshape(-1, dim)


def _join(k: int, same: bool):
    def run(rows: pa.Table, asked: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), 0, np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for dim in pc.unique(asked.column("dim")).to_pylist():
            some = rows.filter(pc.equal(rows.column("dim"), dim))
            anchors = asked.filter(pc.equal(asked.column("dim"), dim))
            if some.num_rows:
                out += _matches(some, anchors, dim, k, same)
        return pa.table({
            "row": pa.array(np.concatenate([np.full(len(x[2]), x[0][0] if len(x[0]) else 0) for x in out]), pa.int64()),
            "window": pa.array(np.concatenate([np.full(len(x[2]), x[1]) for x in out]), pa.int32()),
            "id": pa.array(np.concatenate([x[2] for x in out]), pa.int64()),
            "score": pa.array(np.concatenate([x[3] for x in out]), pa.int64()),
        })

    return run


def _matches(rows: pa.Table, asked: pa.Table, dim: int, k: int, same: bool) -> list[tuple]:
    names = pc.unique(rows.column("label"))
    labels = pc.index_in(rows.column("label"), names).to_numpy()
    wanted = pc.index_in(asked.column("label"), names).fill_null(-1).to_numpy()
    numbers, own = rows.column("row").to_numpy(), asked.column("row").to_numpy()
    windows = asked.column("windows").to_pylist()
    least = min((w["low"] for some in windows for w in some), default=HIGHEST)
    index = Index(_matrix(rows, dim), _matrix(asked, dim), float(least))
    ids, labels, numbers = rows.column("id").to_numpy()[index.rows], labels[index.rows], numbers[index.rows]
    out = []
    for first in range(0, len(own), AT_ONCE):
        part = slice(first, first + AT_ONCE)
        sums, rest = index.partial(part)
        for at, (partial, more) in enumerate(zip(sums, rest), start=first):
            usable = ((labels == wanted[at]) == same) & (numbers != own[at])
            upper, lower = partial + more, partial - more
            for window in windows[at]:
                places, scores = fill(
                    window["low"], window["high"], k, ids, upper, lower, usable,
                    lambda chosen: index.completed(at, partial, chosen),
                )
                if len(places):
                    out.append((own[at : at + 1], window["window"], ids[places], scores))
    return out


def part_of(name: str, n_parts: int) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(n_parts)).cast("int")


def _met(rows: DataFrame, asked: DataFrame, k: int, same: bool, n_parts: int) -> DataFrame:
    """Matches of blocks with the anchors that name them in ``block``."""
    parts = F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1)))
    some = rows.select("block", "dim", "label", "id", "row", "v").withColumn("part", parts)
    dealt = asked.withColumn("part", part_of("row", n_parts))
    return (
        some.groupBy("block", "part").cogroup(dealt.groupBy("block", "part")).applyInArrow(_join(k, same), FOUND)
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("row", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def windowed(rows: DataFrame, asked: DataFrame, k: int, same: bool, most_anchors: int = ANCHORS) -> DataFrame:
    """Per anchor and window its k best rows: row, window, id, score, rank.

    ``asked``: row, home, label, dim, v and windows (array of window, low, high). ``same``: rows of the
    anchor's label, else of any other.
    """
    n_parts = max(1, -(-asked.count() // most_anchors))
    n_lots = -(-(1 + int(rows.agg(F.max("block")).first()[0] or 0)) // LOT)
    seeds = materialize(_met(rows, asked.withColumn("block", F.col("home")), k, same, n_parts), "negatives-seeds")
    filled = _best(seeds, k).groupBy("row", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
    raised = F.when(F.col("n") >= k, F.greatest("low", "last")).otherwise(F.col("low"))
    windows = (
        asked.select("row", F.inline("windows")).join(filled, ["row", "window"], "left")
        .groupBy("row").agg(F.collect_list(F.struct("window", raised.alias("low"), "high")).alias("windows"))
    )
    # The anchors of a part meet the blocks of a lot, so that no task makes all pairs of a key.
    keys = [*(["dim", "label"] if same else ["dim"]), "part", "lot"]
    places = rows.groupBy(*keys[:-2], "block").agg(F.lit(0)).select(
        *[F.col(c).alias(c) for c in keys[:-2]], F.col("block").alias("block"), F.pmod("block", F.lit(n_lots)).alias("lot"),
        F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))).alias("part"),
    )
    spread = (
        asked.drop("windows").join(windows, "row").withColumn("part", part_of("row", n_parts))
        .withColumn("lot", F.explode(F.sequence(F.lit(0), F.lit(n_lots - 1))))
        .join(places, keys).drop("lot").where(F.col("block") != F.col("home"))
    )
    return _best(seeds.unionByName(_met(rows, spread, k, same, n_parts)), k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, n_negatives: int = 10,
    low: int = 30, high: int = 90, base: int = 100, id_name: str = "vec_id", vector_name: str = "embedding",
    scale: float = SCALE, most_rows: int = ROWS, most_anchors: int = ANCHORS,
) -> DataFrame:
    """anchor_row, anchor_id, positive_rank, positive_id, positive_score, rank, negative_id, negative_score.

    ``is_anchor`` is a condition on the column ``id``; ``label`` an expression on ``vectors``.
    """
    rows = blocks_of(quantised(vectors, id_name, label, vector_name, scale), vectors.count(), most_rows)
    names = {"row": "row", "block": "home", "id": "id", "label": "label", "dim": "dim", "v": "v"}
    anchors = rows.where(is_anchor).select(*[F.col(c).alias(name) for c, name in names.items()])
    all_scores = F.array(F.struct(F.lit(0).alias("window"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high")))
    found = windowed(rows, anchors.withColumn("windows", all_scores), n_positives, True, most_anchors)
    positives = materialize(
        found.select("row", F.col("rank").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
        "negatives-positives",
    )
    # low * positive <= base * negative <= high * positive, in whole numbers
    least = F.expr(f"-(((-{low} * positive_score) - pmod(-{low} * positive_score, {base})) div {base})")
    most = F.expr(f"(({high} * positive_score) - pmod({high} * positive_score, {base})) div {base}")
    windows = (
        positives.select("row", F.struct("window", least.alias("low"), most.alias("high")).alias("w"))
        .where("w.low <= w.high").groupBy("row").agg(F.collect_list("w").alias("windows"))
    )
    negatives = windowed(rows, anchors.join(windows, "row"), n_negatives, False, most_anchors)
    return (
        negatives.select("row", "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(positives, ["row", "window"])
        .join(anchors.select("row", F.col("id").alias("anchor_id")), "row")
        .select(
            F.col("row").alias("anchor_row"), "anchor_id", F.col("window").alias("positive_rank"), "positive_id",
            "positive_score", "rank", "negative_id", "negative_score",
        )
    )
