"""Line dedup by levelled sorted runs of line hashes, in DataFrame functions only.

Documents arrive in batches of ascending id. A run is a table of line hashes, sorted
and bucketed by hash, with the smallest document that holds each line. A batch

1. reduces its lines to distinct hashes (combined before the shuffle, so a line found
   in a third of all documents costs one row per task),
2. merge-anti-joins them with the runs, which are not shuffled as their buckets fit,
3. writes what is new as a run of level 0; ``fanout`` runs of a level are merged into
   one run of the next,
4. drops those of its lines that it did not bring itself: an anti join on hash *and*
   document, which no frequent line can make uneven.

Defined cases: a null or empty text is one empty line. A null id is a document after
all others. Rows equal in id and text get equal results. An empty table gives an empty
result. Other columns play no part.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from pagesift.llm.common import col, hinted, partitions, text_of
from pagesift.session import materialize, new_path

BATCHES = 4
FANOUT = 2
MIN_POINTS = 10
WHITE = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z in lower case.

    ``lower`` does that for ASCII and is much faster than ``translate``.
    """
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(
        F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    )


def occurrences(docs: DataFrame, min_points: int) -> DataFrame:
    """One row per line with a long enough key: document, hash of its text, position, 128 bits of hash."""
    lines = docs.select("d", "t", F.posexplode(F.split("x", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("d", "t", "pos", line_key(F.col("line")).alias("key"))
    return keyed.where(F.char_length("key") >= min_points).select(
        "d", "t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2")
    )


class Runs:
    """Sorted runs by level, in the shared folder, known to the session as bucketed tables."""

    def __init__(self, spark, fanout: int):
        self.spark, self.fanout, self.buckets = spark, fanout, partitions(spark)
        self.levels: list[list[str]] = []

    def all(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        path = new_path(self.spark, "line-run")
        (
            rows.repartition(self.buckets, "h1", "h2").write.format("parquet").option("path", path)
            .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        )
        return name

    def add(self, fresh: DataFrame) -> str:
        """A new run of level 0; a level that is full becomes one run of the next."""
        name = self.write(fresh)
        self._put(0, name)
        return name

    def compact(self) -> None:
        level = 0
        while level < len(self.levels):
            if len(self.levels[level]) >= self.fanout:
                old = self.levels[level]
                parts = [self.spark.table(x) for x in old]
                merged = parts[0]
                for part in parts[1:]:
                    merged = merged.unionByName(part)
                self.levels[level] = []
                self._put(level + 1, self.write(merged))
                self._forget(old)
            level += 1

    def close(self) -> None:
        for level in self.levels:
            self._forget(level)

    def _put(self, level: int, name: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)

    def _forget(self, names: list[str]) -> None:
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch_filters(docs: DataFrame, batches: int) -> list[Column]:
    """Ranges of ascending id with about equally many rows; the last also takes null ids. Ids that are no numbers are one range."""
    shares = [i / batches for i in range(1, batches)] if isinstance(docs.schema["d"].dataType, NumericType) else []
    cuts = docs.agg(F.percentile_approx("d", shares).alias("c")).first()["c"] if shares else []
    cuts = sorted(set(cuts or []))
    d = F.col("d")
    lows = [None, *cuts]
    ranges = []
    for low, high in zip(lows, [*cuts, None]):
        test = F.lit(True) if low is None else d > F.lit(low)
        ranges.append(test & (d <= F.lit(high)) if high is not None else (test | d.isNull()))
    return ranges


def _batch_drops(docs: DataFrame, runs: Runs, min_points: int) -> DataFrame:
    """The positions that a batch loses; the keys that are new in it become a run."""
    lines = occurrences(docs, min_points)
    fresh = lines.groupBy("h1", "h2").agg(F.min("d").alias("first"))
    for run in runs.all():
        fresh = fresh.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
    kept = docs.sparkSession.table(runs.add(fresh)).select(
        F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("first").alias("k3")
    )
    own = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")) & F.col("d").eqNullSafe(F.col("k3"))
    late = lines.join(kept.hint("merge"), own, "left_anti")
    return materialize(late.groupBy("d", "t").agg(F.collect_set("pos").alias("late")), "line-drops")


def dropped_lines(
    docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT, min_points: int = MIN_POINTS
) -> DataFrame:
    """Per (d, t): the positions of the lines to drop. ``docs`` has d (id), t (hash of text), x (text)."""
    spark = docs.sparkSession
    runs, drops = Runs(spark, fanout), []
    try:
        for wanted in batch_filters(docs, batches):
            drops.append(_batch_drops(docs.where(wanted), runs, min_points))
            runs.compact()
    finally:
        runs.close()
    found = drops[0]
    for part in drops[1:]:
        found = found.unionByName(part)
    return found


def line_dedup(
    docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", batches: int = BATCHES, fanout: int = FANOUT,
    min_points: int = MIN_POINTS,
) -> DataFrame:
    """Per document: id, ``n_lines``, ``n_dropped`` and ``kept_text``."""
    rows = docs.select(col(id_name).alias("d"), text_of(text_name).alias("x")).withColumn("t", F.xxhash64("x"))
    found = dropped_lines(rows, batches, fanout, min_points).select(
        F.col("d").alias("kd"), F.col("t").alias("kt"), "late"
    )
    same = F.col("d").eqNullSafe(F.col("kd")) & (F.col("t") == F.col("kt"))
    joined = rows.join(hinted(found, F.size("late") * 4 + 64), same, "left")
    lines = joined.withColumn("lines", F.split("x", "\n", -1)).withColumn("n", F.size("lines"))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n") - 1), F.col("late"))
    kept = F.array_join(F.transform(stay, lambda i: F.element_at("lines", i + 1)), "\n")
    return lines.select(
        F.col("d").alias(id_name),
        F.col("n").cast("long").alias("n_lines"),
        F.when(F.col("late").isNull(), 0).otherwise(F.size("late")).cast("long").alias("n_dropped"),
        F.when(F.col("late").isNull(), F.col("x")).otherwise(kept).alias("kept_text"),
    )
