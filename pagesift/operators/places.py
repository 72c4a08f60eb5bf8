"""Joins that leave wide rows where they are.

Rows with bodies or texts are written once, with a place: the number of the writing task and the position
in its file. Everything that must be shuffled to judge them is a narrow projection of that
table, with the place beside the key. Verdicts come back by place: they are measured per file, files
are grouped into lots whose verdicts fit in a broadcast, and each lot reads only its own files. So
a wide row is written once and read once per result, and never stands below an Exchange,
however large the lookup is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.operators.joins import BROADCAST_BYTES, ROWS_PER_TASK, count_keys, row_bytes, salted_join, table_bytes
from pagesift.session import materialize, new_path

PLACE = "_place"
#: Bits of a place below the number of the file.
POSITION_BITS = 33


@dataclass(frozen=True)
class Placed:
    """Written rows; ``columns`` are theirs, without the place."""

    rows: DataFrame
    columns: tuple[str, ...]

    def narrow(self, *columns: str) -> DataFrame:
        return self.rows.select(PLACE, *columns)


def placed(df: DataFrame, name: str = "placed") -> Placed:
    """Write ``df`` once; the scan behind it runs no second time."""
    return Placed(materialize(df.withColumn(PLACE, F.monotonically_increasing_id()), name), tuple(df.columns))


def _file_number():
    return F.shiftright(F.col(PLACE), POSITION_BITS)


def lots(results: DataFrame, limit: int) -> list[tuple[int, int]]:
    """Runs [from, to) of file numbers whose results have at most ``limit`` bytes; a single file may have more."""
    sizes = results.groupBy(_file_number().alias("file")).agg(F.sum(row_bytes(results)).alias("b")).orderBy("file").collect()
    ends, held = [], 0
    for row in sizes:
        if held and held + row["b"] > limit:
            ends.append(row["file"])
            held = 0
        held += row["b"]
    starts = [0, *ends]
    return list(zip(starts, [*ends, 1 << (63 - POSITION_BITS)]))


def attached(
    table: Placed, results: DataFrame, how: str = "left", then: Callable[[DataFrame], DataFrame] | None = None,
    name: str = "attached", limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows joined with ``results``, which hold at most one row per place.

    With one lot nothing runs here. With more, each lot's rows, after ``then``, are appended to one table.
    """
    results = materialize(results, name + "-results")
    runs = lots(results, limit)

    def joined(rows: DataFrame, part: DataFrame) -> DataFrame:
        out = rows.join(F.broadcast(part), PLACE, how).drop(PLACE)
        return then(out) if then else out

    if len(runs) == 1:
        return joined(table.rows, results)
    spark = table.rows.sparkSession
    found = table.rows.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min(_file_number()).alias("file")).collect()
    path, schema = new_path(spark, name), None
    for first, end in runs:
        files = [x["path"] for x in found if first <= x["file"] < end]
        if files:
            rows = spark.read.schema(table.rows.schema).parquet(*files)
            part = joined(rows, results.where((_file_number() >= first) & (_file_number() < end)))
            part.write.mode("append").parquet(path)
            schema = part.schema
    if schema is None:
        return joined(table.rows, results)
    return spark.read.schema(schema).parquet(path)


def placed_join(
    rows: DataFrame | Placed, lookup: DataFrame, keys: Sequence[str] | str, how: str = "inner",
    broadcast_bytes: int | None = None, size: int | None = None, rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``lookup_join`` for wide rows: beyond a broadcast only the keys are shuffled.

    ``lookup`` has one row per key. Supports inner, left, left_semi and left_anti. Null keys meet nothing.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    added = [] if how in ("left_semi", "left_anti") else [c for c in lookup.columns if c not in keys]
    if (table_bytes(lookup) if size is None else size) <= limit:
        given = rows.rows.drop(PLACE) if isinstance(rows, Placed) else rows
        return given.join(F.broadcast(lookup), keys, how)
    table = rows if isinstance(rows, Placed) else placed(rows)
    narrow = table.narrow(*keys)
    sizes = materialize(count_keys(narrow, keys), "key-sizes")
    kind = "inner" if added else "left_semi"
    found = salted_join(narrow, lookup, keys, sizes, kind, rows_per_task, max(limit, 1)).select(PLACE, *added)
    out = attached(table, found, how, limit=max(limit, 1))
    return out.select(*keys, *[c for c in table.columns if c not in keys], *added)
