"""Joins that stay balanced when one key holds a large share of the rows.

``lookup_join`` joins rows to a table with one row per key. The table is
broadcast only after its size was measured; otherwise the join shuffles, and
keys with many rows are spread over several tasks by ``salted_join``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.session import materialize

BROADCAST_BYTES = 64 << 20
ROWS_PER_TASK = 500_000
MAX_HOT_KEYS = 100_000
NULL_SALTS = 1024

SALT = "_salt"
SALTS = "_salts"


def row_bytes(df: DataFrame) -> Column:
    """Size of a row as text plus a fixed cost."""
    return F.octet_length(F.to_json(F.struct(*[F.col(c) for c in df.columns]))).cast("long") + F.lit(48)


def table_bytes(df: DataFrame) -> int:
    return int(df.agg(F.sum(row_bytes(df)).alias("b")).first()["b"] or 0)


def any_null(keys: Sequence[str]) -> Column:
    test = F.col(keys[0]).isNull()
    for key in keys[1:]:
        test = test | F.col(key).isNull()
    return test


def count_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, combined before the shuffle."""
    return rows.where(~any_null(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    sizes: DataFrame,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Shuffle join of ``rows`` with ``lookup`` (unique on ``keys``).

    ``sizes`` holds ``keys`` and ``n``, the number of rows per key. A key above
    the limit gets ``ceil(n / limit)`` salts: its rows spread over that many
    groups and its lookup row is repeated once for each. At most
    ``MAX_HOT_KEYS`` keys can be above the limit, because the limit is at least
    the total divided by that number; this bounds what is broadcast here.
    Supports inner, left, left_semi and left_anti.
    """
    keys = list(keys)
    total, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    limit = max(rows_per_task, -(-int(total or 0) // MAX_HOT_KEYS))
    if not largest or largest <= limit:
        return _null_safe(rows, keys).join(
            lookup.withColumn(SALT, F.lit(0).cast("long")), keys + [SALT], how
        ).drop(SALT)

    hot = sizes.where(F.col("n") > limit).select(
        *keys, F.ceil(F.col("n") / limit).cast("long").alias(SALTS)
    )
    if table_bytes(hot) <= broadcast_bytes:
        hot = F.broadcast(hot)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.col(SALTS))
    left = rows.join(hot, keys, "left").withColumn(
        SALT,
        F.when(any_null(keys), _null_salt(rows))
        .when(F.col(SALTS).isNotNull(), spread)
        .otherwise(F.lit(0).cast("long")),
    )
    right = lookup.join(hot, keys, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(SALTS) - 1, F.lit(0).cast("long"))))
    )
    return left.drop(SALTS).join(right.drop(SALTS), keys + [SALT], how).drop(SALT)


def _null_salt(rows: DataFrame) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(NULL_SALTS).cast("long"))


def _null_safe(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    salt = F.when(any_null(keys), _null_salt(rows)).otherwise(F.lit(0).cast("long"))
    return rows.withColumn(SALT, salt)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str] | str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
    size: int | None = None,
) -> DataFrame:
    """Join ``rows`` with ``lookup``, a table with one row per key.

    ``size`` is an upper bound of the lookup's bytes if the caller measured it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if (table_bytes(lookup) if size is None else size) <= broadcast_bytes:
        return rows.join(F.broadcast(lookup), keys, how)
    sizes = materialize(count_keys(rows, keys), "key-sizes")
    return salted_join(rows, lookup, keys, sizes, how, rows_per_task, broadcast_bytes)
