"""What the operators of this folder share: tables, columns, batches, checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table up to this many bytes, measured first, may be broadcast; a larger one is shuffled.
BROADCAST_BYTES = 32 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, which may hold dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    """The text, null as empty."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hinted(df: DataFrame, row_bytes: Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` to be broadcast if its rows, measured by ``row_bytes``, fit in ``limit``; else to be shuffled."""
    total = df.agg(F.sum(row_bytes).alias("b")).first()["b"] or 0
    return F.broadcast(df) if total <= limit else df.hint("merge")


@contextmanager
def _set(spark: SparkSession, key: str, value: int):
    before = spark.conf.get(key)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def few_bytes(spark: SparkSession, most: int):
    """Jobs inside send at most about ``most`` bytes to a Python worker at once, however wide their rows are."""
    return _set(spark, ARROW_BYTES, most)


def few_rows(spark: SparkSession, most: int):
    """Scans of Parquet inside hold ``most`` rows at once."""
    return _set(spark, READ_ROWS, most)


def chunks(
    batches: Iterator[pa.RecordBatch], most_bytes: int, bytes_of: Callable[[pa.RecordBatch], int] | None = None
) -> Iterator[pa.Table]:
    """Tables of about ``most_bytes``, or as ``bytes_of`` counts them: small batches are joined, large ones are cut."""
    pending: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        own = bytes_of(batch) if bytes_of else batch.nbytes
        pieces = max(1, min(batch.num_rows, -(-own // most_bytes)))
        step = -(-batch.num_rows // pieces) if batch.num_rows else 1
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            pending.append(part)
            size += part.get_total_buffer_size() if pieces == 1 and not bytes_of else own // pieces
            if size >= most_bytes:
                yield pa.Table.from_batches(pending).combine_chunks()
                pending, size = [], 0
    if pending:
        yield pa.Table.from_batches(pending).combine_chunks()


def binary_values(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of every value, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def out_batches(table: pa.Table, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    yield from table.cast(schema).combine_chunks().to_batches(max_chunksize=20_000)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: where each text's words start, a number per word, the distinct words.

    Empty words may occur at the ends of a text.
    """
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    starts = split.offsets.to_numpy()
    coded = split.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
    return starts - starts[0], coded.indices.to_numpy().astype(np.int64), coded.dictionary
