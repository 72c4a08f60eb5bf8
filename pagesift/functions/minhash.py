"""MinHash signatures.

Function k maps a shingle hash h to ``(a_k * h + b_k) mod p`` with
p = 2**31 - 1, so every product fits a 64-bit integer in any engine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from pagesift.functions.hashing import OF_RUNS, PRIME31
from pagesift.functions.text import simple_lines

BUCKETS = 11
HASHES = 10
#: Shingles that are hashed at once, however wide the texts of a batch are.
SLICE = 1 << 17
#: Bytes of the lines whose runs of words are hashed at once.
LINE_BYTES = 1 << 19


def coefficients(count: int = BUCKETS * HASHES, seed: int = 1) -> list[tuple[int, int]]:
    """Pairs (a, b) from a seeded generator; the same for every run and engine."""
    rng = np.random.Generator(np.random.PCG64(seed))
    a = rng.integers(1, PRIME31, size=count)
    b = rng.integers(0, PRIME31, size=count)
    return list(zip(a.tolist(), b.tolist()))


def _folded(x: np.ndarray) -> np.ndarray:
    """``x % PRIME31`` of products of two numbers below it, without a division."""
    x = (x & PRIME31) + (x >> 31)  # less than twice the prime
    return np.minimum(x.view(np.uint64), (x - PRIME31).view(np.uint64)).view(np.int64)


def lengths(column: pa.Array) -> np.ndarray:
    """Elements of each array, or bytes of each string; null has none."""
    sizes = column.value_lengths() if pa.types.is_list(column.type) else pc.binary_length(column)
    return np.asarray(sizes.fill_null(0)).astype(np.int64)


def slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs whose values in ``column`` have about ``most`` elements or bytes."""
    runs = np.cumsum(lengths(batch.column(column))) // most
    cuts = [0, *(np.flatnonzero(np.diff(runs)) + 1).tolist(), batch.num_rows]
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(low, high - low)


def ngram_hashes(lines: pa.Array, n: int, of_bytes: Callable[[list[bytes]], np.ndarray]) -> pa.ListArray:
    """For each line of words with one blank between them the hashes of all runs of ``n`` words; null has none.

    A run is a part of its line, so none is put together.
    """
    lines = pa.concat_arrays([lines.cast(pa.large_binary()).fill_null(b"")])
    offsets = np.frombuffer(lines.buffers()[1], np.int64, len(lines) + 1, 8 * lines.offset)
    data = lines.buffers()[2].to_pybytes() if lines.buffers()[2] is not None else b""
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    blanks = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
    filled = offsets[1:] > offsets[:-1]
    starts = np.sort(np.concatenate([offsets[:-1][filled], blanks + 1]))
    ends = np.sort(np.concatenate([offsets[1:][filled], blanks]))
    bounds = np.searchsorted(starts, offsets)
    sizes = np.diff(bounds)
    first = np.flatnonzero(np.repeat(bounds[1:], sizes) - np.arange(len(starts)) >= n)
    hashes = [np.zeros(0, np.int64)]
    for at in range(0, len(first), SLICE):
        some = first[at : at + SLICE]
        low, high = starts[some], ends[some + n - 1]
        if of_bytes in OF_RUNS:
            hashes.append(OF_RUNS[of_bytes](data, low, high))
        else:
            hashes.append(of_bytes([data[x:y] for x, y in zip(low.tolist(), high.tolist())]))
    cuts = np.concatenate([[0], np.cumsum(np.maximum(sizes - n + 1, 0))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(hashes)))


def run_hashes(rows: DataFrame, id_col: str, n: int, of_bytes: Callable[[list[bytes]], np.ndarray]) -> DataFrame:
    """Rows ``(id, text)`` with texts from ``text.half_simple`` to ``(id, hashes)``: those of all runs of ``n`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, LINE_BYTES):
                hashes = ngram_hashes(simple_lines(part.column(1)), n, of_bytes)
                yield pa.RecordBatch.from_arrays([part.column(0), hashes], [id_col, "hashes"])

    kind = rows.schema[id_col].dataType
    return rows.mapInArrow(run, StructType([StructField(id_col, kind), StructField("hashes", ArrayType(LongType()))]))


def minima(shingles: pa.Array, pairs: list[tuple[int, int]], hashes: int) -> pa.Array:
    """For each array of shingle hashes one array of minima per bucket; empty without shingles."""
    lengths = np.asarray(shingles.value_lengths().fill_null(0))
    filled = lengths[lengths > 0]
    lowest = np.zeros((filled.size, len(pairs)), dtype=np.int64)
    if filled.size:
        values = np.asarray(shingles.flatten()).astype(np.int64)
        starts = np.concatenate(([0], np.cumsum(filled)[:-1]))
        modulo = _folded if values.min() >= 0 and values.max() < PRIME31 else lambda x: x % PRIME31
        for k, (a, b) in enumerate(pairs):
            lowest[:, k] = np.minimum.reduceat(modulo(values * a + b), starts)
    inner = np.arange(0, lowest.size + 1, hashes, dtype=np.int32)
    outer = np.concatenate(([0], np.cumsum(np.where(lengths > 0, len(pairs) // hashes, 0)))).astype(np.int32)
    buckets = pa.ListArray.from_arrays(pa.array(inner), pa.array(lowest.reshape(-1)))
    return pa.ListArray.from_arrays(pa.array(outer), buckets)


def signatures(
    rows: DataFrame, id_col: str, buckets: int, hashes: int, seed: int, n: int = 0,
    of_bytes: Callable[[list[bytes]], np.ndarray] | None = None,
) -> DataFrame:
    """Rows ``(id, shingles array<bigint>)`` to ``(id, minima array<array<bigint>>)``, one Arrow batch at a time.

    With ``of_bytes`` the rows are ``(id, line)``, and the shingles are its hashes of the lines' runs of ``n`` words.
    """
    pairs = coefficients(buckets * hashes, seed)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, SLICE if of_bytes is None else LINE_BYTES):
                shingles = part.column(1) if of_bytes is None else ngram_hashes(part.column(1), n, of_bytes)
                yield pa.RecordBatch.from_arrays([part.column(0), minima(shingles, pairs, hashes)], [id_col, "minima"])

    kind = rows.schema[id_col].dataType
    schema = StructType([StructField(id_col, kind), StructField("minima", ArrayType(ArrayType(LongType())))])
    return rows.mapInArrow(sign, schema)
