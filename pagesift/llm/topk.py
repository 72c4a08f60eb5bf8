"""Exact top-k search by inner product over a bit-sliced index.

Vectors are quantised to integers. A block of the index holds, for each dimension, the
bits of its values as bitmaps over the block's rows (slices). For a query, the slices of
all dimensions are added by bitmap arithmetic, each shifted to the bits of the query's
component, complemented where that is negative. This gives the slices of the scores. The
top rows are selected from the most significant slice downward: rows that have the bit
are taken as long as they are fewer than k, else the search goes on among them. Rows that
are equal in all slices (the boundary) are resolved by the smaller id, and the scores of
the rows found are computed exactly.

Blocks of rows meet blocks of queries on an equal (block, query block) key, so both may
be larger than any one machine; nothing is broadcast.

Defined cases: rows with a null id or a null, empty or non-finite vector take no part.
Rows that are equal in all are different rows: a query is compared with every row but itself
that has the same number of components, and equal queries each give their rows. Scores must fit in 64 bits. An empty
table, or one without queries, gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagesift.llm.common import col
from pagesift.session import materialize

SCALE = 64
ROWS = 65_536
QUERIES = 256


def quantised(vectors: DataFrame, id_name: str, vector_name: str, scale: float) -> DataFrame:
    """id and v (array of long) of the rows that take part."""
    vector = col(vector_name)
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = col(id_name).isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & finite
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.where(good).select(col(id_name).alias("id"), whole.alias("v"))


def sliced(ids: np.ndarray, numbers: np.ndarray, values: np.ndarray) -> dict:
    """An index block: rows by id with their numbers, per dimension its least value, its number of bits and its slices."""
    order = np.argsort(ids, kind="stable")
    ids, numbers, values = ids[order], numbers[order], values[order]
    low = values.min(axis=0)
    high = (values - low).max(axis=0)
    bits = np.array([int(x).bit_length() for x in high.tolist()], dtype=np.int32)
    words = -(-len(ids) // 64)
    slices = np.zeros((int(bits.sum()), words * 8), dtype=np.uint8)
    at = 0
    for d, n in enumerate(bits.tolist()):
        shifted = (values[:, d] - low[d]).astype(np.uint64)
        for j in range(n):
            packed = np.packbits(((shifted >> np.uint64(j)) & np.uint64(1)).astype(np.uint8), bitorder="little")
            slices[at, : len(packed)] = packed
            at += 1
    return {"ids": ids.tobytes(), "numbers": numbers.tobytes(), "low": low.tobytes(), "bits": bits.tobytes(), "slices": slices.tobytes()}


class Block:
    """An index block in memory."""

    def __init__(self, ids: bytes, numbers: bytes, low: bytes, bits: bytes, slices: bytes):
        self.ids, self.low = np.frombuffer(ids, np.int64), np.frombuffer(low, np.int64)
        self.numbers = np.frombuffer(numbers, np.int64)
        self.bits = np.frombuffer(bits, np.int32)
        self.words = -(-len(self.ids) // 64)
        self.slices = np.frombuffer(slices, np.uint64).reshape(-1, self.words)
        self.inverse = ~self.slices
        self.first = np.cumsum(self.bits) - self.bits
        self.exists = np.zeros(self.words, dtype=np.uint64)
        ones = np.packbits(np.ones(len(self.ids), dtype=np.uint8), bitorder="little")
        self.exists.view(np.uint8)[: len(ones)] = ones

    def sums(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the scores, least significant first, up to a constant of the query."""
        columns: list[list[np.ndarray]] = [[]]
        for d, value in enumerate(query.tolist()):
            source = self.slices if value > 0 else self.inverse
            first, n, weight = int(self.first[d]), int(self.bits[d]), abs(value)
            shift = 0
            while weight:
                if weight & 1:
                    for j in range(n):
                        while len(columns) <= shift + j:
                            columns.append([])
                        columns[shift + j].append(source[first + j])
                weight >>= 1
                shift += 1
        out = []
        for at, column in enumerate(columns):  # grows by its carries
            while len(column) > 1:
                a, b = column.pop(), column.pop()
                half = a ^ b
                carry = a & b
                if column:
                    c = column.pop()
                    carry |= half & c
                    half ^= c
                column.insert(0, half)
                if at + 1 == len(columns):
                    columns.append([])
                columns[at + 1].append(carry)
            out.append(column[0] if column else np.zeros(self.words, dtype=np.uint64))
        return out

    def top(self, number: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the k best rows but that of this number; of equal scores the smaller ids."""
        rest = self.exists.copy()
        for row in np.flatnonzero(self.numbers == number).tolist():
            rest[row >> 6] &= ~(np.uint64(1) << np.uint64(row & 63))
        taken, n_taken = np.zeros(self.words, dtype=np.uint64), 0
        for piece in reversed(self.sums(query)):
            with_bit = rest & piece
            n = n_taken + int(np.bitwise_count(with_bit).sum())
            if n > k:
                rest = with_bit
            else:
                taken |= with_bit
                n_taken = n
                rest = rest & ~piece
                if n == k:
                    break
        rows = self._rows(taken)
        if n_taken < k:
            rows = np.concatenate([rows, self._rows(rest)[: k - n_taken]])
        return self.ids[rows], self._exact(rows, query)

    @staticmethod
    def _rows(bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))

    def _exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Scores from the bits of the rows."""
        bits = (self.slices[:, rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)
        score = np.full(len(rows), int((self.low * query).sum()), dtype=np.int64)
        for d, value in enumerate(query.tolist()):
            first = int(self.first[d])
            for j in range(int(self.bits[d])):
                score += bits[first + j].astype(np.int64) * (value << j)
        return score


def _build(most: int):
    def run(batches):
        held: dict[int, list[tuple[np.ndarray, ...]]] = {}
        names = ["ids", "numbers", "low", "bits", "slices"]

        def block(dim: int) -> pa.RecordBatch:
            made = sliced(*(np.concatenate(x) for x in zip(*held.pop(dim))))
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), *(pa.array([made[c]], pa.binary()) for c in names)], ["dim", *names]
            )

        for batch in batches:
            ids = batch.column(0).to_numpy()
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            flat = batch.column(1).flatten().to_numpy()
            numbers = batch.column(2).to_numpy()
            starts = np.cumsum(sizes) - sizes
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                held.setdefault(dim, []).append((ids[rows], numbers[rows], flat[starts[rows][:, None] + np.arange(dim)]))
                if sum(len(x[0]) for x in held[dim]) >= most:
                    yield block(dim)
        for dim in list(held):
            yield block(dim)

    return run


def _search(k: int):
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query_id": [], "query_no": [], "vec_id": [], "score": []}
        for row in index.to_pylist():
            block = Block(row["ids"], row["numbers"], row["low"], row["bits"], row["slices"])
            for query_id, number, vector in zip(*(queries.column(c).to_pylist() for c in ("id", "no", "v"))):
                if len(vector) == row["dim"]:
                    ids, scores = block.top(number, np.array(vector, dtype=np.int64), k)
                    found["query_id"] += [query_id] * len(ids)
                    found["query_no"] += [number] * len(ids)
                    found["vec_id"] += ids.tolist()
                    found["score"] += scores.tolist()
        return pa.table({c: pa.array(x, pa.int64()) for c, x in found.items()})

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, id_name: str = "vec_id", vector_name: str = "embedding",
    scale: float = SCALE, rows: int = ROWS, queries: int = QUERIES,
) -> DataFrame:
    """Per query: query_id, rank, vec_id, score. ``is_query`` is a condition on the column ``id``."""
    rows_of = quantised(vectors, id_name, vector_name, scale)
    whole = materialize(rows_of.withColumn("no", F.monotonically_increasing_id()), "topk-rows")
    asked = whole.where(is_query)
    n_blocks = max(1, -(-whole.count() // rows))
    n_queries = max(1, -(-asked.count() // queries))
    index = (
        whole.repartition(n_blocks)
        .mapInArrow(_build(2 * rows), "dim int, ids binary, numbers binary, low binary, bits binary, slices binary")
        .withColumn("block", F.spark_partition_id())
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    )
    spread = (
        asked.withColumn("part", F.pmod(F.xxhash64("id", "no"), F.lit(n_queries)).cast("int"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    )
    found = (
        index.groupBy("block", "part")
        .cogroup(spread.groupBy("block", "part"))
        .applyInArrow(_search(k), "query_id long, query_no long, vec_id long, score long")
    )
    best = W.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
