"""Packing with a controlled mixture: deficit round-robin over source queues.

Every source of at least 1 / MAX_QUEUES of all tokens is a queue; the smaller ones share
one more, in which a second round-robin deals the quanta of each of them. A queue earns credit in proportion to its share of all tokens while the stream
of sequences grows, and is served one quantum whenever its credit covers it; credit that
it has not used (its deficit) stays for the next sequence. So each sequence holds every
queue's share up to a quantum, and no sequence is left short.

The state after any number of services has a closed form. Quantum j of queue s is served
when the credit of s reaches j quanta, at time j / weight(s), so the number of quanta that
another queue has been served before is a division. Every document therefore finds its
place from its queue's offset alone, no matter which partition holds it: deficits carry
from partition to partition without any task waiting for another.

The second level has no limit on its sources. Each of the m quanta of a source stands at
an even distance, 1 / m, from the next, from a start that the hash of the source gives.
The quanta are sorted by that time over all partitions, and running sums of their sizes
are their places in the shared queue, so each stretch of it holds its sources' shares.

1. Tokenise; write (part, source, tokens before it in that part, ids) once.
2. Sum tokens per part and source, then running sums over the parts, per source.
3. Texts of small sources are cut at the borders of quanta and join the places of these.
4. Each row, where it lies, cuts its ids at the borders of quanta and sequences.

The last incomplete sequence is cut into powers of two, so nothing is padded.

Defined cases: a null text is empty and has the end id only. A null source is the empty
one. Rows equal in all columns are packed each for itself. An empty table gives an empty
result. Other columns play no part.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagesift.llm.common import col, hinted, partitions, text_of, words
from pagesift.session import materialize, new_path

SEQUENCE = 2048
QUANTUM = 256
MAX_QUEUES = 64
WEIGHTS = 1 << 20
#: Words that a worker remembers; when full, the memo starts anew.
MEMO_WORDS = 800_000
MEMO_PIECES = 300_000
MEMO_CHARS = 64


class WordTokenizer:
    """Ids of texts; words between ASCII white space are independent and are remembered.

    Normalising, splitting and merging are those of the tokenizer file. The library's parts
    are called one by one, as its whole call costs several times as much for a single word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        with open(path) as file:
            split = json.load(file)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split).findall
        self.normal, self.merge = own.normalizer.normalize_str, own.model.tokenize
        self.cut = own.pre_tokenizer.pre_tokenize_str
        # Ids as little-endian unsigned 32-bit numbers, which take less room than lists.
        self.pieces: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        ids = np.array([x.id for x in self.merge(text)], dtype="<u4").tobytes()
        if len(text) <= MEMO_CHARS:
            if len(self.pieces) >= MEMO_PIECES:
                self.pieces.clear()
            self.pieces[text] = ids
        return ids

    def word(self, text: str) -> bytes:
        if text.isascii() and text.isprintable():  # its normal form is lower case and its bytes stand for themselves
            low = text.lower()
            found = [low] if low.isalpha() else self.split(low)
        else:
            found = [x for x, _ in self.cut(self.normal(text))]
        known = self.pieces.get
        ids = b"".join([known(x) or self.piece(x) for x in found])
        if len(text) <= MEMO_CHARS:
            if len(self.words) >= MEMO_WORDS:
                self.words.clear()
            self.words[text] = ids
        return ids

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each text start, and all ids; each text ends with ``end_id``."""
        starts, numbers, distinct = words(texts)
        known = self.words.get
        found = [known(x) or self.word(x) for x in distinct.to_pylist()]
        found.append(np.array([end_id], dtype="<u4").tobytes())
        numbers = np.insert(numbers, starts[1:], len(found) - 1)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        n = sizes[numbers]
        ends = np.cumsum(n)
        ids = flat[np.repeat(first[numbers] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]
        return np.concatenate([[0], ends])[starts + np.arange(len(starts))], ids


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokenised(docs: DataFrame, path: str, end_id: int, id_name: str, text_name: str, source_name: str) -> DataFrame:
    """id, source, part, ``at`` (ids of that source before it in the part), n, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path).encode
        part, before = TaskContext.get().partitionId(), {}
        for batch in batches:
            for first in range(0, batch.num_rows, 2_500):
                rows = batch.slice(first, 2_500)
                bounds, ids = encode(rows.column(2), end_id)
                sizes, starts = np.diff(bounds), []
                data = ids.astype("<u4").tobytes()
                cut = [data[4 * a : 4 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                for source, n in zip(rows.column(1).to_pylist(), sizes.tolist()):
                    starts.append(before.get(source, 0))
                    before[source] = starts[-1] + n
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0), rows.column(1), pa.array([part] * len(cut), pa.int64()),
                        pa.array(starts, pa.int64()), pa.array(sizes), pa.array(cut, pa.binary()),
                    ],
                    ["id", "source", "part", "at", "n", "ids"],
                )

    rows = docs.select(col(id_name).alias("id"), text_of(source_name).alias("source"), text_of(text_name).alias("text"))
    kind = f"id {rows.schema['id'].dataType.simpleString()}, source string, part long, at long, n long, ids binary"
    return rows.mapInArrow(run, kind)


class Schedule:
    """Where each quantum of each queue stands in the stream of all tokens."""

    def __init__(self, totals: list[int], sequence: int = SEQUENCE, quantum: int = QUANTUM):
        self.totals = np.array(totals, dtype=np.int64)
        self.sequence, self.quantum = sequence, quantum
        everything = int(self.totals.sum())
        # At most 2 ** 20, so that (quanta x weight) stays far below 2 ** 63.
        self.weights = np.array([max(1, t * WEIGHTS // max(1, everything)) for t in totals], dtype=np.int64)
        full = everything // sequence
        rest, starts = everything - full * sequence, [full * sequence]
        for bit in reversed(range(sequence.bit_length())):
            if rest & (1 << bit):
                starts.append(starts[-1] + (1 << bit))
        self.full, self.tail = full, np.array(starts, dtype=np.int64)

    def position(self, queue: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Tokens that the stream holds before quantum ``j`` of ``queue``."""
        own = self.weights[queue]
        before = j * self.quantum
        for other, weight in enumerate(self.weights.tolist()):
            # Quanta i of the other queue with i / weight < j / own; of equal times the lower queue comes first.
            earlier = np.where(other < queue, j * weight // own + 1, -(-(j * weight) // own))
            served = np.minimum(earlier * self.quantum, self.totals[other])
            before += np.where(queue == other, 0, served)
        return before

    def sequence_of(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The sequence that holds a position, and where that sequence starts."""
        last = np.searchsorted(self.tail, position, side="right") - 1
        number = np.where(last < 0, position // self.sequence, self.full + last)
        return number, np.where(last < 0, number * self.sequence, self.tail[np.maximum(last, 0)])

    def pieces(self, queue: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, start, length, sequence, offset) of documents that take [at, at + n) of their queues."""
        q = self.quantum
        first, count = at // q, (at + n - 1) // q - at // q + 1
        row = np.repeat(np.arange(len(n)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        j = first[row] + step
        low, high = np.maximum(at[row], j * q), np.minimum((at + n)[row], (j + 1) * q)
        place = self.position(queue[row], j) + low - j * q
        # A quantum is shorter than a sequence, but the last sequences are short: cut until nothing is cut.
        start, length = low - at[row], high - low
        while True:
            number, begin = self.sequence_of(place)
            following, _ = self.sequence_of(place + length - 1)
            across = number != following
            if not across.any():
                break
            ends = np.where(number < self.full, begin + self.sequence, 0)
            tail = number >= self.full
            ends[tail] = self.tail[np.minimum(number[tail] - self.full + 1, len(self.tail) - 1)]
            cut = (ends - place)[across]
            parts = [np.concatenate([x, y]) for x, y in (
                (row, row[across]), (start, start[across] + cut), (place, place[across] + cut),
                (length, length[across] - cut),
            )]
            parts[3][: len(length)][across] = cut
            order = np.lexsort((parts[1], parts[0]))
            row, start, place, length = (x[order] for x in parts)
        # Join what touches in the document, in the stream and in the sequence.
        if len(row):
            fresh = np.ones(len(row), dtype=bool)
            fresh[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + length[:-1]) | (number[1:] != number[:-1])
            heads = np.flatnonzero(fresh)
            length = np.add.reduceat(length, heads)
            row, start, place, number, begin = (x[heads] for x in (row, start, place, number, begin))
        return row, start, length, number, place - begin


def _cut(schedule: Schedule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queue, at, n, first, whole = (batch.column(i).to_numpy() for i in (1, 2, 3, 5, 6))
            ids = batch.column(4).to_pylist()
            row, start, length, number, offset = schedule.pieces(queue, at, n)
            cut = [ids[r][4 * a : 4 * (a + k)] for r, a, k in zip(row.tolist(), start.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row)), pa.array(first[row] + start), pa.array(length),
                    pa.array(cut, pa.binary()), pa.array(whole[row]), pa.array(number), pa.array(offset),
                ],
                ["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

    return run


def _split(quantum: int):
    """Each text cut at the borders of its source's quanta: ``low`` is the place in quantum ``j``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            ids = batch.column(4).to_pylist()
            count = (at + n - 1) // quantum - at // quantum + 1
            row = np.repeat(np.arange(len(n)), count)
            j = (at // quantum)[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            low, high = np.maximum(at[row], j * quantum), np.minimum((at + n)[row], (j + 1) * quantum)
            first, length = low - at[row], high - low
            for k in range(0, len(row), 20_000):
                some = slice(k, k + 20_000)
                cut = [ids[r][4 * a : 4 * (a + m)] for r, a, m in zip(row[some].tolist(), first[some].tolist(), length[some].tolist())]
                own = pa.array(row[some])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(own), batch.column(1).take(own), pa.array(j[some]),
                        pa.array((low - j * quantum)[some]), pa.array(length[some]), pa.array(cut, pa.binary()),
                        pa.array(first[some]), pa.array(n[row[some]]),
                    ],
                    ["id", "source", "j", "low", "n", "ids", "first", "doc_tokens"],
                )

    return run


def dealt_quanta(totals: DataFrame, quantum: int) -> DataFrame:
    """Where quantum ``j`` of each source of ``totals`` (source, n) stands in their shared queue."""
    count = F.ceil(F.col("n") / quantum).cast("long")
    block = 4_096
    blocks = totals.withColumn("m", count).withColumn("b", F.explode(F.sequence(F.lit(0), F.expr(f"(m - 1) div {block}"))))
    quanta = blocks.withColumn("j", F.explode(F.sequence(F.col("b") * block, F.least(F.col("m"), (F.col("b") + 1) * block) - 1)))
    phase = F.pmod(F.xxhash64("source"), F.lit(1 << 32)) / float(1 << 32)
    quanta = quanta.select(
        "source", "j", F.least(F.lit(quantum), F.col("n") - F.col("j") * quantum).alias("size"),
        ((F.col("j") + phase) / F.col("m")).alias("time"),
    )
    order = ["time", "source", "j"]
    # The number of a range is its place in the order of ranges.
    ranges = quanta.repartitionByRange(partitions(totals.sparkSession), *order).withColumn("range", F.spark_partition_id())
    ranges = materialize(ranges, "quanta")
    sums = ranges.groupBy("range").agg(F.sum("size").alias("all"))  # a row per range
    before = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("range", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = ranges.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return placed.join(F.broadcast(sums), "range").select("source", "j", (F.col("base") + F.col("inner")).alias("at"))


def packed(
    docs: DataFrame, path: str, end_id: int = 1, id_name: str = "doc_id", text_name: str = "text",
    source_name: str = "source", sequence: int = SEQUENCE, quantum: int = QUANTUM, max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """Per piece: id, start, length, ids (binary, unsigned 32-bit), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    rows = tokenised(docs, path, end_id, id_name, text_name, source_name)
    place = new_path(spark, "packing-ids")
    rows.write.option("compression", "zstd").parquet(place)
    rows = spark.read.schema(rows.schema).parquet(place)

    sums = materialize(rows.groupBy("part", "source").agg(F.sum("n").alias("n")), "packing-sums")
    total = sums.agg(F.sum("n").alias("n")).first()["n"] or 0
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    is_large = F.col("n") * max_queues >= total
    # At most max_queues sources can have that share.
    large = by_source.where(is_large).orderBy(F.desc("n"), "source").collect()
    rest = total - sum(x["n"] for x in large)
    schedule = Schedule([*[x["n"] for x in large], rest], sequence, quantum)
    names = F.create_map(*[F.lit(y) for i, x in enumerate(large) for y in (x["source"], i)]) if large else None
    queue = F.coalesce(names[F.col("source")], F.lit(len(large))) if large else F.lit(len(large))

    over = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = sums.select(
        "part", "source", queue.cast("long").alias("queue"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base")
    )
    found = rows.join(hinted(bases, F.octet_length("source") + 64), ["part", "source"]).select(
        "id", "source", "queue", (F.col("base") + F.col("at")).alias("at"), "n", "ids"
    )
    columns = ["id", "queue", "at", "n", "ids", "first", "doc_tokens"]
    ready = found.where(F.col("queue") < len(large)).withColumns({"first": F.lit(0).cast("long"), "doc_tokens": F.col("n")})
    ready = ready.select(*columns)
    if rest:
        kind = (
            f"id {rows.schema['id'].dataType.simpleString()}, source string, j long, low long, n long, ids binary, "
            "first long, doc_tokens long"
        )
        small = found.where(F.col("queue") == len(large)).select("id", "source", "at", "n", "ids").mapInArrow(_split(quantum), kind)
        places = dealt_quanta(by_source.where(~is_large), quantum).hint("merge")
        small = small.join(places, ["source", "j"]).withColumns(
            {"queue": F.lit(len(large)).cast("long"), "at": F.col("at") + F.col("low")}
        ).select(*columns)
        ready = ready.unionByName(small) if large else small
    kind = (
        f"id {rows.schema['id'].dataType.simpleString()}, start long, length long, ids binary, doc_tokens long, "
        "sequence_id long, offset long"
    )
    return ready.mapInArrow(_cut(schedule), kind).withColumnRenamed("id", id_name)
