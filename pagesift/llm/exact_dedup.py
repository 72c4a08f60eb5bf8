"""Exact dedup by Grace hash partitioning.

Records meet by the hash of their normalised text. A bucket that is too large for
a table in memory is partitioned to spill files by the next bits of the hash, again
and again until it fits; then an open-addressing table compares complete texts.

* Each map task first does this for the rows it has, a bounded chunk at a time, and
  sends one representative of each text. So a text with a third of all rows sends
  one row per chunk and no task ever gets all its copies.
* The members of a local group stay in a written table, one row per group, and meet
  the verdict by the group's number, which is unique on both sides.
* Spill files are anonymous scratch of one task attempt. They vanish with it; the
  attempt that replaces a lost one makes its own from the shuffle.

Defined cases: a null text equals an empty one and all such rows are one group. A
null id sorts after all others. Of rows equal in id and text one stays. An empty
table gives an empty result. Other columns, whatever their names, ride in a struct.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm.common import binary_values, chunks, col, partitions
from pagesift.session import new_path

#: Bytes of records that one table in memory holds.
TABLE_BYTES = 48 << 20
#: Spill files of one partitioning step: 2 ** FAN_BITS.
FAN_BITS = 4
WHITE = b" \t\n\x0b\x0c\r"


class OpenTable:
    """Open addressing with linear probing; a slot holds the number of a distinct content."""

    def __init__(self, rows: int):
        self.mask = (1 << max(4, (2 * rows).bit_length())) - 1
        self.slots = [-1] * (self.mask + 1)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def number(self, digest: int, content: bytes) -> int:
        """The number of ``content``, a new one if no equal content is here."""
        at = digest & self.mask
        while (found := self.slots[at]) >= 0:
            if self.hashes[found] == digest and self.contents[found] == content:
                return found
            at = (at + 1) & self.mask
        self.slots[at] = len(self.contents)
        self.hashes.append(digest)
        self.contents.append(content)
        return self.slots[at]


def normalised(texts: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [x.translate(None, WHITE) for x in binary_values(texts)]


def numbered(contents: list[bytes], hashes: list[int]) -> tuple[np.ndarray, int]:
    slots = OpenTable(len(contents))
    groups = np.fromiter(map(slots.number, hashes, contents), dtype=np.int64, count=len(contents))
    return groups, len(slots.contents)


def ranked(groups: np.ndarray, points: pa.Array, ids: pa.Array) -> np.ndarray:
    """Row numbers by group, in it the most code points first, then the smallest id."""
    keys = pa.table({"g": groups, "p": points, "i": ids, "at": np.arange(len(groups))})
    order = [("g", "ascending"), ("p", "descending"), ("i", "ascending"), ("at", "ascending")]
    return pc.sort_indices(keys, sort_keys=order, null_placement="at_end").to_numpy()


def points_of(texts: pa.ChunkedArray | pa.Array) -> pa.Array:
    return pc.fill_null(pc.utf8_length(texts), 0).cast(pa.int64())


def field(rows: pa.Table, name: str) -> pa.ChunkedArray:
    return pc.struct_field(rows.column("row"), name)


def _local(id_name: str, text_name: str, table_bytes: int, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 40
        for rows in chunks(batches, table_bytes):
            texts, ids = field(rows, text_name), field(rows, id_name)
            contents = normalised(texts)
            hashes = [xxhash.xxh3_64_intdigest(x) for x in contents]
            groups, n = numbered(contents, hashes)
            order = ranked(groups, points_of(texts), ids)
            first = np.searchsorted(groups[order], np.arange(n))
            leaders = order[first]
            bounds = np.append(first, len(order))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("row").combine_chunks().take(pa.array(leaders)),
                    pa.array(made + np.arange(n)),
                    pa.array(np.array(hashes, dtype=np.uint64)[leaders].view(np.int64)),
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.concat_arrays(ids.take(pa.array(order)).chunks)),
                ],
                schema=schema,
            )
            made += n

    return run


def spilled(batches: Iterator[pa.RecordBatch], level: int) -> list:
    """Deal rows to 2 ** FAN_BITS scratch files by the bits of the hash that belong to ``level``."""
    files, writers = [tempfile.TemporaryFile() for _ in range(1 << FAN_BITS)], {}
    for batch in batches:
        bits = batch.column("hash").to_numpy().view(np.uint64) >> np.uint64(64 - FAN_BITS * (level + 1))
        bits &= np.uint64((1 << FAN_BITS) - 1)
        for bucket in np.unique(bits).tolist():
            if bucket not in writers:
                writers[bucket] = pa.ipc.new_stream(files[bucket], batch.schema)
            writers[bucket].write_batch(batch.take(pa.array(np.flatnonzero(bits == bucket))))
    for bucket, writer in writers.items():
        writer.close()
        files[bucket].seek(0)
    return [file for bucket, file in enumerate(files) if bucket in writers]


def buckets(batches: Iterator[pa.RecordBatch], table_bytes: int, level: int = 0) -> Iterator[pa.Table]:
    """Tables that hold whole hash buckets and fit in memory, by recursive partitioning."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.get_total_buffer_size()
        if size > table_bytes and FAN_BITS * (level + 1) <= 64:
            break
    else:
        if held:
            yield pa.Table.from_batches(held).combine_chunks()
        return

    def rest() -> Iterator[pa.RecordBatch]:
        while held:
            yield held.pop(0)
        yield from batches

    for file in spilled(rest(), level):
        with file, pa.ipc.open_stream(file) as reader:
            yield from buckets(iter(reader), table_bytes, level + 1)


def _global(id_name: str, text_name: str, table_bytes: int, rows_too: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in buckets(batches, table_bytes):
            texts, ids = field(rows, text_name), field(rows, id_name)
            contents = normalised(texts)
            groups, n = numbered(contents, rows.column("hash").to_pylist())
            order = ranked(groups, points_of(texts), ids)
            leaders = order[np.searchsorted(groups[order], np.arange(n))]
            sizes = np.bincount(groups, weights=rows.column("n").to_numpy(), minlength=n).astype(np.int64)
            wins = np.zeros(len(groups), dtype=bool)
            wins[leaders] = True
            if rows_too:
                yield from rows.select(["row"]).take(pa.array(leaders)).cast(schema).combine_chunks().to_batches(5_000)
                continue
            digests = pa.array([hashlib.sha256(contents[i]).hexdigest() for i in leaders.tolist()])
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("gid").combine_chunks(),
                    ids.take(pa.array(leaders[groups])).combine_chunks(),
                    pa.array(sizes[groups]),
                    pa.array(wins),
                    digests.take(pa.array(groups)),
                ],
                schema=schema,
            )

    return run


def _schema(kind: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kind)


def _sent(docs: DataFrame, id_name: str, text_name: str, columns: list[str], table_bytes: int) -> DataFrame:
    """One row per local group: its best row, number, hash, size and members."""
    rows = docs.select(F.struct(*[col(c) for c in columns]).alias("row"))
    id_type = docs.select(col(id_name)).schema[0].dataType
    kind = (
        T.StructType().add("row", rows.schema["row"].dataType).add("gid", "long").add("hash", "long").add("n", "long")
        .add("members", T.ArrayType(id_type))
    )
    return rows.mapInArrow(_local(id_name, text_name, table_bytes, _schema(kind)), kind)


def grace_groups(
    docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` of the normalised text."""
    spark = docs.sparkSession
    sent = _sent(docs, id_name, text_name, [id_name, text_name], table_bytes)
    path = new_path(spark, "exact-groups")
    sent.write.option("compression", "zstd").parquet(path)
    sent = spark.read.schema(sent.schema).parquet(path)
    id_type = sent.schema["members"].dataType.elementType
    kind = (
        T.StructType().add("gid", "long").add("keep_id", id_type).add("group_size", "long").add("wins", "boolean")
        .add("text_sha256", "string")
    )
    verdicts = (
        sent.select("row", "gid", "hash", "n")
        .repartition(partitions(spark), "hash")
        .mapInArrow(_global(id_name, text_name, table_bytes, False, _schema(kind)), kind)
    )
    return (
        sent.select("gid", F.posexplode("members").alias("at", "id"))
        .join(verdicts, "gid")
        .select(
            F.col("id").alias(id_name), "keep_id", "group_size", (F.col("wins") & (F.col("at") == 0)).alias("kept"),
            "text_sha256",
        )
    )


def grace_distinct(
    docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", table_bytes: int = TABLE_BYTES
) -> DataFrame:
    """The rows that stay, with all their columns."""
    kind = T.StructType().add("row", docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row")).schema[0].dataType)
    return (
        _sent(docs, id_name, text_name, docs.columns, table_bytes)
        .drop("members")
        .repartition(partitions(docs.sparkSession), "hash")
        .mapInArrow(_global(id_name, text_name, table_bytes, True, _schema(kind)), kind)
        .select("row.*")
    )
