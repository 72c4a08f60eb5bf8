"""Web archives as a Spark data source, and their index.

``spark.read.format("warc").load(path)`` gives one row per response record, one task per archive file.
Archives are gzip streams that cannot be split, and the record number counts from the start of the file, so
without an index a file is the unit of work. Records are read one by one; a file is never held in memory.

A scan reads what is asked for: columns are chosen by the schema given to the reader (``scan_warc`` has
``columns``), and filters on URL, date, number or path are pushed into it. A body that nobody asks for, or of a
record that a filter drops, is skipped and never becomes a value.

``archive_index`` is one such scan: it writes down where each record lies. Archives hold each record in
a gzip member of its own, so ``fetch_records`` reads single records by their range, and one archive by many
tasks. Records that share a member with others have no range; their archive is read through.
"""

from __future__ import annotations

import gzip
import io
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

SCHEMA = (
    "cc_path string, record_idx bigint, url string, date string, content_type string, body binary"
)
FAILURE_SCHEMA = SCHEMA + ", error string"
INDEX_SCHEMA = "cc_path string, record_idx bigint, url string, date string, content_type string, offset bigint, length bigint, error string"
ARROW_TYPES = {
    "cc_path": pa.string(), "record_idx": pa.int64(), "url": pa.string(), "date": pa.string(), "content_type": pa.string(),
    "body": pa.binary(), "offset": pa.int64(), "length": pa.int64(), "error": pa.string(),
}
COLUMNS = ("cc_path", "record_idx", "url", "date", "content_type", "body", "error")
INDEX_COLUMNS = ("cc_path", "record_idx", "url", "date", "content_type", "offset", "length", "error")
BATCH_BYTES = 4 << 20
#: Rows that a writer turns into Python values at once.
WRITTEN_ROWS = 64
PIECE = 1 << 18
#: An archive is dealt to tasks in stretches of this size when its records are fetched by range.
STRETCH = 64 << 20
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
#: What is known of a record before its body is read.
HEADER_COLUMNS = ("cc_path", "record_idx", "url", "date")
PROBLEMS = (OSError, EOFError, ValueError, zlib.error)


# ---- records of a stream ----


class Members(io.RawIOBase):
    """Bytes of an archive, unpacked member by member; ``starts`` maps where a member begins to its place in the file."""

    def __init__(self, raw, packed: bool):
        self.raw, self.packed = raw, packed
        self.inflate, self.held, self.place, self.out = None, b"", 0, 0
        self.starts: dict[int, int] = {}

    def readable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.out

    def readinto(self, target) -> int:
        data = self._inflated(len(target)) if self.packed else self.raw.read(len(target))
        target[: len(data)] = data
        self.out += len(data)
        return len(data)

    def _inflated(self, most: int) -> bytes:
        while True:
            if not self.held:
                self.held = self.raw.read(PIECE)
            if self.inflate is None:
                if not self.held:
                    return b""
                self.starts[self.out] = self.place
                self.inflate = zlib.decompressobj(31)
            ended = not self.held
            data = self.inflate.decompress(self.held, most)
            rest = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
            self.place += len(self.held) - len(rest)
            self.held = rest
            if self.inflate.eof:
                self.inflate = None
            elif ended and not data:
                raise EOFError("archive cut short")
            if data:
                return data

    def place_of(self, position: int) -> int | None:
        """Place in the file of a position where a record begins; None inside a member."""
        if not self.packed:
            return position
        for old in [p for p in self.starts if p < position]:
            del self.starts[old]
        return self.starts.get(position)

    @property
    def end(self) -> int:
        """Bytes of the file that are read."""
        return self.place if self.packed else self.out

    def close(self) -> None:
        self.raw.close()
        super().close()


def _open(path: str) -> tuple[Members, io.BufferedReader]:
    where, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    members = Members(where.open_input_stream(name, compression=None), name.endswith(".gz"))
    return members, io.BufferedReader(members, PIECE)


def _headers(stream) -> dict[str, str] | None:
    """Header block up to a blank line; None at the end of the stream. ``at`` is where it begins."""
    at, line = stream.tell(), stream.readline()
    while line in (b"\r\n", b"\n"):
        at, line = stream.tell(), stream.readline()
    if not line:
        return None
    found = {"at": at}
    while line not in (b"\r\n", b"\n", b""):
        name, colon, value = line.partition(b":")
        if colon and name != b"at":
            found[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        line = stream.readline()
    return found


def _skip(stream, length: int) -> None:
    while length > 0:
        if not (part := stream.read(min(length, 1 << 20))):
            raise EOFError("record cut short")
        length -= len(part)


def _block(stream, length: int, with_body: bool) -> tuple[str | None, bytes | None]:
    """Content type and body of an HTTP block; without the body only its headers are kept."""
    data = stream.read(length if with_body else min(length, 1 << 16))
    if len(data) < length and (with_body or not data):
        raise EOFError(f"record cut short: {len(data)} of {length} bytes")
    if not with_body and b"\n\r\n" not in data and b"\n\n" not in data:
        data += stream.read(length - len(data))
    _skip(stream, length - len(data))
    block = io.BytesIO(data)
    http = _headers(block) or {}
    return http.get("content-type"), block.read() if with_body else None


@dataclass
class Record:
    """A response record; ``offset`` and ``length`` are its range in the file if it has one of its own."""

    record_idx: int
    url: str | None
    date: str | None
    content_type: str | None = None
    body: bytes | None = None
    offset: int | None = None
    length: int | None = None
    cc_path: str | None = None
    error: str | None = None


def response_records(
    stream, members: Members | None = None, with_body: bool = True, wanted: Callable[[Record], bool] | None = None
) -> Iterator[Record]:
    """The response records; where ``wanted`` says no, nothing of the block is kept and no record given."""
    number, last = 0, None
    while True:
        head = _headers(stream)
        at = None if members is None else members.end if head is None else members.place_of(head["at"])
        if last is not None:
            if at is None or last.offset is None:
                last.offset = None
            else:
                last.length = at - last.offset
            yield last
            last = None
        if head is None:
            return
        length = int(head.get("content-length", 0))
        if head.get("warc-type") != "response":
            _skip(stream, length)
            continue
        record = Record(number, head.get("warc-target-uri"), head.get("warc-date"), offset=at)
        number += 1
        if wanted is not None and not wanted(record):
            _skip(stream, length)
            continue
        record.content_type, record.body = _block(stream, length, with_body)
        last = record


def _batch(records: list[Record], columns: Iterable[str]) -> pa.RecordBatch:
    names = list(columns)
    return pa.RecordBatch.from_arrays([pa.array([getattr(r, c) for r in records], ARROW_TYPES[c]) for c in names], names=names)


def _batches(
    name: str, path: str, columns: Iterable[str] = COLUMNS, wanted: Callable[[Record], bool] | None = None
) -> Iterator[pa.RecordBatch]:
    """Records of an archive, in batches of bounded size."""
    held: list[Record] = []
    size = 0
    members, stream = _open(path)
    with stream:
        for record in response_records(stream, members, "body" in columns, wanted):
            record.cc_path = name
            held.append(record)
            size += 512 + len(record.body or b"")
            if size > BATCH_BYTES:
                yield _batch(held, columns)
                held, size = [], 0
    if held:
        yield _batch(held, columns)


# ---- data source ----


def _test(condition: ds.Filter) -> Callable[[Record], bool] | None:
    """A filter on what is known before the body, as a test of a record; None if it is not such a one."""
    if isinstance(condition, ds.Not):
        inner = condition.child
        # NULL is neither true nor false: only tests that cannot meet it are turned round.
        if isinstance(inner, (ds.IsNull, ds.IsNotNull, ds.EqualNullSafe)) and (test := _test(inner)) is not None:
            return lambda r: not test(r)
        return None
    name = condition.attribute[0] if len(condition.attribute) == 1 else None
    if name not in HEADER_COLUMNS:
        return None
    of = lambda r: getattr(r, name)
    if isinstance(condition, ds.IsNull):
        return lambda r: of(r) is None
    if isinstance(condition, ds.IsNotNull):
        return lambda r: of(r) is not None
    value = condition.value
    if isinstance(condition, ds.EqualNullSafe):
        return lambda r: of(r) == value
    tests = {
        ds.EqualTo: lambda x: x == value, ds.GreaterThan: lambda x: x > value, ds.GreaterThanOrEqual: lambda x: x >= value,
        ds.LessThan: lambda x: x < value, ds.LessThanOrEqual: lambda x: x <= value, ds.In: lambda x: x in value,
        ds.StringStartsWith: lambda x: x.startswith(value), ds.StringEndsWith: lambda x: x.endswith(value),
        ds.StringContains: lambda x: value in x,
    }
    # Order of text differs between Python and UTF-8 bytes, so only equality of text is tested here.
    ordered = (ds.GreaterThan, ds.GreaterThanOrEqual, ds.LessThan, ds.LessThanOrEqual)
    test = tests.get(type(condition))
    if test is None or (isinstance(condition, ordered) and isinstance(value, str)) or (value is None):
        return None
    return lambda r: of(r) is not None and test(of(r))


@dataclass
class ArchiveFile(InputPartition):
    path: str


@dataclass
class WarcReader(DataSourceReader):
    path: str
    columns: tuple[str, ...]
    pushed: list[ds.Filter] = field(default_factory=list)

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        self.pushed = [f for f in filters if _test(f) is not None]
        return [f for f in filters if _test(f) is None]

    def partitions(self) -> list[InputPartition]:
        where, name = fs.FileSystem.from_uri(self.path if ":" in self.path else f"file://{self.path}")
        info = where.get_file_info(name)
        prefix = self.path[: len(self.path) - len(name)] if ":" in self.path else ""
        if info.type == fs.FileType.File:
            return [ArchiveFile(self.path)]
        found = where.get_file_info(fs.FileSelector(name, recursive=True))
        names = sorted(f.path for f in found if f.is_file and f.path.endswith((".warc", ".warc.gz")))
        return [ArchiveFile(prefix + n) for n in names]

    def read(self, partition: ArchiveFile) -> Iterator[pa.RecordBatch]:
        tests = [_test(f) for f in self.pushed]

        def wanted(record: Record) -> bool:
            record.cc_path = partition.path
            return all(test(record) for test in tests)

        yield from _batches(partition.path, partition.path, self.columns, wanted)


class WarcWriter(DataSourceArrowWriter):
    """Writes rows of ``url``, ``date``, ``body`` as response records, one archive per task."""

    def __init__(self, path: str, schema):
        self.path = path
        self.names = schema.fieldNames()

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        rows = (row for batch in batches for at in range(0, batch.num_rows, WRITTEN_ROWS) for row in batch.slice(at, WRITTEN_ROWS).to_pylist())
        where, folder = fs.FileSystem.from_uri(self.path if ":" in self.path else f"file://{self.path}")
        where.create_dir(folder, recursive=True)
        sink = None
        for values in rows:
            if sink is None:
                # Tasks may be tried twice; each attempt writes its own file and only moves it when done.
                name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                sink = where.open_output_stream(name + ".part", compression=None)
            sink.write(gzip.compress(_record("request", values, b"GET / HTTP/1.1\r\n\r\n")))
            http = b"HTTP/1.1 200 OK\r\nContent-Type: " + str(values.get("content_type") or "text/html").encode() + b"\r\n\r\n"
            sink.write(gzip.compress(_record("response", values, http + bytes(values["body"] or b""))))
        if sink is not None:
            sink.close()
            return Written(name)
        return Written(None)

    def commit(self, messages) -> None:
        for message in messages:
            if message is not None and message.name:
                where, _ = fs.FileSystem.from_uri(self.path if ":" in self.path else f"file://{self.path}")
                where.move(message.name + ".part", message.name)

    def abort(self, messages) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    name: str | None


def _record(kind: str, values: dict, block: bytes) -> bytes:
    head = (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: {values.get('url')}\r\n"
        f"WARC-Date: {values.get('date')}\r\nContent-Length: {len(block)}\r\n\r\n"
    )
    return head.encode() + block + b"\r\n\r\n"


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], tuple(schema.fieldNames()))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], schema)


def scan_warc(spark: SparkSession, path: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Response records with their time as a timestamp ``ts``, if they have a date.

    ``columns`` are those to read; without ``body`` no body is kept. Filters on URL, path, number and date are
    pushed into the scan.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set(PUSHDOWN, "true")
    reader = spark.read.format("warc")
    if columns is not None:
        names = list(columns)
        reader = reader.schema(", ".join(part for part in SCHEMA.split(", ") if part.split()[0] in names))
    records = reader.load(path)
    return records.withColumn("ts", F.try_to_timestamp("date")) if "date" in records.columns else records


def _spread(listing: DataFrame, path: str, tasks: int | None) -> DataFrame:
    files = listing.select(path).distinct()
    return files.repartition(tasks or listing.sparkSession.sparkContext.defaultParallelism, path)


def _failed(name: str, problem: BaseException) -> Record:
    return Record(None, None, None, cc_path=name, error=f"{type(problem).__name__}: {problem}")


def scan_archives(listing: DataFrame, root: str, path: str = "cc_path", tasks: int | None = None) -> DataFrame:
    """Response records of the archives in a listing, with the failures.

    An archive that cannot be opened or read to its end gives one row with
    ``error`` and no records, instead of failing the job; see ``failed_ledger``.
    Its records wait in a scratch file of the task until the archive has ended
    well, so a failed archive can run again without giving any record twice.
    """
    return _spread(listing, path, tasks).mapInArrow(_whole_archives(root.rstrip("/"), COLUMNS), FAILURE_SCHEMA)


def archive_index(listing: DataFrame, root: str, path: str = "cc_path", tasks: int | None = None) -> DataFrame:
    """Where the response records of the listed archives lie: path, number, URL, date, content type, offset, length.

    Bodies are unpacked but not kept. A record without a gzip member of its own has no offset. Archives that
    cannot be read give one row with ``error``.
    """
    return _spread(listing, path, tasks).mapInArrow(_whole_archives(root.rstrip("/"), INDEX_COLUMNS), INDEX_SCHEMA)


def _whole_archives(root: str, columns: tuple[str, ...]):
    schema = pa.schema([(c, ARROW_TYPES[c]) for c in columns])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with tempfile.TemporaryFile() as held:
                    try:
                        with pa.ipc.new_stream(held, schema) as out:
                            for batch_of_rows in _batches(name, f"{root}/{name}", columns):
                                out.write_batch(batch_of_rows)
                    except PROBLEMS as problem:
                        yield _batch([_failed(name, problem)], columns)
                        continue
                    held.seek(0)
                    with pa.ipc.open_stream(held) as whole:
                        yield from whole

    return read


def fetch_records(index: DataFrame, root: str, tasks: int | None = None, stretch: int = STRETCH) -> DataFrame:
    """The records that rows of an index name, with their bodies, read by range.

    Only index rows are shuffled: an archive is dealt out in stretches, so many tasks may read from it. A range
    that does not hold the record, or cannot be read, gives a row with ``error``.
    """
    root = root.rstrip("/")
    rows = index.where(F.col("error").isNull()).select("cc_path", "record_idx", "url", "offset", "length")
    rows = rows.withColumn("stretch", F.floor(F.col("offset") / stretch))
    dealt = rows.repartition(tasks or index.sparkSession.sparkContext.defaultParallelism, "cc_path", "stretch")
    dealt = dealt.sortWithinPartitions("cc_path", F.asc_nulls_first("offset"), "record_idx")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_name, file, through = None, None, {}
        held, size = [], 0
        for row in (r for batch in batches for r in [*batch.to_pylist(), None]):
            if row is None:
                continue
            if row["cc_path"] != open_name:
                yield from _read_through(open_name, root, through)
                open_name, file, through = row["cc_path"], None, {}
            if row["offset"] is None:
                through[row["record_idx"]] = row["url"]
                continue
            record = Record(row["record_idx"], row["url"], None, cc_path=open_name)
            try:
                if file is None:
                    file = _random(f"{root}/{open_name}")
                record = _at(file, open_name, row)
            except PROBLEMS as problem:
                record.error = f"{type(problem).__name__}: {problem}"
            held.append(record)
            size += 512 + len(record.body or b"")
            if size > BATCH_BYTES:
                yield _batch(held, COLUMNS)
                held, size = [], 0
        yield from _read_through(open_name, root, through)
        if held:
            yield _batch(held, COLUMNS)

    return dealt.mapInArrow(read, FAILURE_SCHEMA)


def _random(path: str):
    where, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return where.open_input_file(name)


def _at(file, name: str, row: dict) -> Record:
    """The record in a range of a file."""
    data = file.read_at(row["length"], row["offset"])
    if name.endswith(".gz"):
        data = zlib.decompress(data, 31)
    record = next(response_records(io.BytesIO(data)), None)
    if record is None or record.url != row["url"]:
        raise ValueError("the index names another record")
    record.cc_path, record.record_idx = name, row["record_idx"]
    return record


def _read_through(name: str | None, root: str, numbers: dict[int, str | None]) -> Iterator[pa.RecordBatch]:
    """Records without a range of their own, by reading their archive from the start."""
    if not numbers:
        return
    try:
        yield from _batches(name, f"{root}/{name}", COLUMNS, lambda r: r.record_idx in numbers)
    except PROBLEMS as problem:
        yield _batch([_failed(name, problem)], COLUMNS)


def failed_ledger(records: DataFrame) -> DataFrame:
    """Archives that could not be read, with the reason."""
    return records.where(F.col("error").isNotNull()).select("cc_path", "error")
