"""Web archives with segmented records: written, read back and reassembled.

Writing: one record per page. Its HTTP message carries the payload in chunks. A message
longer than ``SEGMENT`` bytes is split: a first record and continuation records that name
it as their origin, numbered, the last with the total length. A long payload seen on
several pages is stored once, with the largest id; the other pages become revisit records.
Archives are files of Spark's text sink (the record separator is the line separator), so
they go through Spark's commit protocol to any file system, and a lost task leaves nothing.

Reading: archives are parsed a file at a time; an archive holds at most ``RECORDS``
records of at most a segment each. Parsed records are written once. Whole records are
decoded where they lie; segments are grouped by their origin's identifier, sorted by
segment number, joined, checked against the total length, and decoded. Only segments are
shuffled, and a group is one record.

Defined cases: a null payload is empty. A null id is an empty part of the record's
identifier; such a page is never the one that others refer to. Pages equal in id and
payload have equal records, which are told apart by count only. A null address is left
out; control characters in one are percent-encoded. A record that is short, of a wrong
total length, or with a segment missing comes back with ``error`` set and no payload. An
empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.llm.common import col, hinted, partitions
from pagesift.session import materialize, new_path

#: Bytes of HTTP message in one record, payload bytes in one chunk, records in one archive.
SEGMENT = 16_384
CHUNK = 4_096
RECORDS = 4_000
#: Payloads of at least so many bytes are stored once.
REVISIT_BYTES = 1_000
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"
#: A batch of parsed records holds about this many bytes.
BATCH_BYTES = 8 << 20

RECORD = (
    "record_id string, type string, uri string, refers_to string, digest string, origin string, number int, "
    "total long, block binary, error string"
)
PAGE = (
    "record_id string, record_type string, uri string, refers_to string, payload_bytes long, payload_digest string, "
    "payload binary, error string"
)
FIELDS = {
    "warc-record-id": "record_id", "warc-type": "type", "warc-target-uri": "uri", "warc-refers-to": "refers_to",
    "warc-payload-digest": "digest", "warc-segment-origin-id": "origin", "warc-segment-number": "number",
    "warc-segment-total-length": "total",
}


def identifier(page: str | None, digest: str) -> str:
    return f"<urn:page:{page or ''}:{digest}>"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(x), x) for x in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """Payload of a body in chunked transfer coding; raises ValueError if it is not whole."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk header missing")
        size = int(body[at:end].split(b";")[0].strip(), 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(body[at : at + size])
        at += size + 2


def decoded(message: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of an HTTP message."""
    head, found, body = message.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("HTTP header not ended")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    return fields, unchunked(body) if fields.get("transfer-encoding", "").lower() == "chunked" else body


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its two closing line ends, which the sink adds."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block


def records(page: str | None, uri: str | None, payload: bytes, leader: str | None, segment: int) -> Iterator[bytes]:
    digest = hashlib.sha1(payload)
    own = identifier(page, digest.hexdigest())
    shared = [("WARC-Date", DATE), ("WARC-Payload-Digest", "sha1:" + base64.b32encode(digest.digest()).decode())]
    if uri is not None:
        clean = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)
        shared.insert(0, ("WARC-Target-URI", clean))
    kind = [("Content-Type", "application/http; msgtype=response")]
    if leader is not None:
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        refers = [("WARC-Profile", profile), ("WARC-Refers-To", identifier(leader, digest.hexdigest()))]
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *shared, *refers, *kind], head.encode())
        return
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    message = head.encode() + chunked(payload)
    parts = [message[i : i + segment] for i in range(0, len(message), segment)]
    first = [("WARC-Segment-Number", "1")] if len(parts) > 1 else []
    yield record([("WARC-Type", "response"), ("WARC-Record-ID", own), *shared, *first, *kind], parts[0])
    for number, part in enumerate(parts[1:], 2):
        fields = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{number}>"), *shared,
            ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", str(number)),
        ]
        if number == len(parts):
            fields.append(("WARC-Segment-Total-Length", str(len(message))))
        yield record(fields, part)


def write_archives(
    pages: DataFrame, path: str, id_name: str = "page_id", uri_name: str = "url", text_name: str = "html",
    segment: int = SEGMENT, per_file: int = RECORDS, least: int = REVISIT_BYTES,
) -> None:
    """Write the pages as compressed archives to ``path``, in as many files as tasks need."""
    rows = pages.select(
        col(id_name).alias("id"), col(uri_name).cast("string").alias("uri"),
        F.coalesce(col(text_name).cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.when(F.octet_length("payload") >= least, F.sha1("payload")))
    groups = (
        rows.where(F.col("digest").isNotNull()).groupBy("digest")
        .agg(F.max("id").alias("leader"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        .select(F.col("digest").alias("key"), "leader")
    )
    groups = materialize(groups, "warc-groups")
    joined = rows.join(hinted(groups, F.lit(80)), F.col("digest") == F.col("key"), "left")
    other = ~F.col("id").eqNullSafe(F.col("leader")) & F.col("leader").isNotNull()
    told = joined.select(
        F.col("id").cast("string").alias("id"), "uri", "payload", F.when(other, F.col("leader").cast("string")).alias("leader")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                made = [
                    x
                    for row in zip(*(batch.slice(at, 500).column(i).to_pylist() for i in range(4)))
                    for x in records(*row, segment)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["block"])

    (
        told.mapInArrow(run, "block binary").select(F.col("block").cast("string").alias("value")).write
        .option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)
    )


def parsed(content: bytes) -> Iterator[dict]:
    """The records of one archive; a broken one ends it with a record that has ``error``."""
    try:
        data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    except (zlib.error, EOFError, OSError) as error:
        yield {"error": f"archive: {error}"}
        return
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        head = data[at:end].decode("utf-8", "replace").split("\r\n")
        if end < 0 or not head[0].startswith("WARC/"):
            yield {"error": "no record header"}
            return
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head[1:])}
        found = {own: fields.get(name) for name, own in FIELDS.items()}
        try:
            found |= {k: int(found[k]) if found[k] else None for k in ("number", "total")}
            size = int(fields.get("content-length") or -1)
        except ValueError as error:
            yield found | {"number": None, "total": None, "error": f"header: {error}"}
            return
        block = data[end + 4 : end + 4 + size]
        at = end + 4 + size + 4
        if size < 0 or len(block) < size or data[at - 4 : at] != b"\r\n\r\n":
            yield found | {"error": "record cut short"}
            return
        yield found | {"block": block}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``, as they are stored."""
    schema = pa.schema([
        *((n, pa.string()) for n in ("record_id", "type", "uri", "refers_to", "digest", "origin")),
        ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("error", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for row in parsed(content.as_py()):
                    held.append(row)
                    size += len(row.get("block") or b"") + 500
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(run, RECORD)


def page(first: dict, message: bytes | None, error: str | None) -> dict:
    """A page of its first record and its whole message."""
    out = {k: first.get(k) for k in ("record_id", "uri", "refers_to")}
    out |= {"record_type": first.get("type"), "error": error or first.get("error")}
    if out["error"] is None:
        try:
            fields, payload = decoded(message or b"")
            digest = base64.b32decode((first.get("digest") or "").removeprefix("sha1:"))
            if first["type"] == "revisit":  # the payload is with the record referred to
                return out | {"payload_bytes": int(fields["content-length"]), "payload_digest": digest.hex()}
            if hashlib.sha1(payload).digest() != digest:
                raise ValueError("payload digest differs")
            return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest.hex()}
        except (ValueError, KeyError) as fault:
            out["error"] = str(fault)
    return out


def reassembled(segments: list[dict]) -> list[dict]:
    """The pages whose segments these are: all of one origin, ordered by number.

    Pages equal in id and payload have equal segments; each number then occurs as often.
    """
    firsts = [x for x in segments if x["number"] == 1]
    parts = {x["number"]: x for x in segments}
    if not firsts:
        return [page({"record_id": segments[0]["origin"]}, None, "first segment missing")]
    broken = next((x["error"] for x in segments if x["error"]), None)
    message = b"".join(x["block"] or b"" for x in parts.values())
    total = parts[max(parts)]["total"]
    if list(parts) != list(range(1, len(parts) + 1)) or total != len(message):
        broken = broken or "segments missing or of wrong total length"
    return [page(firsts[0], message, broken)] * len(firsts)


PAGE_ARROW = pa.schema([
    ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string()),
])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = batch.slice(at, 500).to_pylist()
            yield pa.RecordBatch.from_pylist([page(x, x["block"], None) for x in rows], schema=PAGE_ARROW)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by origin and number; a group may span batches."""
    held: list[dict] = []
    for batch in batches:
        made = []
        for row in batch.to_pylist():
            if held and held[0]["origin"] != row["origin"]:
                made += reassembled(held)
                held = []
            held.append(row)
        yield pa.RecordBatch.from_pylist(made, schema=PAGE_ARROW)
    if held:
        yield pa.RecordBatch.from_pylist(reassembled(held), schema=PAGE_ARROW)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the archives under ``path``: type, payload (null for a revisit), its length and digest, error."""
    place = new_path(spark, "warc-records")
    found = read_records(spark, path)
    found.write.option("compression", "zstd").parquet(place)
    found = spark.read.schema(found.schema).parquet(place)
    origin = F.coalesce("origin", F.when(F.col("number").isNotNull(), F.col("record_id")))
    found = found.withColumn("origin", origin)
    whole = found.where(F.col("origin").isNull()).mapInArrow(_whole, PAGE)
    parts = (
        found.where(F.col("origin").isNotNull()).repartition(partitions(spark), "origin")
        .sortWithinPartitions("origin", "number").mapInArrow(_joined, PAGE)
    )
    return whole.unionByName(parts)
