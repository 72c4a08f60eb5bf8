"""Removal of long repeated byte strings by bucket-pointer refinement of suffixes.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else, in the
same document or another, is removed. A suffix is a place where such a string can start.

1. Initial q-gram buckets. Each string of LENGTH bytes has one anchor: its GRAM-byte
   q-gram of least hash, the leftmost of equals. Equal strings have equal anchors at equal
   distances, so suffixes are dealt to tasks by the q-gram of their anchor. Neighbouring
   suffixes share an anchor; they travel together as one context, a stretch of text of
   less than 2 * LENGTH bytes. Buckets with one member are done: first the q-grams are
   counted, then only contexts whose q-gram may occur twice are sent. The test for that is
   a bitmap of bounded size; where it errs, a context is sent in vain, never lost.
2. Refinement. In a bucket, equal contexts are combined (before the shuffle, too, so a
   passage with thousands of copies is sent once by a task). The suffixes of different
   contexts are sorted by their first 8 bytes, then by the pair of bucket identifiers at
   offset 0 and 8, at 0 and 16, and so on: each step uses the identifiers that the step
   before has assigned, and drops suffixes that are alone, until LENGTH bytes are equal.
3. Contexts learn which of their bytes are covered, documents collect these by a join on
   the context's 128-bit hash, and the bytes are cut out.

A bucket with very many contexts is dealt further: its suffixes are split into ranges of
distance from the anchor, and each range is keyed by the bytes that all its strings share.

Defined cases: a null text is empty; a text shorter than LENGTH loses nothing. Rows equal
in id and text get equal results, and as they are two documents, both lose all they share.
Null ids are ids like others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm.common import binary_values, chunks, col, partitions, text_of
from pagesift.llm.near_dedup import mixed
from pagesift.session import materialize

LENGTH = 200
GRAM = 32
#: Bits of the bitmap of repeated q-grams: 16 for each, up to this many.
MOST_BITS = 28
#: A bucket of more contexts than this, or than one in a million of all, is dealt further.
HOT = 1_000
HOT_SHARE = 1_000_000
RANGES = 16
CHUNK_BYTES = 1 << 20
SORT_BYTES = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of the ``gram`` bytes at each position; ``gram`` is a power of two."""
    out = data.astype(np.uint64) + np.uint64(1)
    power, width = MULTIPLIER, 1
    while width < gram:
        out = out[:-width] * np.uint64(power) + out[width:]
        power = power * power % (1 << 64)
        width *= 2
    return mixed(out)


def least_places(order: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours, by doubling."""
    out, have = order, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


def contexts(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of string starts with a common anchor: (document, first, last, anchor, hash of its q-gram).

    Places count from the start of all texts put together.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    hashes = gram_hashes(data, gram)
    width = length - gram + 1
    # The upper bits decide, then the place: at most 2 ** 31 bytes are put together.
    order = (hashes & np.uint64(0xFFFFFFFF80000000)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (least_places(order, width) & np.uint64(0x7FFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    starts = np.arange(len(anchor))
    valid = np.flatnonzero(starts + length <= ends[doc])
    if not len(valid):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),)
    doc, anchor = doc[valid], anchor[valid]
    fresh = np.ones(len(valid), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
    heads = np.flatnonzero(fresh)
    last = valid[np.append(heads[1:], len(valid)) - 1]
    return doc[heads], valid[heads], last, anchor[heads], hashes[anchor[heads]]


class Filter:
    """Which q-grams may occur twice, and which have very many contexts."""

    def __init__(self, words: np.ndarray, bits: int, hot: np.ndarray):
        self.words, self.bits, self.hot = words, bits, hot

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64((1 << self.bits) - 1)
        return hashes & mask, (hashes >> np.uint64(32)) & mask

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), dtype=bool)
        for at in self.places(hashes):
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def dealt(texts: list[bytes], length: int, gram: int, test: Filter) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(document, place in it, key, distance to the anchor, bytes) of each context that may be repeated."""
    doc, first, last, anchor, hashes = contexts(texts, length, gram)
    keep = np.flatnonzero(test.maybe(hashes)) if len(hashes) else np.zeros(0, np.int64)
    hot = np.isin(hashes[keep], test.hot)
    begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    data = b"".join(texts)
    step = -(-(length - gram + 1) // RANGES)
    keys = hashes[keep].view(np.int64).tolist()
    for d, low, high, x, key, split in zip(*(y[keep].tolist() for y in (doc, first, last, anchor)), keys, hot.tolist()):
        base = int(begin[d])
        if not split:
            yield d, low - base, key, x - low, data[low : high + length]
            continue
        for r in range((x - high) // step, (x - low) // step + 1):
            # Distances r * step to r * step + step - 1; all their strings share these bytes.
            near, far = r * step, min(r * step + step - 1, length - gram)
            shared = data[x - near : x - far + length]
            own = xxhash.xxh3_64_intdigest(shared, seed=r + 1) - (1 << 63)
            a, b = max(low, x - far), min(high, x - near)
            yield d, a - base, own, x - a, data[a : b + length]


def name_of(key: int, lead: int, data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data + b"%d %d" % (key, lead))


def ranked(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket identifiers of values, and the size of each value's bucket."""
    _, ids, sizes = np.unique(values, return_inverse=True, return_counts=True)
    return ids.astype(np.uint64), sizes[ids]


def repeated(groups: np.ndarray, leads: np.ndarray, data: list[bytes], length: int) -> list[np.ndarray]:
    """For each context the starts of strings that another context of its group has, too.

    ``groups`` are bucket numbers, ``leads`` the distances of the anchors; contexts differ.
    """
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    begin = np.cumsum(sizes) - sizes
    text = np.frombuffer(b"".join(data) + bytes(8), dtype=np.uint8)
    owner = np.repeat(np.arange(len(data)), sizes)
    inner = np.arange(len(owner)) - begin[owner]
    left = sizes[owner] - inner
    # Initial buckets: group, place relative to the anchor, and eight bytes.
    word = np.zeros(len(owner), dtype=np.uint64)
    for k in range(8):
        word = (word << np.uint64(8)) | text[k : k + len(owner)]
    _, grams = np.unique(word, return_inverse=True)
    place = groups[owner].astype(np.uint64) * np.uint64(4 * length) + (inner - leads[owner] + 2 * length).astype(np.uint64)
    bucket = np.zeros(len(owner), dtype=np.uint64)
    active = np.flatnonzero(left >= 8)
    ids, count = ranked(place[active] * np.uint64(len(owner) + 1) + grams[active].astype(np.uint64))
    bucket[active] = ids + np.uint64(1)
    active = active[count > 1]
    width = 8
    while width < length:
        step = min(width, length - width)
        # A suffix that was alone before stays alone: only the others are refined.
        alone = np.zeros(len(owner) + 1, dtype=bool)
        alone[:-1] = True
        alone[active] = False
        active = active[(left[active] >= width + step)]
        active = active[~alone[active + step]]
        ids, count = ranked(bucket[active] * np.uint64(len(owner) + 2) + bucket[active + step])
        bucket = np.zeros(len(owner), dtype=np.uint64)
        bucket[active] = ids + np.uint64(1)
        active = active[count > 1]
        width += step
    where = owner[active]
    return np.split(inner[active], np.searchsorted(where, np.arange(1, len(data))))


def runs(starts: np.ndarray, length: int) -> np.ndarray:
    """Covered runs as (first, end) pairs, from ascending starts of strings."""
    if not len(starts):
        return np.zeros((0, 2), dtype=np.int32)
    gaps = np.flatnonzero(np.diff(starts) > length)
    first = starts[np.append(0, gaps + 1)]
    return np.stack([first, starts[np.append(gaps, len(starts) - 1)] + length], axis=1).astype(np.int32)


def _grams(length: int, gram: int):
    """q-grams of anchors with their numbers of places and of different contexts in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 8 * CHUNK_BYTES):
            found = []
            for at in range(0, part.num_rows, 500):
                found.append(contexts(binary_values(part.column("text").slice(at, 500)), length, gram)[4])
            hashes, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
            for at in range(0, len(hashes), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[at : at + 50_000].view(np.int64)), pa.array(n[at : at + 50_000].astype(np.int64))], ["gram", "n"]
                )

    return run


def _sent(length: int, gram: int, test):
    """Different contexts of a chunk with their numbers of places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 8 * CHUNK_BYTES):
            counts: dict[tuple[int, int, bytes], int] = {}
            for at in range(0, part.num_rows, 500):
                for _, _, key, lead, data in dealt(binary_values(part.column("text").slice(at, 500)), length, gram, test.value):
                    own = (key, lead, data)
                    counts[own] = counts.get(own, 0) + 1
            rows = list(counts.items())
            for at in range(0, len(rows), 10_000):
                some = rows[at : at + 10_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x[0][0] for x in some], pa.int64()), pa.array([x[0][1] for x in some], pa.int32()),
                        pa.array([x[0][2] for x in some], pa.binary()), pa.array([x[1] for x in some], pa.int64()),
                    ],
                    ["key", "lead", "data", "n"],
                )

    return run


def _judged(length: int):
    """Covered runs of each different context; rows come sorted by key."""

    def judge(held: dict[tuple[int, int, bytes], int]) -> pa.RecordBatch:
        rows = list(held)
        keys = np.array([x[0] for x in rows], dtype=np.int64)
        _, groups, sizes = np.unique(keys, return_inverse=True, return_counts=True)
        # Contexts with several places are repeated whole; groups of only such need no sorting.
        single = np.fromiter((held[x] == 1 for x in rows), bool, len(rows))
        several = np.flatnonzero((sizes[groups] > 1) & (np.bincount(groups, weights=single)[groups] > 0))
        starts: dict[int, np.ndarray] = {}
        if len(several):
            leads = np.array([rows[i][1] for i in several], dtype=np.int64)
            found = repeated(groups[several], leads, [rows[i][2] for i in several], length)
            starts = dict(zip(several.tolist(), found))
        names, covered = [], []
        for i, row in enumerate(rows):
            own = np.arange(len(row[2]) - length + 1) if held[row] > 1 else starts.get(i, ())
            if len(own):
                names.append(name_of(*row))
                covered.append(runs(own, length).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(covered, pa.binary())], ["name", "covered"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, bytes], int] = {}
        size, last = 0, None
        for batch in batches:
            for key, lead, data, n in zip(*(x.to_pylist() for x in batch.columns)):
                if key != last and size >= SORT_BYTES:
                    yield judge(held)
                    held, size = {}, 0
                last = key
                own = (key, lead, data)
                size += 0 if own in held else len(data)
                held[own] = held.get(own, 0) + n
        if held:
            yield judge(held)

    return run


def _placed(length: int, gram: int, test):
    """Where each context stands: id, hash of the text, context's name, place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 4 * CHUNK_BYTES):
            ids, hashes = (pa.concat_arrays(part.column(c).chunks) for c in ("id", "t"))
            for at in range(0, part.num_rows, 500):
                rows, names, places = [], [], []
                for d, place, key, lead, data in dealt(binary_values(part.column("text").slice(at, 500)), length, gram, test.value):
                    rows.append(at + d)
                    names.append(name_of(key, lead, data))
                    places.append(place)
                own = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(own), hashes.take(own), pa.array(names, pa.binary()), pa.array(places, pa.int32())],
                    ["id", "t", "name", "place"],
                )

    return run


def cut(data: bytes, places: list[int], covered: list[bytes]) -> tuple[bytes, int, int, str | None]:
    """(what is left, bytes removed, runs removed, the whole characters of what is left or None if nothing is removed).

    Each stretch is decoded for itself, so the remains of characters cut at its borders go and nothing else.
    """
    if not places:
        return data, 0, 0, None
    pairs = np.concatenate([np.frombuffer(some, dtype=np.int32).reshape(-1, 2) + place for place, some in zip(places, covered)])
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    ends = np.maximum.accumulate(pairs[:, 1])
    heads = np.append(0, np.flatnonzero(pairs[1:, 0] > ends[:-1]) + 1)
    first, end = pairs[heads, 0].tolist(), ends[np.append(heads[1:], len(ends)) - 1].tolist()
    stretches = [data[a:b] for a, b in zip([0, *end], [*first, len(data)])]
    kept = b"".join(stretches)
    return kept, len(data) - len(kept), len(first), "".join([x.decode("utf-8", "ignore") for x in stretches])


def repeat_filter(source: DataFrame, length: int, gram: int) -> Filter:
    """Bitmap of the q-grams that occur twice or more, and the list of those with very many contexts."""
    counted = source.select("text").mapInArrow(_grams(length, gram), "gram long, n long")
    twice = materialize(counted.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1"), "grams")
    n, total = twice.agg(F.count(F.lit(1)), F.sum("n")).first()
    bits = min(MOST_BITS, max(10, (16 * n).bit_length()))
    mask = (1 << bits) - 1
    at = F.explode(F.array(F.col("gram").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("gram", 32).bitwiseAND(F.lit(mask))))
    bit = F.expr("shiftleft(1L, cast(at & 63 as int))")
    words = twice.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    found = words.toArrow()  # 2 ** bits / 64 rows at most
    table = np.zeros(max(1, (1 << bits) >> 6), dtype=np.uint64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    limit = max(HOT, (total or 0) // HOT_SHARE)
    hot = [x["gram"] for x in twice.where(F.col("n") > limit).collect()]  # HOT_SHARE at most
    return Filter(table, bits, np.array(hot, dtype=np.int64).view(np.uint64))


def without_repeats(
    docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", length: int = LENGTH, gram: int = GRAM
) -> DataFrame:
    """Per document: ``row`` (struct of all its columns), ``kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_text`` (null if nothing is removed)."""
    spark = docs.sparkSession
    source = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_name).alias("id"), text_of(text_name).alias("text")
    ).withColumn("t", F.xxhash64("text"))
    test = spark.sparkContext.broadcast(repeat_filter(source, length, gram))
    sent = source.select("text").mapInArrow(_sent(length, gram, test), "key long, lead int, data binary, n long")
    verdicts = (
        sent.repartition(partitions(spark), "key").sortWithinPartitions("key")
        .mapInArrow(_judged(length), "name binary, covered binary")
    )
    verdicts = materialize(verdicts, "verdicts")
    id_type = source.schema["id"].dataType.simpleString()
    placed = source.select("id", "t", "text").mapInArrow(_placed(length, gram, test), f"id {id_type}, t long, name binary, place int")
    spans = placed.join(verdicts.hint("merge"), "name").groupBy("id", "t").agg(
        F.collect_list(F.struct("place", "covered")).alias("spans")
    )
    spans = materialize(spans.select(F.col("id").alias("si"), F.col("t").alias("st"), "spans"), "spans")
    same = F.col("id").eqNullSafe(F.col("si")) & (F.col("t") == F.col("st"))
    # Always shuffled: the spans grow with the texts.
    joined = source.join(spans.hint("merge"), same, "left").select(
        "row", "text", F.col("spans.place").alias("places"), F.col("spans.covered").alias("covered")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = binary_values(part.column(1))
                done = [cut(x, p or [], c or []) for x, p, c in zip(texts, part.column(2).to_pylist(), part.column(3).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array([x[0] for x in done], pa.binary()),
                        pa.array([len(x) for x in texts], pa.int64()), pa.array([x[1] for x in done], pa.int64()),
                        pa.array([x[2] for x in done], pa.int64()), pa.array([x[3] for x in done], pa.string()),
                    ],
                    ["row", "kept", "n_bytes", "n_removed", "n_spans", "kept_text"],
                )

    kind = (
        T.StructType().add("row", joined.schema["row"].dataType).add("kept", "binary").add("n_bytes", "long")
        .add("n_removed", "long").add("n_spans", "long").add("kept_text", "string")
    )
    return joined.mapInArrow(run, kind)
