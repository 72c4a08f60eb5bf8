"""Near-duplicate classes: consistent weighted sampling over TF-IDF shingles.

A text is the weighted set of its word 5-grams, weight = count x (1 + IDF_SHARE x idf), where
idf = ln(1 + N / df) / ln(1 + N). The weight is tempered so that a common shingle still has
two thirds of a rare one's: the shingles of a text with thousands of near copies are common
for just that reason, and the copies' own changes must not outweigh them. Document
frequencies are exact, one count for each 64-bit hash of a shingle. Texts lie in chunks of some
megabytes; a chunk sends its distinct hashes once, sorted and cut into ranges of hash, as
one array for each range, of differences that compress. A range meets the arrays of all chunks, adds up their counts, and
gives every chunk back the hashes that more than one text has, with their frequency; all
others are 1. The number of ranges grows with the text, so a range holds about
``RANGE_HASHES`` hashes, and a shingle of any number of texts is there once for each chunk.

Improved consistent weighted sampling (gamma variates r and c, uniform beta for each
shingle and function, drawn from its hash) gives ``BANDS * ROWS`` samples that two texts
share with probability equal to their weighted Jaccard similarity. Texts that agree in
all samples of a band meet in a bucket. Candidates are verified by the exact weighted
Jaccard similarity of their whole texts; ``THRESHOLD`` or more is a link. Linked texts
are one class, named by its smallest id.

Equal word sequences are one node, so copies are never compared. In a bucket of n nodes
no task gets the group and not all pairs are made: each round compares the members with
one member (the centre), and buckets whose members are all in one class are done. Later
rounds take other centres, so members that are unlike the first but linked to another
are found. As soon as the pairs of members in different classes are at most ``PAIRS`` times
the nodes, by counts, or after ``TURNS`` rounds, all that may still be links (by the triangle
inequality over distances from the first centre) are compared, so none is left untested.

What two texts share is at most the lesser of their shared weights, the weight of a text's shingles that
any other text has. Where that is too little for a link, the pair is an exact non-link and is not made; a
text whose own shingles alone outweigh a link is in no bucket. So the members of a large group of near copies
that are like none of its texts are settled without a comparison.

Defined cases: a null text is empty; a text without words is a class of its own. A text
of fewer than five words is one shingle. A null id sorts after all others. Rows equal in
id and text get equal results. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.llm.common import chunks, col, few_bytes, hinted, text_of, words
from pagesift.llm.components import components
from pagesift.session import materialize, new_path

SHINGLE = 5
THRESHOLD = 0.8
IDF_SHARE = 0.5
#: A pair at the threshold shares no band with probability (1 - 0.8 ** 3) ** 13 < 0.0001.
BANDS, ROWS = 13, 3
#: Texts of a chunk; hashes that a range holds; bytes of texts that a worker is sent at once.
TEXT_CHUNK = 4 << 20
RANGE_HASHES = 1 << 20
BATCH_BYTES = 8 << 20
TURNS = 8
PAIRS = 4
CHUNK_BYTES = 1 << 20
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * B
    x ^= x >> np.uint64(32)
    x *= A
    return x ^ (x >> np.uint64(29))


def shingles(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds of each text, its distinct shingles' hashes, their counts)."""
    starts, numbers, distinct = words(pc.ascii_lower(texts))
    names = distinct.to_pylist()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(x) if x else 0 for x in names), np.uint64, len(names))
    word = hashes[numbers] if len(names) else np.zeros(0, np.uint64)
    real = word != 0  # empty words at the ends of a text
    starts = np.concatenate([[0], np.cumsum(real)])[starts]
    word = word[real]
    n_words = np.diff(starts)
    doc = np.repeat(np.arange(len(n_words)), n_words)
    left = np.repeat(starts[1:], n_words) - np.arange(len(word))  # words from here to the end
    value = np.zeros(len(word), dtype=np.uint64)
    for k in range(size):
        ahead = np.zeros_like(word)
        ahead[: max(0, len(word) - k)] = word[k:]
        value = value * A + np.where(left > k, ahead, np.uint64(k + 1))
        value ^= value >> np.uint64(31)
    first = np.arange(len(word)) == np.repeat(starts[:-1], n_words)
    keep = (left >= size) | (first & (left < size))
    doc, value = doc[keep], mixed(value[keep])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    heads = np.flatnonzero(fresh)
    counts = np.diff(np.append(heads, len(doc)))
    doc, value = doc[heads], value[heads]
    return np.searchsorted(doc, np.arange(len(n_words) + 1)), value, counts


def part_texts(part: pa.Table, name: str = "text") -> pa.Array:
    return pa.concat_arrays(part.column(name).chunks)


def in_chunks(texts: DataFrame, most_bytes: int) -> DataFrame:
    """``texts`` (v, n, text) with ``chunk``, the same number for some megabytes of texts that lie together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        for i, part in enumerate(chunks(batches, most_bytes)):
            yield from part.append_column("chunk", pa.array(np.full(part.num_rows, first + i))).to_batches()

    return texts.select("v", "n", "text").mapInArrow(run, "v long, n long, text string, chunk long")


def range_of(value: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash; it rises with the hash."""
    return ((value >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def differences(value: np.ndarray) -> bytes:
    """Rising hashes as their differences, the same byte of all beside each other.

    Of a chunk's hashes the upper bytes of the differences are zero, which compresses; of the hashes none does.
    """
    return np.diff(value, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_differences(column: pa.ChunkedArray) -> np.ndarray:
    """The hashes of all rows of ``differences``."""
    data = [np.frombuffer(x, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel().cumsum(dtype=np.uint64) for x in column.to_pylist() if x]
    return np.concatenate(data) if data else np.zeros(0, np.uint64)


def _counted(ranges: int, most_bytes: int):
    """The distinct shingles of a chunk, one row for each range: hashes and the number of documents that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, most_bytes):
            of_row = part.column("chunk").to_numpy()
            for chunk in np.unique(of_row).tolist():
                some = part.filter(pa.array(of_row == chunk))
                bounds, value, _ = shingles(part_texts(some))
                n = np.repeat(some.column("n").to_numpy(), np.diff(bounds))
                order = np.argsort(value)
                value, n = value[order], n[order]
                heads = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]])) if len(value) else np.zeros(0, np.int64)
                value, n = value[heads], np.add.reduceat(n, heads) if len(heads) else n
                cuts = np.searchsorted(range_of(value, ranges), np.arange(ranges + 1, dtype=np.uint64))
                there = np.flatnonzero(np.diff(cuts))
                numbers = n.astype(np.uint32).tobytes()
                lows, highs = cuts[there].tolist(), cuts[there + 1].tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array(there, pa.int64()), pa.array(np.full(len(there), chunk), pa.int64()),
                    pa.array([differences(value[a:b]) for a, b in zip(lows, highs)], pa.binary()),
                    pa.array([numbers[4 * a : 4 * b] for a, b in zip(lows, highs)], pa.binary()),
                ], ["range", "chunk", "gs", "n"])

    return run


def _numbers(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x or b"" for x in column.to_pylist()), kind)


def _repeated(table: pa.Table) -> pa.Table:
    """What of a range each chunk has that more than one document has."""
    gs, n = from_differences(table.column("gs")), _numbers(table.column("n"), np.uint32)
    _, which = np.unique(gs, return_inverse=True)
    df = np.bincount(which, weights=n).astype(np.uint32)[which]
    ends = np.cumsum([len(x) // 8 for x in table.column("gs").to_pylist()])
    found: dict[str, list] = {"chunk": [], "gs": [], "dfs": []}
    for chunk, low, high in zip(table.column("chunk").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
        keep = df[low:high] > 1
        if keep.any():
            found["chunk"].append(chunk)
            found["gs"].append(differences(gs[low:high][keep]))
            found["dfs"].append(df[low:high][keep].tobytes())
    kinds = {"chunk": pa.int64(), "gs": pa.binary(), "dfs": pa.binary()}
    return pa.table({c: pa.array(x, kinds[c]) for c, x in found.items()})


def frequencies(texts: DataFrame, n_bytes: int, chunk_bytes: int, range_hashes: int) -> DataFrame:
    """Frequencies above 1 of the shingles of each chunk of ``texts``: chunk, gs and dfs, in several rows."""
    ranges = max(1, -(-n_bytes // (6 * range_hashes)))  # a word and its blank have some six bytes
    sent = texts.mapInArrow(_counted(ranges, chunk_bytes), "range long, chunk long, gs binary, n binary")
    return sent.groupBy("range").applyInArrow(_repeated, "chunk long, gs binary, dfs binary")


def listed(lists: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a chunk that are repeated, in order, and their frequencies."""
    known, at = np.unique(from_differences(lists.column("gs")), return_index=True)
    return known, _numbers(lists.column("dfs"), np.uint32)[at].astype(np.float64)


def looked_up(value: np.ndarray, known: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Document frequencies of hashes, 1 for those that are not known."""
    if not len(known):
        return np.ones(len(value))
    place = np.minimum(np.searchsorted(known, value), len(known) - 1)
    return np.where(known[place] == value, numbers[place], 1.0)


def weighted(counts: np.ndarray, df: np.ndarray, total: int) -> np.ndarray:
    return counts * (1 + IDF_SHARE * np.log1p(total / df) / np.log1p(max(total, 1)))


def _members(rows: pa.Table, lists: pa.Table) -> pa.Table:
    """The shingles of each text as arrays: hashes ``gs`` in order, document frequencies ``dfs``, counts ``ns``."""
    known, numbers = listed(lists)
    out = [pa.table([pa.array([], t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary())], ["v", "gs", "dfs", "ns"])]
    for part in chunks(iter(rows.to_batches()), CHUNK_BYTES):
        bounds, value, counts = shingles(part_texts(part))
        data = [value, looked_up(value, known, numbers).astype(np.uint32), counts.astype(np.uint32)]
        cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
        columns = [pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for x in data]
        out.append(pa.table([part_texts(part, "v"), *columns], ["v", "gs", "dfs", "ns"]))
    return pa.concat_tables(out)


def with_frequencies(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """The shingles of ``texts`` (chunk, v, text) with their frequencies, as arrays: v, gs, dfs, ns."""
    some = texts.select("chunk", "v", "text").groupBy("chunk").cogroup(lists.groupBy("chunk"))
    return some.applyInArrow(_members, "v long, gs binary, dfs binary, ns binary")


def variates() -> tuple[np.ndarray, np.ndarray]:
    """Quantiles of the gamma (2, 1) distribution and their logarithms, for 16 bits of hash.

    The distribution function is 1 - (1 + x) exp(-x); Newton's method inverts it.
    """
    p = (np.arange(65_536) + 0.5) / 65_536
    x = np.where(p < 0.5, np.sqrt(2 * p), -np.log(1 - p) + 1)
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - p) / np.maximum(x * np.exp(-x), 1e-300), 1e-9)
    return x.astype(np.float32), np.log(x).astype(np.float32)


GAMMA, LOG_GAMMA = variates()


def samples(value: np.ndarray, weight: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """``n`` samples of each non-empty text, as 64-bit numbers."""
    log_weight = np.log(weight).astype(np.float32)
    sizes = np.diff(bounds)
    out = np.zeros((len(sizes), n), dtype=np.uint64)
    for k in range(n):
        z = mixed(value + np.uint64((k + 1) * int(B) % 2**64))
        r = GAMMA[(z >> np.uint64(48)).astype(np.int64)]
        log_c = LOG_GAMMA[((z >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64)]
        beta = (z & np.uint64(0xFFFFFFFF)).astype(np.float32) * np.float32(2.0**-32)
        t = np.floor(log_weight / r + beta)
        log_a = log_c - r * (t - beta) - r
        least = np.minimum.reduceat(log_a, bounds[:-1])
        hits = np.flatnonzero(log_a == np.repeat(least, sizes))
        at = hits[np.searchsorted(hits, bounds[:-1])]
        out[:, k] = mixed(value[at] + t[at].astype(np.int64).view(np.uint64) * A)
    return out


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each text's words, null if it has none."""
    for part in chunks(batches, CHUNK_BYTES):
        bare = [b" ".join((x or b"").split()) for x in pc.ascii_lower(part_texts(part)).cast(pa.binary()).to_pylist()]
        digest = [xxhash.xxh3_128_digest(x) if x else None for x in bare]
        yield pa.RecordBatch.from_arrays([part_texts(part, "id"), part_texts(part, "t"), pa.array(digest, pa.binary())], ["id", "t", "key"])


SIGNED = ("v", "total", "shared", "bands")


def _signed(total: int, bands: int, rows: int):
    """Total weight, weight of the shingles that other nodes have, too, and band keys of each node."""

    def run(texts: pa.Table, lists: pa.Table) -> pa.Table:
        known, numbers = listed(lists)
        out = [pa.table([pa.array([], t) for t in (pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()))], SIGNED)]
        for part in chunks(iter(texts.to_batches()), CHUNK_BYTES):
            bounds, value, counts = shingles(part_texts(part))
            df = looked_up(value, known, numbers)
            weight = weighted(counts, df, total)
            sums = np.add.reduceat(weight, bounds[:-1])  # a node has a shingle at least
            # The copies of a node are one text, however many documents they are.
            own = df <= np.repeat(part.column("n").to_numpy(), np.diff(bounds))
            shared = np.add.reduceat(np.where(own, 0.0, weight), bounds[:-1])
            found = samples(value, weight, bounds, bands * rows).reshape(len(sums), bands, rows)
            keys = np.zeros((len(sums), bands), dtype=np.uint64)
            for k in range(rows):
                keys = mixed(keys * A + found[:, :, k])
            keys = mixed(keys + np.arange(1, bands + 1, dtype=np.uint64) * B)
            flat = pa.array(keys.view(np.int64).ravel())
            cuts = pa.array(np.arange(len(sums) + 1) * bands, pa.int32())
            out.append(pa.table([part_texts(part, "v"), pa.array(sums), pa.array(shared), pa.ListArray.from_arrays(cuts, flat)], SIGNED))
        return pa.concat_tables(out)

    return run


def _similar(total: int):
    """Weighted Jaccard similarity of the two texts of each row, from their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, 4 * CHUNK_BYTES):
            n = part.num_rows
            pairs, values, of_side = [], [], []
            for side in ("x", "y"):
                gs, dfs, ns = (part.column(f"{side}_{c}").to_pylist() for c in ("gs", "dfs", "ns"))
                pairs.append(np.repeat(np.arange(n), [len(x) // 8 for x in gs]))
                values.append(np.frombuffer(b"".join(gs), np.uint64))
                df, counts = (np.frombuffer(b"".join(x), np.uint32).astype(np.float64) for x in (dfs, ns))
                of_side.append(weighted(counts, df, total))
            pair, value, weight = (np.concatenate(x) for x in (pairs, values, of_side))
            order = np.lexsort((value, pair))
            pair, value, weight = pair[order], value[order], weight[order]
            same = np.flatnonzero((pair[1:] == pair[:-1]) & (value[1:] == value[:-1]))
            shared = np.bincount(pair[same], weights=np.minimum(weight[same], weight[same + 1]), minlength=n)
            union = np.bincount(pair, weights=weight, minlength=n) - shared
            yield pa.RecordBatch.from_arrays(
                [*(part_texts(part, c) for c in ("a", "b", "la", "lb")), pa.array(shared / np.maximum(union, 1e-300))],
                ["a", "b", "la", "lb", "similarity"],
            )

    return run


def written(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def verified(pairs: DataFrame, texts: DataFrame, total: int) -> DataFrame:
    """``pairs`` (a, b, la, lb) with their similarity. Shingles are sent for these pairs only."""
    def side(name: str) -> list[Column]:
        return [F.col(c).alias(f"{name}_{c}") for c in ("gs", "dfs", "ns")]

    small = hinted(pairs, F.lit(64))
    left = texts.join(small, F.col("v") == F.col("a")).select("a", "b", "la", "lb", *side("x"))
    right = texts.join(small, F.col("v") == F.col("b")).select("a", "b", *side("y"))
    both = left.join(right.hint("merge"), ["a", "b"])
    return both.mapInArrow(_similar(total), "a long, b long, la long, lb long, similarity double")


def linked_labels(buckets: DataFrame, texts: DataFrame, total: int, threshold: float, turns: int) -> DataFrame:
    """(v, label) of all nodes in ``buckets`` (k, v, total, shared, met): nodes joined by links have one label.

    ``texts`` holds the shingles of the nodes.
    """
    labels = materialize(buckets.select("v").distinct().select("v", F.col("v").alias("label")), "node-labels")
    nodes, still_open, tested = labels.count(), buckets, None
    for turn in range(turns + 1):
        members = still_open.join(labels.hint("merge"), "v")
        # First the member that meets the most others in its buckets: of the copies of a text that is likely the text
        # itself, to which all of them are linked. Then a different one in each bucket.
        order = F.xxhash64("v", "k", F.lit(turn)) if turn else F.struct(-F.col("met"), F.xxhash64("v"))
        groups = members.groupBy("k").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n"),
            F.min(F.struct(order.alias("o"), "v", "label", "total", "shared")).alias("c"),
        ).where("low <> high")
        groups = materialize(groups, "open-buckets")
        if groups.isEmpty():
            break
        centres = groups.select("k", F.col("c.v").alias("w"), F.col("c.label").alias("lw"), F.col("c.total").alias("tw"), F.col("c.shared").alias("sw"))
        members = materialize(members.join(centres.hint("merge"), "k"), "bucket-members")
        last = turn == turns
        if turn and not last:
            # Pairs of different labels, counted without making them.
            of_label = members.groupBy("k", "label").agg(F.count(F.lit(1)).alias("n"))
            of_bucket = of_label.groupBy("k").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("open"))
            last = (of_bucket.agg(F.sum("open")).first()[0] or 0) <= PAIRS * nodes
        if turn and last:
            # The distance 1 - similarity is a metric. What differs more in its distance from the first centre
            # than a link allows cannot be linked; that settles the members that are unlike the rest.
            # A pair is made once, in the least of the buckets that both are in: while the labels differ, all of them are open.
            first = labels.select(F.col("v").alias("first"), F.col("label").alias("first_label"))
            met_in = members.groupBy("v").agg(F.collect_set("k").alias("ks"))
            known = materialize(members.join(met_in.hint("merge"), "v").join(first.hint("merge"), "first"), "last-members")
            other = known.select(
                "k", F.col("v").alias("w"), F.col("label").alias("lw"), F.col("total").alias("tw"), F.col("shared").alias("sw"),
                F.col("near").alias("near_w"), F.col("ks").alias("ks_w"),
            )
            rest = known.where(F.col("label") != F.col("first_label")).drop("w", "lw", "tw", "sw", "first")
            possible = rest.join(other.hint("merge"), "k").where(
                (F.col("label") != F.col("lw")) & ((F.col("lw") == F.col("first_label")) | (F.col("v") < F.col("w")))
                & (F.coalesce(F.abs(F.col("near") - F.col("near_w")), F.lit(0.0)) <= 1 - threshold + 1e-6)
                & (F.col("k") == F.array_min(F.array_intersect("ks", "ks_w")))
            )
            pairs = _pairs(possible, tested, threshold)
        else:
            pairs = _pairs(members.where(F.col("label") != F.col("lw")), tested, threshold)
        found = materialize(verified(materialize(pairs, "pairs"), texts, total), "verified")
        fresh = found.select("a", "b")
        tested = fresh if tested is None else tested.union(fresh)
        links = found.where(F.col("similarity") >= threshold).select(F.col("la").alias("a"), F.col("lb").alias("b"))
        if not links.isEmpty():
            moved = components(links).select(F.col("v").alias("label"), "p")
            labels = materialize(
                labels.join(moved.hint("merge"), "label", "left").select("v", F.coalesce("p", "label").alias("label")), "node-labels"
            )
        if last:
            break
        if turn == 0:
            both = found.select("a", "b", F.col("similarity").alias("near"))
            known = members.withColumns({"a": F.least("v", "w"), "b": F.greatest("v", "w")}).join(both.hint("merge"), ["a", "b"], "left")
            known = known.withColumn("near", F.when(F.col("v") == F.col("w"), 1.0).otherwise(F.col("near")))
            still_open = materialize(known.select("k", "v", "total", "shared", "met", "near", F.col("w").alias("first")), "bucket-distances")
        else:
            still_open = members.select("k", "v", "total", "shared", "met", "near", "first")
    return labels


def _pairs(joined: DataFrame, tested: DataFrame | None, threshold: float) -> DataFrame:
    """Distinct pairs (a, b) with their labels that have not been compared and whose weights allow a link."""
    swap = F.col("v") > F.col("w")
    most = F.least("shared", "sw")  # of the weight that both have
    pairs = joined.where(most >= (threshold - 1e-6) * (F.col("total") + F.col("tw") - most)).select(
        F.least("v", "w").alias("a"), F.greatest("v", "w").alias("b"),
        F.when(swap, F.col("lw")).otherwise(F.col("label")).alias("la"),
        F.when(swap, F.col("label")).otherwise(F.col("lw")).alias("lb"),
    ).distinct()
    return pairs if tested is None else pairs.join(tested.hint("merge"), ["a", "b"], "left_anti")


def _unique(keyed: DataFrame) -> bool:
    """Whether no two rows are equal in id and text."""
    return keyed.groupBy("id", "t").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()


def near_classes(
    docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", threshold: float = THRESHOLD, bands: int = BANDS,
    rows: int = ROWS, turns: int = TURNS,
) -> DataFrame:
    """Per document: id, ``class_id`` (smallest id of its class), ``class_size``, ``kept``, and ``t``, its text's hash."""
    spark = docs.sparkSession
    source = docs.select(col(id_name).alias("id"), text_of(text_name).alias("text")).withColumn("t", F.xxhash64("text"))
    id_type = source.schema["id"].dataType.simpleString()
    total = source.count()
    keyed = written(source.mapInArrow(_keyed, f"id {id_type}, t long, key binary"), "keys")
    # Null ids sort last: a node's name is the smallest id that it has.
    nodes = keyed.where("key is not null").groupBy("key").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("r"), F.count(F.lit(1)).alias("n"),
    )
    nodes = written(nodes.select("key", "r.id", "r.t", "n", F.monotonically_increasing_id().alias("v")), "nodes")
    wanted = nodes.select("v", "n", F.col("id").alias("ni"), F.col("t").alias("nt"))
    same = F.col("id").eqNullSafe(F.col("ni")) & (F.col("t") == F.col("nt"))
    with few_bytes(spark, BATCH_BYTES):
        # Rows equal in id and text are several rows of one node.
        texts = source.join(hinted(wanted, F.lit(64)), same).select("v", "n", "text")
        texts = texts if _unique(keyed) else texts.dropDuplicates(["v"])
        texts = written(in_chunks(texts, TEXT_CHUNK), "node-texts")
        n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        lists = written(frequencies(texts, n_bytes, TEXT_CHUNK, RANGE_HASHES), "shingle-frequencies")
        both = texts.select("chunk", "v", "n", "text").groupBy("chunk").cogroup(lists.groupBy("chunk"))
        signed = written(both.applyInArrow(_signed(total, bands, rows), "v long, total double, shared double, bands array<long>"), "signatures")
        linkable = signed.where(F.col("shared") >= (threshold - 1e-6) * F.col("total"))
        spread = linkable.select("v", "total", "shared", F.explode("bands").alias("k"))
        shared = spread.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        met = materialize(spread.join(shared.hint("merge"), "k"), "bucket-sizes")
        degrees = met.groupBy("v").agg(F.sum("n").alias("met"))
        buckets = materialize(met.drop("n").join(degrees.hint("merge"), "v"), "buckets")
        members = materialize(buckets.select("v").distinct(), "wanted")
        texts = written(with_frequencies(texts.join(hinted(members, F.lit(64)), "v"), lists), "member-texts")
    labels = linked_labels(buckets, texts, total, threshold, turns)

    named = nodes.select("key", "v", "id", "n").join(labels, "v", "left").withColumn("label", F.coalesce("label", "v"))
    named = materialize(named, "named")
    classes = named.groupBy("label").agg(F.min("id").alias("class_id"), F.sum("n").alias("class_size"))
    verdict = named.select("key", "label").join(classes, "label").select("key", "class_id", "class_size")
    with_words = keyed.where("key is not null").join(verdict.hint("merge"), "key").select(
        "id", "t", "class_id", "class_size", F.col("id").eqNullSafe(F.col("class_id")).alias("kept")
    )
    without = keyed.where("key is null").select(
        "id", "t", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("class_size"), F.lit(True).alias("kept")
    )
    return with_words.unionByName(without).withColumnRenamed("id", id_name)
