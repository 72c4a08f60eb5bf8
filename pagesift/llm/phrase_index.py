"""Benchmark decontamination over a distributed positional inverted index.

Texts are cut into lower-case words. ``index`` writes the positions of every word of all texts:
the index lies in shards of documents, and a shard holds its words, the number of postings of each, and their
positions, ordered by word. Documents of a shard are kept ``GAP`` positions apart, so no match spans two.

``matches`` looks up the windows of the benchmark, ``window`` consecutive words of an item or all
words of a shorter one. For each window and shard the words are taken from the rarest, by
their number of postings there, to the most frequent. The positions of the rarest, less its offset in the
window, are the first candidates; each further word intersects them with its own positions less its
offset. What is left after all words are the exact occurrences. With ``slack`` every word may
stand up to so many places from where a phrase that starts at a place has it: all such places are
found, and those that are not exact are proximity matches. A window with a word that the shard lacks
ends at once.

The benchmark is a query set against all shards. It is packed into parts of bounded size, and each
shard meets each part: by a broadcast of all parts if their measured size allows it, else by a shuffle on (shard,
part). Nothing is capped: a shard is bounded by the bytes of its texts, or holds one longer text alone. Shards are
small, and few of them are written, read or sent to a worker at once, so a task's memory does not grow with its input.
Spans and items of one document are combined by (shard, place of the document), which no hot word
and no item can make large beyond the document's own words.

Defined cases: words are runs of digits, letters A-Z (as lower case) and any character beyond ASCII. A null or empty
text has no words and gives a row with zeros. Null ids of documents stay; a null id of an item is the
empty string, and rows of one id are one item. Items without words take no part. Equal rows are
documents of their own, with the same result. An empty benchmark hits nothing; an empty table gives no
rows. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from pagesift.llm.common import BROADCAST_BYTES, chunks, col, few_bytes, few_rows, text_of
from pagesift.session import materialize

WINDOW = 10
#: The postings of such a shard stay below half a MB, so the JVM's heap is not broken up by arrays that span its regions.
SHARD_BYTES = 1 << 18
#: Bytes of texts or shards that are sent to a Python worker at once.
BATCH_BYTES = 2 << 20
#: Shards of a row group, which is written and read as a whole, and those that a scan holds at once.
GROUP_SHARDS = 16
READ_SHARDS = 4
PART_BYTES = 1 << 20
GAP = 1 << 10
#: Candidates that are intersected at once.
AT_ONCE = 1 << 20
NO_WORD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
SPANS = "array<struct<from:long,to:long>>"


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and all words."""
    texts = pa.concat_arrays([texts.cast(pa.large_string()).fill_null("")])
    _, offsets, data = texts.buffers()
    plain = (data.to_pybytes() if data else b"").translate(NO_WORD)
    texts = pa.LargeStringArray.from_buffers(len(texts), offsets, pa.py_buffer(plain), offset=texts.offset)
    split = pc.ascii_split_whitespace(texts)
    words, ends = pc.list_flatten(split), split.offsets.to_numpy()
    real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    ends = ends - ends[0]
    return before[ends[1:]] - before[ends[:-1]], words.filter(pa.array(real))


def _postings(shard_bytes: int, ids: pa.DataType):
    schema = pa.schema([
        ("ids", pa.list_(ids)), ("sizes", pa.list_(pa.int64())), ("words", pa.list_(pa.large_string())),
        ("counts", pa.binary()), ("positions", pa.binary()),
    ])

    def run(batches):
        for table in chunks(batches, shard_bytes):
            sizes, words = split_words(table.column("text").combine_chunks())
            coded = words.dictionary_encode()
            codes = coded.indices.to_numpy().astype(np.int64)
            places = np.arange(len(codes)) + np.repeat(np.arange(len(sizes)) * GAP, sizes)
            order = np.argsort(codes, kind="stable")
            counts = np.bincount(codes, minlength=len(coded.dictionary))
            lists = [
                table.column("id").combine_chunks(), pa.array(sizes, pa.int64()), coded.dictionary.cast(pa.large_string()),
            ]
            made = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            made += [pa.array([x.astype(np.uint32).tobytes()], pa.binary()) for x in (counts, places[order])]
            yield pa.RecordBatch.from_arrays([x.cast(t) for x, t in zip(made, schema.types)], schema=schema)

    return run


def index(docs: DataFrame, id_name: str = "doc_id", text_name: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The positional index: shard, ids and sizes (documents), words, counts and positions (postings by word); written once."""
    id_type = docs.schema[id_name].dataType
    rows = docs.select(col(id_name).alias("id"), text_of(text_name).alias("text"))
    schema = T.StructType([
        T.StructField("ids", T.ArrayType(id_type)), T.StructField("sizes", T.ArrayType(T.LongType())),
        T.StructField("words", T.ArrayType(T.StringType())), T.StructField("counts", T.BinaryType()),
        T.StructField("positions", T.BinaryType()),
    ])
    made = rows.mapInArrow(_postings(shard_bytes, to_arrow_type(id_type)), schema)
    with few_bytes(docs.sparkSession, BATCH_BYTES):
        made = made.withColumn("shard", F.monotonically_increasing_id())
        return materialize(made, "postings", **{"parquet.block.row.count.limit": str(GROUP_SHARDS)})


def _pack(window: int, part_bytes: int):
    """Items as rows of bounded size; a long item is cut into pieces that overlap by a window less one word."""

    def run(batches):
        held, size = [], 0
        schema = pa.schema([("items", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())), ("words", pa.list_(pa.string()))])

        def row():
            return pa.RecordBatch.from_pylist(
                [{"items": [x[0] for x in held], "sizes": [len(x[1]) for x in held], "words": [w for x in held for w in x[1]]}],
                schema=schema,
            )

        step = 4096
        for batch in batches:
            sizes, words = split_words(batch.column(1))
            ends = np.cumsum(sizes)
            for item, first, end in zip(batch.column(0).to_pylist(), (ends - sizes).tolist(), ends.tolist()):
                for at in range(first, max(first + 1, end - window + 1), step):
                    piece = words.slice(at, min(step + window - 1, end - at)).to_pylist()
                    if not piece:
                        continue
                    held.append((item, piece))
                    size += sum(map(len, piece)) + 8 * len(piece)
                    if size >= part_bytes:
                        yield row()
                        held, size = [], 0
        if held:
            yield row()

    return run


def packed_items(benchmark: DataFrame, window: int, part_bytes: int, item_name: str, text_name: str) -> DataFrame:
    """The benchmark in parts: part, items, sizes (words of each), words; written once."""
    rows = benchmark.select(text_of(item_name).alias("item"), text_of(text_name).alias("text"))
    schema = "items array<string>, sizes array<long>, words array<string>"
    made = materialize(rows.coalesce(8).mapInArrow(_pack(window, part_bytes), schema), "benchmark-parts")
    return materialize(made.withColumn("part", F.monotonically_increasing_id()), "benchmark-parts")


class Windows:
    """The windows of a part: words as numbers of its own vocabulary."""

    def __init__(self, items: list[str], sizes: list[int], words: pa.Array, window: int):
        coded = words.dictionary_encode()
        self.vocabulary, codes = coded.dictionary, coded.indices.to_numpy()
        self.items = np.array(items, dtype=object)
        sizes = np.array(sizes, dtype=np.int64)
        n = np.maximum(sizes - window + 1, 1)
        self.item = np.repeat(np.arange(len(sizes)), n)
        starts = np.repeat(np.cumsum(sizes) - sizes, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.length = np.minimum(sizes, window)[self.item]
        places = np.minimum(starts[:, None] + np.arange(window), len(codes) - 1)
        self.inside = np.arange(window)[None, :] < self.length[:, None]
        self.codes = np.where(self.inside, codes[places], 0)


def occurrences(windows: Windows, words: pa.Array, counts: np.ndarray, positions: np.ndarray, slack: int) -> tuple:
    """Window, start and exactness of all matches in a shard."""
    ends = np.cumsum(counts)
    # Postings as one ordered list of (word, position).
    keys = (np.repeat(np.arange(len(counts)), counts) << 36) | positions
    here = pc.index_in(windows.vocabulary, words.cast(windows.vocabulary.type)).fill_null(-1).to_numpy().astype(np.int64)
    codes = np.where(windows.inside, here[windows.codes], 0)
    able = np.flatnonzero((codes >= 0).all(axis=1))
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
    if not len(able):
        return out[0]
    codes, inside = codes[able], windows.inside[able]
    frequency = np.where(inside, counts[codes], np.iinfo(np.int64).max)
    by_rarity = np.argsort(frequency, axis=1, kind="stable")
    rarest = codes[np.arange(len(able)), by_rarity[:, 0]]
    lots = np.cumsum(counts[rarest] * (2 * slack + 1)) // AT_ONCE
    for lot in np.unique(lots).tolist():
        chosen = np.flatnonzero(lots == lot)
        n = counts[rarest[chosen]]
        which = np.repeat(chosen, n)
        at = np.repeat(ends[rarest[chosen]] - n, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = positions[at] - by_rarity[which, 0]
        near = np.arange(-slack, slack + 1)
        which, start = np.repeat(which, len(near)), (start[:, None] + near[None, :]).ravel()
        exact = np.tile(near == 0, len(at))
        ok = start >= -slack
        which, start, exact = which[ok], start[ok], exact[ok]
        for turn in range(1, by_rarity.shape[1]):
            if not len(which):
                break
            offset = by_rarity[which, turn]
            real = inside[which, offset]
            place = start + offset
            word = codes[which, offset] << 36
            least = word | np.maximum(place - slack, 0)
            first = keys[np.minimum(np.searchsorted(keys, least), len(keys) - 1)]
            found = ~real | ((first >= least) & (first <= (word | (place + slack))))
            if slack:
                there = np.minimum(np.searchsorted(keys, word | np.maximum(place, 0)), len(keys) - 1)
                exact &= ~real | (keys[there] == (word | place))
            which, start, exact = which[found], start[found], exact[found]
        out.append((able[which], start, exact))
    return tuple(np.concatenate(x) for x in zip(*out))


def _lookup(window: int, slack: int):
    def run(batches):
        known: dict[int, Windows] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                part = row["part"].as_py()
                if part not in known:
                    known = {part: Windows(row["items"].as_py(), row["item_sizes"].as_py(), row["item_words"].values, window)}
                asked = known[part]
                counts, positions = (np.frombuffer(row[c].as_py(), np.uint32).astype(np.int64) for c in ("counts", "positions"))
                which, start, exact = occurrences(asked, row["words"].values, counts, positions, slack)
                if not len(which):
                    continue
                sizes = np.array(row["sizes"].as_py(), dtype=np.int64)
                firsts = np.cumsum(sizes) - sizes + np.arange(len(sizes)) * GAP
                doc = np.searchsorted(firsts, np.maximum(start, 0), side="right") - 1
                # A proximity match may begin before the first word of its document.
                doc += (doc + 1 < len(firsts)) & (start >= (firsts + sizes)[doc] + GAP // 2)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(doc), row["shard"].as_py()), pa.int64()), pa.array(doc, pa.int64()),
                    pa.array(asked.items[asked.item[which]], pa.string()), pa.array(start - firsts[doc], pa.int64()),
                    pa.array(asked.length[which], pa.int64()), pa.array(exact, pa.bool_()),
                ], ["shard", "place", "item_id", "from", "length", "exact"])

    return run


def matches(
    postings: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = 0, item_name: str = "item_id",
    text_name: str = "text", part_bytes: int = PART_BYTES, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per match: shard and place of the document, item_id, from (its first word), length, exact."""
    if not 0 <= 2 * (slack + window) < GAP:
        raise ValueError("windows and slack must be shorter than the gap between documents")
    asked = packed_items(benchmark, window, part_bytes, item_name, text_name)
    asked = asked.withColumnRenamed("sizes", "item_sizes").withColumnRenamed("words", "item_words")
    size = F.sum(F.octet_length(F.array_join("item_words", " ")).cast("long") + F.lit(8) * F.size("item_words"))
    total, parts = asked.agg(size, F.collect_list("part")).first()
    listed = F.explode(F.array(*[F.lit(p) for p in parts])) if parts else F.explode(F.expr("cast(array() as array<long>)"))
    met = postings.withColumn("part", listed)
    if (total or 0) <= broadcast_bytes:
        pairs = met.join(F.broadcast(asked), "part")
    else:
        shards = postings.select("shard", F.lit(1).alias("one")).join(asked.select("part", F.lit(1).alias("one")), "one").drop("one")
        pairs = met.join(shards.join(asked, "part"), ["shard", "part"])
    schema = "shard long, place long, item_id string, `from` long, length long, exact boolean"
    return pairs.mapInArrow(_lookup(window, slack), schema)


def documents_of(postings: DataFrame) -> DataFrame:
    """shard, place, doc_id and n_words of every document of the index."""
    return postings.select("shard", F.posexplode(F.arrays_zip("ids", "sizes")).alias("place", "doc")).select(
        "shard", F.col("place").cast("long").alias("place"), F.col("doc.ids").alias("doc_id"), F.col("doc.sizes").alias("n_words")
    )


def merged(spans: Column) -> Column:
    """Number of places that spans cover."""
    start = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n"))

    def add(acc: Column, span: Column) -> Column:
        end = F.greatest(acc["end"], span["to"])
        return F.struct(end.alias("end"), (acc["n"] + end - F.greatest(acc["end"], F.least(span["from"], end))).alias("n"))

    return F.aggregate(F.array_sort(spans), start, add, lambda acc: acc["n"])


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **names) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (sorted), spans (of its hit words, by item)."""
    postings = index(docs, **names)
    hits = matches(postings, benchmark, window).where("exact")
    span = F.struct("from", (F.col("from") + F.col("length")).alias("to"))
    by_doc = hits.groupBy("shard", "place").agg(
        F.collect_set(span).alias("spans"), F.array_sort(F.collect_set("item_id")).alias("items")
    )
    with few_bytes(docs.sparkSession, BATCH_BYTES), few_rows(docs.sparkSession, READ_SHARDS):
        by_doc = materialize(by_doc, "phrase-hits")
    found = documents_of(postings).join(by_doc, ["shard", "place"], "left")
    spans = F.coalesce("spans", F.expr(f"cast(array() as {SPANS})"))
    return found.select(
        "doc_id", "n_words", merged(spans).alias("n_hit"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        spans.alias("spans"),
    )
