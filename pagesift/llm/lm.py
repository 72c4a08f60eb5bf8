"""Language-model scores from a hashed maximum-entropy model.

The probability of a token given those before it has two factors, P(class) x P(token in
class), both maximum-entropy models over hashed features of the history:

* Classes: the ``WORDS`` most frequent tokens lie in classes of ``WIDTH`` by rank; all
  others, known or not, in ``TAILS`` classes by the hash of their last letters. A softmax
  over all classes takes the weights of the features [w1], [w1 w2], [skip w2] and
  [class trigram], where w1 is the token before.
* Inside a class of frequent tokens a softmax over its tokens takes the features
  [class, w1] and [class, skip w2]. Inside the others a token has its smoothed share
  (c + 0.1) / (N_k + 0.1 (V_k + 1)), as the base model has over all tokens.

Training is distributed: in each round every task starts from the same weights, makes
gradient steps over its part of the training texts, and sends its change of the weights;
the changes of a row are averaged by how often each task has met its features. Each training text is
used in exactly one round. Tables have a fixed size; they are what is broadcast.

Texts are tokenised twice: to find the frequent tokens, and to count. The second time the
codes of each text's tokens are written, and all later passes read those.

Counts are exact and over all texts. The ``HEAD`` most frequent tokens have a place in a
vector that each task fills. Any other token is a row (hash, text) that is shuffled by
the hash once; such a token is rare, so no group is large, however large the vocabulary.

Defined cases: a null text is empty and has the end token only. A text with a null id
counts as training text. Rows equal in id and text get equal results. An empty table
gives an empty result; without training texts every token has c = 0. Other columns play
no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagesift.llm.common import chunks, col, partitions, text_of, words
from pagesift.session import new_path

HEAD = 65_536
WORDS = 1_024
WIDTH = 32
TAILS = 32
SUFFIX = 3
CLASS_ROWS = 1 << 14
WORD_ROWS = 1 << 13
ROUNDS = 2
#: A step is RATE x gradient / sqrt(FLOOR + sum of squared gradients so far).
RATE = 0.25
FLOOR = 1.0
#: Tokens of a gradient step, and of a step of scoring.
STEP = 4_096
SCORE_STEP = 512
#: Rows of weights, or of outcomes, that are worked on at once, so that they stay in a core's cache.
BLOCK = 512
#: Rows that a step meets more often than this are summed up one by one.
MANY = 24
CHUNK_BYTES = 1 << 20
#: Distinct tokens that a task holds while it looks for frequent ones.
HELD = 500_000
END = "\n"
CLASSES = WORDS // WIDTH + TAILS
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where each text's tokens start, a number per token, the distinct tokens; ``END`` ends each text."""
    starts, numbers, distinct = words(pc.ascii_lower(texts))
    kept, empty = starts, pc.index(distinct, "").as_py()
    if empty >= 0:  # it may stand at the ends of a text
        real = numbers != empty
        kept = np.concatenate([[0], np.cumsum(real)])[starts]
        numbers = numbers[real]
    numbers = np.insert(numbers, kept[1:], len(distinct))
    return kept + np.arange(len(kept)), numbers, pa.concat_arrays([distinct, pa.array([END], distinct.type)])


def texts_of(part: pa.Table) -> pa.Array:
    return pa.concat_arrays(part.column("text").chunks) if part.column("text").num_chunks else pa.array([], pa.string())


def held_out(id_name: str) -> Column:
    return F.coalesce(F.crc32(col(id_name).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def summed(words_of: pa.Array, n: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Each word once, in the order of their first places, with its sum."""
    coded = words_of.dictionary_encode()
    total = np.bincount(coded.indices.to_numpy(), weights=n, minlength=len(coded.dictionary))
    return coded.dictionary, total.astype(np.int64)


def frequent(train: DataFrame, most: int) -> list[str]:
    """About the most frequent tokens: each task names its own, their counts are summed."""

    def best(held: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
        top = np.argsort(-counts, kind="stable")[:most]
        return pa.RecordBatch.from_arrays([held.take(pa.array(top)).cast(pa.string()), pa.array(counts[top])], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = pa.array([], pa.large_string()), np.zeros(0, np.int64)
        held, counts = none
        for part in chunks(batches, 4 * CHUNK_BYTES):
            _, numbers, names = tokens(texts_of(part))
            n = np.bincount(numbers, minlength=len(names))
            used = np.flatnonzero(n)
            held, counts = pa.concat_arrays([held, names.take(pa.array(used))]), np.concatenate([counts, n[used]])
            if len(held) > HELD:
                held, counts = summed(held, counts)
            if len(held) > HELD:
                yield best(held, counts)
                held, counts = none
        yield best(*summed(held, counts))

    found = train.select("text").mapInArrow(run, "word string, n long").where(F.col("n") > 0)
    top = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most).collect()
    return [x["word"] for x in top]


class Lexicon:
    """What is known of a token from its text: hash, class, place in the class, place in the head."""

    def __init__(self, head: list[str]):
        names = [END] + [x for x in head if x != END]
        self.place = {x: i for i, x in enumerate(names)}
        self.names = pa.array(names, pa.large_string())

    def look_up(self, names: pa.Array, rare_only: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, place in the head or -1, class) of distinct tokens; with ``rare_only`` no hashes of the head."""
        places = pc.index_in(names, self.names).fill_null(-1).to_numpy().astype(np.int64)
        hashed = np.flatnonzero(places < 0) if rare_only else np.arange(len(names))
        listed = names.take(pa.array(hashed)).to_pylist()
        hashes = np.zeros(len(names), np.uint64)
        hashes[hashed] = np.fromiter(map(xxhash.xxh3_64_intdigest, listed), np.uint64, len(listed))
        endings = pc.utf8_slice_codeunits(names, -SUFFIX).dictionary_encode()
        of_ending = np.array([xxhash.xxh3_64_intdigest(x) % TAILS for x in endings.dictionary.to_pylist()], dtype=np.int64)
        tails = of_ending[endings.indices.to_numpy()] if len(names) else places
        plain = (places >= 0) & (places < WORDS)
        return hashes, places, np.where(plain, places // WIDTH, CLASSES - TAILS + tails)


def mixed(values: np.ndarray, rows: int) -> np.ndarray:
    """Rows of a table; ``values`` is overwritten."""
    values ^= values >> np.uint64(29)
    values *= MIX[1]
    values ^= values >> np.uint64(32)
    values *= MIX[3]
    values >>= np.uint64(64 - (rows.bit_length() - 1))
    return values.view(np.int64)


def features(hashes: np.ndarray, classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the class table (4 per token) and of the word table (2 per token)."""

    def back(values: np.ndarray, k: int) -> np.ndarray:
        out = np.ones_like(values)
        out[k:] = values[: len(values) - k]
        for inner in range(k):
            first = starts[:-1] + inner
            out[first[first < starts[1:]]] = 1
        return out

    w1, w2 = back(hashes, 1), back(hashes, 2)
    shifted = classes.astype(np.uint64) + np.uint64(2)
    trigram = back(shifted, 1)
    for k in (2, 3):
        trigram *= np.uint64(256)
        trigram += back(shifted, k)
    own = classes.astype(np.uint64) * MIX[2]
    one, skip = w1 * MIX[0], w2 * MIX[2]
    for_word = [one ^ own, skip ^ (own + MIX[3])]
    w1 *= MIX[2]
    w2 *= MIX[0]
    w2 += MIX[1]
    w1 ^= w2
    skip += MIX[0]
    trigram *= MIX[1]
    trigram += MIX[2]
    return (
        np.stack([mixed(x, CLASS_ROWS) for x in (one, w1, skip, trigram)]).T,
        np.stack([mixed(x, WORD_ROWS) for x in for_word]).T,
    )


class Weights:
    """The two tables and the log shares of classes and tokens that they start from."""

    def __init__(self, class_bias: np.ndarray, word_bias: np.ndarray):
        self.class_bias, self.word_bias = class_bias.astype(np.float32), word_bias.astype(np.float32)
        self.tables = [np.zeros((CLASS_ROWS, CLASSES), np.float32), np.zeros((WORD_ROWS, WIDTH), np.float32)]

    def logits(self, rows: np.ndarray, bias: np.ndarray, which: int) -> np.ndarray:
        table = self.tables[which]
        out = table.take(rows[:, 0], axis=0)
        for k in range(1, rows.shape[1]):
            out += table.take(rows[:, k], axis=0)
        out += bias
        # Rows are short, so their maxima are found faster half against half, then down the columns of a turned copy.
        top = out
        while top.shape[1] > 16:
            half = top.shape[1] // 2
            top = np.maximum(top[:, :half], top[:, -half:])
        out -= np.ascontiguousarray(top.T).max(axis=0)[:, None]
        return out

    def factors(self, rows: np.ndarray, bias: np.ndarray, which: int) -> np.ndarray:
        """Probabilities of all outcomes of one factor."""
        found = np.empty((len(rows), self.tables[which].shape[1]), np.float32)
        for at in range(0, len(rows), BLOCK):
            cut = slice(at, at + BLOCK)
            out = self.logits(rows[cut], bias[cut] if bias.ndim == 2 else bias, which)
            np.exp(out, out=out)
            np.divide(out, out.sum(axis=1, keepdims=True), out=found[cut])
        return found

    def log_factor(self, rows: np.ndarray, bias: np.ndarray, which: int, target: np.ndarray) -> np.ndarray:
        """Log probability (natural) of one outcome for each row."""
        out = self.logits(rows, bias, which)
        own = out[np.arange(len(target)), target]
        np.exp(out, out=out)
        return own - np.log(out.sum(axis=1))

    def moved(self, changes: dict[int, np.ndarray]) -> Weights:
        """Weights after the changes of rows; those of the second table are numbered after the first."""
        out = Weights(self.class_bias, self.word_bias)
        out.tables = [x.copy() for x in self.tables]
        for row, change in changes.items():
            which, at = divmod(row, CLASS_ROWS)
            out.tables[which][at] += change.astype(np.float32)
        return out

    def learn(self, rows: np.ndarray, bias: np.ndarray, target: np.ndarray, which: int, sums: np.ndarray, met: np.ndarray) -> None:
        """One adaptive gradient step over a few thousand tokens."""
        gradient = self.factors(rows, bias, which)
        gradient[np.arange(len(target)), target] -= 1
        table = self.tables[which]
        # Only the rows that the step meets change, those met most often first.
        flat = rows.T.reshape(-1)
        often = np.bincount(flat, minlength=len(table))
        met += often
        token = np.argsort(flat.astype(np.min_scalar_type(len(table))), kind="stable") % len(target)
        touched = np.flatnonzero(often)
        n = often[touched]
        first = np.cumsum(n) - n
        by = np.argsort((len(flat) - n).astype(np.min_scalar_type(len(flat))), kind="stable")
        touched, n, first = touched[by], n[by], first[by]
        for at in range(0, len(touched), BLOCK):
            cut = slice(at, at + BLOCK)
            self._move(table, touched[cut], self._sums(gradient, token, first[cut], n[cut]), sums)

    @staticmethod
    def _sums(gradient: np.ndarray, token: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """For each row the sum of the gradients of the ``n`` tokens from ``first`` on; ``n`` falls."""
        total = gradient.take(token[first], axis=0)
        if n[0] <= 2:
            total[: np.count_nonzero(n == 2)] += gradient.take(token[first[n == 2] + 1], axis=0)
            return total
        total = total.astype(np.float64)
        # Of the rows met often each is summed up by itself, the others in turns.
        many = np.count_nonzero(n > MANY)
        for k in range(many):
            gradient.take(token[first[k] : first[k] + n[k]], axis=0).sum(axis=0, dtype=np.float64, out=total[k])
        for turn in range(1, n[many] if many < len(n) else 0):
            more = np.count_nonzero(n > turn)
            total[many:more] += gradient.take(token[first[many:more] + turn], axis=0)
        return total.astype(np.float32)

    @staticmethod
    def _move(table: np.ndarray, touched: np.ndarray, total: np.ndarray, sums: np.ndarray) -> None:
        squares = sums.take(touched, axis=0)
        squares += total * total
        sums[touched] = squares
        squares += np.float32(FLOOR)
        total *= np.float32(RATE)
        total /= np.sqrt(squares, out=squares)
        table[touched] = table.take(touched, axis=0) - total


def coded(starts: np.ndarray, numbers: np.ndarray, hashes: np.ndarray, places: np.ndarray, classes: np.ndarray) -> list[pa.Array]:
    """Two binaries for each text: ``codes``, a 32-bit number per token, and ``rare``, the hashes of those outside the head.

    A code is the place in the head, or -1 less the tail class.
    """
    codes = np.where(places >= 0, places, CLASSES - TAILS - 1 - classes).astype("<i4")[numbers]
    outside = codes < 0
    before = np.concatenate([[0], np.cumsum(outside)])[starts]
    rare = hashes[numbers[outside]].astype("<u8")
    return [
        pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(at * x.itemsize), pa.py_buffer(x)]).cast(pa.binary())
        for at, x in ((starts.astype(np.int64), codes), (before.astype(np.int64), rare))
    ]


def numbers_of(column: pa.ChunkedArray, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(where each row's numbers start, all numbers) of a column of binaries."""
    rows = pa.concat_arrays([x.cast(pa.large_binary()) for x in column.chunks])
    offsets = np.frombuffer(rows.buffers()[1], np.int64, len(rows) + 1, 8 * rows.offset)
    data = rows.buffers()[2]
    held = np.frombuffer(data[offsets[0] : offsets[-1]].to_pybytes() if data is not None else b"", kind)
    return (offsets - offsets[0]) // held.itemsize, held


class Head:
    """Hash and class of a token by its code."""

    def __init__(self, hashes: np.ndarray, classes: np.ndarray):
        self.hashes = np.concatenate([hashes, np.zeros(TAILS, np.uint64)])
        self.classes = np.concatenate([classes, np.arange(CLASSES - 1, CLASSES - TAILS - 1, -1)])


class Batch:
    """Tokens of some coded texts with all that the model needs."""

    def __init__(self, part: pa.Table, head: Head):
        self.starts, codes = numbers_of(part.column("codes"), "<i4")
        self.hashes, self.classes, self.places = head.hashes[codes], head.classes[codes], np.maximum(codes, -1)
        self.hashes[codes < 0] = numbers_of(part.column("rare"), "<u8")[1]
        self.class_rows, self.word_rows = features(self.hashes, self.classes, self.starts)
        self.plain = np.flatnonzero(self.classes < CLASSES - TAILS)


def coded_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Coded texts in the chunks that the texts themselves would be in."""

    def text_bytes(batch: pa.RecordBatch) -> int:
        return (pc.sum(batch.column("bytes")).as_py() or 0) + 4 * (batch.num_rows + 1)

    return chunks(batches, CHUNK_BYTES, text_bytes)


def _train(weights, head):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, own = weights.value, Weights(weights.value.class_bias, weights.value.word_bias)
        own.tables = [x.copy() for x in first.tables]
        sums = [np.zeros_like(x) for x in own.tables]
        met = [np.zeros(len(x), dtype=np.int64) for x in own.tables]
        for part in coded_chunks(batches):
            b = Batch(part, head.value)
            for at in range(0, len(b.hashes), STEP):
                cut = slice(at, at + STEP)
                own.learn(b.class_rows[cut], own.class_bias, b.classes[cut], 0, sums[0], met[0])
            for at in range(0, len(b.plain), STEP):
                cut = b.plain[at : at + STEP]
                bias = own.word_bias[b.classes[cut]]
                own.learn(b.word_rows[cut], bias, b.places[cut] % WIDTH, 1, sums[1], met[1])
        for which, (new, old) in enumerate(zip(own.tables, first.tables)):
            change = (new - old).astype(np.float16)
            used = np.flatnonzero(met[which])
            for at in range(0, len(used), 2_000):
                some = used[at : at + 2_000]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(which * CLASS_ROWS + some), pa.array(met[which][some]),
                        pa.array([x.tobytes() for x in change[some]], pa.binary()),
                    ],
                    ["row", "n", "change"],
                )

    return run


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean change of each row, weighted by n; a task holds the rows of its partition only."""
    held: dict[int, np.ndarray] = {}
    weight: dict[int, int] = {}
    for batch in batches:
        for row, n, change in zip(*(x.to_pylist() for x in batch.columns)):
            add = np.frombuffer(change, np.float16).astype(np.float64) * n
            held[row] = held[row] + add if row in held else add
            weight[row] = weight.get(row, 0) + n
    means = [(x / weight[row]).astype(np.float32).tobytes() for row, x in held.items()]
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(means, pa.binary())], ["row", "change"])


def trained(train: DataFrame, head, counts: np.ndarray, tails: dict[int, tuple[int, int]], rounds: int) -> Weights:
    """Weights after ``rounds`` rounds over coded texts; a round uses the training texts whose hash falls to it."""
    spark = train.sparkSession
    plain = np.zeros(WORDS)
    plain[: min(WORDS, len(counts))] = counts[:WORDS]
    plain = plain.reshape(-1, WIDTH)
    shares = np.concatenate([plain.sum(axis=1), [tails.get(k, (0, 0))[0] for k in range(CLASSES - TAILS, CLASSES)]])
    weights = Weights(np.log(shares + 1) - np.log(shares.sum() + CLASSES), np.log(plain + 0.1))
    weights.word_bias -= np.log(np.exp(weights.word_bias).sum(axis=1, keepdims=True))
    n_all = float(shares.sum())
    for turn in range(rounds if n_all else 0):
        shared = spark.sparkContext.broadcast(weights)
        some = train.where(F.pmod("t", F.lit(rounds)) == turn).select("codes", "rare", "bytes")
        changes = some.mapInArrow(_train(shared, head), "row long, n long, change binary")
        means = changes.repartition(partitions(spark), "row").mapInArrow(_averaged, "row long, change binary")
        # As much as the tables hold, whatever the corpus.
        weights = weights.moved({x["row"]: np.frombuffer(x["change"], np.float32) for x in means.collect()})
        shared.unpersist()
    return weights


def _counted(lexicon, size: int):
    """A row per text and token outside the head, a row per text with its codes, with class -2.

    At last a row per token of the head, with class -1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, dtype=np.int64)
        names_of = ["id", "t", "train", "hash", "class", "n", "codes", "rare", "bytes"]
        id_type = pa.null()

        def batch(texts: list[pa.Array], hashes: np.ndarray, classes: np.ndarray, n: np.ndarray, codes: list[pa.Array]) -> pa.RecordBatch:
            rest = codes or [pa.nulls(len(n), x) for x in (pa.binary(), pa.binary(), pa.int64())]
            return pa.RecordBatch.from_arrays([*texts, pa.array(hashes), pa.array(classes.astype(np.int32)), pa.array(n), *rest], names_of)

        for part in chunks(batches, 4 * CHUNK_BYTES):
            id_type = part.schema.field("id").type
            texts = texts_of(part)
            starts, numbers, names = tokens(texts)
            hashes, places, classes = lexicon.value.look_up(names, rare_only=True)
            doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            train = part.column("train").to_numpy()[doc]
            place = places[numbers]
            counts += np.bincount(place[(place >= 0) & train], minlength=size)
            rare = place < 0
            pairs, n = np.unique(doc[rare] * len(names) + numbers[rare], return_counts=True)
            doc, name = pairs // len(names), pairs % len(names)
            own = [pa.concat_arrays(part.column(c).chunks) for c in ("id", "t", "train")]
            kept = [*coded(starts, numbers, hashes, places, classes), pc.binary_length(texts).cast(pa.int64())]
            n_tokens = np.diff(starts)
            yield batch(own, np.zeros(len(n_tokens), np.int64), np.full(len(n_tokens), -2), n_tokens, kept)
            rows = batch([x.take(pa.array(doc)) for x in own], hashes[name].view(np.int64), classes[name], n, [])
            for at in range(0, rows.num_rows, 50_000):
                yield rows.slice(at, 50_000)
        used = np.flatnonzero(counts)
        if len(used):
            nothing = [pa.nulls(len(used), id_type), pa.nulls(len(used), pa.int64()), pa.array([True] * len(used))]
            yield batch(nothing, used, np.full(len(used), -1), counts[used], [])

    return run


def _score(weights, head_of, counts, tail_logs):
    """Per text: tokens, known ones, log10 sums of the head's counts, and of the model without rare counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, logs = weights.value, np.log10(counts.value + 0.1)
        for part in coded_chunks(batches):
            b = Batch(part, head_of.value)
            model = np.zeros(len(b.hashes))
            for at in range(0, len(b.hashes), SCORE_STEP):
                cut = slice(at, at + SCORE_STEP)
                model[cut] = own.log_factor(b.class_rows[cut], own.class_bias, 0, b.classes[cut])
            for at in range(0, len(b.plain), SCORE_STEP):
                cut = b.plain[at : at + SCORE_STEP]
                model[cut] += own.log_factor(b.word_rows[cut], own.word_bias[b.classes[cut]], 1, b.places[cut] % WIDTH)
            model /= np.log(10)
            in_head = b.places >= 0
            head = np.where(in_head, logs[b.places], 0.0)
            known = in_head & (counts.value[b.places] > 0)
            other = b.classes >= CLASSES - TAILS
            model += np.where(other, head - tail_logs[b.classes], 0.0)
            sums = [np.add.reduceat(x.astype(np.float64), b.starts[:-1]) for x in (known, head, model)] if part.num_rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.concat_arrays(part.column(c).chunks) for c in ("id", "t", "train")),
                    pa.array(np.diff(b.starts)), pa.array(np.asarray(sums[0], dtype=np.int64)),
                    pa.array(sums[1], pa.float64()), pa.array(sums[2], pa.float64()),
                ],
                ["id", "t", "train", "n_tokens", "known", "head", "model"],
            )

    return run


def scored(
    docs: DataFrame, is_held_out: Column, id_name: str = "doc_id", text_name: str = "text", head: int = HEAD,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Per text: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    rows = docs.select(
        col(id_name).alias("id"), text_of(text_name).alias("text"), (~is_held_out).alias("train")
    ).withColumn("t", F.xxhash64("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    train = rows.where("train")
    names = frequent(train, head)
    lexicon = spark.sparkContext.broadcast(Lexicon(names))
    size = len(lexicon.value.place)
    counts = np.zeros(size, dtype=np.int64)
    kind = f"id {id_type}, t long, train boolean, hash long, class int, n long, codes binary, rare binary, bytes long"
    path = new_path(spark, "rare-tokens")
    rows.mapInArrow(_counted(lexicon, size), kind).write.option("compression", "zstd").parquet(path)
    counted = spark.read.schema(kind).parquet(path)
    for row in counted.where("class = -1").groupBy("hash").agg(F.sum("n").alias("n")).collect():  # HEAD rows at most
        counts[row["hash"]] = row["n"]
    rare = counted.where("class >= 0")
    by_hash = rare.where("train").groupBy("hash").agg(F.sum("n").alias("c"), F.first("class").alias("class"))
    found = by_hash.groupBy("class").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    rare_n, rare_v = sum(x["n"] for x in found), sum(x["v"] for x in found)
    tails = {x["class"]: (x["n"], x["v"]) for x in found}
    by_place = sorted(lexicon.value.place, key=lexicon.value.place.get)
    hashes, _, classes = lexicon.value.look_up(pa.array(by_place, pa.large_string()))
    for k in range(CLASSES - TAILS, CLASSES):
        n, v = tails.get(k, (0, 0))
        tails[k] = (n + int(counts[classes == k].sum()), v + int((counts[classes == k] > 0).sum()))
    tail_logs = np.zeros(CLASSES)
    for k, (n, v) in tails.items():
        tail_logs[k] = np.log10(n + 0.1 * (v + 1))
    total, distinct = int(counts.sum()) + rare_n, int((counts > 0).sum()) + rare_v

    # The texts were tokenised and looked up once; training and scoring read their codes.
    texts = counted.where("class = -2").select("id", "t", "train", "codes", "rare", "bytes")
    of_code = spark.sparkContext.broadcast(Head(hashes, classes))
    weights = spark.sparkContext.broadcast(trained(texts.where("train"), of_code, counts, tails, rounds))
    shared = spark.sparkContext.broadcast(counts)
    c = F.coalesce(F.sum(F.when(F.col("train"), F.col("n"))).over(W.partitionBy("hash")), F.lit(0))
    sums = (
        rare.withColumn("c", c).groupBy("id", "t")
        .agg(F.sum(F.col("n") * F.log10(F.col("c") + 0.1)).alias("rare"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"))
        .select(F.col("id").alias("rare_id"), F.col("t").alias("rare_t"), "rare", "rare_known")
    )
    kind = f"id {id_type}, t long, train boolean, n_tokens long, known long, head double, model double"
    parts = texts.mapInArrow(_score(weights, of_code, shared, tail_logs), kind)
    # Rows equal in id and text have added up in ``sums``.
    copies = F.count(F.lit(1)).over(W.partitionBy("id", "t"))
    same = F.col("id").eqNullSafe(F.col("rare_id")) & (F.col("t") == F.col("rare_t"))
    joined = parts.withColumn("copies", copies).join(sums.hint("merge"), same, "left")
    rare_sum = F.coalesce(F.col("rare") / F.col("copies"), F.lit(0.0))
    rare_known = F.coalesce(F.col("rare_known") / F.col("copies"), F.lit(0.0))
    norm = float(np.log10(total + 0.1 * (distinct + 1)))
    return joined.select(
        F.col("id").alias(id_name), (~F.col("train")).alias("held_out"), "n_tokens",
        (F.col("known") + rare_known.cast("long")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("head") + rare_sum - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        (F.col("model") + rare_sum).alias("score"),
    )
