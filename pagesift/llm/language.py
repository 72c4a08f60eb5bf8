"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built of a bounded sample of its labelled text.
A text is parsed against each automaton: the longest match from where the last one ended
is one phrase. The language that needs the fewest phrases, normalised to bits per symbol
(phrases x log2(sample length) / text length), wins; a tie goes to the smaller name.

Texts become letters in lower case with one gap for each run of other characters. They
are parsed whole, in blocks of ``BLOCK`` symbols that start a phrase of their own, so that
numpy moves thousands of blocks through an automaton in lockstep. Longer texts are just
more blocks.

Each language has the alphabet of all letters of its sample, of any script. Its common
letters have columns in a table of transitions; the moves of the others, of which even a
script of many thousand signs has few for each state, are a sorted list. A letter that the
sample lacks is a phrase of its own.

Bounds, all parameters: ``SAMPLE_DOCS`` excerpts of ``EXCERPT`` characters for each
language, ``SAMPLE`` symbols in an automaton. They are sent to all workers; their size
depends on the number of languages only. ``DENSE`` columns are a matter of speed only.

Defined cases: a null text, one without letters, or a table without labels gives ``und``
and score 0. Null ids and repeated rows are rows like others. An empty table gives an
empty result. Other columns, whatever their names, ride in a struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagesift.llm.common import chunks, col

SAMPLE_DOCS = 64
EXCERPT = 2_048
SAMPLE = 32_000
DENSE = 48
BLOCK = 256
#: Bytes of rows that are parsed at once; the arrays for them take some fifty times as much.
PARSED = 1 << 20
#: Symbols of evidence that the score counts at most; more would make every score 1.
EVIDENCE = 8
UNKNOWN = "und"


def automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton, of each state."""
    following: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(following)
        following.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in following[at]:
            following[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = following[at][symbol]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                copy = len(following)
                following.append(dict(following[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                while at >= 0 and following[at].get(symbol) == target:
                    following[at][symbol] = copy
                    at = link[at]
                link[target] = link[new] = copy
        last = new
    return following


class Transitions:
    """Moves of one language: a table for the symbols below ``DENSE``, sorted (state, symbol) keys for the others."""

    def __init__(self, following: list[dict[int, int]], letters: np.ndarray):
        #: Code points up to the last letter and one more, which stands for all above it; 0 is the gap.
        self.number = np.full(int(letters.max()) + 2, len(letters) + 1, dtype=np.int32)
        self.number[letters] = np.arange(1, len(letters) + 1)
        self.number[0] = 0
        self.alphabet = len(letters) + 2  # the last symbol is any unknown letter
        self.dense = min(DENSE, self.alphabet)
        self.table = np.zeros(len(following) * self.dense, dtype=np.uint32)
        others: dict[int, int] = {}
        for state, moves in enumerate(following):
            for symbol, target in moves.items():
                if symbol < self.dense:
                    self.table[state * self.dense + symbol] = target
                else:
                    others[state * self.alphabet + symbol] = target
        self.keys = np.array(sorted(others), dtype=np.int64)
        self.targets = np.array([others[x] for x in self.keys.tolist()], dtype=np.uint32)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        """The symbols of lower-case letters; 0 stays."""
        return self.number[np.minimum(codes, len(self.number) - 1)].astype(np.int64)

    def move(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The next states; 0, the start, where there is none."""
        if not len(self.keys):
            known = symbol < self.dense
            return np.where(known, self.table[state * self.dense + np.where(known, symbol, 0)], 0).astype(np.int64)
        out = np.zeros(len(symbol), dtype=np.int64)
        common = symbol < self.dense
        out[common] = self.table[state[common] * self.dense + symbol[common]]
        rare = np.flatnonzero(~common)
        if len(rare):
            key = state[rare] * self.alphabet + symbol[rare]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out[rare] = np.where(self.keys[at] == key, self.targets[at], 0)
        return out


@lru_cache(maxsize=1)
def lowered() -> np.ndarray:
    """For each code point the code point of its lower-case letter; 0 if it is no letter."""
    out = np.zeros(0x110000, dtype=np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            out[point] = ord(letter.lower()[0])
    return out


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


class Model:
    """Languages, the lower-case letter of each code point, and an automaton for each language."""

    def __init__(self, samples: dict[str, list[str]], sample: int = SAMPLE):
        self.code = lowered()
        self.languages, self.tables, self.bits = [], [], []
        for language in sorted(samples):
            parts = [self.code[points(text)] for text in samples[language]]
            joined = collapsed(np.concatenate([np.append(x, 0) for x in parts])) if parts else np.zeros(0, np.uint32)
            joined = joined[:sample]
            if (joined > 0).any():
                found, n = np.unique(joined[joined > 0], return_counts=True)
                letters = found[np.lexsort((found, -n))].astype(np.uint32)  # common ones first
                number = dict(zip(letters.tolist(), range(1, len(letters) + 1)))
                number[0] = 0
                following = automaton([number[x] for x in joined.tolist()])
                self.languages.append(language)
                self.tables.append(Transitions(following, letters))
                self.bits.append(float(np.log2(max(2, len(joined)))))

    def phrases(self, table: Transitions, codes: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Phrases of each block; ``codes`` holds a step per row, ``active`` the blocks that reach it."""
        state = np.zeros(codes.shape[1], dtype=np.int64)
        count = np.zeros(codes.shape[1], dtype=np.int32)
        symbols = table.symbols(codes)
        for step, n in enumerate(active.tolist()):
            symbol = symbols[step, :n]
            here = state[:n]
            moved = table.move(here, symbol)
            fresh = moved == 0
            count[:n] += fresh | (here == 0)
            state[:n] = np.where(fresh, table.move(np.zeros_like(here), symbol), moved)
        return count

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        texts = [x or "" for x in texts]
        codes = self.code[points("".join(texts))]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        owner = np.repeat(np.arange(len(texts)), sizes)
        keep = np.ones(len(codes), dtype=bool)
        if len(codes):
            keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0) | (owner[1:] != owner[:-1])
        codes, owner = codes[keep], owner[keep]
        letters = np.bincount(owner, weights=codes > 0, minlength=len(texts))
        sizes = np.bincount(owner, minlength=len(texts))
        starts = np.cumsum(sizes) - sizes
        # Blocks, longest first.
        n_blocks = -(-sizes // BLOCK)
        doc = np.repeat(np.arange(len(texts)), n_blocks)
        inner = np.arange(len(doc)) - np.repeat(np.cumsum(n_blocks) - n_blocks, n_blocks)
        begin = starts[doc] + inner * BLOCK
        length = np.minimum(BLOCK, starts[doc] + sizes[doc] - begin)
        order = np.argsort(-length, kind="stable")
        doc, begin, length = doc[order], begin[order], length[order]
        padded = np.append(codes, np.zeros(BLOCK, dtype=codes.dtype))
        grid = padded[begin[None, :] + np.arange(BLOCK)[:, None]].astype(np.int64)
        active = len(length) - np.searchsorted(np.sort(length), np.arange(BLOCK), side="right")
        bits = np.zeros((len(self.languages), len(texts)))
        for i, table in enumerate(self.tables):
            found = np.bincount(doc, weights=self.phrases(table, grid, active), minlength=len(texts))
            bits[i] = found * self.bits[i] / np.maximum(sizes, 1)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best = bits.argmin(axis=0)
        odds = 2.0 ** (-(bits - bits.min(axis=0)) * np.minimum(sizes, EVIDENCE))
        score = np.where(letters > 0, 1 / odds.sum(axis=0), 0.0)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best.tolist(), letters.tolist())], score


def collapsed(codes: np.ndarray) -> np.ndarray:
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)
    return codes[keep]


def held_out(id_name: str) -> Column:
    return F.coalesce(F.crc32(col(id_name).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitted(
    labelled: DataFrame, id_name: str = "doc_id", text_name: str = "text", lang_name: str = "lang",
    docs: int = SAMPLE_DOCS, excerpt: int = EXCERPT, sample: int = SAMPLE,
) -> Model:
    """Model of at most ``docs`` excerpts per label, from the middle of texts picked by the hash of their id."""
    rows = labelled.where(col(lang_name).isNotNull() & F.length(col(text_name)).between(1, 2_000_000_000)).select(
        col(lang_name).cast("string").alias("lang"),
        F.xxhash64(col(id_name), F.length(col(text_name))).alias("pick"),
        F.substring(
            col(text_name), F.greatest(F.lit(1), ((F.length(col(text_name)) - excerpt) / 2).cast("int")), F.lit(excerpt)
        ).alias("x"),
    )
    place = F.row_number().over(W.partitionBy("lang").orderBy("pick", "x"))
    chosen = rows.withColumn("place", place).where(F.col("place") <= docs)
    samples: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "place").collect():
        samples.setdefault(row["lang"], []).append(row["x"])
    return Model(samples, sample)


def parsed(batches: Iterator[pa.RecordBatch], model: Model, at: int | None) -> Iterator[pa.RecordBatch]:
    """The rows with language and score; the text is field ``at`` of ``row``, or a column of its own."""
    for part in chunks(batches, PARSED):
        row = part.column("row").combine_chunks()
        texts = part.column("text") if at is None else pc.struct_field(row, [at])
        languages, score = model.predict(texts.to_pylist())
        yield pa.RecordBatch.from_arrays([row, pa.array(languages, pa.string()), pa.array(score)], ["row", "lang_pred", "score"])


def identified(docs: DataFrame, model: Model, text_name: str = "text", columns: list[str] | None = None) -> DataFrame:
    """``row`` (struct of ``columns``, all by default), ``lang_pred`` and ``score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns if columns is None else columns
    rows = docs.select(F.struct(*[col(c) for c in names]).alias("row"), col(text_name).cast("string").alias("text"))
    at = None
    if text_name in names and rows.schema["row"].dataType[names.index(text_name)].dataType == T.StringType():
        rows, at = rows.select("row"), names.index(text_name)  # a text that rides in the struct is sent once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return parsed(batches, shared.value, at)

    kind = T.StructType().add("row", rows.schema["row"].dataType).add("lang_pred", "string").add("score", "double")
    return rows.mapInArrow(run, kind)
