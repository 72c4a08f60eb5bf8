"""Byte-level BPE by Aho-Corasick matching and backtracking.

A vocabulary's tokens, bytes mapped to Latin-1 characters, are the words of one
pyahocorasick automaton. One pass over a piece gives the longest token that starts at
each byte. Encoding goes left to right with the longest token; two neighbours are
compatible if merging their joint bytes gives back just these two. If no prefix of the
longest token is compatible with the token before it, that token is taken back and its
next shorter prefix is tried. A position that failed once is never tried again, so the
work is linear in the piece. A sequence whose neighbours are all compatible is the one
that the merges produce. Compatibility is memoised.

Pieces come from the public split pattern; a bounded memo maps frequent pieces to ids.

Defined cases: a null text is empty, an empty text has no ids and decodes to no bytes.
Rows are independent, so repeated rows get equal results and ids may be null.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.llm.common import col, text_of

#: Pieces and neighbour pairs that a worker remembers; when full, the memo starts anew.
MEMO_WORDS = 500_000
MEMO_PIECES = 250_000
MEMO_PAIRS = 1_000_000
#: Rows that are encoded together.
ROWS = 1_500
#: Pieces longer than this are not worth remembering.
MEMO_BYTES = 64


NEVER = 1 << 60
#: Number of ids, the ids as text, the bytes that they decode to.
Found = tuple[int, str, bytes]


def edge(word: str, at: int) -> bool:
    """Whether ``word`` has a character at that end that is no white space."""
    return word != "" and not word[at].isspace()


class Encoder:
    """Encodes and decodes by a table of token bytes and ranks, as the merges by rank would."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.lengths = list(map(len, self.bytes_of))
        self.split = regex.compile(pattern).findall
        self.words: dict[str, Found] = {}
        self.pieces: dict[str, Found] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int] = {}
        # A token that its own merges cannot build is found only as a whole piece.
        self.halves: dict[int, tuple[int, int]] = {}
        self.built: dict[bytes, int] = {}
        for token, rank in ranks.items():
            parts = self.merged(token, 2)
            if len(parts) == 1:
                self.built[token] = rank
            elif len(parts) == 2 and ranks.get(parts[0] + parts[1]) == rank:
                self.built[token] = rank
                self.halves[rank] = (ranks[parts[0]], ranks[parts[1]])
        self.spines: dict[tuple[int, int], list[int]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.built.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self.automaton.make_automaton()

    def merged(self, data: bytes, least: int = 1) -> list[bytes]:
        """The definition: merge the neighbours of least rank, leftmost first, until ``least`` parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = self.ranks
        while len(parts) > least:
            best, at = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if best == NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spine(self, token: int, side: int) -> list[int]:
        """What stands at the left (0) or right (1) edge of ``token`` while it is merged, first byte to whole."""
        known = self.spines.get((token, side))
        if known is None:
            known = [token]
            while known[-1] in self.halves:
                known.append(self.halves[known[-1]][side])
            known.reverse()
            self.spines[token, side] = known
        return known

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joint bytes never merges across the border, so that it gives back both."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self._apart(self.spine(left, 1), self.spine(right, 0))
        return known

    def _apart(self, lefts: list[int], rights: list[int]) -> bool:
        bytes_of, i, j = self.bytes_of, 0, 0
        while True:
            # A merge happens at its rank; of equal ranks the one further left comes first.
            grow_left = lefts[i + 1] if i + 1 < len(lefts) else NEVER
            grow_right = rights[j + 1] if j + 1 < len(rights) else NEVER
            across = self.ranks.get(bytes_of[lefts[i]] + bytes_of[rights[j]], NEVER)
            if across < grow_left and across <= grow_right and across < NEVER:
                return False
            if grow_left == grow_right == NEVER:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def prefix(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if there is none."""
        known = self.shorter.get(token)
        if known is None:
            data = self.bytes_of[token]
            known = next((self.built[data[:n]] for n in range(len(data) - 1, 0, -1) if data[:n] in self.built), -1)
            self.shorter[token] = known
        return known

    def backtracked(self, data: bytes) -> list[int]:
        longest = [0] * len(data)
        for end, (size, rank) in self.automaton.iter(data.decode("latin-1")):
            longest[end - size + 1] = rank  # a later end is a longer token of the same start
        lengths, pairs, total = self.lengths, self.pairs, len(data)
        dead = bytearray(total + 1)
        ids: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < total:
            end = at + lengths[token]
            fits = last < 0 or pairs.get((last, token))
            if fits is None:
                fits = self.compatible(last, token)
            if fits and not dead[end]:
                ids.append(token)
                at, last = end, token
                token = longest[at] if at < total else -1
                continue
            token = self.prefix(token)
            while token < 0:  # no token fits here: take back the one before
                dead[at] = 1
                at -= lengths[last]
                token = self.prefix(ids.pop())
                last = ids[-1] if ids else -1
        return ids

    def piece(self, text: str) -> Found:
        data = text.encode()
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else self.backtracked(data)
        found = (len(ids), " ".join(map(str, ids)), self.decode(ids))
        if len(data) <= MEMO_BYTES:
            if len(self.pieces) >= MEMO_PIECES:
                self.pieces.clear()
            self.pieces[text] = found
        return found

    def part(self, text: str) -> Found:
        """The ids of a text that is split for itself."""
        known = self.pieces.get
        found = [known(x) or self.piece(x) for x in self.split(text)]
        if len(found) == 1:
            return found[0]
        return sum(x[0] for x in found), " ".join([x[1] for x in found]), b"".join([x[2] for x in found])

    def word(self, word: str) -> Found:
        """A word after a single space."""
        found = self.part(" " + word)
        if len(word) <= MEMO_BYTES:
            if len(self.words) >= MEMO_WORDS:
                self.words.clear()
            self.words[word] = found
        return found

    def apart(self, texts: pa.Array) -> Iterator[Found]:
        """The ids of each text.

        A space between two characters that are no white space always begins a piece, so a
        text may be cut there. Texts with other spaces are split as a whole; of the rest
        each different word of the batch is looked up once.
        """
        split = pc.split_pattern(texts.cast(pa.large_string()), " ")
        starts = split.offsets.to_numpy()
        coded = split.values.slice(starts[0], starts[-1] - starts[0]).dictionary_encode()
        starts = starts - starts[0]
        numbers, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        clean = np.fromiter((edge(x, 0) and edge(x, -1) for x in names), bool, len(names))
        # A text's first word has no space before it; it is added to the words.
        head = starts[:-1]
        firsts = [names[i] for i in numbers[head].tolist()]
        whole = np.logical_and.reduceat(clean[numbers], head) if len(head) else np.zeros(0, bool)
        known = self.words.get
        found = [(known(x) or self.word(x)) if ok else (0, "", b"") for x, ok in zip(names, clean.tolist())]
        found += [self.part(x) if ok else (0, "", b"") for x, ok in zip(firsts, whole.tolist())]
        numbers[head] = len(names) + np.arange(len(head))
        sizes = np.fromiter((x[0] for x in found), np.int64, len(found))
        n = np.add.reduceat(sizes[numbers], head) if len(head) else sizes
        ids, data = [x[1] for x in found], [x[2] for x in found]
        bounds = starts.tolist()
        for i, ok in enumerate(whole.tolist()):
            if ok:
                own = numbers[bounds[i] : bounds[i + 1]].tolist()
                yield int(n[i]), " ".join([ids[k] for k in own]), b"".join([data[k] for k in own])
            else:
                yield self.part(texts[i].as_py())

    def encode(self, text: str) -> list[int]:
        return [int(x) for _, ids, _ in self.apart(pa.array([text])) for x in ids.split()]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per worker and vocabulary; the file is installed on every machine."""
    return Encoder(read_ranks(path), pattern)


def encoded(docs: DataFrame, path: str, pattern: str, id_name: str = "doc_id", text_name: str = "text") -> DataFrame:
    """Per row: id, ``ids`` (array of int) of the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = [[int(x) for x in found[1].split()] for found in own.apart(part.column(1))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["id", "ids"])

    rows = docs.select(col(id_name).alias("id"), text_of(text_name).alias("text"))
    kind = f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>"
    return rows.mapInArrow(run, kind).select(F.col("id").alias(id_name), "ids")


def round_trip(docs: DataFrame, path: str, pattern: str, id_name: str = "doc_id", text_name: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, SHA-256 of the ids as text and of the bytes that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sizes, digests, decoded = [], [], []
                for n, ids, data in own.apart(part.column(1)):
                    sizes.append(n)
                    digests.append(hashlib.sha256(ids.encode()).hexdigest())
                    decoded.append(hashlib.sha256(data).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(col(id_name).alias("id"), text_of(text_name).alias("text"))
    kind = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(run, kind).withColumnRenamed("id", id_name)
