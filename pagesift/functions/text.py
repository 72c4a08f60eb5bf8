"""Word-level text expressions."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesift.functions.binding import let

# Character classes.
SPACE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
WORD = r"[\p{L}\p{N}_]"
NOT_WORD_NOR_SPACE = r"[^\p{L}\p{N}_\s\p{Z}\x{1c}-\x{1f}\x{85}]"
NOT_ALNUM_NOR_SPACE = r"[^\p{L}\p{N}\s\p{Z}\x{1c}-\x{1f}\x{85}]"

NUMBER_TOKEN = "<NUM>"
END_OF_LINE = " <EOS> "
MAX_TOKEN_CHARS = 100
MAX_LINE_TOKENS = 1024


def _decomposed(text: pd.Series) -> pd.Series:
    def bare(value: str | None) -> str | None:
        return value and "".join(c for c in unicodedata.normalize("NFD", value) if unicodedata.category(c) != "Mn")

    return text.map(bare)


def without_marks(text: Column) -> Column:
    """Characters decomposed and their marks dropped; only texts beyond ASCII go to Python."""
    wide = text.rlike(r"[^\x00-\x7f]")
    return F.when(wide, F.pandas_udf(_decomposed, "string")(F.when(wide, text))).otherwise(text)


def one_line(text: Column) -> Column:
    """Runs of white space become one blank; ends are trimmed."""
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def split_blanks(text: Column) -> Column:
    """Tokens of a text that went through ``one_line``."""
    return F.filter(F.split(text, " "), lambda w: w != "")


def simplify(
    text: Column, remove_punctuation: bool = True, norm_numbers: bool = False, strip_diacritics: bool = False
) -> Column:
    """Text as it is compared between documents: lower case, no punctuation, one blank; without accents if asked."""
    out = F.lower(without_marks(text) if strip_diacritics else text)
    if norm_numbers:
        out = F.regexp_replace(out, r"\p{Nd}+", "0")
    if remove_punctuation:
        out = F.regexp_replace(out, NOT_ALNUM_NOR_SPACE, "")
    return one_line(out)


#: Characters that ``simple_lines`` knows: their kinds are the same in all versions of Unicode in use.
_KNOWN = (range(0x250), range(0x2000, 0x2070))
_BEYOND = r"[^\x00-\x{24f}\x{2000}-\x{206f}]"


def _kind(code: int) -> int:
    """0 for a character that ``simplify`` drops, 1 for a kept one, 2 for white space."""
    kind = unicodedata.category(chr(code))[0]
    if kind == "Z" or code in (*range(0x09, 0x0E), *range(0x1C, 0x20), 0x85):
        return 2
    return 1 if kind in "LN" else 0


# The last one stands for all others, which ``half_simple`` leaves in simplified texts only.
_KINDS = np.array([_kind(x) if any(x in known for known in _KNOWN) else 1 for x in range(0x2071)], np.uint8)
_BYTE_KINDS = np.concatenate([_KINDS[:0x80], np.ones(0x80, np.uint8)])


def half_simple(text: Column) -> Column:
    """Text that ``simple_lines`` makes equal to ``simplify(text)``: in lower case, or simplified if it has rarer characters."""
    lower = F.lower(text)
    return F.when(lower.rlike(_BEYOND), simplify(text)).otherwise(lower)


def simple_lines(texts: pa.Array) -> pa.Array:
    """``simplify`` for Arrow batches of ``half_simple`` texts, byte by byte instead of by patterns; null is empty."""
    texts = pa.concat_arrays([texts.cast(pa.large_binary()).fill_null(b"")])
    cuts = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer if buffer is not None else b"", np.uint8)[cuts[0] : cuts[-1]]
    cuts = cuts - cuts[0]
    kinds = _BYTE_KINDS[data]
    for low, high, size, bits in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F)):
        first = np.flatnonzero((data >= low) & (data < high))
        code = (data[first] & bits).astype(np.int64)
        for k in range(1, size):
            code = code << 6 | data[first + k] & 0x3F
        kind = _KINDS[np.minimum(code, len(_KINDS) - 1)]
        first, kind = first[kind != 1], kind[kind != 1]
        kinds[first] = kind
        for k in range(1, size):
            kinds[first + k] = 0
    data = np.where(kinds == 2, np.uint8(32), data)
    data, cuts = _without(data, cuts, np.flatnonzero(kinds == 0))
    # Of each run of blanks the first one stays, but none at the ends of a text.
    blanks = np.flatnonzero(data == 32)
    row = np.searchsorted(cuts, blanks, "right") - 1
    first = np.ones(len(blanks), bool)
    first[1:] = (np.diff(blanks) > 1) | (np.diff(row) > 0)
    last = np.append(first[1:], True)[: len(blanks)]
    at_end = np.repeat((blanks + 1 == cuts[row + 1])[last], np.diff(np.append(np.flatnonzero(first), len(blanks))))
    data, cuts = _without(data, cuts, blanks[~first | (blanks == cuts[row]) | at_end])
    return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(cuts), pa.py_buffer(data)])


def _without(data: np.ndarray, cuts: np.ndarray, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of texts when the bytes at ``gone`` are taken out."""
    stays = np.ones(len(data), bool)
    stays[gone] = False
    return data[stays], cuts - np.searchsorted(gone, cuts)


def words(
    text: Column, remove_punctuation: bool = True, norm_numbers: bool = False, strip_diacritics: bool = False
) -> Column:
    return split_blanks(simplify(text, remove_punctuation, norm_numbers, strip_diacritics))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` tokens, joined by blanks; empty for a shorter text."""

    def runs(t: Column) -> Column:
        # Single elements are read in constant time; "slice" would copy the whole array for every run.
        grams = F.transform(
            F.sequence(F.lit(0), F.size(t) - n),
            lambda i: F.concat_ws(" ", *[F.get(t, i + k) for k in range(n)]),
        )
        return F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>"))

    return let(tokens, runs)


def overlap_ngrams(query: Column, label: Column, n: int) -> Column:
    """Runs of ``n`` tokens that end a query and begin its label, one per split point."""

    def across(both: Column) -> Column:
        q, a = both["q"], both["a"]
        # k tokens come from the label, n - k from the query.
        first = F.greatest(F.lit(1), F.lit(n) - F.size(q))
        last = F.least(F.lit(n - 1), F.size(a))
        grams = F.transform(
            F.sequence(first, last),
            lambda k: F.array_join(
                F.concat(F.slice(q, F.size(q) - (F.lit(n) - k) + 1, F.lit(n) - k), F.slice(a, F.lit(1), k)), " "
            ),
        )
        return F.when(first <= last, grams).otherwise(F.array().cast("array<string>"))

    return let(F.struct(query.alias("q"), label.alias("a")), across)


def word_punct_tokens(text: Column) -> Column:
    """Runs of word characters and runs of punctuation."""
    return F.regexp_extract_all(text, F.lit(f"{WORD}+|{NOT_WORD_NOR_SPACE}+"), 0)


def classifier_line(text: Column) -> Column:
    """Text as the topic classifier sees it: tokens in lower case, digits as one symbol."""
    tokens = F.transform(word_punct_tokens(text), lambda t: F.lower(t))
    tokens = F.transform(tokens, lambda t: F.when(t.rlike(r"^\p{Nd}+$"), F.lit(NUMBER_TOKEN)).otherwise(t))
    tokens = F.filter(tokens, lambda t: F.length(t) <= MAX_TOKEN_CHARS)
    out = F.array_join(tokens, " ")
    out = F.regexp_replace(out, r"[-_]+", " ")
    # "<" and ">" stay, as parts of the number symbol.
    out = F.regexp_replace(out, r"[^a-zA-Z0-9\s<>]", "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def cut_lines(line: Column, size: int = MAX_LINE_TOKENS) -> Column:
    """Put an end-of-line mark after every ``size`` tokens."""

    # One pass: the mark stands before the first token of every piece but the first ("slice" would copy all tokens for each).
    mark = F.lit(END_OF_LINE.strip() + " ")
    marked = F.transform(split_blanks(line), lambda t, i: F.when((i > 0) & (i % size == 0), F.concat(mark, t)).otherwise(t))
    return F.coalesce(F.array_join(marked, " "), F.lit(""))
