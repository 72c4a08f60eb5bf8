"""Hash expressions. ``md5``-based ones can be recomputed by any SQL engine."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME31 = (1 << 31) - 1


def md5_31(value: Column) -> Column:
    """A number below 2**31 - 1 from the first 32 bits of the MD5 digest."""
    return F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long") % F.lit(PRIME31)


def xx_31(value: Column) -> Column:
    """Same range, from xxHash64; about four times faster than MD5."""
    return F.pmod(F.xxhash64(value), F.lit(PRIME31))


def md5_bucket(value: Column, digits: int = 3) -> Column:
    """The first hexadecimal digits of the MD5 digest, as a number."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")


#: Runs up to this many blocks of 64 bytes are hashed side by side, longer ones one by one.
_BLOCKS = 4
#: Runs that are hashed at once, so that their state stays in a core's cache.
_LANES = 1 << 13
_TURNS = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], np.uint32)
_ADDED = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2**32).astype(np.uint32)
_START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)
#: By the bytes of a run that lie in a block: which are kept, and the end mark after them.
_KEPT = np.where(np.arange(64) < np.arange(65)[:, None], 255, 0).astype(np.uint8)
_MARK = np.where(np.arange(64) == np.arange(65)[:, None], 128, 0).astype(np.uint8)


def _md5_block(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """MD5 state of every lane after one block more; ``block`` holds its sixteen words, lane by lane."""
    a, b, c, d = (x.copy() for x in state)
    x, y = np.empty_like(a), np.empty_like(a)
    for k in range(64):
        turn = k // 16
        if turn < 2:  # (b and c) or (not b and d), then (d and b) or (not d and c)
            p, q, r = (b, c, d) if turn == 0 else (d, b, c)
            np.bitwise_xor(q, r, out=x)
            x &= p
            x ^= r
        elif turn == 2:
            np.bitwise_xor(b, c, out=x)
            x ^= d
        else:
            np.invert(d, out=x)
            x |= b
            x ^= c
        x += a
        x += block[(k, 5 * k + 1, 3 * k + 5, 7 * k)[turn] % 16]
        x += _ADDED[k]
        left = _TURNS[turn, k % 4]
        np.left_shift(x, left, out=y)
        x >>= np.uint32(32) - left
        x |= y
        x += b
        a, x, b, c, d = d, a, x, b, c
    return state + np.stack([a, b, c, d])


def _md5_31_of_runs(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same numbers for parts of ``data``, many at once."""
    out = np.empty(len(starts), np.int64)
    sizes = ends - starts
    blocks = (sizes + 8) // 64 + 1
    long = np.flatnonzero(blocks > _BLOCKS)
    out[long] = _md5_31_of([data[low:high] for low, high in zip(starts[long].tolist(), ends[long].tolist())])
    padded = np.frombuffer(data + bytes(64 * _BLOCKS), np.uint8)
    windows = np.ndarray(len(padded) - 63, "V64", padded, strides=(1,))
    for count in range(1, _BLOCKS + 1):
        alike = np.flatnonzero(blocks == count)
        for at in range(0, len(alike), _LANES):
            some = alike[at : at + _LANES]
            state = np.repeat(_START[:, None], len(some), axis=1)
            for k in range(count):
                inside = np.clip(sizes[some] - 64 * k, 0, 64)
                block = windows[starts[some] + 64 * k].view(np.uint64).reshape(-1, 8)
                block &= _KEPT.view(np.uint64).take(inside, axis=0)
                mark = _MARK.view(np.uint64).take(inside, axis=0)
                mark[sizes[some] < 64 * k] = 0  # it stands in the block before
                block |= mark
                if k == count - 1:
                    block[:, 7] = sizes[some] * 8
                state = _md5_block(state, np.ascontiguousarray(block.view("<u4").T))
            out[some] = state[0].byteswap().astype(np.int64) % PRIME31
    return out


def _md5_31_of(values: list[bytes]) -> np.ndarray:
    first = b"".join([hashlib.md5(x).digest()[:4] for x in values])
    return np.frombuffer(first, ">u4").astype(np.int64) % PRIME31


def _xx_31_of(values: list[bytes]) -> np.ndarray:
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in values), np.uint64, len(values))
    return hashes.view(np.int64) % PRIME31


#: The same values from bytes, for functions on Arrow batches. Inside ``transform`` Spark interprets an
#: expression element by element, which for these takes several times as long.
OF_BYTES: dict[Callable[[Column], Column], Callable[[list[bytes]], np.ndarray]] = {md5_31: _md5_31_of, xx_31: _xx_31_of}
#: Those that also take many parts of one run of bytes at once, as (bytes, starts, ends).
OF_RUNS: dict[Callable[[list[bytes]], np.ndarray], Callable[[bytes, np.ndarray, np.ndarray], np.ndarray]] = {
    _md5_31_of: _md5_31_of_runs
}
