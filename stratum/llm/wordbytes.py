"""Vectorised word work on the UTF-8 bytes of Arrow string columns.

A batch's texts are one byte buffer plus offsets.  Word borders come from a
256-entry class table and word hashes from prefix sums of a polynomial modulo
2**64, so no Python object is made per word.  Multi-byte characters consist of
bytes >= 0x80 only; for the word classes used here those are word bytes, hence
byte borders are character borders.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text handled at once; a longer document is handled alone
CHUNK_BYTES = 1 << 20

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[list(SPACES)] = False
#: ASCII letters and digits and every byte of a non-ASCII character
ALNUM = np.zeros(256, dtype=bool)
for _lo, _hi in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    ALNUM[_lo:_hi + 1] = True

SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    have = 1
    while have < n:
        step = min(have, n - have)
        out[have:have + step] = out[:step] * np.uint64(pow(base, have, 1 << 64))
        have += step
    return out


def powers(n: int) -> list[np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (kept between calls)."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        _powers[:] = [_geometric(_BASE, size), _geometric(_BASE_INV, size)]
    return _powers


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hash of each slice ``values[start:end]`` (uint64 values)."""
    fwd, inv = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * fwd[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inv[starts] + (ends - starts).astype(np.uint64)
               * np.uint64(0xD6E8FEB86659FD93) + np.uint64(salt))


def byte_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte slice ``data[start:end]``."""
    return range_hash(_BYTE_VALUE[data], starts, ends)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1, from 0) of a string array; null is empty."""
    arr = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = arr.buffers()
    offsets = np.frombuffer(bufs[1], np.int64)[arr.offset:arr.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most ``size`` bytes (one document at least)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


class Words:
    """The words of consecutive documents.

    ``start``/``end``: byte range of each word in ``data``; ``doc``: the index
    of its document; ``first``: index of each document's first word (n + 1).
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word_class: np.ndarray,
                 fold: np.ndarray = SAME) -> None:
        self.data, self.offsets, self.fold = data, offsets, fold
        n = len(data)
        is_word = np.zeros(n + 2, dtype=bool)
        is_word[1:-1] = word_class[data]
        border = np.zeros(n + 1, dtype=bool)
        border[offsets] = True
        inside, before = is_word[1:], is_word[:-1]
        self.start = np.flatnonzero(inside[:n] & (~before[:n] | border[:n]))
        self.end = np.flatnonzero(before[1:] & (~inside[1:] | border[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64-bit hash of every (folded) word."""
        return byte_hash(self.fold[self.data], self.start, self.end)


def windows(first: np.ndarray, length: int) -> np.ndarray:
    """Start index of every run of ``length`` consecutive words of one document."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    begin = np.repeat(first[:-1], counts)
    return begin + np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as the longs Spark stores."""
    return x.view(np.int64)
