"""Words and their hashes for whole Arrow batches, without a loop over words.

A word is a run of characters other than space, tab, line feed, vertical tab,
form feed and carriage return.  All of those are single bytes in UTF-8, so words
can be found in the bytes themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORD = r"[^\x20\x09-\x0D]+"

_SOLID = np.ones(256, bool)
_SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD1342543DE82EF95)
_powers = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 output bits; one to one."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 … base ** (n - 1), modulo 2 ** 64."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        known = np.cumprod(np.full(size, base, np.uint64))
        known = np.concatenate([np.ones(1, np.uint64), known[:-1]])
        if size <= 1 << 23:  # those of a giant text are not kept
            _powers[int(base)] = known
    return known[:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after another, and where each row begins (one more entry than rows). Null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]] if len(column) else whole[:0], (offsets - offsets[0]).copy()


def portions(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes; a longer row is a range of its own."""
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, min(hi, rows)
        lo = min(hi, rows)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last one, and row of every word."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    solid = _SOLID[data]
    filled = offsets[:-1] < offsets[1:]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    begins, ends = offsets[:-1][filled], offsets[1:][filled] - 1
    first[begins], last[ends] = solid[begins], solid[ends]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(offsets, start, side="right") - 1


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes; equal words have equal ones wherever they stand."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=total[1:])
    return mix((total[end] - total[start]) * powers(_BASE_INVERSE, len(data) + 1)[start])


def ngram_hashes(words: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n words in a row, and the index of the first of them; none crosses rows."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(row[:count] == row[n - 1:])
    h = words[at].copy()
    for k in range(1, n):
        h *= _STEP
        h += words[at + k]
    return mix(h), at
