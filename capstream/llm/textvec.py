"""Texts of an Arrow batch as one byte array, and its words, for vectorised passes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: UTF-8 bytes looked at together; a longer text is a slice of its own.
AT_ONCE = 2 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Weights of a word's (or line's) first bytes in its hash; later bytes use them again.
POWERS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, np.uint64))


def slices(texts: pa.Array, at_once: int = AT_ONCE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row starts in the bytes); NULL is empty. ``texts``: a string array."""
    texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    start = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(start, start[i] + at_once, "right")) - 1)
        yield i, j, data[start[i]:start[j]], start[i:j + 1] - start[i]
        i = j


def words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of every run of bytes between white space (runs end at a row's end)."""
    inside = ~SPACE[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    cuts = starts[:-1][starts[:-1] < len(data)]
    before[cuts] = False
    begin = np.flatnonzero(inside & ~before)
    last = np.zeros(len(data), bool)
    if len(data):
        last[:-1] = ~inside[1:]
        last[-1] = True
        last[starts[1:][starts[1:] > 0] - 1] = True
    end = np.flatnonzero(inside & last) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every span; spans are in order and do not overlap."""
    if not len(begin):
        return np.zeros(0, np.uint64)
    length = end - begin
    at = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    values = (data[at + np.repeat(begin, length)].astype(np.uint64) + np.uint64(1)) * POWERS[at & 1023]
    return np.add.reduceat(values, np.cumsum(length) - length) if (length > 0).all() else _with_empty(values, length)


def _with_empty(values: np.ndarray, length: np.ndarray) -> np.ndarray:
    out = np.zeros(len(length), np.uint64)
    full = length > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(length) - length)[full])
    return out


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of ``values`` (one per byte) over each row."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[starts[1:]] - total[starts[:-1]]
