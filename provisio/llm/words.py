"""Words of whole Arrow text columns as numpy arrays: positions, hashes, windows.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. UTF-8 never uses those bytes inside a
longer character, so splitting bytes and splitting characters give the same words. Null texts
have no words. All work is done in blocks of bounded size, so that one long text or one large
batch does not multiply the memory of a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 2 << 20  # bytes of text that are split at once (one row may be longer)
BLOCK = 1 << 18  # bytes that are hashed at once

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUES = np.zeros(256, bool)  # second and later bytes of a UTF-8 character
CONTINUES[0x80:0xC0] = True

U = np.uint64
_ODD = (U(0x9E3779B97F4A7C15), U(0xD1B54A32D192ED03))
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTES = tuple(mix(np.arange(256, dtype=np.uint64) + U(1 + 1000 * lane)) for lane in range(2))


def _powers(n: int, lane: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if lane not in _POWERS or len(_POWERS[lane][0]) < n:
        size, odd = max(n, 2 * BLOCK), int(_ODD[lane])
        inverse = pow(odd, -1, 1 << 64)
        tables = []
        for base in (odd, inverse):
            steps = np.full(size, U(base))
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=np.uint64))
        if size > 8 * BLOCK:  # a word of megabytes: not worth keeping
            return tables[0], tables[1]
        _POWERS[lane] = (tables[0], tables[1])
    return _POWERS[lane]


class Words:
    """Words of the rows ``lo`` to ``hi`` of a batch."""

    def __init__(self, lo: int, offsets: np.ndarray, buf: np.ndarray):
        self.lo, self.hi = lo, lo + len(offsets) - 1
        self.buf, self.offsets = buf, offsets
        inside = ~SPACE[buf]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(buf))]
        starts[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.inside = inside
        self.start, self.end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        #: index of the first word of each row, then the number of words
        self.first = np.searchsorted(self.start, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """Row (from 0 at ``lo``) of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lane: int = 0) -> np.ndarray:
        return hash_ranges(self.buf, self.start, self.end, lane)


def hash_ranges(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """64-bit hash of the bytes in each of the ascending, disjoint ranges."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(start, start[at] + BLOCK)))
        low, high = int(start[at]), int(end[at:to].max())
        up, down = _powers(high - low + 1, lane)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTES[lane][buf[low:high]] * up[: high - low], out=sums[1:])
        s, e = start[at:to] - low, end[at:to] - low
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * _ODD[1 - lane])
        at = to
    return out


def as_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column, nulls as empty texts."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    elif pa.types.is_string(texts.type) or pa.types.is_binary(texts.type):
        kind = np.int32
    else:
        return as_bytes(texts.cast(pa.string()))
    _, offsets, data = texts.buffers()
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0] : offsets[-1]]


def split(texts, lower: bool = False, piece: int = PIECE) -> Iterator[Words]:
    """Words of a text column, a bounded number of bytes at a time."""
    offsets, data = as_bytes(texts)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + piece, side="right")) - 1)
        buf = data[offsets[lo] : offsets[hi]]
        yield Words(lo, offsets[lo : hi + 1] - offsets[lo], LOWER[buf] if lower else buf)
        lo = hi


def windows(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``k`` words that stays inside one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    last = np.repeat(first[1:], np.diff(first))[:n]
    at = np.flatnonzero(np.arange(k, n + k) <= last)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _ODD[0] + hashes[j : n + j]
    return mix(out[at] + U(k)), at


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every ``k``-word shingle; a row of fewer words is one shingle."""
    value, at = windows(hashes, first, k)
    row = np.searchsorted(first, at, side="right") - 1
    counts = np.diff(first)
    values, rows = [value], [row]
    for short in range(1, k):
        which = np.flatnonzero(counts == short)
        if len(which):
            out = np.zeros(len(which), np.uint64)
            for j in range(short):
                out = out * _ODD[0] + hashes[first[which] + j]
            values.append(mix(out + U(short)))
            rows.append(which)
    return np.concatenate(values), np.concatenate(rows)


def distinct_sets(value: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row, end to end, and the first index of each row."""
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    keep = np.ones(len(value), bool)
    keep[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[keep], row[keep]
    return value, np.searchsorted(row, np.arange(n_rows + 1))


def rolling(buf: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of the ``k`` bytes at every position, equal to ``hash_ranges`` of the same bytes."""
    n = len(buf) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(buf) + 1, lane)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTES[lane][buf] * up[: len(buf)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * down[:n] + U(k * int(_ODD[1 - lane]) % (1 << 64)))
