"""Vectorised word work on Arrow string columns (numpy, inside tasks).

Words are maximal runs of bytes of a class; each gets a 64-bit hash that does
not depend on its place.  Work goes through slices of about ``SLICE`` bytes,
so memory follows the slice (or the longest single text), never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
U64 = np.uint64
FILL = U64(0x9E3779B97F4A7C15)
_BASE = 0xD1342543DE82EF95
_BASE_INV = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*spans: tuple[int, int], invert: bool = False) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in spans:
        t[a:b + 1] = True
    return ~t if invert else t


# words [^\x20\x09-\x0D]+ and [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (after lower-casing)
NOT_SPACE = byte_class((0x20, 0x20), (0x09, 0x0D), invert=True)
ALNUM = byte_class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F), invert=True)


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xA0761D6478BD642F)
    x ^= x >> U64(32)
    return x


@lru_cache(1)
def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=U64) * FILL)


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SLICE * 2, 1 << int(n).bit_length())
    if size not in _powers:
        if size > 2 * SLICE:  # a rare very long word: not worth keeping
            return _make_powers(size)
        _powers[size] = _make_powers(size)
    return _powers[size]


def _make_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, _BASE_INV):
        p = np.full(size, base, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Words(NamedTuple):
    """Words of rows ``first`` .. ``first + len(counts) - 1`` of a batch."""
    first: int
    hash: np.ndarray     # uint64, one per word
    start: np.ndarray    # byte place in ``buf``
    end: np.ndarray
    counts: np.ndarray   # words per row
    buf: np.ndarray      # bytes of these rows, lower-cased if asked

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.counts)])


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return raw(col.cast(pa.large_string()).fill_null(""))


def raw(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column without nulls."""
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1 + col.offset)[col.offset:]
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def row_slices(off: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer single row goes alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def hash_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans ascend and do not overlap."""
    out = np.empty(len(start), U64)
    values = _byte_values()
    i = 0
    while i < len(start):
        a = int(start[i])
        j = max(int(np.searchsorted(end, a + SLICE, side="right")), i + 1)
        b = int(end[j - 1])
        pw, inv = _power_tables(b - a)
        pre = np.empty(b - a + 1, U64)
        pre[0] = 0
        np.cumsum(values[buf[a:b]] * pw[:b - a], out=pre[1:])
        s, e = start[i:j] - a, end[i:j] - a
        h = (pre[e] - pre[s]) * inv[s]
        out[i:j] = mix64(h + (e - s).astype(U64) * FILL)
        i = j
    return out


def spans_of(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal true runs, cut at ``bounds`` (places where a row begins)."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inner = bounds[(bounds > 0) & (bounds < n)]
    prev = np.empty(n, bool)
    prev[0] = False
    prev[1:] = mask[:-1]
    prev[inner] = False
    nxt = np.empty(n, bool)
    nxt[-1] = False
    nxt[:-1] = mask[1:]
    nxt[inner - 1] = False
    return np.flatnonzero(mask & ~prev), np.flatnonzero(mask & ~nxt) + 1


def words(col: pa.Array, kind: np.ndarray = NOT_SPACE, lower: bool = True,
          limit: int = SLICE) -> Iterator[Words]:
    """Words of every whole text of a column, slice by slice."""
    data, off = utf8(col)
    for i, j in row_slices(off, limit):
        buf = data[off[i]:off[j]]
        if lower:
            buf = LOWER[buf]
        bounds = off[i:j + 1] - off[i]
        s, e = spans_of(kind[buf], bounds[:-1])
        counts = np.diff(np.searchsorted(s, bounds))
        yield Words(i, hash_spans(buf, s, e), s, e, counts, buf)


_MULT = mix64(np.arange(1, 65, dtype=U64) * U64(0xC2B2AE3D27D4EB4F)) | U64(1)


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words (no row borders)."""
    if len(h) < n:
        return np.zeros(0, U64)
    acc = np.zeros(len(h) - n + 1, U64)
    for k in range(n):
        acc += h[k:len(h) - n + 1 + k] * _MULT[k % 64]
        if k % 64 == 63:
            acc = mix64(acc)
    return mix64(acc)


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row-ordered ``n``-word shingle hashes and their counts per row.

    A row of fewer words, but not none, is one shingle of the whole sequence.
    """
    off = w.offsets
    counts = np.where(w.counts == 0, 0, np.maximum(w.counts - n + 1, 1))
    if not counts.sum():
        return np.zeros(0, U64), counts
    padded = np.concatenate([w.hash, np.full(n, FILL, U64)])
    every = window_hashes(padded, n)
    out_off = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(off[:-1] - out_off[:-1], counts) + np.arange(out_off[-1])
    out = every[at]
    for r in np.flatnonzero((w.counts > 0) & (w.counts < n)):
        own = np.full(n, FILL, U64)
        own[:w.counts[r]] = w.hash[off[r]:off[r + 1]]
        out[out_off[r]] = window_hashes(own, n)[0]
    return out, counts
