"""Vectorised text primitives over Arrow batches: words, word hashes, shingles.

All functions take the bytes of a run of texts and their offsets, so that a batch is
handled by a few numpy passes. Work is cut into slices of about ``SLICE`` bytes (a longer
text is a slice of its own), which bounds memory."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
IS_WORD = ~_SPACES
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * U(_BASE))


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def column(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a text column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], col.type)
    if pa.types.is_null(col.type):
        col = col.cast(pa.string())
    if pa.types.is_string(col.type) or pa.types.is_large_string(col.type):
        col = pc.fill_null(col, "")
    else:
        col = pc.fill_null(col, b"")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = col.buffers()
    offs = np.frombuffer(at, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def slices(offs: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes together, or one longer text."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the index of its first word (one more entry at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    m = IS_WORD[data]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    full = offs[1:] > offs[:-1]
    at, to = offs[:-1][full], offs[1:][full] - 1
    first[at], last[to] = m[at], m[to]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, chunk: int = 1 << 19) -> np.ndarray:
    """64-bit hashes of byte spans that follow each other without overlap."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + chunk, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        power, inverse = _powers(max(19, (b - a).bit_length()))
        terms = np.empty(b - a + 1, np.uint64)
        terms[0] = 0
        np.cumsum(_BYTE[data[a:b]] * power[: b - a], out=terms[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix(((terms[e] - terms[s]) * inverse[s]) + (e - s).astype(np.uint64))
        i = j
    return out


def shingles(h: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of each run of ``k`` word hashes; fewer words: one hash of all."""
    if not len(h):
        return h
    k = min(k, len(h))
    s = h[: len(h) - k + 1].copy()
    for j in range(1, k):
        s = s * U(_BASE) + h[j : len(h) - k + 1 + j]
    return mix(s + U(k))


def word_hashes(data: np.ndarray, offs: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words, and first words by text."""
    starts, ends, first = words(data, offs)
    return span_hashes(LOWER[data] if lower else data, starts, ends), starts, ends, first
