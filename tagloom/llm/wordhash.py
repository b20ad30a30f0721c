"""Vectorised word splitting and hashing over Arrow string columns.

A chunk of texts is one byte buffer with offsets. Words are maximal runs of bytes outside a separator set; a word's
64-bit hash is a polynomial over its bytes, read from prefix sums, so no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text makes a chunk of its own.
CHUNK = 1 << 19
#: Bytes of a longer text whose words are hashed at once; arrays as long as bytes are never larger, but for longer words.
PIECE = 1 << 20
_B = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


@lru_cache(maxsize=24)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i up to n."""
    up, down = np.full(n + 1, base & _MASK, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int, base: int = _B) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(16, int(n).bit_length()), base)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser; equal in, equal out."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def chunks(column: pa.Array | pa.ChunkedArray, size: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of pieces of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        end = min(end, n)
        yield at, raw[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False, space: np.ndarray = _SPACE, also: np.ndarray | None = None):
    """(hash of each word, first word of each text and one past the last, word starts, word ends).

    also: a class per byte; where two neighbours' classes differ a word ends as well.
    """
    n = len(data)
    if n <= PIECE:
        return _words(data, offsets, lower, space, also)
    found, at = [], 0
    while at < n:
        # Pieces end behind a separator, or at the end of the word that has none.
        end = min(n, at + PIECE)
        if end < n:
            gaps = np.flatnonzero(space[data[at:end]])
            while not len(gaps) and end < n:
                ahead = np.flatnonzero(space[data[end : end + PIECE]])
                gaps = ahead[:1] + end - at
                end = min(n, end + PIECE)
            end = at + int(gaps[-1]) + 1 if len(gaps) else n
        inner = offsets[(offsets > at) & (offsets < end)] - at
        h, _, starts, ends = _words(data[at:end], np.concatenate(([0], inner, [end - at])), lower, space, also)
        found.append((h, starts + at, ends + at))
        at = end
    h, starts, ends = (np.concatenate(x) for x in zip(*found, strict=True))
    return h, np.searchsorted(starts, offsets), starts, ends


def _words(data: np.ndarray, offsets: np.ndarray, lower: bool, space: np.ndarray, also: np.ndarray | None):
    n = len(data)
    bounds = np.zeros(len(offsets), np.int64)
    if not n:
        return np.zeros(0, np.uint64), bounds, np.zeros(0, np.int64), np.zeros(0, np.int64)
    if lower:
        data = _LOWER[data]
    sp = space[data]
    first, last = np.empty(n, bool), np.empty(n, bool)
    first[0], last[-1] = True, True
    first[1:], last[:-1] = sp[:-1], sp[1:]
    if also is not None:
        kind = also[data]
        turn = kind[1:] != kind[:-1]
        first[1:] |= turn
        last[:-1] |= turn
    inner = offsets[(offsets > 0) & (offsets < n)]
    first[inner], last[inner - 1] = True, True
    starts, ends = np.flatnonzero(first & ~sp), np.flatnonzero(last & ~sp) + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[:n], out=sums[1:])
    h = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    bounds = np.searchsorted(starts, offsets)
    return h, bounds, starts, ends


def prefixes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the words longer than k bytes, hash of their first k bytes), apart from all whole words' hashes."""
    at = np.flatnonzero(ends - starts > k)
    up, _ = powers(k)
    h = np.zeros(len(at), np.uint64)
    for i in range(k):
        byte = data[starts[at] + i]
        h += _TABLE[_LOWER[byte] if lower else byte] * up[i]
    return at, mix(h + np.uint64(0x2545F4914F6CDD1D + k))


def runs(h: np.ndarray, k: int, base: int = 0xA24BAED4963EE407) -> np.ndarray:
    """Hash of each k consecutive words, by first word; max(0, len - k + 1) of them, over text borders too."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = powers(n, base)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: n - k + 1])


def within(bounds: np.ndarray, k: int, n: int) -> np.ndarray:
    """Which of the n-k+1 runs of k words stay inside one text."""
    ok = np.zeros(max(0, n - k + 1), bool)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= k:
            ok[a : b - k + 1] = True
    return ok


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
