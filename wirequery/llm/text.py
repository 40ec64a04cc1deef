"""Vectorised byte-level text work over Arrow string arrays: words, hashes, shingles.

All functions work on UTF-8 bytes in NumPy. Words are maximal runs of bytes that are neither 0x20 nor 0x09-0x0D;
A-Z count as a-z. Work is done in slices of about SLICE bytes, so memory is bounded by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
_P = 0x9E3779B97F4A7C15 | 1
_INV = pow(_P, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(2)
def _values(fold: bool = True) -> np.ndarray:
    """A random 64-bit value for each byte, if fold A-Z as a-z."""
    out = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
    if fold:
        out[65:91] = out[97:123]
    return out


_pows: list[np.ndarray] = [np.ones(0, np.uint64)] * 2


def _powers(n: int) -> list[np.ndarray]:
    if len(_pows[0]) <= n:
        size = 1 << max(17, int(n + 1).bit_length())
        for i, base in enumerate((_P, _INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _pows[i] = np.multiply.accumulate(x)
    return _pows


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def raw(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def slices(offs: np.ndarray, size: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` bytes in all, one text at least."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + size, "right")) - 1)
        yield i, j
        i = j


def spans(word: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first run of each text and the total) of the runs of True that lie in one text."""
    n = len(word)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.concatenate(([False], word[:-1]))
    after = np.concatenate((word[1:], [False]))
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offs)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hash of each byte range, if fold A-Z as a-z."""
    pw, inv = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_values(fold)[data] * pw[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, starts, ends, first word of each text and the total)."""
    starts, ends, first = spans(~SPACE[data], offs)
    return hashes(data, starts, ends), starts, ends, first


def grams(h: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of every n-word gram; a text of 1 to n-1 words gives its whole sequence as one."""
    counts = np.diff(first)
    doc = np.repeat(np.arange(len(counts)), counts)
    w = len(h)
    if w >= n:
        acc = np.zeros(w - n + 1, np.uint64)
        for k in range(n):
            acc = acc * np.uint64(0xD6E8FEB86659FD93) + h[k : w - n + 1 + k]
        ok = doc[: w - n + 1] == doc[n - 1 :]
        out, owner = mix(acc[ok]), doc[: w - n + 1][ok]
    else:
        out, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        more = np.zeros(len(short), np.uint64)
        for k in range(n - 1):
            has = counts[short] > k
            more[has] = more[has] * np.uint64(0xD6E8FEB86659FD93) + h[first[short[has]] + k]
        out = np.concatenate((out, mix(more + counts[short].astype(np.uint64) * np.uint64(_P))))
        owner = np.concatenate((owner, short))
    return out, owner


def distinct(value: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (value, owner) pairs, sorted by owner, then value."""
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value) == 0:
        return value, owner
    keep = np.concatenate(([True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])))
    return value[keep], owner[keep]
