"""Word and shingle hashing over Arrow string columns, vectorised with numpy.

Everything here works on the UTF-8 bytes of a whole Arrow batch at once. Words are maximal runs of
bytes other than the space and the controls 0x09-0x0D; all of those are ASCII, so splitting bytes is
the same as splitting code points. A null text has no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_M = (1 << 64) - 1
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed together; temporary arrays take eight bytes for each, and so do the powers that a worker keeps.
CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_BYTES_LOWER = _BYTES[_LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class _Powers:
    """Powers of the base and of its inverse, grown when a longer run of bytes needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 12)
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)


_POWERS = _Powers()


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8), at - at[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the index of its first word (one more at the end)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~WHITE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edge - 1] = inside[edge - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of bytes. Spans are in order and don't overlap."""
    out, table, i = np.empty(len(starts), np.uint64), _BYTES_LOWER if lower else _BYTES, 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        _POWERS.reach(b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum(table[data[a:b]] * _POWERS.up[: b - a], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * _POWERS.down[s]
        i = j
    return mix(out ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n consecutive word hashes."""
    k = len(words) - n + 1
    if k <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(k, np.uint64)
    for i in range(n):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + words[i : i + k]
    return mix(out)


def shingle_sets(texts: pa.Array, n: int = 5) -> list[np.ndarray]:
    """The sorted distinct n-word shingles of each text, as 64-bit hashes; the whole sequence where there are fewer words."""
    data, offsets = buffers(texts)
    out, i = [], 0
    while i + 1 < len(offsets):  # a few texts at a time, for the temporary arrays' sake
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + 4 * CHUNK, "right")) - 1)
        out += _shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
        i = j
    return out


def _shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    starts, ends, rows = spans(data, offsets)
    words = hashes(data, starts, ends)
    every = windows(words, n)
    out = []
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if b - a >= n:
            out.append(np.unique(every[a : b - n + 1]))
        else:
            out.append(windows(words[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out
