"""Texts of an Arrow column as numpy arrays: words, rolling hashes, windows.

Work goes by chunks of whole documents of about CHUNK bytes, so that the temporary arrays stay at some tens of MB
whatever the batch holds; one longer document is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: every bit of the result depends on every bit of x."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
IS_WORD = ~_SPACES
_BYTE = mixed(np.arange(1, 257, dtype=U) * U(0xD1342543DE82EF95))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_powers = np.ones(1, U)
_inverses = np.ones(1, U)


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, CHUNK)
        ones = np.full(size, _BASE, U)
        ones[0] = 1
        _powers = np.multiply.accumulate(ones)
        ones[1:] = _BASE_INVERSE
        _inverses = np.multiply.accumulate(ones)
    return _powers, _inverses


class Chunk:
    """Some documents: `data` (bytes), `off` (n + 1 offsets), `rows` (the slice of the batch they come from)."""

    def __init__(self, data: np.ndarray, off: np.ndarray, rows: slice):
        self.data, self.off, self.rows, self.n = data, off, rows, len(off) - 1
        self._sums = None

    def words(self, of: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and document of every word; of: which bytes make words."""
        n = len(self.data)
        is_word = np.zeros(n + 2, bool)
        is_word[1:-1] = of[self.data]
        edge = np.zeros(n + 1, bool)
        edge[self.off] = True
        start = np.flatnonzero(is_word[1:-1] & (~is_word[:-2] | edge[:-1]))
        end = np.flatnonzero(is_word[1:-1] & (~is_word[2:] | edge[1:])) + 1
        return start, end, self.doc_of(start)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, side="right") - 1

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte spans [start, end)."""
        powers, inverses = _powers_to(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, U)
            np.cumsum(_BYTE[self.data] * powers[: len(self.data)], out=self._sums[1:])
        return mixed((self._sums[end] - self._sums[start]) * inverses[start])

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """How many of the flags, one a byte, are set in each document."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.off[1:]] - total[self.off[:-1]]


def byte_codes(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def sums_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """mixed((sums[e] - sums[s]) * inverses[s]) are the hashes of the spans [s, e) of codes."""
    powers, inverses = _powers_to(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, U)
    np.cumsum(codes * powers[: len(codes)], out=sums[1:])
    return sums, inverses


def row_sums(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of bytes: mixed((sums[:, e] - sums[:, s]) * inverses[s]) are the hashes of the spans [s, e)."""
    powers, inverses = _powers_to(rows.shape[1] + 1)
    sums = np.zeros((rows.shape[0], rows.shape[1] + 1), U)
    np.cumsum(_BYTE[rows] * powers[: rows.shape[1]], axis=1, out=sums[:, 1:])
    return sums, inverses


def chunks(column: pa.Array, lower: bool = False, size: int | None = None) -> Iterator[Chunk]:
    """Null texts are empty. lower: A-Z become a-z."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo, size = 0, size or CHUNK
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, side="right")) - 1)
        part = data[off[lo] : off[hi]]
        yield Chunk(_LOWER[part] if lower else part, off[lo : hi + 1] - off[lo], slice(lo, hi))
        lo = hi


_STEPS = mixed(np.arange(1, 65, dtype=U))


def windows(word_hashes: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words of one document, and the index of the first word of each."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    total = word_hashes[:n] * _STEPS[0]
    for j in range(1, k):
        total += word_hashes[j : j + n] * (_STEPS[j] | U(1))
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mixed(total[at]), at


def repeated(key: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(key)
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = key[order[1:]] == key[order[:-1]] if len(key) > 1 else False
    out = np.zeros(len(key), bool)
    out[order] = same[1:] | same[:-1]
    return out


def covered(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in some span [start, end)."""
    change = np.bincount(start, minlength=n + 1)[: n + 1] - np.bincount(end, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


def signed(x: np.ndarray) -> np.ndarray:
    """uint64 hashes as Spark's longs."""
    return x.view(np.int64)
