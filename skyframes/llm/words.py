"""Words of many texts at once, as NumPy arrays over the bytes of an Arrow column.

A piece is some rows of a batch whose texts hold about PIECE bytes together, so the arrays stay
small whatever the batch size. One text is never cut: memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20

# fixed values: the bytes between words
BLANKS = np.zeros(256, bool)
BLANKS[[9, 10, 11, 12, 13, 32]] = True

_random = np.random.default_rng(20240229)
_BYTES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_BYTES[BLANKS] = 0
_FOLDED[BLANKS] = 0
_POWER = np.uint64(0x9E3779B97F4A7C15)
_SALTS = _random.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that looks random; another one for each salt below 64."""
    h = h ^ _SALTS[salt]
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    p = np.full(n, _POWER)
    p[0] = 1
    return np.multiply.accumulate(p)


class Piece:
    """Texts start .. stop of an Arrow string array; a null text is empty."""

    def __init__(self, column: pa.Array, start: int, stop: int):
        self.start, self.n = start, stop - start
        column = column.slice(start, self.n)
        wide = pa.types.is_large_string(column.type)
        at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
        at = at[column.offset : column.offset + self.n + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        self.data, self.at = data[at[0] : at[-1]], at - at[0]
        if column.null_count:
            none = np.asarray(column.is_null())
            size = np.diff(self.at)
            if size[none].any():  # bytes under a null are not part of it
                self.data = self.data[np.repeat(~none, size)]
                self.at = np.concatenate([[0], np.cumsum(np.where(none, 0, size))])

    def split(self, blanks: np.ndarray = BLANKS) -> Piece:
        """Find words: starts, ends (byte positions), doc (row of each word), first (n + 1 word offsets)."""
        full = ~blanks[self.data]
        edges = self.at[:-1][self.at[:-1] < len(full)]
        before = np.empty_like(full)
        before[:1], before[1:] = False, full[:-1]
        before[edges] = False
        self.starts = np.flatnonzero(full & ~before)
        after = np.empty_like(full)
        after[-1:], after[:-1] = False, full[1:]
        after[edges[edges > 0] - 1] = False
        self.ends = np.flatnonzero(full & ~after) + 1
        self.first = np.searchsorted(self.starts, self.at)
        self.doc = np.repeat(np.arange(self.n), np.diff(self.first))
        return self

    def hashes(self, folded: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; folded: A-Z count as a-z."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        lead = self.starts[0]
        value = (_FOLDED if folded else _BYTES)[self.data[lead:]]
        gaps = np.diff(self.starts, append=len(self.data))
        value *= _powers(int(gaps.max()))[np.arange(lead, len(self.data)) - np.repeat(self.starts, gaps)]
        h = np.add.reduceat(value, self.starts - lead)
        return mixed(h + (self.ends - self.starts).astype(np.uint64))

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Sums of a number per byte, for each text."""
        total = np.concatenate([[0], np.cumsum(per_byte, dtype=np.int64)])
        return total[self.at[1:]] - total[self.at[:-1]]

    def words(self, row: int) -> list[bytes]:
        raw = self.data.data
        return [bytes(raw[s:e]) for s, e in zip(self.starts[self.first[row] : self.first[row + 1]], self.ends[self.first[row] : self.first[row + 1]])]


def grams(h: np.ndarray, doc: np.ndarray, k: int, salt: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words of one text, and the positions of their first words."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g = np.zeros(n, np.uint64)
    for j in range(k):
        g = g * _SALTS[salt] + h[j : j + n]
    at = np.flatnonzero(doc[:n] == doc[k - 1 :])
    return mixed(g[at], salt), at


def pieces(column: pa.Array, most: int = PIECE) -> Iterator[Piece]:
    """Cut a string column into pieces of whole texts."""
    if pa.types.is_large_string(column.type):
        size = np.frombuffer(column.buffers()[1], np.int64)
    elif pa.types.is_string(column.type):
        size = np.frombuffer(column.buffers()[1], np.int32) if len(column) else np.zeros(1, np.int32)
    else:
        raise TypeError(f"text must be a string column, not {column.type}")
    at = size[column.offset : column.offset + len(column) + 1].astype(np.int64)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
        yield Piece(column, start, min(stop, len(column)))
        start = min(stop, len(column))


def code_points(data: np.ndarray) -> np.ndarray:
    """True for each byte that starts a UTF-8 code point."""
    return (data & 0xC0) != 0x80
