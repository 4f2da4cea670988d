"""Words and hashes of many texts at once, on the UTF-8 bytes of an Arrow batch.

Words are ``[^\\x20\\x09-\\x0D]+``: in UTF-8 these separators are single bytes that occur nowhere
inside another character, so bytes are enough. A hash is a polynomial over the bytes (or words)
modulo 2**64, taken from prefix sums and then mixed, so it needs no loop over texts or words.
Equal hashes stand for equal contents: with 64 bits two different ones among n agree with odds of n**2 / 2**65.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# odd, so that it has an inverse modulo 2**64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 ... base**n modulo 2**64; what a usual piece needs is kept for the next call, more is not."""
    if base in _powers and len(_powers[base]) > n:
        return _powers[base]
    usual = PIECE_BYTES + (PIECE_BYTES >> 4)
    steps = np.full(max(n, usual) + 1, base, np.uint64)
    steps[0] = 1
    powers = np.cumprod(steps, dtype=np.uint64)
    if n <= usual:
        _powers[base] = powers
    return powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words in which each bit depends on all."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def planes(values: np.ndarray) -> bytes:
    """The values' first bytes, then their second ones, and so on: high bytes are mostly 0 and compress well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def prefix_sums(values: np.ndarray, base: int = _BASE) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * _power(base, len(values))[: len(values)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hashes of the spans [start, end); equal spans have equal hashes wherever they stand."""
    inverse = _INVERSE if base == _BASE else pow(base, -1, 1 << 64)
    raw = (sums[ends] - sums[starts]) * _power(inverse, len(sums))[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Piece:
    """Some whole texts: rows [first, first + n) of the batch."""

    first: int
    n: int
    data: np.ndarray  # bytes of all texts
    offsets: np.ndarray  # n + 1 text borders
    starts: np.ndarray  # of each word
    ends: np.ndarray
    words_at: np.ndarray  # n + 1 borders of the texts' words
    hashes: np.ndarray  # of each word

    def word_text(self) -> np.ndarray:
        """The text number of each word."""
        return np.repeat(np.arange(self.n), np.diff(self.words_at))

    def per_text(self, values: np.ndarray, borders: np.ndarray) -> np.ndarray:
        """Sums of the values between each text's borders."""
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        return sums[borders[1:]] - sums[borders[:-1]]

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows of ``size`` words of one text."""
        last = np.repeat(self.words_at[1:], np.diff(self.words_at)) - size
        at = np.arange(len(self.starts))
        return at[at <= last]

    def window_hashes(self, at: np.ndarray, size: int | np.ndarray, base: int = _BASE) -> np.ndarray:
        return span_hashes(prefix_sums(self.hashes, base), at, at + size, base)


def text_pieces(column: pa.Array, lower: bool = False, piece_bytes: int = PIECE_BYTES) -> Iterator[Piece]:
    """The texts of an Arrow column in pieces of about ``piece_bytes``; null counts as empty.

    A text is never cut: a longer one is a piece of its own, so the memory needed is some 40
    bytes per byte of the longest text.
    """
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        stop = max(first + 1, int(np.searchsorted(offsets, offsets[first] + piece_bytes, "right")) - 1)
        stop = min(stop, n)
        yield _piece(first, data[offsets[first] : offsets[stop]], offsets[first : stop + 1] - offsets[first], lower)
        first = stop


def _piece(first: int, data: np.ndarray, offsets: np.ndarray, lower: bool) -> Piece:
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(inside[1:] & (~inside[:-1] | border))
    ends = np.flatnonzero(inside[:-1] & (~inside[1:] | border))
    hashes = span_hashes(prefix_sums(data.astype(np.uint16) + np.uint16(1)), starts, ends)
    return Piece(first, len(offsets) - 1, data, offsets, starts, ends, np.searchsorted(starts, offsets), hashes)
