"""Vectorised text kernels over Arrow batches: word boundaries, hashes, rolling windows.

Everything works on one slice of documents at a time: their UTF-8 bytes end to
end and the bounds between them. Arithmetic is modulo 2**64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SLICE_BYTES = 2 << 20
_BYTE_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
_BYTE_CODES = np.random.default_rng(20240501).integers(1, 2**63, 256).astype(np.uint64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)``; grown on demand and kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base % 2**64, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.multiply.accumulate(steps)
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 2**64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the bounds of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row stands alone."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


def rows_of(bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(bounds, at, "right") - 1


class Words:
    """Finds the words of a slice: runs of bytes that are no separator."""

    def __init__(self, separators: tuple[int, ...] = SPACES, lower: bool = False):
        self.is_separator = np.zeros(256, bool)
        self.is_separator[list(separators)] = True
        self.codes = _BYTE_CODES.copy()
        if lower:
            self.codes[ord("A") : ord("Z") + 1] = self.codes[ord("a") : ord("z") + 1]

    def bounds(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the words; none crosses a row."""
        if not len(data):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        inside = ~self.is_separator[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[bounds] = True
        before = np.empty(len(data), bool)
        before[0] = True
        np.logical_not(inside[:-1], out=before[1:])
        starts = np.flatnonzero(inside & (before | cut[:-1]))
        after = np.empty(len(data), bool)
        after[-1] = True
        np.logical_not(inside[1:], out=after[:-1])
        ends = np.flatnonzero(inside & (after | cut[1:])) + 1
        return starts, ends

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * powers(_BYTE_BASE, len(data)), out=sums[1:])
        own = (sums[ends] - sums[starts]) * powers(inverse(_BYTE_BASE), len(data) + 1)[starts]
        return mixed(own + (ends - starts).astype(np.uint64))


def rabin_karp(items: np.ndarray, width: int) -> np.ndarray:
    """Rolling hashes of every ``width`` consecutive items (also across rows)."""
    n = len(items) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    sums = np.zeros(len(items) + 1, np.uint64)
    np.cumsum(items * powers(_WORD_BASE, len(items)), out=sums[1:])
    return mixed((sums[width:] - sums[:n]) * powers(inverse(_WORD_BASE), n))


def byte_items(data: np.ndarray) -> np.ndarray:
    return _BYTE_CODES[data]


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values: block-wise running minima, two passes."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, values.dtype)
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value stands in sorted ``keys``, and whether it does."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return place, keys[place] == wanted


def within(per_row: np.ndarray) -> np.ndarray:
    """0, 1, 2, .. inside each row, for row sizes ``per_row``."""
    ends = np.cumsum(per_row)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - per_row, per_row)


def interval_union(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal intervals covered by windows of ``width`` at sorted ``starts``."""
    if not len(starts):
        return starts, starts
    new = np.flatnonzero(np.concatenate(([True], np.diff(starts) > width)))
    last = np.concatenate((new[1:] - 1, [len(starts) - 1]))
    return starts[new], starts[last] + width
