"""Words and rolling word-window hashes of whole Arrow columns, in numpy.

A word is a run of bytes outside ``0x20`` and ``0x09-0x0D``.  Hashes are polynomials over 64-bit
table values modulo 2**64, taken from prefix sums, so a window costs the same at every length.
Two different windows meet with a chance of about 2**-60; nothing else is approximate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
SLICE_BYTES = 2_000_000

_rng = np.random.default_rng(20_241)
_EXACT = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_FOLDED = _EXACT.copy()
_FOLDED[65:91] = _EXACT[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xC2B2AE3D27D4EB4F


class _Powers:
    """``base**i`` and ``base**-i`` modulo 2**64; tables beyond a slice are not kept, as workers live on."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = self.up, self.down
        while len(up) <= n:
            k = min(len(up), n + 1 - len(up)) if n > SLICE_BYTES else len(up)
            with np.errstate(over="ignore"):
                up = np.concatenate([up, up[:k] * U64(pow(self.base, len(up), 2**64))])
                down = np.concatenate([down, down[:k] * U64(pow(self.inverse, len(down), 2**64))])
        if n <= SLICE_BYTES:
            self.up, self.down = up[: SLICE_BYTES + 1], down[: SLICE_BYTES + 1]
        return up, down


_BYTES, _WORDS = _Powers(_BYTE_BASE), _Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows of at most ``most`` bytes; a longer row comes alone.

    A null counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in ``data``, and the words before each row (one entry more than rows)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    first[heads] = inside[heads]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = offsets[1:][offsets[1:] > 0] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool) -> np.ndarray:
    """One 64-bit hash per word; ``fold`` lower-cases A-Z."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = _BYTES.upto(len(data))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((_FOLDED if fold else _EXACT)[data] * up[: len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def windows(hashes: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of each window of ``k`` words inside one row."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    up, down = _WORDS.upto(n)
    counts = np.maximum(np.diff(before) - k + 1, 0)
    at = np.arange(counts.sum()) + np.repeat(before[:-1] - (np.cumsum(counts) - counts), counts)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, U64)
        np.cumsum(hashes * up[:n], out=sums[1:])
        return mix((sums[at + k] - sums[at]) * down[at] + U64(k)), at


def whole(hashes: np.ndarray, before: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hash of the whole word sequence of each of ``rows``."""
    lo, hi = before[rows], before[rows + 1]
    up, down = _WORDS.upto(len(hashes))
    with np.errstate(over="ignore"):
        sums = np.zeros(len(hashes) + 1, U64)
        np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
        return mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(U64))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """A bucket from the upper 24 bits."""
    return ((hashes >> U64(40)) * U64(buckets) >> U64(24)).astype(np.int64)


def pack48(values: np.ndarray) -> bytes:
    """The lower 48 bits of each value."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(packed: bytes) -> np.ndarray:
    out = np.zeros((len(packed) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of equal values."""
    if not len(key):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return first, np.diff(np.append(first, len(key)))
