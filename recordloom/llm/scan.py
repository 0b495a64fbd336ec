"""Vectorised scans of whole texts: words, lines and their hashes, straight from Arrow's byte buffers.

A word is a longest run of bytes other than 0x20 and 0x09 to 0x0D. All positions are bytes of UTF-8. Hashes are 64 bits
wide and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
SEGMENT = 1 << 19  # bytes hashed at once; bounds the memory, not the text

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below `size`, kept for the next call."""
    if len(_powers[0]) < size:
        for at, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            factors = np.full(size, base, dtype=np.uint64)
            factors[0] = 1
            _powers[at] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def span_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of buffer[start:end] for each of the ascending, disjoint spans."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + SEGMENT, side="right")))
        low, high = int(starts[first]), int(ends[last - 1])
        power, inverse = _power_tables(max(SEGMENT, high - low) + 1)
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((buffer[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=sums[1:])
        begin = starts[first:last] - low
        out[first:last] = (sums[ends[first:last] - low] - sums[begin]) * inverse[begin]
        first = last
    lengths = (ends - starts).astype(np.uint64)
    return mixed(out + lengths * np.uint64(0xA24BAED4963EE407))


def word_spans(buffer: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and for each text of `bounds` the number of words before it (one entry more than texts)."""
    inside = ~SPACE[buffer]
    edge = np.zeros(len(buffer) + 1, dtype=bool)
    edge[bounds] = True
    edge[0] = edge[-1] = True
    begins = inside & edge[:-1]
    begins[1:] |= inside[1:] & ~inside[:-1]
    finishes = inside & edge[1:]
    finishes[:-1] |= inside[:-1] & ~inside[1:]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, bounds)


def blocks(column: pa.Array, size: int = 2 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `size` bytes: first and last row, bytes, and bounds of the texts in them.

    A null counts as an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1)
        yield first, last, whole[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last
