"""Words, lines and word windows of many texts at once, as 64-bit fingerprints over the bytes of an Arrow buffer.

A fingerprint is a polynomial over the bytes of a word modulo 2**64, with a random weight per byte value, and a final
mixing step. Fingerprints are the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from trendspark.llm.arrow import STEP_BYTES, raw_text, steps

_WEIGHTS = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_set(members: bytes | range) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


# Bytes of words: all but the space and the control characters 9 to 13.
WORD_BYTES = ~byte_set(b"\x20\x09\x0a\x0b\x0c\x0d")
# Bytes of the first byte of a code point.
LEADING_BYTES = ~byte_set(range(0x80, 0xC0))
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept per process up to the longest text seen."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20) + 1
        _POWERS[:] = [_power_run(b, size) for b in (_BASE, _BASE_INVERSE)]
    return _POWERS[0][:n], _POWERS[1][:n]


def _power_run(base: int, size: int) -> np.ndarray:
    out = np.empty(size, np.uint64)
    out[0] = 1
    filled, step = 1, base
    while filled < size:
        n = min(filled, size - filled)
        out[filled : filled + n] = out[:n] * np.uint64(step)
        filled += n
        step = step * step % (1 << 64)
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_prints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of disjoint ascending byte spans of ``data``, some bytes at a time."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + STEP_BYTES, side="right"))
        last = max(last, first + 1)
        low, high = starts[first], ends[last - 1]
        out[first:last] = _near_prints(data[low:high], starts[first:last] - low, ends[first:last] - low)
        first = last
    return out


def _near_prints(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverse = _powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_WEIGHTS[data] * powers, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


@dataclass(frozen=True)
class Texts:
    """Some rows of a text column: their bytes, the offsets of the rows, and the first row's number."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def rows_of(self, places: np.ndarray) -> np.ndarray:
        """Row of each byte place, which must be ascending."""
        return np.searchsorted(self.offsets, places, side="right") - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """Number of set flags in each row; one flag per byte."""
        if len(self) == 1:
            return np.array([np.count_nonzero(flags)])
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of set flags; a run ends with its row."""
        if not len(inside):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        bounds = self.offsets[(self.offsets > 0) & (self.offsets < len(inside))]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[bounds] = inside[bounds]
        closes[:-1] &= ~inside[1:]
        closes[bounds - 1] = inside[bounds - 1]
        return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def texts(column: pa.Array) -> Iterator[Texts]:
    """A text column in steps of bounded size; nulls are empty."""
    data, offsets = raw_text(column)
    for first, last in steps(offsets):
        at = offsets[first : last + 1]
        yield Texts(data[at[0] : at[-1]], at - at[0], first)


def window_prints(prints: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all runs of ``size`` words inside one row, and the number of each run's first word."""
    n = len(prints) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(_BASE) + prints[k : k + n]
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return mix(out[at]), at


def row_hash(rows: np.ndarray, prints: np.ndarray) -> np.ndarray:
    """Fingerprints that differ between rows."""
    return mix(prints + mix(rows.astype(np.uint64) + np.uint64(1)))
