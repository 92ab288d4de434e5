"""Token ids in files of Simple-8b words.

A word of 64 bits holds a selector in its upper four bits and ids of equal width below, first id lowest. Widths are
chosen greedily: the word takes as many of the next ids as fit. An id of 2**30 or more is an escape: a word with the
escape selector whose lower 60 bits hold the id.

A file is a run of blocks, then a table of the blocks (byte offset, words, documents, ids each), then its length and
the magic word. A block holds whole documents: their ids as a column, the numbers of their ids, and the words; words of
a block are decoded together, selector by selector.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np

# Fixed values of the coding: ids per word for each selector, and bits of each; the last selector is the escape.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15
MAGIC = b"TSS8B001"
_FIELD = np.uint64(60)


_SHORT = np.array([max(1, i.bit_length()) for i in range(1 << 16)], np.uint8)


def bit_widths(values: np.ndarray) -> np.ndarray:
    """Bits of each id, one at least."""
    if values.max() < len(_SHORT):
        return _SHORT[values]
    bits = np.ones(len(values), np.uint8)
    for k in range(1, 60):
        bits += values >= np.uint64(1 << k)
    return bits


def encode(values: np.ndarray) -> np.ndarray:
    """The words of a run of unsigned ids below 2**60."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    needed = bit_widths(values)
    # For each place: the selector a word starting there would get, by the widest id among the next few.
    best = np.full(n, len(COUNTS) - 1, np.int64)
    widest, ahead = needed.copy(), 1
    for s in range(len(COUNTS) - 2, -1, -1):
        count, width = COUNTS[s], WIDTHS[s]
        if n < count:
            break
        while ahead < count:
            widest = np.maximum(widest[:-1], needed[ahead:])
            ahead += 1
        fits = widest <= width
        if not fits.any():
            break
        best[: n - count + 1][fits] = s
    counts = np.array(COUNTS)
    taken = counts[best]
    starts, place, step = [], 0, taken.tolist()
    while place < n:
        starts.append(place)
        place += step[place]
    at = np.array(starts)
    chosen = best[at]
    words = np.zeros(len(at), np.uint64)
    for s in np.unique(chosen):
        rows = np.flatnonzero(chosen == s)
        count, width = COUNTS[s], WIDTHS[s]
        first = at[rows]
        packed = np.zeros(len(rows), np.uint64)
        for k in range(count):
            packed |= values[first + k] << np.uint64(k * width)
        words[rows] = packed
    selectors = np.where((chosen == len(COUNTS) - 1), ESCAPE, chosen).astype(np.uint64)
    return words | (selectors << _FIELD)


def decode(words: np.ndarray) -> np.ndarray:
    """The ids of a run of words."""
    words = np.ascontiguousarray(words, np.uint64)
    selectors = (words >> _FIELD).astype(np.int64)
    selectors[selectors == ESCAPE] = len(COUNTS) - 1
    counts = np.array(COUNTS)[selectors]
    ends = np.cumsum(counts)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s in np.unique(selectors):
        rows = np.flatnonzero(selectors == s)
        count, width = COUNTS[s], WIDTHS[s]
        shifts = (np.arange(count, dtype=np.uint64) * np.uint64(width))[None, :]
        mask = np.uint64((1 << width) - 1)
        places = (ends[rows] - count)[:, None] + np.arange(count)
        out[places] = (words[rows][:, None] >> shifts) & mask
    return out


class Writer:
    """Writes documents to an open binary file, in blocks of about ``block_ids`` ids."""

    def __init__(self, sink, block_ids: int = 1 << 18):
        self.sink, self.block_ids = sink, block_ids
        self.at, self.table = 0, []
        self.keys: list[int | None] = []
        self.sizes: list[int] = []
        self.runs: list[np.ndarray] = []
        self.held = 0

    def add(self, keys: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> None:
        """Documents with ``sizes`` ids each, their ids one after another."""
        done, first = np.cumsum(sizes), 0
        while first < len(keys):
            before = int(done[first - 1]) if first else 0
            last = int(np.searchsorted(done, before + self.block_ids - self.held)) + 1
            last = min(max(last, first + 1), len(keys))
            self.keys += keys[first:last]
            self.sizes += sizes[first:last].tolist()
            self.runs.append(ids[before : int(done[last - 1])])
            self.held += int(done[last - 1]) - before
            if self.held >= self.block_ids:
                self.flush()
            first = last

    def flush(self) -> None:
        if not self.keys:
            return
        words = encode(np.concatenate(self.runs))
        known = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        payload = known.tobytes() + keys.tobytes() + np.array(self.sizes, "<u8").tobytes() + words.astype("<u8").tobytes()
        self.sink.write(payload)
        self.table.append((self.at, len(words), len(self.keys), self.held))
        self.at += len(payload)
        self.keys, self.sizes, self.runs, self.held = [], [], [], 0

    def close(self) -> None:
        self.flush()
        table = np.array(self.table, "<u8").reshape(-1, 4).tobytes()
        self.sink.write(table + struct.pack("<Q", len(self.table)) + MAGIC)


def block_table(source, size: int) -> np.ndarray:
    """Rows (byte offset, words, documents, ids) of the blocks of a seekable file of ``size`` bytes."""
    source.seek(size - 16)
    tail = source.read(16)
    if tail[8:] != MAGIC:
        raise ValueError("not a token file")
    n = struct.unpack("<Q", tail[:8])[0]
    source.seek(size - 16 - 32 * n)
    return np.frombuffer(source.read(32 * n), "<u8").reshape(-1, 4).astype(np.int64)


def read_blocks(source, size: int) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(document ids, ids per document, all their ids) of each block."""
    for at, words, documents, n in block_table(source, size).tolist():
        source.seek(at)
        raw = source.read(17 * documents + 8 * words)
        known = np.frombuffer(raw, np.uint8, documents)
        keys = np.frombuffer(raw, "<i8", documents, documents)
        sizes = np.frombuffer(raw, "<u8", documents, 9 * documents).astype(np.int64)
        ids = decode(np.frombuffer(raw, "<u8", words, 17 * documents))[:n]
        yield [k if ok else None for k, ok in zip(keys.tolist(), known.tolist(), strict=True)], sizes, ids
