"""Words of whole texts as numpy arrays: boundaries, word fingerprints and n-gram fingerprints.

Texts arrive as Arrow strings, many at a time. Their bytes are scanned as one array, so a word costs a
few vector operations and no Python object. Fingerprints are 64-bit polynomial values, the same in every
task and every run; they depend on the bytes only.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C13)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_powers: dict[str, np.ndarray] = {}


def _power(kind: str, n: int) -> np.ndarray:
    """The first ``n`` powers of the multiplier or of its inverse, kept between calls."""
    have = _powers.get(kind)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        steps = np.full(size, _ODD if kind == "up" else _INVERSE)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * CHUNK_BYTES:
            _powers[kind] = have
    return have[:n]


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A fingerprint of ``values[start:end]`` for each span."""
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("up", len(values)), out=total[1:])
    return mix((total[end] - total[start]) * _power("down", len(values) + 1)[start])


#: Bytes that belong to a word: everything but space and 09-0D.
PLAIN = np.ones(256, bool)
PLAIN[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes that belong to a word: digits, a-z (A-Z after lower-casing) and all of multi-byte characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def trim() -> None:
    """Give memory that is no longer used back to the system: Python workers outlive their tasks and stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", int)(0)


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text; a longer text is a run by itself.

    Behind the last run, memory that is free goes back to the system.
    """
    sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
    trim()


#: Called to drop what a Python worker keeps of another operator's words; workers outlive their stage.
RELEASE: list[Callable[[], None]] = []


class Words:
    """Words of the texts of one Arrow array.

    ``start``, ``end``: bytes of each word in ``data``. ``bounds``: first word of each text, and the number
    of all words at the end. Null texts have no words.
    """

    def __init__(self, texts: pa.Array, letters: np.ndarray = PLAIN, lower: bool = False):
        while RELEASE:
            RELEASE.pop()()
        texts = texts.cast(pa.large_string()).fill_null("")
        _, offsets, data = texts.buffers()
        at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        self.data = LOWER[raw] if lower else raw
        inside = letters[self.data]
        first = np.zeros(len(raw) + 1, bool)
        first[at] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | first[1:-1]
        ends[:-1] &= ~inside[1:] | first[1:-1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.bounds = np.searchsorted(self.start, at)
        self.text_start = at

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        """The text of each word, by its place in the array."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def bytes_of(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()

    def joined(self, first: int, stop: int) -> bytes:
        """Words ``first`` to ``stop`` joined by one space."""
        return b" ".join(self.bytes_of(i) for i in range(first, stop))


def window_starts(bounds: np.ndarray, n: int) -> np.ndarray:
    """Places where ``n`` consecutive words of one text start."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    return ragged_ranges(bounds[:-1], counts)


def ragged_ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``first[i], first[i]+1, ...`` with ``counts[i]`` values for each i, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(np.asarray(first, np.int64) - before, counts)


def window_hashes(word_hashes: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of the ``n`` words from each start."""
    return span_hashes(word_hashes, starts, starts + n)


def covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of ``total`` words lie in a window of ``n`` words from one of ``starts``."""
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.subtract.at(edge, np.minimum(starts + n, total), 1)
    return np.cumsum(edge[:-1]) > 0
