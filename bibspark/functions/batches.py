"""Arrow batches in pieces of bounded size: a batch is counted in rows, and rows may be long texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT = 1 << 20  # bytes of text that are taken apart together


def by_bytes(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``LIMIT`` bytes in a text column; a longer text is a run by itself."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + LIMIT, side="right")))
        yield batch.slice(low, high - low)
        low = high
