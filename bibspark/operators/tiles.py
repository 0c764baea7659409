"""Products of sparse rows with each other, tile by tile.

Rows (``id, idx, val`` and any further columns) are put in the order of a few pivots, so that related ones stand
together, and cut into tiles of bounded size. A pair of tiles is two bounded blocks and their products, panel by panel:
columns that many rows of both panels have are laid out, of the others only the entries that meet are multiplied.
With a lower bound for the products, pairs of tiles whose largest weights by term cannot reach it are left out before any
row is sent. Tiles travel by shelves, neighbouring tiles of bounded size together, so a row is sent once for each shelf
that it meets; what a pair of tiles gives leaves the task before the next pair is met.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .numbering import with_ref_id

TILE = 2048  # rows of a tile at most
LEAST = 512  # rows of a tile at least, where there are more
PANEL = 1024  # rows of a block that are laid out at a time
PIVOTS = 64
DENSE = 1 / 160  # a column is laid out if so many of a panel's products have a part from it
MEETS = 1 << 18  # entries that are multiplied at a time
ENTRIES = 1 << 22  # entries of the rows of a shelf, about
_SLACK = 1e-9


class Rows:
    """The rows of a group as flat arrays, with their pandas frame for the other columns."""

    def __init__(self, frame: pd.DataFrame):
        self.frame = frame.reset_index(drop=True)
        sizes = np.array([len(x) for x in frame["idx"]], np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(sizes)))
        self.idx = np.concatenate([np.zeros(0, np.int64), *frame["idx"]]).astype(np.int64)
        self.val = np.concatenate([np.zeros(0), *frame["val"]]).astype(float)
        self.panels: dict[int, _Panel] = {}
        self.sorted: dict[tuple, Rows] = {}

    def ordered(self, *by: str) -> Rows:
        """The same rows in the order of some columns; kept, too."""
        if by not in self.sorted:
            self.sorted[by] = Rows(self.frame.sort_values(list(by)))
        return self.sorted[by]

    def panel(self, low: int) -> _Panel:
        """The panel from row ``low`` on; kept, as it meets many others."""
        if low not in self.panels:
            self.panels[low] = _Panel(self, low, min(low + PANEL, len(self)))
        return self.panels[low]

    def __len__(self) -> int:
        return len(self.frame)

    def __getitem__(self, column: str) -> np.ndarray:
        return self.frame[column].to_numpy()

    def laid_out(self, low: int, high: int, columns: np.ndarray) -> np.ndarray:
        """Rows ``low`` to ``high`` as a matrix over some columns (sorted)."""
        first, stop = self.bounds[low], self.bounds[high]
        at = np.minimum(np.searchsorted(columns, self.idx[first:stop]), max(len(columns) - 1, 0))
        known = columns[at] == self.idx[first:stop] if len(columns) else np.zeros(stop - first, bool)
        row = np.repeat(np.arange(high - low), np.diff(self.bounds[low : high + 1]))
        out = np.zeros((high - low, len(columns)))
        out[row[known], at[known]] = self.val[first:stop][known]
        return out


def _runs(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...``, ``count`` of them, of all runs."""
    return np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())


class _Panel:
    """Some rows of a group, with the entries of a column together."""

    def __init__(self, rows: Rows, low: int, high: int):
        first, stop = rows.bounds[low], rows.bounds[high]
        order = np.argsort(rows.idx[first:stop], kind="stable")
        idx = rows.idx[first:stop][order]
        self.size = high - low
        self.row = np.repeat(np.arange(high - low), np.diff(rows.bounds[low : high + 1]))[order].astype(np.int32)
        self.val = rows.val[first:stop][order]
        self.start = np.flatnonzero(np.concatenate((np.ones(min(1, len(idx)), bool), idx[1:] != idx[:-1])))
        self.columns, self.count = idx[self.start], np.diff(np.append(self.start, len(idx)))

    def laid_out(self, some: np.ndarray) -> np.ndarray:
        """Some columns, by their place among the panel's, as a matrix."""
        at, out = _runs(self.start[some], self.count[some]), np.zeros((self.size, len(some)))
        out[self.row[at], np.repeat(np.arange(len(some)), self.count[some])] = self.val[at]
        return out


def _product(left: _Panel, right: _Panel) -> np.ndarray:
    _, a, b = np.intersect1d(left.columns, right.columns, assume_unique=True, return_indices=True)
    dense = left.count[a] * right.count[b] > DENSE * left.size * right.size
    out = left.laid_out(a[dense]) @ right.laid_out(b[dense]).T
    a, b, flat = a[~dense], b[~dense], out.reshape(-1)
    own = _runs(left.start[a], left.count[a])  # each meets the other panel's entries of its column
    first, meets = np.repeat(right.start[b], left.count[a]), np.repeat(right.count[b], left.count[a])
    ends, low = np.cumsum(meets), 0
    while low < len(own):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + MEETS, side="right")))
        times, other = meets[low:high], _runs(first[low:high], meets[low:high])
        at = np.repeat(left.row[own[low:high]].astype(np.int64) * right.size, times) + right.row[other]
        np.add.at(flat, at, np.repeat(left.val[own[low:high]], times) * right.val[other])
        low = high
    return out


def products(left: Rows, right: Rows) -> Iterator[tuple[int, int, np.ndarray]]:
    """``(low, first, block)``: products of left rows from ``low`` on with right rows from ``first`` on."""
    for first in range(0, len(right), PANEL):
        for low in range(0, len(left), PANEL):
            yield low, first, _product(left.panel(low), right.panel(first))


def _nearest_pivot(rows: DataFrame, wanted: int) -> DataFrame:
    """Add ``_cell``, the pivot row with the largest product; at most ``PIVOTS`` pivots."""
    picked = Rows(rows.orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, wanted)).select("idx", "val").toPandas())
    columns = np.unique(picked.idx)
    pivots = picked.laid_out(0, len(picked), columns).T

    @F.pandas_udf("int")
    def nearest(idx: pd.Series, val: pd.Series) -> pd.Series:
        own = Rows(pd.DataFrame({"idx": idx, "val": val}))
        cells = [(own.laid_out(a, min(a + PANEL, len(own)), columns) @ pivots).argmax(axis=1) for a in range(0, len(own), PANEL)]
        return pd.Series(np.concatenate(cells) if cells else [], dtype="int32")

    return rows.withColumn("_cell", nearest("idx", "val"))


def tiled(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows with their ``tile``, and the number of tiles: at least a few for each core, where there are rows for them."""
    n = rows.count()
    wanted = int(np.ceil(np.sqrt(2 * rows.sparkSession.sparkContext.defaultParallelism)))
    size = min(TILE, max(LEAST, -(-n // wanted)))
    if n <= size:
        return rows.withColumn("tile", F.lit(0).cast("long")), 1
    numbered = with_ref_id(_nearest_pivot(rows, n // size + 1), ["_cell", "id"], "_n")
    return materialize(numbered.withColumn("tile", F.floor(F.col("_n") / size)).drop("_cell", "_n"), "tiled"), -(-n // size)


def tile_pairs(rows: DataFrame, tiles: int, least: float | None) -> DataFrame:
    """``p, q`` with ``p <= q``: pairs of tiles with a product of at least ``least`` (any, if it is None)."""
    spark = rows.sparkSession
    ends = spark.range(tiles).select(F.col("id").alias("p"), F.explode(F.sequence(F.col("id"), F.lit(tiles - 1))).alias("q"))
    if least is None or tiles == 1:
        return ends
    # one row a tile: its largest weight of each term; the products of these rows bound all others
    entries = rows.select("tile", F.explode(F.arrays_zip("idx", "val")).alias("e")).groupBy("tile", "e.idx").agg(F.max("e.val").alias("val"))
    tops = entries.groupBy(F.col("tile").alias("id")).agg(F.collect_list(F.struct("idx", "val")).alias("e"))
    tops = materialize(tops.select("id", F.col("e.idx").alias("idx"), F.col("e.val").alias("val")), "tops")

    def reachable(left: Rows, right: Rows, same: bool) -> pd.DataFrame:
        parts = []
        for low, first, block in products(left, right):
            i, j = np.nonzero(block >= least - _SLACK)
            parts.append(np.column_stack((left["id"][low + i], right["id"][first + j])))
        pairs = np.concatenate([np.zeros((0, 2), np.int64), *parts])
        return pd.DataFrame({"p": pairs.min(axis=1), "q": pairs.max(axis=1)}).drop_duplicates()

    shelves = max(1, -(-tiles // TILE))
    return visit(tops.withColumn("tile", F.floor(F.col("id") / TILE)), shelves, reachable, "p long, q long")


def least_shelves(rows: DataFrame) -> int:
    """Shelves that must stay, where there are tiles for them, to have pairs of them for all cores."""
    return 2 * int(np.ceil(np.sqrt(2 * rows.sparkSession.sparkContext.defaultParallelism)))


def shelf_size(rows: DataFrame, tiles: int) -> int:
    """How many tiles make a shelf."""
    entries = rows.agg(F.sum(F.size("idx"))).first()[0] or 1
    return max(1, min(ENTRIES * tiles // entries, tiles // least_shelves(rows)))


def visit(
    rows: DataFrame, tiles: int, meet: Callable[[Rows, Rows, bool], pd.DataFrame | Iterator[pd.DataFrame]], schema: str, least: float | None = None
) -> DataFrame:
    """All ``meet(left, right, same)`` of pairs of tiles, one frame or several; ``same`` tells that both are the same tile.

    With ``least`` only pairs that can have a product of so much; weights must not be negative then.
    """

    def frames(left: Rows, right: Rows, same: bool) -> Iterator[pd.DataFrame]:
        found = meet(left, right, same)
        yield from (x for x in ([found] if isinstance(found, pd.DataFrame) else found) if len(x))

    pairs = tile_pairs(rows, tiles, least)
    if tiles == 1:
        names = rows.drop("tile").columns

        def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            own = Rows(pd.concat([x[names] for x in batches]))
            yield from frames(own, own, True)

        return rows.groupBy("tile").applyInPandas(alone, schema)
    both = materialize(pairs, "tile_pairs")
    size = shelf_size(rows, tiles)
    shelf = lambda end: F.floor(F.col(end) / size).alias(f"_{end}")
    others = [c for c in rows.columns if c != "tile"]
    # the tiles that a left tile meets on a shelf come with its rows; a right tile is sent to a shelf once
    to = both.groupBy("p", shelf("p"), shelf("q")).agg(F.collect_list("q").alias("_meets")).withColumnRenamed("p", "tile")
    of = both.select(F.col("q").alias("tile"), shelf("p"), shelf("q")).distinct().withColumn("_meets", F.lit(None).cast("array<long>"))
    sent = rows.join(to.unionByName(of), "tile")

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sides: tuple[dict, dict] = ({}, {})
        for batch in batches:
            right = batch["_meets"].isna()
            for side, own in zip(sides, (batch[~right], batch[right])):
                for tile, part in own.groupby("tile"):
                    side.setdefault(tile, []).append(part)
        known = {q: Rows(pd.concat(parts)[others]) for q, parts in sides[1].items()}
        for p in sorted(sides[0]):
            left = pd.concat(sides[0].pop(p))
            own = Rows(left[others])
            for q in sorted(left["_meets"].iloc[0]):
                yield from frames(own, known[q], p == q)

    return sent.groupBy("_p", "_q").applyInPandas(task, schema)
