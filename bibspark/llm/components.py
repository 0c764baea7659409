"""Connected components of a link table by minimum labels, in rounds of joins and grouped minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import Stages

#: Links that a task holds at a time.
RUN = 1 << 18


def _smallest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links that are not the smallest of their component among them, and that smallest node."""
    nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while (label[x] != label[y]).any():
        low, high = np.minimum(label[x], label[y]), np.maximum(label[x], label[y])
        np.minimum.at(label, high, low)
        while (label != label[label]).any():
            label = label[label]
    rest = label != np.arange(len(nodes))
    return nodes[rest], nodes[label[rest]]


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``u, v`` as stars, run by run: each node with the smallest one that the links of the run lead to."""

    def stars(run: list[pa.RecordBatch]) -> pa.RecordBatch:
        ends = [np.concatenate([b.column(c).to_numpy() for b in run]) for c in ("u", "v")]
        return pa.record_batch([*map(pa.array, _smallest(*ends))], ["u", "v"])

    run, rows = [], 0
    for batch in (b.slice(i, RUN) for b in batches for i in range(0, b.num_rows, RUN)):
        if run and rows + batch.num_rows > RUN:
            yield stars(run)
            run, rows = [], 0
        run.append(batch)
        rows += batch.num_rows
    if run:
        yield stars(run)


def _settled(links: DataFrame) -> bool:
    """Whether all nodes have one smaller neighbour or are one."""
    ends = links.select("u", "v").union(links.select(F.col("v").alias("u"), "v"))
    several = ends.groupBy("u").agg((F.min("v") != F.max("v")).alias("several"))
    return not several.agg(F.max("several")).first()[0]


def components(edges: DataFrame, stages: Stages, name: str = "components") -> DataFrame:
    """``node, component`` (smallest node reachable) for the nodes of ``edges`` (``a, b``, long); needs no hub in one task.

    Each round links the larger neighbours of a node to its smallest, then the smaller ones (the "large star" and
    "small star" of Kiveris et al., 2014): the number of rounds is logarithmic, and each round's table is written
    to the shared folder while the last one is dropped. Before a table is written each task makes stars of the links that
    it has, run by run, so few links take a round or none. Ends when all links are stars.
    """

    def keep(links: DataFrame, k: int) -> DataFrame:
        return stages.keep(links.mapInArrow(_stars, "u long, v long"), f"{name}-{k}")

    current, k = keep(edges.where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")), 0), 0
    while not _settled(current):
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("u"), F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v"))
        k += 1
        following = keep(small, k)
        stages.drop(f"{name}-{k - 1}")
        current = following
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(current.select(F.col("v"), F.col("v"))).distinct()
