"""Embedding whitening by the leading components of the covariance, found by FEAST contour integration.

Spark does what grows with the rows: the distinct scaled vectors, their exact sums, the centred covariance (sums of
block products, added up by matrix row in two steps) and the whitened rows. What is left is one symmetric matrix, as large
as the vectors are long.

Its eigenvalues in an interval are found without the others: linear systems with the matrix shifted to complex points on
a circle around the interval, summed with quadrature weights, project a block of vectors onto the interval's
eigenvectors; Rayleigh-Ritz in that block gives the components, and the block goes round again until they hold. The
intervals are placed by inertia counts (signs of a symmetric factorisation), which also tell how many eigenvalues each
must give, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import Stages

COMPONENTS, SCALE = 4, 256
#: Points on the upper half of a contour, and how often a block goes round at most.
NODES, TURNS = 8, 60
#: Eigenvalues nearer to each other than this share of the range stay in one interval.
CLOSE = 1e-4
_LARGEST = float(1 << 63)


def inertia(matrix: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above zero: signs of the blocks of a pivoted LDL' factorisation."""
    a, above, at = matrix.astype(float).copy(), 0, 0
    n, alpha = len(a), (1 + 17**0.5) / 8  # the bound of Bunch and Kaufman's pivoting

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while at < n:
        two = False
        if at + 1 < n:
            below = np.abs(a[at + 1 :, at])
            r = at + 1 + int(below.argmax())
            if abs(a[at, at]) < alpha * below.max():
                others = np.abs(a[at:, r]).copy()
                others[r - at] = 0
                if abs(a[at, at]) * others.max() < alpha * below.max() ** 2:
                    if abs(a[r, r]) >= alpha * others.max():
                        swap(at, r)
                    else:
                        swap(at + 1, r)
                        two = True
        width = 2 if two else 1
        pivot = a[at : at + width, at : at + width]
        if two:
            above += int((np.linalg.eigvalsh(pivot) > 0).sum())
        else:
            above += int(pivot[0, 0] > 0)
        rest = a[at + width :, at : at + width]
        if len(rest) and np.any(rest):
            a[at + width :, at + width :] -= rest @ np.linalg.solve(pivot, rest.T)
        at += width
    return above


def _brackets(matrix: np.ndarray, wanted: int, low: float, high: float) -> list[tuple[float, float]]:
    """Bounds of the largest eigenvalues, falling, each pair apart by ``CLOSE`` of the range at most.

    ``wanted`` ones and those that follow without a gap, and the first after the gap if there is one.
    """
    counts: dict[float, int] = {low: len(matrix), high: 0}

    def above(x: float) -> int:
        if x not in counts:
            counts[x] = inertia(matrix - x * np.eye(len(matrix)))
        return counts[x]

    found: list[tuple[float, float]] = []
    for k in range(1, len(matrix) + 1):
        lower = max(x for x, n in counts.items() if n >= k)
        upper = min(x for x, n in counts.items() if n < k)
        while upper - lower > CLOSE * (high - low):
            middle = (lower + upper) / 2
            lower, upper = (middle, upper) if above(middle) >= k else (lower, middle)
        found.append((lower, upper))
        if k > wanted and upper < found[-2][0]:
            break
    return found


def _contour(matrix: np.ndarray, low: float, high: float, count: int, scale: float) -> np.ndarray:
    """Orthonormal eigenvectors of the ``count`` eigenvalues between ``low`` and ``high``, as columns."""
    n = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (nodes + 1))
    block = np.random.default_rng(0).standard_normal((n, min(n, 2 * count + 8)))
    for _ in range(TURNS):
        projected = np.zeros_like(block)
        for z, w in zip(turn, weights):
            solved = np.linalg.solve((centre + radius * z) * np.eye(n) - matrix, block.astype(complex))
            projected += 0.5 * w * radius * (z * solved).real
        basis = np.linalg.qr(projected)[0]
        values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turned
        inside = (values > low) & (values < high)
        residual = np.linalg.norm(matrix @ block[:, inside] - block[:, inside] * values[inside], axis=0)
        if inside.sum() == count and residual.max(initial=0) <= 64 * np.finfo(float).eps * scale:
            return block[:, inside]
    raise RuntimeError(f"{inside.sum()} of {count} eigenvalues between {low} and {high} after {TURNS} turns")


def leading_components(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """``(eigenvalues, vectors)`` of the largest eigenvalues of a covariance, falling; vectors are columns.

    At most ``wanted``, and only eigenvalues above the rounding error of zero.
    """
    n = len(matrix)
    radius = np.abs(matrix).sum(axis=1) - np.abs(np.diag(matrix))
    high = float((np.diag(matrix) + radius).max(initial=0.0))
    zero = 4 * n * np.finfo(float).eps * high
    if not high > 0:
        return np.zeros(0), np.zeros((n, 0))
    wanted = min(wanted, inertia(matrix - zero * np.eye(n)))
    low, high = min(0.0, float((np.diag(matrix) - radius).min())) - 0.01 * high, 1.01 * high
    found = _brackets(matrix, wanted, low, high)
    rest = found[-1] if len(found) > wanted and found[-1][1] < found[-2][0] else (low, low)
    top = found[:-1] if rest[1] > low else found
    groups: list[list[tuple[float, float]]] = []
    for b in top:
        if groups and groups[-1][-1][0] <= b[1]:
            groups[-1].append(b)
        else:
            groups.append([b])
    vectors, above = [], high
    for k, group in enumerate(groups):
        following = groups[k + 1][0] if k + 1 < len(groups) else rest
        below = (group[-1][0] + following[1]) / 2
        vectors.append(_contour(matrix, below, above, len(group), float(np.abs(matrix).max()) * n))
        above = below
    basis = np.linalg.qr(np.hstack(vectors))[0]  # intervals apart only by rounding are made orthogonal
    values, turned = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    return values[order], basis @ turned[:, order]


def _scaled(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(rows, lengths, x)``: rows whose vector has finite entries only, how many, and the entries floor(256 c)."""
    lists = vectors.cast(pa.large_list(pa.float64()))
    flat = lists.flatten().to_numpy(zero_copy_only=False)  # a null entry is a NaN here
    sizes = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    good = lists.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0)
    good[row[~np.isfinite(flat)]] = False
    x = np.floor(SCALE * flat[good[row]])
    whole = np.clip(x, -_LARGEST, np.nextafter(_LARGEST, 0)).astype(np.int64)
    whole[x >= _LARGEST] = np.iinfo(np.int64).max
    return np.flatnonzero(good), sizes[good], whole


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, sizes, x = _scaled(batch.column("vector"))
        bounds = np.concatenate(([0], 8 * np.cumsum(sizes))).astype(np.int64)
        packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(x.astype("<i8"))])
        yield pa.record_batch([packed.cast(pa.binary())], ["x"])


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The packed vectors of a batch, all of one length, as rows."""
    x = batch.column("x").cast(pa.large_binary())
    return np.frombuffer(b"".join(x.to_pylist()), "<i8").reshape(len(x), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = 0, 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            small = float(np.abs(x.astype(float)).max()) * len(x) < 2**62
            total, n = total + (x.sum(axis=0) if small else x.astype(object).sum(axis=0)).astype(object), n + len(x)
    if n:
        exact = pa.array([Decimal(int(s)) for s in total], pa.decimal128(38, 0))
        yield pa.record_batch([pa.array(np.arange(len(total)), pa.int64()), exact, pa.array(np.full(len(total), n), pa.int64())], ["dim", "s", "n"])


def _add_rows(frame: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.asarray(r, float) for r in frame["row"]], axis=0)
    return pd.DataFrame({"i": frame["i"].iloc[:1], "row": [total]})


def _product(vectors: DataFrame, transform, width: int) -> np.ndarray:
    """Sum over all rows of y' y, with y the transformed rows (``width`` columns): one block product a batch.

    Each task sends one partial matrix by row; rows are added up among about the root of the tasks first, then at last.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = transform(_matrix(batch))
                total = y.T @ y + (0 if total is None else total)
        if total is not None:
            yield pa.record_batch([pa.array(np.arange(width), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"])

    rows = vectors.select("x").mapInArrow(partial, "i long, row array<double>").withColumn("part", F.spark_partition_id())
    tasks = max(1, vectors.rdd.getNumPartitions())
    some = rows.groupBy("i", F.pmod("part", F.lit(int(tasks**0.5) + 1)).alias("part")).applyInPandas(_add_rows, "i long, row array<double>")
    whole = some.groupBy("i").applyInPandas(_add_rows, "i long, row array<double>").toPandas()  # as large as one vector squared
    out = np.zeros((width, width))
    for i, row in zip(whole.i, whole.row):
        out[i] = row
    return out


def whiten(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row per vector and component: id, ``component, n, deviation decimal(38,0), whitened, explained, identity_error``.

    Vectors that are null or empty or hold null, NaN or infinite entries are left out, as are those whose length is not the
    most frequent one among distinct vectors (of several the longest). Entries are scaled to ``floor(256 c)``, at
    the bounds of a long beyond it. Statistics are those of the distinct scaled vectors; repeated rows, null ids too,
    return as often as they stand. Vectors with fewer entries than ``components`` have fewer components. A component
    without variance (all with one distinct vector, say) has a null ``whitened`` and is left out of
    ``identity_error``. Among equal eigenvalues any orthonormal vectors may come. ``deviation`` is null beyond 38 digits.
    Extra columns are ignored; an empty table gives no rows.
    """
    spark, stages = rows.sparkSession, Stages(rows.sparkSession)
    kind = rows.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    given = rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").alias("vector"))
    distinct = stages.keep(given.select("vector").mapInArrow(_packed, "x binary").distinct(), "distinct")
    lengths = distinct.groupBy((F.octet_length("x") / 8).cast("int").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    d = int(lengths.d)
    fit = distinct.where(F.octet_length("x") == 8 * d)
    sums = fit.mapInArrow(_sums, "dim long, s decimal(38,0), n long").groupBy("dim").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    n, total = int(sums[0].n), [0] * d
    for r in sums:
        total[r.dim] = int(r.s)
    mean = np.array([s / n for s in total])
    covariance = _product(fit, lambda x: x - mean, d) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading_components(covariance, components)
    trace, k = float(np.trace(covariance)), len(values)
    projection = vectors / np.sqrt(values)
    # the whitened rows and a column of ones: their product holds the sums, too
    product = _product(fit, lambda x: np.column_stack(((x - mean) @ projection, np.ones(len(x)))), k + 1) / n
    spread = product[:k, :k] - np.outer(product[k, :k], product[k, :k])
    error = float(np.abs(spread - np.eye(k)).max(initial=0.0))
    shown, largest = min(components, d), max(map(abs, total))
    explained = [float(v / trace) for v in values] + [0.0] * (shown - k)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, sizes, flat = _scaled(batch.column("vector"))
            x = flat[np.repeat(sizes == d, sizes)].reshape(-1, d)
            row = row[sizes == d]
            apart = n * float(np.abs(x.astype(float)).max(initial=0.0)) + largest
            if apart * apart * d < 2**62:
                deviation = np.square(n * x - np.array(total, np.int64)).sum(axis=1)
            else:
                deviation = np.square(n * x.astype(object) - np.array(total, object)).sum(axis=1)
            exact = [Decimal(int(v)) if v < 10**38 else None for v in deviation.tolist()]
            white = np.full((len(x), shown), np.nan)
            white[:, :k] = (x - mean) @ projection
            ids, m = batch.column("id").take(pa.array(np.repeat(row, shown))), len(x)
            yield pa.record_batch(
                [
                    ids, pa.array(np.tile(np.arange(1, shown + 1), m), pa.int32()), pa.array(np.full(m * shown, n), pa.int64()),
                    pa.array([v for v in exact for _ in range(shown)], pa.decimal128(38, 0)), pa.array(white.ravel(), mask=np.isnan(white.ravel())),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * shown, error)),
                ],
                [id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return given.mapInArrow(project, schema)
