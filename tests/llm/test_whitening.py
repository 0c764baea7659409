"""Whitening against a plain eigenvalue solver; inertia and contours against it on odd matrices."""

import math
from fractions import Fraction

import numpy as np
import pytest

from bibspark.llm.queries import op12_embedding_whitening
from bibspark.llm.whitening import inertia, leading_components, whiten

SCHEMA = "vec_id long, embedding array<float>, component string, vector string, `a.b` int"


def frame(spark, vectors, kind=SCHEMA):
    return spark.createDataFrame([(i, v, "clash", "clash", 1) for i, v in vectors], kind).repartition(3)


def plain(vectors, components=4, entry=np.float32):
    """``{(id, place): (n, deviation, whitened by component, explained by component)}`` and the components."""
    good = [(i, [math.floor(256 * float(entry(c))) for c in v]) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, d = len(fit), len(fit[0])
    total = [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array([[float(Fraction(n * x[k] - total[k], n)) for k in range(d)] for x in fit])
    v = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(v)
    top = np.argsort(-values)[: min(components, d)]
    mean = np.array([float(Fraction(s, n)) for s in total])
    rows = [(i, sum((n * a - s) ** 2 for a, s in zip(x, total)), (np.array(x) - mean) @ vectors_[:, top] / np.sqrt(np.abs(values[top]))) for i, x in good]
    return n, rows, values[top] / np.trace(v)


def check(spark, vectors, kind=SCHEMA):
    n, rows, explained = plain(vectors, entry=float if "double" in kind else np.float32)
    mine = whiten(frame(spark, vectors, kind)).collect()
    assert len(mine) == len(rows) * len(explained)
    for c in range(len(explained)):
        ours = sorted(((r.vec_id if r.vec_id is not None else -1, int(r.deviation), r.whitened) for r in mine if r.component == c + 1), key=lambda r: (r[0], r[1]))
        theirs = sorted(((i if i is not None else -1, dev, w[c]) for i, dev, w in rows), key=lambda r: (r[0], r[1]))
        assert [r[:2] for r in ours] == [r[:2] for r in theirs]
        a, b = np.array([r[2] for r in ours]), np.array([r[2] for r in theirs])
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, -b, atol=1e-8)
    assert {r.n for r in mine} == {n} and {r.identity_error for r in mine} and max(r.identity_error for r in mine) < 1e-9
    assert np.allclose([next(r.explained for r in mine if r.component == c + 1) for c in range(len(explained))], explained, rtol=1e-10)


def test_against_plain(spark):
    rng = np.random.default_rng(4)
    vectors = [(i, (rng.standard_normal(12) * np.linspace(1, 2, 12)).astype("f4").tolist()) for i in range(300)]
    vectors += [(400 + i, vectors[3][1]) for i in range(150)] + [(None, vectors[5][1]), (None, vectors[6][1]), (7, vectors[7][1])]
    odd = [(900, None), (901, [None] * 12), (902, [1.0] * 11 + [float("nan")]), (903, [float("inf")] * 12), (904, []), (905, [0.5] * 11 + [None])]
    check(spark, vectors + odd)
    assert all(r.vec_id not in range(900, 906) for r in whiten(frame(spark, vectors + odd)).select("vec_id").collect())


def test_few_dimensions_large_values_and_doubles(spark):
    rng = np.random.default_rng(5)
    check(spark, [(i, [float(v) for v in rng.integers(-9, 9, 3)]) for i in range(60)])
    check(spark, [(i, [float(v) for v in rng.integers(-(2**30), 2**30, 5) * 2**12]) for i in range(40)], SCHEMA.replace("float", "double"))


def test_other_lengths_and_no_variance(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, rng.standard_normal(6).tolist()) for i in range(40)]
    rows = whiten(frame(spark, vectors + [(77, [1.0, 2.0]), (78, [0.1] * 9)])).collect()
    assert len(rows) == 160 and {r.n for r in rows} == {40}
    same = whiten(frame(spark, [(i, [0.5, -0.5, 1.0]) for i in range(9)])).collect()
    assert len(same) == 27 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.n == 1 for r in same)
    line = whiten(frame(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in line) and max(r.identity_error for r in line) < 1e-9
    huge = whiten(frame(spark, [(i, [3e38 * (-1) ** i, float(i)]) for i in range(5)])).collect()
    assert len(huge) == 10
    assert whiten(frame(spark, vectors).limit(0)).count() == 0 and whiten(frame(spark, [(1, None), (2, [])])).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    n, rows, explained = plain(table)
    mine = op12_embedding_whitening(spark, sf).collect()
    assert dict(op12_embedding_whitening(spark, sf).dtypes)["deviation"] == "bigint"
    assert {(r.vec_id, r.deviation) for r in mine} == {(i, dev) for i, dev, _ in rows} and len(mine) == 4 * len(rows)


def test_inertia_and_contours():
    rng = np.random.default_rng(1)
    for trial in range(120):
        d, n = rng.integers(1, 40), rng.integers(1, 60)
        x = rng.integers(-50, 50, (n, d)).astype(float) * rng.choice([1, 0.1, 1000], d)
        if trial % 5 == 0 and d > 2:
            x[:, 1] = x[:, 0]
        if trial % 7 == 0:
            x = np.vstack([x, np.roll(x, 1, 1), np.roll(x, 2, 1)])
        x = x - x.mean(axis=0)
        v = x.T @ x / len(x)
        whole = np.linalg.eigvalsh(v)[::-1]
        shifted = v - (np.median(whole) * 1.0000001 + 1e-3) * np.eye(d)
        assert inertia(shifted) == (np.linalg.eigvalsh(shifted) > 0).sum()
        e, p = leading_components(v)
        assert np.allclose(e, whole[: len(e)], rtol=1e-9, atol=1e-12 * max(whole[0], 1))
        assert len(e) == min(4, d) or whole[len(e)] < 1e-10 * max(1, whole[0])
        assert np.allclose(p.T @ p, np.eye(len(e)), atol=1e-12) and np.abs(v @ p - p * e).max(initial=0) <= 1e-12 * whole[0] * d


@pytest.mark.parametrize("values", [[3.0] * 6, [5.0, 5, 5, 5, 5, 1], [5.0, 4, 3, 2, 2, 2, 1], [0.0] * 3, [1.0, 1 - 1e-7, 1 - 2e-7, 0.5, 0.5 - 1e-9]])
def test_equal_and_close_eigenvalues(values):
    e, p = leading_components(np.diag(values))
    assert np.allclose(e, [x for x in values if x > 0][:4]) and np.allclose(p.T @ p, np.eye(len(e)), atol=1e-12)
