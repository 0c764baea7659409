"""Products by columns, pairs with their counts, and clusters that draw all others to themselves."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors

from bibspark.operators import linkage, similarity, tiles
from test_vectors import merges_of, sequential


@pytest.mark.parametrize("dense", [0.0, 0.05, 2.0])
def test_products_of_common_and_rare_columns(monkeypatch, dense):
    monkeypatch.setattr(tiles, "DENSE", dense)
    monkeypatch.setattr(tiles, "PANEL", 16)
    monkeypatch.setattr(tiles, "MEETS", 50)
    rng = np.random.default_rng(2)
    a, b = (rng.random((n, 60)) * (rng.random((n, 60)) < rng.random(60) ** 3) for n in (37, 21))
    rows = lambda m: tiles.Rows(pd.DataFrame({"idx": [np.flatnonzero(x) for x in m], "val": [x[x > 0] for x in m]}))
    got = np.full((37, 21), np.nan)
    for low, first, block in tiles.products(rows(a), rows(b)):
        got[low : low + block.shape[0], first : first + block.shape[1]] = block
    assert np.allclose(got, a @ b.T, atol=1e-12)
    assert not list(tiles.products(rows(a[:0]), rows(b)))


def test_pairs_are_not_joined_for_their_counts(spark):
    rows = [(i, Vectors.sparse(6, [(i % 3, 1.0)])) for i in range(7)] + [(9, Vectors.sparse(6, [(0, 0.8), (4, 0.6)]))]
    found = similarity.cosine_pairs(spark.createDataFrame(rows, ["doc_id", "features"]), 0.5)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.i, r.j, r.n_i, r.n_j, round(r.sim, 6)) for r in found.collect()) == [(0, 0, 3, 3, 1.0), (0, 9, 3, 1, 0.8), (1, 1, 2, 2, 1.0), (2, 2, 2, 2, 1.0)]


def test_pairs_of_repeated_ids(spark):
    rows = [(0, Vectors.sparse(3, [(0, 1.0)]))] * 2 + [(1, Vectors.sparse(3, [(0, 0.8), (1, 0.6)]))]
    found = similarity.cosine_pairs(spark.createDataFrame(rows, ["doc_id", "features"]), 0.5)
    assert sorted((r.i, r.j, r.n_i, r.n_j) for r in found.collect()) == [(0, 0, 2, 2)] * 2 + [(0, 1, 2, 1)] * 4


def test_one_merge_at_a_time(spark, monkeypatch, method="complete"):
    """Clusters wider than a cell: rounds without a merge, then one merge, after which nothing may be lost."""
    for module, name, value in ((tiles, "TILE", 8), (tiles, "LEAST", 8), (linkage, "CELL", 3)):
        monkeypatch.setattr(module, name, value)
    m = np.eye(6)
    for i in range(1, 6):
        m[i, 0], m[i, i] = np.cos(0.2 + i / 10), np.sin(0.2 + i / 10)
    rows = [(i, Vectors.sparse(6, [(int(c), float(x[c])) for c in np.nonzero(x)[0]])) for i, x in enumerate(m)]
    got = merges_of(linkage.linkage(spark.createDataFrame(rows, ["doc_id", "features"]), method))
    assert got == sorted((round(h, 6), a, b, n) for a, b, h, n in sequential(np.clip(1 - m @ m.T, 0, None), method))


@pytest.mark.parametrize("method", ["average", "complete"])
def test_a_hub_takes_a_cell_of_others_in_a_round(spark, monkeypatch, method):
    """Each of 90 vectors is nearest to the first one, which took up to ``NEAREST`` of them in a round."""
    for module, name, value in ((tiles, "TILE", 64), (tiles, "LEAST", 64), (linkage, "CELL", 32), (linkage, "WIDE", 8)):
        monkeypatch.setattr(module, name, value)
    m = np.eye(91)
    for i in range(1, 91):
        m[i, 0], m[i, i] = np.cos(0.2 + i / 100), np.sin(0.2 + i / 100)
    rows = [(i, Vectors.sparse(91, [(int(c), float(x[c])) for c in np.nonzero(x)[0]])) for i, x in enumerate(m)]
    visits, visit = [], tiles.visit
    monkeypatch.setattr(tiles, "visit", lambda *args: visits.append(1) or visit(*args))
    got = merges_of(linkage.linkage(spark.createDataFrame(rows, ["doc_id", "features"]), method))
    assert got == sorted((round(h, 6), a, b, n) for a, b, h, n in sequential(np.clip(1 - m @ m.T, 0, None), method))
    assert len(visits) <= 7
