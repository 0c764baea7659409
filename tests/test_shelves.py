"""Tiles and blocks that travel several at a time, against brute force."""

import numpy as np
import pandas as pd

from bibspark.operators import dense, similarity, tiles


def test_shelves_of_several_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(tiles, "TILE", 16)
    monkeypatch.setattr(tiles, "LEAST", 16)
    monkeypatch.setattr(tiles, "least_shelves", lambda rows: 2)
    monkeypatch.setattr(dense, "BLOCK", 16)
    v = np.abs(np.random.default_rng(7).normal(size=(150, 6)))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    sims = u @ u.T
    wanted = {(i, j) for i in range(150) for j in range(i + 1, 150) if sims[i, j] >= 0.9}
    df = spark.createDataFrame(pd.DataFrame({"vec_id": range(150), "embedding": v.tolist()})).repartition(3)
    assert sorted((r.i, r.j) for r in dense.dense_pairs(df, 0.9).collect()) == sorted(wanted)
    rows = spark.createDataFrame(pd.DataFrame({"id": range(150), "idx": [list(range(6))] * 150, "val": u.tolist()}))
    placed, n = tiles.tiled(rows)
    assert tiles.shelf_size(placed, n) == n // 2 > 1
    assert sorted((r.i, r.j) for r in similarity.similar_vectors(rows, 0.9).collect()) == sorted(wanted)
