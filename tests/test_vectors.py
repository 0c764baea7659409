import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from bibspark.operators import dense, evaluate, linkage, similarity, tfidf, tiles

DOCS = [(0, ["code", "game"]), (1, ["code", "loop"]), (2, ["code", "game", "game"])]


def corpus(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id int, tokens array<string>")


def test_tfidf_fixture(spark):
    docs = corpus(spark)
    vocab = tfidf.vocabulary(docs, min_df=2, max_df=1.0, ngram=(1, 1))
    assert dict(zip(vocab.terms, np.round(vocab.idf, 6))) == {"code": 1.0, "game": 1.287682}
    pairs = similarity.cosine_pairs(tfidf.tfidf(docs, vocab), 0.3)
    got = {(r.i, r.j): round(r.sim, 6) for r in pairs.collect()}
    assert got == {(0, 1): 0.613356, (0, 2): 0.958265, (1, 2): 0.361965}
    assert tfidf.vocabulary(docs, min_df=2, max_df=0.9, ngram=(1, 1)).terms == ["game"]
    with pytest.raises(tfidf.EmptyCorpus):
        tfidf.vocabulary(corpus(spark, [(0, [])]))


@pytest.mark.parametrize("slots", [1 << 18, 64])
def test_vocabulary_equals_plain_counting(spark, monkeypatch, slots):
    monkeypatch.setattr(tfidf, "SKETCH", slots)
    rng = np.random.default_rng(5)
    rows = [(i, [f"w{k}" for k in rng.zipf(1.5, 30) if k < 40]) for i in range(80)]
    df, cf = {}, {}
    for _, t in rows:
        grams = [" ".join(t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)]
        for g in grams:
            cf[g] = cf.get(g, 0) + 1
        for g in set(grams):
            df[g] = df.get(g, 0) + 1
    for top, low, high in ((60, 2, 0.9), (500, 1, 1.0)):
        fit = [g for g in cf if low <= df[g] <= high * len(rows)]
        want = sorted(fit, key=lambda g: (-cf[g], g))[:top]
        vocab = tfidf.vocabulary(corpus(spark, rows), top, low, high)
        assert sorted(vocab.terms) == sorted(want)
        assert all(df[t] == d and cf[t] == c for t, d, c in zip(vocab.terms, vocab.df, vocab.cf))


def sparse_rows(n=70, width=25, seed=1):
    rng = np.random.default_rng(seed)
    m = np.zeros((n, width))
    for i in range(n):
        c = rng.choice(width, rng.integers(2, 6), replace=False)
        m[i, c] = rng.random(len(c)) + 0.1
    m[5] = m[9] = m[2]
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.fixture(scope="module")
def vectors(spark):
    m = sparse_rows()
    rows = [(i, Vectors.sparse(m.shape[1], [(int(c), float(r[c])) for c in np.nonzero(r)[0]])) for i, r in enumerate(m)]
    return spark.createDataFrame(rows, ["doc_id", "features"]).cache()


@pytest.fixture(params=[2048, 8])
def tile(request, monkeypatch):
    """One tile, or many tiles of a few rows and panels of fewer."""
    monkeypatch.setattr(tiles, "TILE", request.param)
    monkeypatch.setattr(tiles, "LEAST", request.param)
    monkeypatch.setattr(tiles, "PANEL", request.param // 2 + 1)
    return request.param


def test_threshold_join_is_exact(vectors, tile):
    m = sparse_rows()
    sims = m @ m.T
    reps = [i for i in range(len(m)) if i not in (5, 9)]
    for low in (0.2, 0.6, 1e-12):
        got = {(r.i, r.j): r.sim for r in similarity.cosine_pairs(vectors, low).collect()}
        want = {(i, j) for i in reps for j in reps if i < j and sims[i, j] >= low} | {(2, 2)}
        assert set(got) == want
        assert all(abs(got[p] - sims[p]) < 1e-9 for p in want)


def test_tiles_without_similar_rows_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(tiles, "TILE", 10)
    monkeypatch.setattr(tiles, "LEAST", 10)
    rows = [(i, Vectors.sparse(20, [(i % 4 * 5 + k, 0.5) for k in range(4)])) for i in range(40)]
    units = similarity.unit_arrays(spark.createDataFrame(rows, ["doc_id", "features"]))
    placed, n = tiles.tiled(units.drop("key"))
    assert n == 4 and tiles.tile_pairs(placed, n, None).count() == 10
    assert tiles.tile_pairs(placed, n, 0.5).count() == 4  # each group of ten only with itself


@pytest.mark.parametrize("n", [3, 200])
def test_neighbours_of_all(vectors, tile, n):
    m = sparse_rows()
    sims = np.round(m @ m.T, 9)
    want = {}
    for i in range(len(m)):
        order = sorted((j for j in range(len(m)) if j != i), key=lambda j: (-sims[i, j], j))[:n]
        want |= {(i, k + 1): j for k, j in enumerate(order)}
    assert {(r.i, r["rank"]): r.j for r in similarity.neighbours(vectors, n).collect()} == want


def test_copies_by_term_counts(spark):
    rows = [(0, ["a", "b", "b"]), (1, ["b", "a", "b", "a", "b", "b"]), (2, ["a", "b"]), (3, ["b", "a"] * 3), (4, ["c"]), (5, [])]
    docs = corpus(spark, rows)
    model = tfidf.tfidf(docs, tfidf.vocabulary(docs, min_df=1, max_df=1.0, ngram=(1, 1)))
    got = {r.id: r.rep for r in similarity.copies(similarity.unit_arrays(model)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4}


def test_sums_without_pairs(spark, vectors):
    m = sparse_rows()
    sims = m @ m.T
    got = {r.doc_id: r.score for r in similarity.centrality(vectors).collect()}
    assert np.allclose([got[i] for i in range(len(m))], sims.sum(axis=1))
    assert similarity.most_central(vectors).first().doc_id == sims.sum(axis=1).argmax()
    n = len(m)
    assert abs(similarity.corpus_similarity(vectors).first().percent - 100 * sims.sum() / (n * (n - 1))) < 1e-9
    best = [r.doc_id for r in similarity.most_similar(vectors, 2, 3).collect()]
    order = sorted((i for i in range(n) if i != 2), key=lambda i: (-round(sims[2, i], 12), i))
    assert best == order[:3]


def sequential(distance, method, cut=np.inf):
    """All merges of a distance matrix, one after another: the plain version. Heights that agree in nine digits are equal."""
    d = {(i, j): distance[i, j] for i in range(len(distance)) for j in range(i)}
    at = lambda i, j: d[max(i, j), min(i, j)]
    size, steps = {i: 1 for i in range(len(distance))}, []
    while len(size) > 1:
        h, a, b = min((round(at(i, j), 9), i, j) for i in size for j in size if i < j)
        if h > cut:
            break
        na, nb = size[a], size[b]
        for x in size:
            if x not in (a, b):
                p, q, n = at(a, x), at(b, x), size[x]
                new = {"single": min(p, q), "complete": max(p, q), "average": (na * p + nb * q) / (na + nb)}
                new["ward"] = np.sqrt(max(((na + n) * p * p + (nb + n) * q * q - n * h * h) / (na + nb + n), 0))
                d[max(a, x), min(a, x)] = new[method]
        size[a] += size.pop(b)
        steps.append((a, b, h, size[a]))
    return steps


def partition_of(steps, n):
    label = list(range(n))
    for a, b, *_ in steps:
        label = [a if x == b else x for x in label]
    return dict(enumerate(label))


@pytest.fixture(params=["one cell", "small cells"])
def cells(request, monkeypatch):
    if request.param == "small cells":
        for module, name, value in ((tiles, "TILE", 24), (tiles, "LEAST", 24), (tiles, "PANEL", 7), (linkage, "CELL", 20), (linkage, "WIDE", 5), (linkage, "NEAREST", 4), (linkage, "RUN", 20)):
            monkeypatch.setattr(module, name, value)
    return request.param


def merges_of(df):
    return sorted((round(r.height, 6), r.left, r.right, r["size"]) for r in df.collect())


@pytest.mark.parametrize("method", linkage.METHODS)
def test_linkage_equals_sequential(vectors, method, cells):
    m = sparse_rows()
    steps = sequential(np.clip(1 - m @ m.T, 0, None), method)
    want = sorted((round(h, 6), a, b, n) for a, b, h, n in steps if (a, b) not in ((2, 5), (2, 9)))
    assert merges_of(linkage.linkage(vectors, method)) == want
    labels, merges = linkage.agglomerate(vectors, method, 0.6)
    assert {r.id: r.cluster for r in labels.collect()} == partition_of([s for s in steps if s[2] <= 0.6], len(m))
    assert merges_of(merges) == [w for w in want if w[0] <= 0.6]


@pytest.mark.parametrize("method", linkage.METHODS)
def test_ties_and_copies(spark, method, cells):
    """Few different vectors: many equal distances, many copies, and documents without a common term."""
    rng = np.random.default_rng(8)
    m = np.zeros((36, 8))
    for i in range(36):
        m[i, rng.choice(6 if i < 30 else 8, 2, replace=False)] = 1
    m[33:] = 0
    m[33:, 7] = 1
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(i, Vectors.sparse(8, [(int(c), float(r[c])) for c in np.nonzero(r)[0]])) for i, r in enumerate(m)]
    frame = spark.createDataFrame(rows, ["doc_id", "features"])
    steps = sequential(np.clip(1 - m @ m.T, 0, None), method)
    heights = [round(r[0], 6) for r in merges_of(linkage.linkage(frame, method))]
    if cells == "one cell" or method == "single":
        merged = linkage.agglomerate(frame, method, 0.6)[0]
        assert {r.id: r.cluster for r in merged.collect()} == partition_of([s for s in steps if s[2] <= 0.6], 36)
        assert heights == sorted(round(s[2], 6) for s in steps)[36 - 1 - len(heights) :]
    assert len(heights) == len(np.unique(m, axis=0)) - 1


@pytest.mark.parametrize("method", ["average", "single", "ward"])
def test_wanted_number_of_clusters(vectors, method):
    m = sparse_rows()
    labels, _ = linkage.agglomerate_k(vectors, method, 5)
    steps = sequential(np.clip(1 - m @ m.T, 0, None), method)
    assert {r.id: r.cluster for r in labels.collect()} == partition_of(steps[: len(m) - 5], len(m))


def test_sampled_linkage(vectors):
    tree = linkage.sampled_linkage(vectors, 30).orderBy("step").collect()
    heights = [r.height for r in tree]
    assert len(tree) == 29 and tree[-1]["size"] == 30 and heights == sorted(heights)
    ids = sorted(r.doc_id for r in linkage.sample_docs(vectors, 30).collect())
    m = sparse_rows()[ids]
    steps = sequential(np.clip(1 - m @ m.T, 0, None), "ward")
    assert [(r.left, r.right, round(r.height, 6), r["size"]) for r in tree] == [(ids[a], ids[b], round(h, 6), n) for a, b, h, n in steps]


def test_dense_pairs_and_neighbours(spark, monkeypatch):
    monkeypatch.setattr(dense, "BLOCK", 16)
    rng = np.random.default_rng(3)
    m = rng.normal(size=(8, 10))[rng.integers(0, 8, 120)] + 0.4 * rng.normal(size=(120, 10))
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], "vec_id int, embedding array<double>")
    u = m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = u @ u.T
    got = {(r.i, r.j) for r in dense.dense_pairs(df, 0.7).collect()}
    assert got == {(i, j) for i in range(120) for j in range(i + 1, 120) if sims[i, j] >= 0.7}
    near = dense.top_neighbours(df, 5).collect()
    want = {i: sorted((j for j in range(120) if j != i), key=lambda j: -sims[i, j])[:5] for i in range(120)}
    assert {(r.i, r["rank"]): r.j for r in near} == {(i, k + 1): j for i, js in want.items() for k, j in enumerate(js)}


def test_silhouette(spark, vectors):
    m = sparse_rows()
    d = np.clip(1 - m @ m.T, 0, None)
    label = np.arange(len(m)) % 3
    scores = []
    for i in range(len(m)):
        mean = [d[i, (label == c) & (np.arange(len(m)) != i)].mean() for c in range(3)]
        a, b = mean[label[i]], min(x for c, x in enumerate(mean) if c != label[i])
        scores.append((b - a) / max(a, b))
    labels = spark.createDataFrame([(i, int(c)) for i, c in enumerate(label)], "doc_id long, cluster int")
    assert abs(evaluate.silhouette(vectors, labels).first().silhouette - np.mean(scores)) < 1e-9


def test_svd_scores_match_the_similarity_matrix(spark, vectors):
    m = sparse_rows()
    u, s, _ = np.linalg.svd(m @ m.T)
    got = {r.doc_id: r.features.toArray() for r in dense.svd_scores(vectors, 4).collect()}
    ours = np.array([got[i] for i in range(len(m))])
    assert np.allclose(np.abs(ours), np.abs(u[:, :4] * s[:4]), atol=1e-6)


@pytest.mark.parametrize("method", ["average", "complete", "single"])
def test_documents_without_common_terms_join_in_id_order(spark, method, cells):
    rows = [(i, Vectors.sparse(40, [(i, 1.0)])) for i in range(40)]
    labels, merges = linkage.agglomerate_k(spark.createDataFrame(rows, ["doc_id", "features"]), method, 4)
    assert {r.id: r.cluster for r in labels.collect()} == {i: 0 if i < 37 else i for i in range(40)}
    assert [(r.height, r["size"]) for r in merges.orderBy("right").collect()] == [(1.0, i + 2) for i in range(36)]
