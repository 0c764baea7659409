"""N-grams as numbers against plain counting."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bibspark.operators import grams, similarity, tfidf

DOCS = [["a", "b", "a", "b", "c"], [], ["b"], ["c", "c", "c", "c"], ["a", "b", "c", "d"], ["x", "a", "b", "c"], ["d", "x"], ["a", "b", "a", "b", "c"]]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(DOCS)), "doc_id long, tokens array<string>").repartition(2)


def plain(n):
    lists = [[" ".join(d[i : i + n]) for i in range(len(d) - n + 1)] for d in DOCS]
    df, cf = Counter(t for x in lists for t in set(x)), Counter(t for x in lists for t in x)
    return {t: (df[t], cf[t]) for t in cf}


@pytest.mark.parametrize("size", [2, 1000])
def test_counts(spark, docs, monkeypatch, size):
    monkeypatch.setattr(grams, "TOKENS", size)
    as_dict = lambda rows: {r.term: (r["df"], r["cf"]) for r in rows.collect()}
    assert as_dict(tfidf.word_counts(docs)) == plain(1)
    for n in (2, 3):
        parts = sorted(t for t, (_, cf) in plain(n - 1).items() if cf > 1)
        inside = lambda t: all(" ".join(t.split(" ")[k : k + n - 1]) in parts for k in (0, 1))
        assert as_dict(tfidf.known_counts(docs, n, parts)) == {t: c for t, c in plain(n).items() if inside(t)}
        assert as_dict(tfidf.known_counts(docs, n, parts, 3)) == {t: c for t, c in plain(n).items() if inside(t) and c[1] >= 3}
    assert tfidf.known_counts(docs, 3, []).isEmpty()


def test_vocabulary_with_and_without_sent_parts(docs, monkeypatch):
    sent = tfidf.vocabulary(docs, 6, 1, 0.9)
    monkeypatch.setattr(tfidf, "KNOWN", 1)
    assert tfidf.vocabulary(docs, 6, 1, 0.9) == sent


def test_weights_of_every_order(docs):
    vocab = tfidf.vocabulary(docs, 100, 1, 1.0)
    rows = tfidf.tfidf(docs, vocab).orderBy("doc_id").collect()
    assert [r.doc_id for r in rows] == [0, 2, 3, 4, 5, 6, 7]
    for r in rows:
        d = DOCS[r.doc_id]
        counts = Counter(" ".join(d[i : i + n]) for n in (1, 2, 3) for i in range(len(d) - n + 1))
        weight = np.zeros(len(vocab.terms))
        for t, c in counts.items():
            weight[vocab.terms.index(t)] = c * vocab.idf[vocab.terms.index(t)]
        assert np.allclose(r.features.toArray(), weight / np.linalg.norm(weight), atol=1e-12)
    keys = {r.doc_id: r.key for r in rows}
    assert keys[0] == keys[7] and len(set(keys.values())) == 6
    only = tfidf.tfidf(docs, tfidf.vocabulary(docs, 100, 1, 1.0, (2, 2))).agg(F.count("*")).first()[0]
    assert only == 6


def test_blocks_bring_their_documents_together_once(spark):
    """No n-gram is a row of its own; the leading terms, ties by term, are those of plain counting."""
    rng = np.random.default_rng(3)
    lists = [[f"w{x}" for x in rng.integers(0, 12, rng.integers(0, 9))] for _ in range(45)]
    docs = spark.createDataFrame([*enumerate(lists), (None, ["w1"])], "doc_id long, tokens array<string>").repartition(3)
    found = similarity.blocked_pairs(docs, 20, 0.0, 40)
    assert found._jdf.queryExecution().executedPlan().toString().count("Generate") == 0
    got = {(r.block, r.i, r.j): r.sim for r in found.collect()}
    expected = {}
    for b in range(3):
        own = lists[20 * b : 20 * b + 20]
        grams_of = [Counter(" ".join(d[i : i + n]) for n in (1, 2, 3) for i in range(len(d) - n + 1)) for d in own]
        cf = sum(grams_of, Counter())
        kept = sorted(cf, key=lambda t: (-cf[t], t))[:40]
        m = np.array([[c[t] * (np.log((1 + len(own)) / (1 + sum(t in x for x in grams_of))) + 1) for t in kept] for c in grams_of])
        m = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        expected |= {(b, 20 * b + i, 20 * b + j): (m @ m.T)[i, j] for i in range(len(own)) for j in range(i + 1, len(own)) if (m @ m.T)[i, j] > 0}
    assert set(got) == set(expected) and all(abs(got[k] - expected[k]) < 1e-12 for k in got)
