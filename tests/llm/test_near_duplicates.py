"""The near-duplicate stage against a brute-force version with its own shingles and threshold."""

import random

import brute
import corpus_pipeline
import numpy as np
import pytest

from bibspark.llm import ngram_join

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sets_of(texts, n):
    words = [brute.WORD.findall(brute.lower(t)) for t in texts]
    return [{tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set() for w in words]


def groups(texts, n=5, percent=80):
    """The group of each text: the place of its first member."""
    sets, group = sets_of(texts, n), list(range(len(texts)))
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y) and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    return group


def near_texts():
    rng = random.Random(11)
    prose = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    texts = []
    for size in (6, 9, 14, 30, 60, 150, 400, 900):
        base = prose(size)
        texts.append(" ".join(base))
        for k in range(1, 13):
            words = base.copy()
            for _ in range(max(1, k * size // 400)):
                words[rng.randrange(size)] = f"new{rng.randrange(999)}"
            texts.append(" ".join(words))
        texts += [" ".join(base + prose(size * part // 100)) for part in (5, 15, 22, 30)]
    rng.shuffle(texts)
    return texts


def test_stage_is_whole_at_five_words_and_four_fifths(spark):
    texts = near_texts()
    group = groups(texts)
    assert group != groups(texts, 3, 90)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], COLUMNS)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == sorted(set(group))


@pytest.mark.parametrize("percent", [50, 80, 90, 95])
def test_linked_sets_have_a_list_in_common(percent):
    rng = np.random.default_rng(3)
    for n in [*range(2, 60), 100, 333, 1000, 3000]:
        most = n * (100 - percent) // percent
        for longer in {0, 1, most // 2, most}:
            x = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
            y = np.unique(np.concatenate((x, rng.integers(0, 1 << 64, longer, np.uint64))))
            # as many changed elements as the threshold allows
            while 100 * len(np.intersect1d(x, y[1:])) >= percent * len(np.union1d(x, y[1:])) and len(y) > 1:
                y = y[1:]
            if len(x) != len(np.intersect1d(x, y)) or len(x) != len(y):
                linked = 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y))
                assert not linked or len(np.intersect1d(ngram_join.list_keys(x, percent), ngram_join.list_keys(y, percent)))


def odd_rows():
    """Rows (doc_id, text): ids that are null or stand for several texts, repeated rows, texts without words."""
    rng = random.Random(2)
    rows = [(None if k % 2 else k // 3, t) for k, t in enumerate(near_texts())]
    hub = [f"h{rng.randrange(5000)}" for _ in range(200)]
    near = [" ".join(hub[:at] + [f"n{at}"] + hub[at + 1 :]) for at in range(2, 200, 12)]
    rows += [(None, " ".join(hub))] + [(900 + k, t) for k, t in enumerate(near)]
    return rows + rows[:4] + [(None, ""), (7000, None), (7001, "\n")]


def test_rows_without_an_id_of_their_own(spark):
    rows = odd_rows()
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], COLUMNS).repartition(3)
    for args in ((), (5, 80)):
        group, low = groups([t or "" for _, t in rows], *(args or (3, 90))), {}
        for g, (i, _) in zip(group, rows):
            low[g] = min((x for x in (low.get(g), i) if x is not None), default=None)
        expected = sorted(((i, low[g]) for g, (i, _) in zip(group, rows)), key=repr)
        found = ngram_join.ngram_jaccard_join(docs, *args).collect()
        assert sorted(((r.doc_id, r.component_id) for r in found), key=repr) == expected
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    place = {(i, t): g for g, (i, t) in zip(group, rows)}
    assert sorted(place[r.doc_id, r.text] for r in kept) == sorted(set(group))
    assert all(r.doc_id is not None or low[place[r.doc_id, r.text]] is None for r in kept)


@pytest.mark.parametrize("turns", [0, 1])
def test_members_meet_in_small_blocks(spark, monkeypatch, turns):
    monkeypatch.setattr(ngram_join, "MEMBERS", 4)
    monkeypatch.setattr(ngram_join, "TURNS", turns)
    rng = random.Random(5)
    base = [f"b{rng.randrange(5000)}" for _ in range(120)]
    texts = []
    for _ in range(60):  # near copies around the threshold: many are linked with some of the others only
        words = base.copy()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(120)] = f"n{rng.randrange(999)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], COLUMNS)
    for args in ((3, 90), (5, 80)):
        group = groups(texts, *args)
        assert 1 < len(set(group)) < 60
        assert {r.doc_id: r.component_id for r in ngram_join.ngram_jaccard_join(docs, *args).collect()} == dict(enumerate(group))


def test_leads_of_lists_over_several_ranges(spark):
    rng = random.Random(4)
    often, rows = {}, []
    for s in rng.sample(range(-(10**9), 10**9), 400):
        lists = rng.sample(range(40), 3) + [99] * (s % 3 > 0) + [1000 + s]
        rows += [(s, lists)] * rng.randrange(1, 3)
        for x in lists:
            often.setdefault(x, set()).add(s)
    kept = {"spark.sql.shuffle.partitions": "13", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in kept}
    for k, v in kept.items():
        spark.conf.set(k, v)
    try:
        pairs = ngram_join._lead_pairs(spark.createDataFrame(rows, "set_id long, lists array<long>"), ngram_join.Stages(spark))
        assert sorted(map(tuple, pairs.collect())) == sorted({(min(own), s) for own in often.values() for s in own if s != min(own)})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_sketches_never_tell_more_than_the_difference():
    rng = np.random.default_rng(8)
    for n in (1, 5, 60, 700, 5000):
        x = np.unique(rng.integers(0, 1 << 64, n, np.uint64))
        for changed in (0, 1, n // 9, n):
            y = np.unique(np.concatenate((x[changed // 2 :], rng.integers(0, 1 << 64, changed, np.uint64))))
            if len(y):
                apart = ngram_join.least_apart(ngram_join.sketch(x), ngram_join.sketch(y))
                assert apart <= len(np.setxor1d(x, y))
                # most pairs that are far apart must be known to be so
                assert changed < n or n < 60 or 9 * apart > len(x) + len(y)


def test_sets_that_are_far_apart_are_not_cut(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"b{rng.randrange(5000)}" for _ in range(400)]
    # half of each text is common: they meet in lists, and none are linked
    texts = [" ".join(base[:200] + [f"n{k}x{i}" for i in range(200)]) for k in range(40)]
    texts += [" ".join(base), " ".join(base[:-1])]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], COLUMNS)
    cut, elements = [], ngram_join._elements

    def counted(docs, wanted, shingle):
        cut.append(wanted.count())
        return elements(docs, wanted, shingle)

    monkeypatch.setattr(ngram_join, "_elements", counted)
    found = ngram_join.ngram_jaccard_join(docs, 5, 80).collect()
    assert {r.doc_id: r.component_id for r in found} == {**{i: i for i in range(42)}, 41: 40}
    assert sum(cut) <= 4
