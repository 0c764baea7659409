"""Connected components against a plain version, and how many tables they write."""

import random

import numpy as np
import pyarrow as pa
import pytest

from bibspark.llm import components, ngram_join
from bibspark.llm.shared import Stages


def plain(links):
    """The smallest node of each node's component."""
    low = {x: x for link in links for x in link}
    while any(low[a] != low[b] for a, b in links):
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return low


def tables():
    rng = random.Random(9)
    chain = rng.sample(range(-(10**12), 10**12), 300)
    hub = [(7, x) for x in rng.sample(range(-1000, 1000), 200)]
    loose = [(rng.randrange(10**6, 10**6 + 900), rng.randrange(10**6, 10**6 + 900)) for _ in range(500)]
    links = [*zip(chain, chain[1:]), *hub, *loose, *loose[:50]]
    rng.shuffle(links)
    return [link[:: rng.choice((1, -1))] for link in links]


@pytest.fixture
def written(monkeypatch):
    names, keep = [], Stages.keep
    monkeypatch.setattr(Stages, "keep", lambda self, df, name: names.append(name) or keep(self, df, name))
    return names


@pytest.mark.parametrize("parts", [1, 7])
def test_components(spark, written, parts):
    links = tables()
    found = components.components(spark.createDataFrame(links, "a long, b long").coalesce(1).repartition(parts), Stages(spark), "c").collect()
    expected = {x: low for x, low in plain(links).items() if any(x in link and link[0] != link[1] for link in links)}
    assert sorted(map(tuple, found)) == sorted(expected.items())
    # what a task has needs no round; a round or two put the stars of several tasks together
    assert len(written) <= (1 if parts == 1 else 5)


def test_no_links(spark):
    for links in ([], [(3, 3)]):
        assert components.components(spark.createDataFrame(links, "a long, b long"), Stages(spark)).collect() == []


def test_stars_of_runs(monkeypatch):
    monkeypatch.setattr(components, "RUN", 16)
    links = tables()
    batches = [pa.record_batch([pa.array(side, pa.int64()) for side in zip(*links[i : i + 50])], ["u", "v"]) for i in range(0, len(links), 50)]
    stars = [*components._stars(iter(batches))]
    assert max(b.num_rows for b in stars) <= 16
    out = [tuple(row.values()) for b in stars for row in b.to_pylist()]
    assert all(u > v for u, v in out)
    low, all_low = plain(out), plain(links)
    assert all(low[x] == all_low[x] for x in low) and all(x in low or all_low[x] == x for x in all_low)
    assert all(np.diff(b.column("u").to_numpy()).min(initial=1) > 0 for b in stars)


def test_members_are_placed_once(spark, written):
    """While no further lead is picked, the members of the leads are joined to components once, and links twice at most."""
    rng = random.Random(5)
    base = [f"b{rng.randrange(5000)}" for _ in range(120)]
    texts = []
    for _ in range(60):
        words = base.copy()
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(120)] = f"n{rng.randrange(999)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ngram_join.ngram_jaccard_join(docs).collect()
    assert sum(name.startswith("rows-") for name in written) == 1
    assert sum(name.startswith("parts-") for name in written) == 2
