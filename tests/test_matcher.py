"""The automaton against plain searches, for a small and a large table of patterns."""

import random
import re

import pytest

from bibspark.operators import matcher

TERMS = [("C1", "Semester", "sem"), ("C1", "Reports", "rep"), ("C2", "Reports", "report"), ("C2", "Code", "code.org"), ("C2", "Año", "año"), ("C3", "Nothing", ""), ("C3", "Under", "x_y")]
TEXTS = [(1, "This SEMester reports on sem, code.org"), (2, "sem"), (3, "El año; X_Y x_yz rep_ 1rep"), (4, None), (5, ""), (6, "codexorg AÑOS re-rep.")]


def plain(texts, terms, match):
    out = set()
    for i, text in texts:
        for category, term, synonym in terms:
            own = re.escape(synonym)
            pattern = own if match == "substring" else rf"(?<!\w){own}(?!\w)"
            if synonym and text and re.search(pattern, text.lower()):
                out.add((i, category, term))
    return out


@pytest.mark.parametrize("match", matcher.MATCHES)
@pytest.mark.parametrize("block", [200_000, 2])
def test_small_table(spark, monkeypatch, match, block):
    monkeypatch.setattr(matcher, "BLOCK", block)
    docs = spark.createDataFrame(TEXTS, "doc_id long, abstract string")
    found = matcher.match_patterns(docs, spark.createDataFrame(TERMS, "category string, term string, synonym string"), match)
    rows = [tuple(r) for r in found.collect()]
    assert set(rows) == plain(TEXTS, TERMS, match) and len(rows) == len(set(rows))


def test_large_table(spark):
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcde") for _ in range(n))
    terms = [("C", f"t{k}", word(rng.randrange(3, 9))) for k in range(10_000)]
    texts = [(i, " ".join(word(rng.randrange(2, 9)) for _ in range(60))) for i in range(8)]
    docs, table = spark.createDataFrame(texts, "doc_id long, abstract string"), spark.createDataFrame(terms, "category string, term string, synonym string")
    for match in matcher.MATCHES:
        assert {tuple(r) for r in matcher.match_patterns(docs, table, match).collect()} == plain(texts, terms, match)


def test_unknown_match(spark):
    with pytest.raises(ValueError):
        matcher.match_patterns(spark.createDataFrame(TEXTS, "doc_id long, abstract string"), spark.createDataFrame(TERMS, "category string, term string, synonym string"), "fuzzy")


@pytest.mark.parametrize("match", matcher.MATCHES)
@pytest.mark.parametrize("block", [200_000, 2])
def test_counts_without_a_row_per_document_and_term(spark, monkeypatch, match, block):
    """Only documents of several rows are matched one by one; rows with one id, null among them, count once."""
    monkeypatch.setattr(matcher, "BLOCK", block)
    found, seen = matcher.match_patterns, []

    def one_by_one(docs, *rest):
        seen.extend(docs.collect())
        return found(docs, *rest)

    monkeypatch.setattr(matcher, "match_patterns", one_by_one)
    texts = [*TEXTS, (2, "sem report"), (None, "code.org"), (None, "code.org sem"), (1, TEXTS[0][1])]
    docs, table = (spark.createDataFrame(x, f"{c} string") for x, c in ((texts, "doc_id long, abstract"), (TERMS, "category string, term string, synonym")))
    got = {(r.category, r.term): r.freq for r in matcher.pattern_freq(docs, table, match).collect()}
    hits = plain(texts, TERMS, match)
    assert got == {t: sum(h[1:] == t for h in hits) for t in {h[1:] for h in hits}}
    assert {r.doc_id for r in seen} == {1, 2, None}
