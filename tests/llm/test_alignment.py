"""Alignment against a plain version that compares all token ranges of a text."""

import random
from collections import Counter

import brute
import numpy as np
import public_tokenizers
from sentencepiece import SentencePieceProcessor

from bibspark.llm import alignment

SF = "/root/testdata/sf0.001"


def tokens(text, a, b):
    """Byte ranges and ids of both sides, read off the tokenizers' own tables; none if they do not give back the text."""
    if not text:
        return [], []
    signs = alignment._byte_level()
    by_a = [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    by_b = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    if not b"".join(x for _, x in by_a) == (" " + text).encode() == b"".join(x for _, x in by_b):
        return [], []
    out = []
    for side in (by_a, by_b):
        ends = np.cumsum([len(x) for _, x in side]).tolist()
        out.append([(i, end - len(x), end) for (i, x), end in zip(side, ends)])
    return out


def plain(texts):
    a, b = brute.tokenizer(alignment.FILE_A), SentencePieceProcessor(model_file=public_tokenizers.path(alignment.FILE_B))
    a.encode_special_tokens = True
    rows, held = [], Counter()
    for i, text in texts:
        x, y = tokens(text, a, b)
        links = Counter()
        for p, s, e in x:
            for q, u, v in y:
                if s < v and u < e:
                    links[p, q] += 1
        held.update(links.keys())
        common = sorted({e for _, _, e in x} & {e for _, _, e in y})
        groups, at = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s, e in side if at <= s and e <= end) for side in (x, y)))
            at = end
        rows.append((i, len(x), len(y), len(common), links, brute.sha(";".join(groups)) if groups else ""))
    most = Counter()
    for (p, _), n in held.items():
        most[p] = max(most[p], n)
    return [
        (i, na, nb, g, sum(links.values()), sum(n for k, n in links.items() if held[k] == most[k[0]]), sum(n * held[k] for k, n in links.items()), digest)
        for i, na, nb, g, links, digest in rows
    ], held


COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()


def corpus(spark):
    rng = random.Random(3)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = [(i, t[:1500]) for i, t in rows if t][:60]  # the plain version is quadratic in a text
    signs = ["<|endoftext|>", "</s>", "<0x41>", "▁", " ", "\n", "\t", "é", "日本語", "😀", "'ll", "1234", " ", "\x00", "ab", "-" * 20, "ﬁ", "é"]
    rows += [(1000 + k, "".join(rng.choice(signs) for _ in range(rng.randrange(1, 40)))) for k in range(60)]
    return [*rows, (2000, None), (2001, ""), (None, "null id"), (None, "null id"), (2002, "x" * 700), (2003, " "), (2003, " "), (2004, "a▁b")]


def test_against_plain(spark, monkeypatch):
    rows = corpus(spark)
    docs = spark.createDataFrame([(i, t, "clash", 0) for i, t in rows], "doc_id long, text string, row string, pairs int").repartition(3)
    expected, held = plain(rows)
    assert sum(r[1] > 0 for r in expected) > 80 and sum(r[1] == 0 for r in expected) > 3
    for share in (alignment.COMMON_SHARE, 0.004, 1.0):  # counts sent to every task, both ways, all joined
        monkeypatch.setattr(alignment, "COMMON_SHARE", share)
        out = alignment.alignment_report(docs)
        assert sorted((tuple(r) for r in out.select(*COLUMNS).collect()), key=repr) == sorted(expected, key=repr)
    counts = {(r.a_id, r.b_id): r.n_docs for r in alignment.pair_counts(docs).collect()}
    assert counts == dict(held)
    assert alignment.alignment_report(docs.limit(0)).count() == 0


def test_groups_give_back_the_text(spark):
    rows = [(1, "Überraschung, 東京 token"), (2, None), (3, "a" * 50), (4, "")]
    groups = alignment.token_groups(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id", "place").collect()
    pair = alignment._pair(*alignment._paths(None, None))
    for i, text in rows:
        own = [r for r in groups if r.doc_id == i]
        sides = [b"".join(table[t] for r in own for t in getattr(r, name)) for table, name in ((pair.bytes_a, "a_ids"), (pair.bytes_b, "b_ids"))]
        assert sides == [(" " + text).encode() if text else b""] * 2 and [r.place for r in own] == list(range(len(own)))
        assert sum(r.bytes for r in own) == len(sides[0])


def test_fast_ids_are_those_of_the_file():
    pair, rng = alignment._pair(*alignment._paths(None, None)), random.Random(2)
    assert pair.fast_a is not None
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [f"a{c}b 1{c}2 {c} ?{c}!{c}{c}  x" for c in points]
    texts += ["".join(rng.choice([*points[:0x300], *"  \n\t'sdmtlre"]) for _ in range(50)) for _ in range(2000)]
    texts += [" " * 6000 + "x", "x" * 50_000, "\n" * 4999 + "é", "a" + " " * 1_000_000, "<|endoftext|>"]
    for at in range(0, len(texts), 20_000):
        own = texts[at : at + 20_000]
        assert [pair.encode_a(t) for t in own] == [e.ids for e in pair.library_a.encode_batch_fast(own, add_special_tokens=False)]


def test_galloping():
    rng = np.random.default_rng(1)
    for _ in range(600):
        m = rng.integers(1, 200)
        a, b = (np.unique(np.append(rng.integers(1, m + 1, rng.integers(0, 80)), m)) for _ in range(2))
        assert (alignment.ranks(a, b) == np.searchsorted(b, a)).all()
        ends_a, ends_b, x, y = alignment.align_ends(a, b)
        both = np.intersect1d(a, b)
        assert (a[ends_a] == both).all() and (b[ends_b] == both).all()
        starts = [np.concatenate(([0], s[:-1])) for s in (a, b)]
        links = {(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]}
        assert len(x) == len(links) and links == set(zip(x.tolist(), y.tolist()))
    none = np.zeros(0, np.int64)
    assert len(alignment.ranks(none, np.array([1]))) == 0 and all(len(p) == 0 for p in alignment.align_ends(none, none))
