"""Every operator on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import random
import zlib

import brute
import numpy as np
import pytest

from bibspark.llm import lattice, language, licenses, packing, quality, recompress, tokens, urls
from bibspark.llm.decontaminate import contamination_report, remove_spans
from bibspark.llm.ngram_join import ngram_jaccard_join

SF = "/root/testdata/sf0.001"
VOCABULARY = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def corpus():
    """Rows (doc_id, text) with copies, near copies, a shared passage, runs, licence lines and odd texts."""
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(VOCABULARY) + str(rng.randrange(40)) for _ in range(n))
    base, passage = prose(160), prose(60)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, base), (4, base), (5, "One"), (6, "one"), (7, "x " * 120), (8, "Und " * 40 + prose(30))]
    for k in range(9, 30):
        words = base.split()
        for _ in range(k % 9):
            words[rng.randrange(len(words))] = "changed" + str(rng.randrange(999))
        rows.append((k, " ".join(words)))
    rows += [(k, prose(30) + " " + passage + "\n" + prose(rng.randrange(5, 50))) for k in range(30, 36)]
    rows += [(36, prose(3000)), (37, "Released under the MIT License. MIT license, CC BY-NC 4.0"), (38, "a|b # $ % " * 30), (39, "GNU General  Public\nLicense apache license")]
    return rows + [(40, "Ünï çödé ßtraße 日本 😀 " * 9), (40, "Ünï çödé ßtraße 日本 😀 " * 9), (41, "<|endoftext|> a<|endoftext|>")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or ""), "clash") for i, t in corpus()]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words_of string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("doc_id < 0")


def rows_of(df, columns):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.select(*columns.split()).collect()), key=repr)


def same(df, columns, expected):
    expected = sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in expected), key=repr)
    assert rows_of(df, columns) == expected


def test_join(docs, empty):
    same(ngram_jaccard_join(docs), "doc_id n_shingles component_id", brute.jaccard(corpus()))
    assert ngram_jaccard_join(empty).count() == 0


def test_quality(docs, empty):
    same(quality.quality_report(docs), "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed", brute.quality(corpus()))
    assert quality.quality_report(empty).count() == 0
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert kept == {r.doc_id for r in quality.quality_report(docs).where("kept").collect()} and 3 in kept and 38 not in kept
    assert quality.keep_good(docs).columns == docs.columns


def test_quality_ablations(docs):
    rows = quality.ledger(docs.select("doc_id", "text"))
    table = {(r.policy, r.rule): (r.n_failed, r.n_only) for r in quality.ablations(rows).collect()}
    bits = [r.fail_bits for r in rows.collect()]
    for policy, names in quality.POLICIES.items():
        for name in names:
            bit, whole = quality.mask([name]), quality.mask(policy)
            assert table.get((policy, name), (0, 0)) == (sum(b & bit > 0 for b in bits), sum(b & whole == bit for b in bits))


def test_contamination(spark, docs, empty):
    items = [(7, corpus()[3][1][:200]), (10, "one"), (2, "changed"), (3, None), (4, " .. "), (5, corpus()[3][1][:200])]
    table = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id long")
    columns = "doc_id n_words n_hit n_items items_sha256 contaminated"
    expected = brute.contamination(corpus(), items)
    same(contamination_report(docs, table), columns, expected)
    same(contamination_report(docs, table, block=5), columns, expected)  # several broadcasts
    same(contamination_report(docs, table.where("item_id < 0")), columns, brute.contamination(corpus(), []))
    assert contamination_report(empty, table).count() == 0
    clean = sorted(r[0] for r in expected if not r[5])
    assert sorted(r.doc_id for r in remove_spans(docs, table, drop_share=0.0).collect()) == clean
    left = remove_spans(docs, table, drop_share=1.0)
    assert left.count() == docs.count() and not contamination_report(left, table).where("doc_id = 3 and contaminated").count()


def test_substrings(docs, empty):
    same(recompress.dedup_substrings(docs.select("doc_id", "text")).withColumnRenamed("kept", "kept_sha256"), "doc_id n_words n_removed kept_sha256", brute.substrings(corpus()))
    assert recompress.dedup_substrings(empty).count() == 0


def test_equal_substrings_have_equal_symbols():
    rng = np.random.default_rng(1)
    common = rng.integers(0, 50, 200).astype(np.uint64)
    texts = [np.concatenate((rng.integers(0, 50, n).astype(np.uint64), common)) for n in (13, 57)]
    bounds = np.array([0, len(texts[0]), len(texts[0]) + len(texts[1])])
    sym, left, right = recompress.symbols(np.concatenate(texts), bounds)
    inner = [{(s, a - bounds[k + 1], b - bounds[k + 1]) for s, a, b in zip(sym, left, right) if a >= bounds[k + 1] - 200 and b <= bounds[k + 1]} for k in (0, 1)]
    assert inner[0] == inner[1] and inner[0]


def test_language(spark, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
    odd = spark.createDataFrame([(1, None, "en"), (2, "12 34 !", "en"), (3, "", None)], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in language.identify_languages(odd).collect()} == {"und"}
    assert language.identify_languages(empty).count() == 0


def test_packing(docs, empty):
    library = brute.tokenizer(packing.VOCABULARY)
    rows = packing.pack(docs, with_ids=True).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        assert r.length in {1 << b for b in range(13)} and r.offset == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
    for i, text in corpus():
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_doc[i], key=lambda r: (r.start, r.sequence_id))
        own = own[::2] if i == 40 else own  # a row that stands twice is packed twice
        assert [x for r in own for x in r.ids] == ids and {r.doc_tokens for r in own} == {len(ids)}
    assert packing.pack(empty).count() == 0


def test_licenses(docs, empty):
    same(licenses.license_scan(docs), "doc_id n_words n_base first_word last_word base_labels", brute.base_licenses(corpus()))
    assert licenses.license_scan(empty).count() == 0


@pytest.mark.parametrize(
    "text, ways, sound",
    [
        ("mit or apache-2.0", {("mit",), ("apache",)}, True),
        ("mit and (gpl-2.0-only with classpath-exception-2.0 or bsd-3-clause)", {("gpl", "mit"), ("bsd", "mit")}, True),
        ("mit or isc and mpl-2.0", {("mit",), ("isc", "mpl")}, True),
        ("(mit or isc", {("mit",), ("isc",)}, False),
        ("mit released in 2020", {("mit",)}, True),
        ("and", None, False),
    ],
)
def test_expressions(text, ways, sound):
    value, well_formed = licenses.parse_expression(licenses.tokens(text.encode()))
    assert (value and {tuple(sorted(w)) for w in value.ways}) == ways and well_formed == sound


def plain_expression(node):
    """``(text, ways)`` of a random expression: its text with the brackets it needs, and its alternatives."""
    kind, *rest = node
    if kind == "id":
        return rest[0], {frozenset([licenses.family(rest[0])])}
    if kind == "with":
        return f"{plain_expression(rest[0])[0]} with {rest[1]}", plain_expression(rest[0])[1]
    sides = [plain_expression(x) for x in rest]
    texts = [f"({t})" if x[0] == "or" and kind == "and" or x[0] == kind and n else t for n, (x, (t, _)) in enumerate(zip(rest, sides))]
    ways = sides[0][1] | sides[1][1] if kind == "or" else {a | b for a in sides[0][1] for b in sides[1][1]}
    return f" {kind} ".join(texts), ways


def test_random_expressions():
    rng = random.Random(6)
    names = ["mit", "apache-2.0", "gpl-2.0+", "bsd-3-clause", "cc-by-nc-4.0", "zlib", "own-1.0", "lgpl-3.0-only"]

    def some(depth):
        kind = rng.choice(["id", "with", "or", "and"]) if depth else "id"
        name = ("id", rng.choice(names))
        return name if kind == "id" else ("with", name, "classpath-exception-2.0") if kind == "with" else (kind, some(depth - 1), some(depth - 1))

    for _ in range(400):
        text, ways = plain_expression(some(rng.randrange(4)))
        value, sound = licenses.parse_expression(licenses.tokens(text.encode()))
        assert sound and value.labels == set().union(*ways) and (value.ways == ways or len(ways) > 16), text


def plain_labels(text):
    """Labels and score of a text whose tagged expressions are sound: phrases by words, expressions by the line."""
    low = brute.lower(text)
    words = brute.ALNUM.findall(low)
    stands = lambda phrase: any(words[k : k + len(p)] == p for p in [phrase.split()] for k in range(len(words)))
    found = {label: 0.8 for phrase, label in licenses.BASE.items() if stands(phrase)}
    for phrase, label in licenses.NOTICES.items():
        if stands(phrase):
            found[label] = max(found.get(label, 0), 0.4 if label == "public-domain" else 0.7)
    for line in low.split("\n"):
        if "spdx-license-identifier:" in line:
            for name in line.split("spdx-license-identifier:")[1].replace("(", " ").replace(")", " ").split():
                if name not in ("or", "and"):
                    found[licenses.family(name)] = 1.0
    return ",".join(sorted(found)), max(found.values(), default=0.0)


def test_license_labels_against_plain(spark):
    rng = random.Random(8)
    parts = [*licenses.BASE, *licenses.NOTICES, "some words", "license", "gnu", "\n", "// SPDX-License-Identifier: (MIT OR ISC) AND zlib\n", "# spdx-license-identifier: Apache-2.0\n", "é"]
    rows = [(i, " ".join(rng.choice(parts).title() if rng.random() < 0.3 else rng.choice(parts) for _ in range(rng.randrange(1, 9)))) for i in range(400)]
    rows += [(500, None), (None, "MIT License"), (None, "MIT License")]
    found = sorted(((r.doc_id, r.labels, r.score) for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert found == sorted(((i, *plain_labels(t)) for i, t in rows), key=repr)


def test_many_tags_in_a_line_are_linear():
    import time

    machine, start = licenses.automaton(), time.process_time()
    places, base, labels, score = licenses.scan_text(b"spdx-license-identifier: mit " * 100_000, machine)
    assert labels == {"mit"} and score > 0 and time.process_time() - start < 20


def test_tagged_licenses(spark):
    rows = [(1, "code\n// SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\nint x;"), (2, "MIT license " * 2000)]
    found = {r.doc_id: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].labels == "apache,bsd,mit" and found[1].score == 1.0 and found[1].n_base == 0
    assert (found[2].n_base, found[2].last_word, found[2].base_labels) == (2000, 3998, "mit")


def test_lm_scores(docs, empty):
    df = lattice.lattice_scores(docs)
    same(df, "doc_id held_out n_tokens n_known train_tokens base_score", brute.unigram(corpus()))
    assert all(r.score < 0 for r in df.collect())
    assert lattice.lattice_scores(empty).count() == 0


def test_lattice_sums_all_segmentations():
    pieces = sorted({b"a", b"b", b"ab", b"ba", b"aba", b"c"})
    logs = np.log(np.array([0.3, 0.1, 0.2, 0.1, 0.2, 0.1]))
    words = [b"a", b"abab", b"cabba", b"b" * 9]
    known = lattice.Lattice(pieces, logs)
    expected = [brute.lattice_log10(w, dict(zip(pieces, logs))) for w in words]
    assert np.allclose(known.log_probabilities(words) / np.log(10), expected)
    counts, likelihood = known.expected_counts(words, np.array([1.0, 2, 1, 3]))
    assert np.isclose(likelihood, np.log(10) * (np.array(expected) @ [1, 2, 1, 3]))
    plain = dict.fromkeys(pieces, 0.0)

    def ways(word):
        return [[]] if not word else [[p, *rest] for p in pieces if word.startswith(p) for rest in ways(word[len(p) :])]

    for word, n in zip(words, (1, 2, 1, 3)):
        weighed = [(np.exp(sum(logs[pieces.index(p)] for p in way)), way) for way in ways(word)]
        for weight, way in weighed:
            for p in way:
                plain[p] += n * weight / sum(w for w, _ in weighed)
    assert np.allclose(counts, [plain[p] for p in pieces])


def test_lm_scores_of_documents(spark, docs):
    """The score of each text from the fitted weights, word by word, against all its segmentations."""
    rows = [(i, t) for i, t in corpus() if i not in (7, 36)]  # the plain version is slow on the long texts
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(((r.doc_id, r.score) for r in lattice.lattice_scores(table).collect()))
    pieces, logs = lattice.vocabulary(lattice.public_tokenizers.path(lattice.VOCABULARY))
    assert np.isclose(np.exp(logs).sum(), 1) and logs[pieces.index("▁the".encode())] > logs[pieces.index(b"\xff")]
    texts = [(i, brute.WORD.findall(brute.lower(t)), zlib.crc32(str(i).encode()) % 7 == 2) for i, t in rows]
    counted = brute.Counter(w for _, own, out in texts if not out for w in own)
    words = spark.createDataFrame([(w.encode(), n) for w, n in counted.items()], "word binary, c long")
    known = dict(zip(pieces, lattice.fitted(words, pieces, logs)))
    ends = sum(not out for *_, out in texts)
    share = (ends + 1) / (sum(counted.values()) + ends + 2)
    one = {w: brute.lattice_log10("▁".encode() + w.encode(), known) for w in {w for _, own, _ in texts for w in own}}
    expected = sorted((i, sum(one[w] for w in own) + len(own) * np.log10(1 - share) + np.log10(share)) for i, own, _ in texts)
    assert [i for i, _ in found] == [i for i, _ in expected]
    assert np.allclose([s for _, s in found], [s for _, s in expected], rtol=1e-9)


def test_lattice_fit_ends_when_it_hardly_gains(spark):
    pieces, logs = [b"a", b"b", b"ab", lattice._BEGIN], np.log(np.full(4, 0.25))
    words = spark.createDataFrame([(b"abab", 10), (b"ab", 5), (b"zz", 0)], "word binary, c long")
    once, likelihood = lattice._estimate(words, pieces, logs)
    again, better = lattice._estimate(words, pieces, once)
    assert better > likelihood and np.allclose(lattice.fitted(words, pieces, logs, 1), once)
    assert np.allclose(lattice.fitted(words.where("c = 0"), pieces, logs), logs)


def test_urls(spark):
    rows = [
        (1, "https://www.Example.com/en/1?x#y"), (2, "https://a.example.com/en/1"), (3, "http://b.com"), (4, "http://b.com/x"),
        (5, "https://q.net/es/#a"), (6, None), (7, "no scheme"), (8, "https://q.org/a?b/c"), (8, "https://q.org/a?b/c"),
    ]
    table = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, rule string")
    found = sorted((r.page_id, r.host, r.path, r.rule) for r in urls.judge_urls(table).na.fill("", "rule").collect())
    assert found == [
        (1, "www.example.com", "/en/1", "www.example.com/en/"), (2, "a.example.com", "/en/1", "example.com/en/"), (3, "b.com", "", ""),
        (4, "b.com", "/x", "com/"), (5, "q.net", "/es/", "net/es/"), (6, "", "", ""), (7, "", "", ""), (8, "q.org", "/a", ""), (8, "q.org", "/a", ""),
    ]
    verdicts = {r.page_id: r.verdict for r in urls.judge_urls(table).collect()}
    assert (verdicts[1], verdicts[2], verdicts[4], verdicts[5]) == ("allow", "block", "allow", "block")
    assert verdicts[6] == verdicts[7]  # both have the end mark alone
    assert urls.judge_urls(table.where("page_id < 0")).count() == 0


def test_url_models_part_known_kinds(spark):
    train = [(i, f"https://{'good' if i % 2 else 'spam'}{i}.{'com/x' if i % 2 else 'net/es/x'}") for i in range(200)]
    asked = [(1000, "https://good7.org/x"), (1001, "https://spam8.org/es/x")]
    table = spark.createDataFrame(train + asked, "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in urls.judge_urls(table).where("page_id >= 1000").collect()}
    assert verdicts == {1000: "allow", 1001: "block"}


def test_token_counts(docs, empty):
    same(tokens.token_counts(docs), "doc_id n_bytes n_tokens over_limit", brute.token_counts(corpus()))
    assert tokens.token_counts(empty).count() == 0
