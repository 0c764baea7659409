"""The pipeline's stages against a plain version of all of them."""

import zlib

import brute
import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from test_near_duplicates import groups

from bibspark.llm import packing

SF = "/root/testdata/sf0.001"


def plain(docs, items):
    rows = {i: t for i, t in docs}
    upper = lambda t: sum(c.isupper() for c in t)
    kept = []
    for (i, n, chars, symbols, dup, _, failed), (_, text) in zip(brute.quality(docs), docs):
        lines = [x for x in text.split("\n") if brute.WORD.search(x)]
        letters = sum(c.isalpha() for c in text)
        if not (failed or 10 * symbols > n or chars < 3 * n or chars > 10 * n or 100 * dup > 30 * len(lines) or 2 * upper(text) > chars or 2 * letters < chars):
            kept.append(i)
    docs = [(i, rows[i]) for i in kept]
    group, low = groups([t for _, t in docs]), {}
    for g, (i, _) in zip(group, docs):
        low[g] = min(low.get(g, i), i)
    docs = [(i, t) for g, (i, t) in zip(group, docs) if i == low[g]]
    texts = []
    for (i, text), (_, n, removed, _) in zip(docs, brute.substrings(docs)):
        if removed:
            words, gone = brute.WORD.findall(text), removed_words(docs, i)
            text = " ".join(w for k, w in enumerate(words) if k not in gone)
        if not n or removed < n:
            texts.append((i, text))
    clean = {r[0] for r in brute.contamination(texts, items) if not r[5]}
    return {i: t for i, t in texts if i in clean}


def removed_words(docs, doc_id, n=35):
    from collections import Counter

    words = {i: brute.WORD.findall(t) for i, t in docs}
    count = Counter(tuple(w[k : k + n]) for w in words.values() for k in range(len(w) - n + 1))
    own = words[doc_id]
    return {p for k in range(len(own) - n + 1) if count[tuple(own[k : k + n])] > 1 for p in range(k, k + n)}


def test_run(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    expected = set()
    library = brute.tokenizer(packing.VOCABULARY)
    for i, text in plain(docs, items).items():
        ids, at = np.array(library.encode(text, add_special_tokens=False).ids + [2], "<u4"), 0
        for n in packing.power_lengths(len(ids)):
            expected.add((i, at, n, zlib.crc32(ids[at : at + n].tobytes()), len(ids)))
            at += n
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows} == expected
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(0).unionByName(spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0)], docs.schema))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_columns_with_names_of_the_operators(spark):
    """Extra columns, whatever their names, go through every stage as they are; null ids and texts stay whole."""
    base = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 40")
    odd = spark.createDataFrame([(None, "a text without an id " * 30, "en", "s", 9), (7000, None, None, None, None)], base.schema)
    names = ["n_words", "key", "kept", "windows", "shared", "n_removed", "counts_only", "_hits", "_n_words", "_row", "row", "fail_bits", "a.b", "c0", "owner", "component", "set_id"]
    docs = base.union(odd).withColumns({f"{n}": F.concat(F.lit(n), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))) for n in names if n != "a.b"})
    docs = docs.select("*", F.lit("dot").alias("a.b"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n}{'-' if r.doc_id is None else r.doc_id}" for r in rows for n in names if n != "a.b")
        assert all(r["a.b"] == "dot" for r in rows)
    assert corpus_pipeline.packing(spark, docs, SF).count() > 0


def test_empty_benchmark(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 20")
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, docs.collect()))
