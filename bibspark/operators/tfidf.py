"""TF-IDF vectors over word n-grams.

The vocabulary is an exact top-k by corpus frequency. Both document and corpus
frequency of an n-gram are bounded by those of the (n-1)-grams inside it, so
longer n-grams are counted only where both of their parts can still make the
list. There they are numbers, found batch by batch (:mod:`grams`); where the
parts are too many to be sent to every task, they are joined, and n-grams in the slots of a count sketch that are not full
enough never leave their row. Vectors are computed row by row from a fixed-size vocabulary: no exchange at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.tokens import ngrams
from ..session import materialize
from .grams import Grams, counted as counted_codes, flat, slices


SKETCH = 1 << 18  # slots of a count sketch
KNOWN = 200_000  # parts of n-grams that are sent to every task; with more they are joined


class EmptyCorpus(ValueError):
    """No document holds a token."""


@dataclass(frozen=True)
class Vocabulary:
    """Terms with document and corpus frequency, rarest first; ``n`` documents.

    Term positions are the vector indices, so ascending indices run from rare
    to common terms.
    """

    terms: list[str]
    df: list[int]
    cf: list[int]
    n: int
    ngram: tuple[int, int]

    @property
    def idf(self) -> list[float]:
        return [math.log((1 + self.n) / (1 + d)) + 1 for d in self.df]


def _slot(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(SKETCH)).cast("int")


def _full_slots(docs: DataFrame, n: int, least: int) -> DataFrame:
    """One row, ``bits array<long>``: the slots whose n-grams together occur ``least`` times or more.

    A task sends at most one count per slot, however many n-grams it has.
    """
    slots = docs.select(F.explode(F.transform(ngrams(F.col("tokens"), n), _slot)).alias("slot"))
    full = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("cf")).filter(F.col("cf") >= least)
    words = full.groupBy(F.expr("slot div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, slot % 64)")).alias("bits"))
    every = docs.sparkSession.range(SKETCH // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    listed = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(listed.alias("_w")).select(F.col("_w.bits").alias("bits"))


def gram_counts(docs: DataFrame, n: int, parts: DataFrame | None = None, least: int = 0) -> DataFrame:
    """``term, df, cf`` of the n-grams of one order, in a single aggregation.

    The n-grams of a row are sorted, so the first of each run stands for the
    document and no (document, term) exchange is needed. With ``parts`` only
    n-grams whose first and last (n-1)-gram are listed there are counted. With
    ``least`` those that cannot occur so often are left out in the row: they
    share a slot of a count sketch, an upper bound, that is not full.
    """
    found = ngrams(F.col("tokens"), n)
    if least > 1:
        docs = docs.select("tokens").join(F.broadcast(_full_slots(docs, n, least)))  # one row of fixed size
        found = F.filter(found, lambda g: F.getbit(F.element_at("bits", F.expr("1") + F.floor(_slot(g) / 64).cast("int")), F.pmod(_slot(g), F.lit(64))) == 1)
    rows = docs.select(F.sort_array(found).alias("g"))
    marked = F.transform(
        "g", lambda g, i: F.struct(g.alias("term"), ((i == 0) | (g != F.get("g", i - 1))).cast("int").alias("first"))
    )
    grams = rows.select(F.inline(marked))
    if parts is not None:
        known = parts.select(F.col("term").alias("part"))
        for part in (F.substring_index("term", " ", n - 1), F.substring_index("term", " ", 1 - n)):
            grams = grams.withColumn("part", part).join(known, "part", "left_semi")
    return grams.groupBy("term").agg(F.sum("first").alias("df"), F.count(F.lit(1)).alias("cf"))


def word_counts(docs: DataFrame) -> DataFrame:
    """``term, df, cf`` of the tokens; a task sends each word once for some millions of tokens."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            for low, high in slices(lists):
                tokens, row, _ = flat(lists.slice(low, high - low))
                coded = tokens.dictionary_encode()
                code, df, cf = counted_codes(coded.indices.to_numpy().astype(np.int64), row)
                yield pa.record_batch([coded.dictionary.take(pa.array(code)), pa.array(df), pa.array(cf)], ["term", "df", "cf"])

    found = docs.select("tokens").mapInArrow(task, "term string, df long, cf long")
    return found.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def known_counts(docs: DataFrame, n: int, parts: list[str], least: int = 0) -> DataFrame:
    """``term, df, cf`` of the n-grams whose first and last (n-1)-gram are among ``parts`` and that occur ``least`` times.

    They travel as numbers; a task sends each once for some millions of tokens.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Grams(parts))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            lists = batch.column(0)
            for low, high in slices(lists):
                tokens, row, left = flat(lists.slice(low, high - low))
                words, nodes = known.find(tokens, left)
                node = nodes[-1] if len(nodes) == n - 1 else np.full(len(words), -1, np.int64)
                at = np.flatnonzero((node >= 0) & (left >= n))
                at = at[node[at + 1] >= 0]
                code, df, cf = counted_codes(node[at] * known.width + words[at + n - 1], row[at])
                yield pa.record_batch([pa.array(code), pa.array(df), pa.array(cf)], ["code", "df", "cf"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            code = batch.column("code").to_numpy()
            first, last = known.term[n - 2][code // known.width], code % known.width
            terms = [f"{known.terms[i]} {known.words[j]}" for i, j in zip(first.tolist(), last.tolist())]
            yield pa.record_batch([pa.array(terms, pa.string()), batch.column("df"), batch.column("cf")], ["term", "df", "cf"])

    found = docs.select("tokens").mapInArrow(task, "code long, df long, cf long")
    found = found.groupBy("code").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf")).filter(F.col("cf") >= least)
    return found.mapInArrow(name, "term string, df long, cf long")


def vocabulary(
    docs: DataFrame,
    max_features: int = 5000,
    min_df: int = 1,
    max_df: float = 1.0,
    ngram: tuple[int, int] = (1, 3),
) -> Vocabulary:
    """The ``max_features`` most frequent n-grams with ``min_df <= df <= max_df * n``.

    Ties are broken by term. ``docs`` needs a ``tokens`` column; documents
    without tokens count towards ``n`` (drop them first if they should not).
    """
    low, high = ngram
    stats = docs.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("tokens") > 0).alias("full")).first()
    if not stats["full"]:
        raise EmptyCorpus("no document has tokens")
    top_df = max_df * stats["n"]
    fits = (F.col("df") >= min_df) & (F.col("df") <= top_df)
    eligible: list[DataFrame] = []
    parts, bound = None, 0
    for order in range(1, high + 1):
        counted = _counts(docs, order, parts, bound)
        counted = materialize(counted.filter(F.col("df") >= min_df), f"grams{order}")
        if order >= low:
            eligible.append(counted.filter(fits))
            bound = _kth_frequency(reduce(DataFrame.unionByName, eligible), max_features)
        parts = counted.filter(F.col("cf") >= bound)
    chosen = (
        reduce(DataFrame.unionByName, eligible)
        .orderBy(F.desc("cf"), "term")
        .limit(max_features)
        .orderBy("df", "term")
        .collect()  # at most max_features rows
    )
    return Vocabulary(
        [r["term"] for r in chosen], [r["df"] for r in chosen], [r["cf"] for r in chosen], stats["n"], ngram
    )


def _counts(docs: DataFrame, n: int, parts: DataFrame | None, least: int) -> DataFrame:
    """The n-grams of one order that can make the list, by numbers where their parts are few enough to be sent around."""
    if parts is None:
        return word_counts(docs)
    names = [r[0] for r in parts.select("term").limit(KNOWN + 1).collect()]  # at most so many rows
    if len(names) > KNOWN:
        return gram_counts(docs, n, parts, least)
    return known_counts(docs, n, names, least)


def _kth_frequency(counts: DataFrame, k: int) -> int:
    """The k-th largest corpus frequency; 0 with fewer rows."""
    row = (
        counts.select("cf").orderBy(F.desc("cf")).limit(k)
        .agg(F.count(F.lit(1)).alias("rows"), F.min("cf").alias("cf")).first()
    )
    return row["cf"] if row["rows"] == k else 0


def vocabulary_df(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    spark = docs.sparkSession
    rows = [(t, i, d, c, w) for i, (t, d, c, w) in enumerate(zip(vocab.terms, vocab.df, vocab.cf, vocab.idf))]
    return spark.createDataFrame(rows, "term string, idx int, df long, cf long, idf double")


def tfidf(docs: DataFrame, vocab: Vocabulary, id_col: str = "doc_id") -> DataFrame:
    """Unit-length sparse vectors ``id, features, key``; documents without a known term are left out.

    ``key`` is the same for documents whose term counts are proportional: their vectors are equal, up to rounding.
    """
    shared = docs.sparkSession.sparkContext.broadcast((Grams(vocab.terms), np.array(vocab.idf)))
    low, high = vocab.ngram

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, idf = shared.value
        for batch in batches:
            for first, stop in slices(batch.column("tokens")):
                tokens, row, left = flat(batch.column("tokens").slice(first, stop - first))
                # a number for each document and term that occurs in it
                found = [np.zeros(0, np.int64)]
                for order, (node, term) in enumerate(zip(known.find(tokens, left)[1], known.term), 1):
                    if low <= order <= high:
                        at = np.flatnonzero(node >= 0)
                        at = at[term[node[at]] >= 0]
                        found.append(row[at] * len(idf) + term[node[at]])
                code, count = np.unique(np.concatenate(found), return_counts=True)
                doc, idx = np.divmod(code, max(1, len(idf)))
                begin = np.flatnonzero(np.concatenate((np.ones(min(1, len(doc)), bool), doc[1:] != doc[:-1])))
                bounds, of = np.append(begin, len(doc)), doc[begin]
                run = np.repeat(np.arange(len(begin)), np.diff(bounds))
                weight = count * idf[idx]
                unit = weight / np.sqrt(np.bincount(run, weight * weight, len(begin)))[run]
                # quotients of equal ratios are equal doubles
                share, idx = count / count[begin][run], idx.astype(np.int32)
                keys = [sha256(idx[a:b].tobytes() + share[a:b].tobytes()).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
                lists = lambda x: pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(x))
                size, none = pa.array(np.full(len(of), len(idf), np.int32)), pa.array(np.zeros(len(of), np.int8))
                features = pa.StructArray.from_arrays([none, size, lists(idx), lists(unit)], ["type", "size", "indices", "values"])
                yield pa.record_batch([batch.column(id_col).slice(first).take(pa.array(of)), features, pa.array(keys, pa.string())], [id_col, "features", "key"])

    schema = StructType([docs.schema[id_col], StructField("features", VectorUDT()), StructField("key", StringType())])
    return docs.select(id_col, "tokens").mapInArrow(task, schema)


def indices(features: Column) -> Column:
    """Indices of a sparse vector column as an array."""
    return F.unwrap_udt(features)["indices"]


def values(features: Column) -> Column:
    """Stored values of a vector column as an array."""
    return F.unwrap_udt(features)["values"]


def total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda acc, x: acc + x)


def weights(vectors: DataFrame, vocab: Vocabulary, id_col: str = "doc_id") -> DataFrame:
    """Long form ``id, term, w``."""
    entry = F.explode(F.arrays_zip(indices(F.col("features")).alias("i"), values(F.col("features")).alias("w")))
    terms = F.array(*[F.lit(t) for t in vocab.terms])
    return vectors.select(id_col, entry.alias("e")).select(
        id_col, F.get(terms, F.col("e.i")).alias("term"), F.col("e.w").alias("w")
    )
