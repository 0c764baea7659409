"""Cosine similarity over sparse TF-IDF vectors.

What needs only sums of similarities (centrality, corpus percentage, one
against all) is computed from the vectors in linear time. Similar pairs and
neighbours come from products of bounded tiles (:mod:`tiles`); tiles that
cannot hold a similar pair do not meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import ElementwiseProduct, Normalizer
from pyspark.ml.linalg import DenseVector, Vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

from ..functions.tokens import keep_if
from ..session import materialize
from . import tiles
from .grams import counted, flat
from .tfidf import indices, total, values

_SLACK = 1e-9  # rounding allowance


def unit_arrays(vectors: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``id, idx, val`` arrays of a sparse vector column, and ``key``, the same for equal vectors.

    Vectors of :func:`tfidf.tfidf` bring the key of their term counts; for others it follows from the values.
    """
    f = F.col("features")
    exact = F.sha2(F.concat_ws(",", indices(f).cast("array<string>"), values(f).cast("array<string>")), 256)
    key = F.col("key") if "key" in vectors.columns else exact
    return vectors.select(F.col(id_col).alias("id"), indices(f).alias("idx"), values(f).alias("val"), key.alias("key"))


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n"))


def copies(rows: DataFrame) -> DataFrame:
    """``id, rep`` for every row of :func:`unit_arrays`: ``rep`` is the smallest id with the same vector."""
    return rows.select("id", "key").join(_groups(rows), "key").select("id", "rep")


def representatives(rows: DataFrame) -> DataFrame:
    """One row per distinct vector: ``id`` (smallest), ``idx, val, n`` rows that share it."""
    return rows.drop("key").join(_groups(rows).select(F.col("rep").alias("id"), "n"), "id")


@F.arrow_udf(DoubleType())
def dot(ai: pa.Array, av: pa.Array, bi: pa.Array, bv: pa.Array) -> pa.Array:
    """Inner products of sparse vectors given as ascending index arrays and value arrays.

    One binary search per batch: keys are (row, index), ascending on both sides.
    """
    def flat(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(array.offsets.to_numpy()), array.flatten().to_numpy(zero_copy_only=False)

    (na, ia), (nb, ib) = flat(ai), flat(bi)
    width = 1 + max(ia.max(initial=0), ib.max(initial=0))
    rows = np.repeat(np.arange(len(na), dtype=np.int64), na)
    key_a = rows * width + ia
    key_b = np.repeat(np.arange(len(nb), dtype=np.int64), nb) * width + ib
    at = np.minimum(np.searchsorted(key_b, key_a), max(len(key_b) - 1, 0))
    hit = key_b[at] == key_a if len(key_b) else np.zeros(len(key_a), bool)
    products = flat(av)[1][hit] * flat(bv)[1][at[hit]]
    return pa.array(np.bincount(rows[hit], weights=products, minlength=len(na)))


def dot_pairs(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Add ``sim``, the inner product of the two vectors, to ``i, j`` rows."""
    a = vectors.select(F.col("id").alias("i"), F.col("idx").alias("ai"), F.col("val").alias("av"))
    b = vectors.select(F.col("id").alias("j"), F.col("idx").alias("bi"), F.col("val").alias("bv"))
    sim = dot(F.col("ai"), F.col("av"), F.col("bi"), F.col("bv"))
    return pairs.join(a, "i").join(b, "j").withColumn("sim", sim).drop("ai", "av", "bi", "bv")


def similar_vectors(vectors: DataFrame, min_sim: float, *more: str) -> DataFrame:
    """``i, j, sim`` of distinct vectors (``id, idx, val``) with ``i < j`` and ``sim >= min_sim``, by products of tiles.

    ``more`` columns of the vectors come as ``<name>_i, <name>_j`` behind them: the pairs need not be joined for them.
    """
    if min_sim <= 0:
        raise ValueError("min_sim must be positive; sums over all pairs have their own operators")
    kind = vectors.schema["id"].dataType.simpleString()

    def meet(left: tiles.Rows, right: tiles.Rows, same: bool) -> Iterator[pd.DataFrame]:
        for low, first, block in tiles.products(left, right):
            a, b = np.nonzero((block >= min_sim - _SLACK) & (block > 0))
            if same:
                once = left["id"][low + a] < right["id"][first + b]
                a, b = a[once], b[once]
            i, j, sim = left["id"][low + a], right["id"][first + b], block[a, b]
            first_i = i < j
            out = {"i": np.where(first_i, i, j), "j": np.where(first_i, j, i), "sim": sim}
            for name in more:
                x, y = left[name][low + a], right[name][first + b]
                out |= {f"{name}_i": np.where(first_i, x, y), f"{name}_j": np.where(first_i, y, x)}
            yield pd.DataFrame(out)

    rows, n = tiles.tiled(vectors.select("id", "idx", "val", *more))
    kinds = [f"{c}_{side} {vectors.schema[c].dataType.simpleString()}" for c in more for side in "ij"]
    return tiles.visit(rows, n, meet, ", ".join([f"i {kind}, j {kind}, sim double", *kinds]), min_sim)


def neighbours(vectors: DataFrame, n: int = 1000, id_col: str = "doc_id") -> DataFrame:
    """``i, rank, j, sim``: the ``n`` most similar other documents of each document, ties by id; exact.

    Documents without a common term have similarity 0 and come last by id. Each pair of tiles gives at most ``n`` rows per
    document, less where the document's own tile already has ``n`` better ones.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    rows, count = tiles.tiled(unit_arrays(vectors, id_col).select("id", "idx", "val"))
    if count > 1:

        def bound(frame: pd.DataFrame) -> pd.DataFrame:
            own, reach = tiles.Rows(frame), np.zeros(len(frame))
            if len(own) > n:
                best = np.full((len(own), n), -np.inf)
                for low, first, block in tiles.products(own, own):
                    at = slice(low, low + len(block))
                    block[low + np.arange(len(block))[:, None] == first + np.arange(block.shape[1])] = -np.inf
                    best[at] = np.partition(np.hstack((best[at], block)), -n, axis=1)[:, -n:]
                reach = best.min(axis=1)
            return pd.DataFrame({"id": own["id"], "reach": reach})

        rows = materialize(rows.join(rows.groupBy("tile").applyInPandas(bound, f"id {kind}, reach double"), "id"), "reach")

    def best(sims: np.ndarray, reach: np.ndarray, ids: np.ndarray, others: np.ndarray) -> list[pd.DataFrame]:
        out = []
        for at in range(0, len(sims), 64):
            raw = sims[at : at + 64]
            block = np.round(raw, 9)  # equal up to rounding is a tie
            order = np.lexsort((np.broadcast_to(others, block.shape), -block), axis=1)[:, :n]
            row = np.repeat(np.arange(len(block)), order.shape[1])
            sim = block[row, order.ravel()]
            ok = (sim >= reach[at + row] - 2 * _SLACK) & (sim >= 0)
            out.append(pd.DataFrame({"i": ids[at + row][ok], "j": others[order.ravel()][ok], "sim": raw[row, order.ravel()][ok], "key": sim[ok]}))
        return out

    def meet(left: tiles.Rows, right: tiles.Rows, same: bool) -> pd.DataFrame:
        parts, whole = [], np.zeros((len(left), len(right)))
        for low, first, block in tiles.products(left, right):
            whole[low : low + len(block), first : first + block.shape[1]] = block
        if same:
            np.fill_diagonal(whole, -1.0)
        for a, b, sims in ((left, right, whole), *(() if same else ((right, left, whole.T),))):
            reach = a["reach"] if count > 1 else np.zeros(len(a))
            parts += best(sims, reach, a["id"], b["id"])
        return pd.concat(parts)

    found = tiles.visit(rows, count, meet, f"i {kind}, j {kind}, sim double, key double")
    order = Window.partitionBy("i").orderBy(F.desc("key"), "j")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).select("i", "rank", "j", "sim")


def cosine_pairs(vectors: DataFrame, min_sim: float, id_col: str = "doc_id") -> DataFrame:
    """Similar pairs of distinct vectors with the number of documents behind each.

    Columns ``i, j, n_i, n_j, sim``: ``i < j`` are the smallest ids of their
    copies. Identical documents are not paired with each other; a row
    ``i = j, sim = 1`` stands for every group of copies. :func:`copies` maps
    each document to its group.
    """
    reps = materialize(representatives(unit_arrays(vectors, id_col)), "reps")
    repeated = reps.groupBy("id").count().filter("count > 1").limit(1).count()
    if repeated:  # every row of an id counts, as in a join
        sizes = reps.select("id", "n")
        pairs = similar_vectors(reps, min_sim).join(sizes.select(F.col("id").alias("i"), F.col("n").alias("n_i")), "i")
        pairs = pairs.join(sizes.select(F.col("id").alias("j"), F.col("n").alias("n_j")), "j").select("i", "j", "n_i", "n_j", "sim")
    else:
        pairs = similar_vectors(reps, min_sim, "n").select("i", "j", "n_i", "n_j", "sim")
    groups = reps.filter("n > 1").select(
        F.col("id").alias("i"), F.col("id").alias("j"), F.col("n").alias("n_i"), F.col("n").alias("n_j"),
        F.lit(1.0).alias("sim"),
    )
    return pairs.unionByName(groups)


# --- sums and single rows, without pairs -----------------------------------------------------


def _times(vectors: DataFrame, factor: Vector, out: str) -> DataFrame:
    """Add the inner product with one fixed vector; row by row."""
    product = ElementwiseProduct(scalingVec=factor, inputCol="features", outputCol="_p")
    return product.transform(vectors).withColumn(out, total(values(F.col("_p")))).drop("_p")


def vector_sum(vectors: DataFrame) -> DenseVector:
    """Sum of all vectors; its length is that of the vocabulary."""
    return vectors.select(Summarizer.sum(F.col("features"))).first()[0]


def most_similar(vectors: DataFrame, doc, k: int = 5, id_col: str = "doc_id") -> DataFrame:
    """The ``k`` documents most similar to ``doc`` (itself left out), ties by id."""
    target = vectors.filter(F.col(id_col) == F.lit(doc)).select("features").first()
    if target is None:
        raise KeyError(f"document {doc!r} has no vector")
    others = vectors.filter(F.col(id_col) != F.lit(doc))
    return (
        _times(others, DenseVector(target[0].toArray()), "sim")
        .select(id_col, "sim")
        .orderBy(F.desc("sim"), id_col)
        .limit(k)
    )


def compare_models(
    models: dict[str, DataFrame], docs: DataFrame, doc, k: int = 5, id_col: str = "doc_id", text_col: str = "abstract"
) -> DataFrame:
    """Neighbours of ``doc`` under several models: ``Modelo, Índice, Similitud, Extracto del Abstract``."""
    parts = [
        most_similar(vectors, doc, k, id_col).withColumn("Modelo", F.lit(name)) for name, vectors in models.items()
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    # k rows per model
    return docs.join(F.broadcast(found), id_col).select(
        "Modelo",
        F.col(id_col).alias("Índice"),
        F.col("sim").alias("Similitud"),
        F.substring(text_col, 1, 100).alias("Extracto del Abstract"),
    )


def centrality(vectors: DataFrame) -> DataFrame:
    """Add ``score``, the sum of similarities to all documents, itself included."""
    return _times(vectors, vector_sum(vectors), "score").drop("features", "key")


def most_central(vectors: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return centrality(vectors).orderBy(F.desc("score"), id_col).limit(1)


def corpus_similarity(vectors: DataFrame, n: int | None = None, include_self: bool = True) -> DataFrame:
    """Total similarity over n * (n - 1) pairs, in percent.

    ``n`` counts documents without a vector too if given. Self pairs are part
    of the total unless ``include_self`` is false.
    """
    stats = vectors.agg(
        Summarizer.sum(F.col("features")).alias("s"), F.count(F.lit(1)).alias("rows")
    ).select("rows", total(F.transform(values(F.col("s")), lambda x: x * x)).alias("total"))
    size = F.lit(n) if n is not None else F.col("rows")
    inner = F.col("total") if include_self else F.col("total") - F.col("rows")
    return stats.select(
        size.cast("long").alias("n"),
        inner.alias("total"),
        F.when(size > 1, 100 * inner / (size * (size - 1))).alias("percent"),
    )


# --- bounded groups ---------------------------------------------------------------------------


def heatmap_table(vectors: DataFrame, ids: list, id_col: str = "doc_id") -> DataFrame:
    """Similarities ``i, j, sim`` (both orders and self) among a short list of documents; 0 without a common term."""
    chosen = vectors.filter(F.col(id_col).isin(list(ids)))
    rows = unit_arrays(chosen, id_col)
    left = rows.select(F.col("id").alias("i"), F.explode(F.arrays_zip("idx", "val")).alias("e"))
    right = rows.select(F.col("id").alias("j"), F.explode(F.arrays_zip("idx", "val")).alias("f"))
    products = left.join(right, F.col("e.idx") == F.col("f.idx")).select("i", "j", (F.col("e.val") * F.col("f.val")).alias("sim"))
    # a zero for each cell of the wanted square
    others = F.array(*[F.lit(i) for i in ids])
    cells = rows.select(F.col("id").alias("i"), F.explode(others).alias("j"), F.lit(0.0).alias("sim"))
    cells = cells.join(rows.select(F.col("id").alias("j")), "j", "left_semi").select("i", "j", "sim")
    return products.union(cells).groupBy("i", "j").agg(F.sum("sim").alias("sim"))


def with_phrase(
    vectors: DataFrame, docs: DataFrame, phrase: str, id_col: str = "doc_id", text_col: str = "abstract"
) -> DataFrame:
    """The rows of ``vectors`` whose documents contain ``phrase`` as given; their pairs are those of the phrase."""
    return vectors.join(docs.filter(F.contains(F.lower(text_col), F.lit(phrase))).select(id_col), id_col, "left_semi")


def blocked_pairs(
    docs: DataFrame,
    block_size: int = 1000,
    min_sim: float = 0.0,
    max_features: int = 5000,
    id_col: str = "doc_id",
    position: Column | None = None,
    ngram: tuple[int, int] = (1, 3),
) -> DataFrame:
    """Similarity inside fixed blocks of the corpus, each with a vocabulary of its own.

    ``position`` is the 0-based place of a document (default: its id). Returns
    ``block, i, j, sim`` with ``i < j`` and ``sim > min_sim``. A block is at
    most ``block_size`` documents by ``max_features`` terms, one matrix product; its
    documents come together once, as tokens, and their n-grams are counted there.
    """
    place = F.col(id_col) if position is None else position
    block = F.floor(place / block_size)
    rows = docs.select(block.alias("block"), F.col(id_col).alias("id"), "tokens").filter(F.col("block").isNotNull())
    low, high = ngram

    def product(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, row_of = np.unique(pdf["id"].to_numpy(), return_inverse=True)
        lists = pa.array([None if x is None else list(x) for x in pdf["tokens"]], pa.list_(pa.string()))
        row, col, tf, df = _leading_terms(lists, low, high, max_features)
        if not len(row):
            return pd.DataFrame({"block": [], "i": [], "j": [], "sim": []})
        dense = np.zeros((len(ids), len(df)))
        dense[row_of[row], col] = tf * (np.log((1 + len(pdf)) / (1 + df)) + 1)[col]
        some = dense.any(axis=1)
        ids, dense = ids[some], dense[some]
        dense /= np.linalg.norm(dense, axis=1, keepdims=True)
        sims = dense @ dense.T
        i, j = np.nonzero(np.triu(sims > min_sim, k=1))
        return pd.DataFrame({"block": pdf["block"].iloc[0], "i": ids[i], "j": ids[j], "sim": sims[i, j]})

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.groupBy("block").applyInPandas(product, f"block long, i {kind}, j {kind}, sim double")


def _leading_terms(lists: pa.ListArray, low: int, high: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``row, col, tf`` of the ``most`` most frequent n-grams of a block, ties by term, and the rows ``df`` that hold each."""
    tokens, row, left = flat(lists)
    coded = tokens.dictionary_encode()
    words = coded.dictionary.to_pylist()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    node, places, names = number, [], []
    for order in range(1, high + 1):
        at = np.flatnonzero(left >= order)
        if order > 1:
            code = node[at] * len(words) + number[at + order - 1]
            node = np.full(len(number), -1, np.int64)
            node[at] = np.unique(code, return_inverse=True)[1]
        if order >= low:
            places.append((order, at, node[at]))
    # one row per distinct n-gram: its order, a place where it stands, and its counts
    for order, at, own in places:
        code, df, cf = counted(own, row[at])
        first = np.zeros(len(code), np.int64)
        first[own] = at
        names.append(np.column_stack((np.full(len(code), order), first, df, cf, code)).reshape(-1, 5))
    grams = np.concatenate([np.zeros((0, 5), np.int64), *names])
    if len(grams) > most:
        least = np.partition(grams[:, 3], -most)[-most]
        sure, tied = grams[grams[:, 3] > least], grams[grams[:, 3] == least]
        term = [" ".join(words[w] for w in number[p : p + n]) for n, p in tied[:, :2]]
        grams = np.concatenate((sure, tied[np.array(sorted(range(len(term)), key=term.__getitem__))[: most - len(sure)]]))
    rows, cols, times = [], [], []
    for order, at, own in places:
        kept = np.flatnonzero(grams[:, 0] == order)
        col = np.full(own.max(initial=-1) + 1, -1, np.int64)
        col[grams[kept, 4]] = kept
        inside = col[own] >= 0
        code, tf = np.unique(row[at][inside] * len(grams) + col[own][inside], return_counts=True)
        rows.append(code // max(1, len(grams)))
        cols.append(code % max(1, len(grams)))
        times.append(tf)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *cols]), np.concatenate([none, *times]), grams[:, 2]


def unit_features(vectors: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Vectors scaled to unit length, so that products are cosines; zero vectors are left out."""
    unit = Normalizer(p=2.0, inputCol="features", outputCol="_u").transform(vectors)
    return unit.select(id_col, keep_if(F.col("_u"), lambda u: F.exists(values(u), lambda x: x != 0)).alias("features"))
