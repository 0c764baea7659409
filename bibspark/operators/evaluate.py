"""Cluster evaluation and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .tfidf import indices, values

DEALS = 16  # parts of a dimension's entries


def silhouette(vectors: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Mean silhouette on the distance 1 - s of unit vectors: ``n, clusters, silhouette``.

    The mean distance of a vector to a cluster is 1 - v * (sum of the cluster) /
    size, so only cluster sums are needed. A single member scores 0.
    """
    labelled = vectors.join(labels, id_col).select(id_col, "features", "cluster")
    entries = labelled.select(
        id_col, "cluster",
        F.explode(F.arrays_zip(indices(F.col("features")).alias("i"), values(F.col("features")).alias("w"))).alias("e"),
    ).select(id_col, "cluster", "e.i", "e.w")
    return _silhouette(entries, labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), id_col)


def dense_silhouette(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """The same on dense vectors (arrays or ML vectors), scaled to unit length first."""
    from .dense import unit_vectors

    units = unit_vectors(df, id_col, vector_col)
    labelled = units.join(df.select(F.col(id_col).alias("id"), F.col(label_col).alias("cluster")), "id")
    entries = labelled.select("id", "cluster", F.posexplode("v").alias("i", "w"))
    return _silhouette(entries, labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")), "id")


def _silhouette(entries: DataFrame, sizes: DataFrame, id_col: str) -> DataFrame:
    sums = entries.groupBy(F.col("cluster").alias("other"), "i").agg(F.sum("w").alias("sum"))
    # a dimension may be held by every row, so its entries are dealt out and meet copies of its sums
    dealt = entries.withColumn("deal", F.pmod(F.xxhash64(id_col), F.lit(DEALS)).cast("int"))
    copied = sums.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1))))
    met = dealt.join(copied, ["i", "deal"]).groupBy(id_col, "cluster", "other").agg(F.sum(F.col("w") * F.col("sum")).alias("dot"))
    dists = met.join(sizes.select(F.col("cluster").alias("other"), F.col("n").alias("m")), "other")
    own = F.col("cluster") == F.col("other")
    count = F.count_if(~own)
    per_doc = dists.groupBy(id_col, "cluster").agg(
        F.max(F.when(own, F.col("m"))).alias("size"),
        F.max(F.when(own & (F.col("m") > 1), 1 - (F.col("dot") - 1) / (F.col("m") - 1))).alias("a"),
        F.min(F.when(~own, 1 - F.col("dot") / F.col("m"))).alias("b"),
        count.alias("near"),
    )
    # clusters without a common dimension are at distance 1
    clusters = sizes.agg(F.count(F.lit(1)).alias("clusters"))
    scored = per_doc.join(F.broadcast(clusters)).withColumn(
        "b", F.when(F.col("near") < F.col("clusters") - 1, F.least(F.coalesce("b", F.lit(1.0)), F.lit(1.0))).otherwise(F.col("b"))
    )
    gap = (F.col("b") - F.col("a")) / F.greatest("a", "b")
    score = F.when((F.col("size") > 1) & (F.greatest("a", "b") > 0), gap).otherwise(0.0)
    return scored.agg(
        F.count(F.lit(1)).alias("n"), F.max("clusters").alias("clusters"), F.avg(score).alias("silhouette")
    )


def cluster_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


def cluster_summary(
    labels: DataFrame, docs: DataFrame, id_col: str = "doc_id", text_col: str = "abstract"
) -> DataFrame:
    """``cluster, n, first_id, example``: size and the text of the member with the smallest id."""
    sizes = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias(id_col))
    texts = docs.select(id_col, F.col(text_col).alias("example"))
    return sizes.join(texts, id_col).select("cluster", "n", F.col(id_col).alias("first_id"), "example")


def cluster_head(
    labels: DataFrame, docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "abstract"
) -> DataFrame:
    """``cluster, rank, id, text`` of the first ``k`` members of each cluster."""
    order = Window.partitionBy("cluster").orderBy(id_col)
    first = labels.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return first.join(docs.select(id_col, F.col(text_col).alias("text")), id_col).select(
        "cluster", "rank", F.col(id_col).alias("id"), "text"
    )
