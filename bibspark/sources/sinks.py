"""Table sinks: Parquet or CSV folders, written in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def write_stats(stats: dict[str, DataFrame], folder: str) -> list[str]:
    """One CSV folder per table; names are cut to 31 characters."""
    paths = []
    for name, table in stats.items():
        paths.append(f"{folder}/{name[:31]}")
        _csv(table, paths[-1])
    return paths


def write_keywords(freq: DataFrame, path: str) -> None:
    """Keyword frequencies by category, most frequent first."""
    named = freq.select(
        F.col("term").alias("Término"), F.col("category").alias("Categoría"), F.col("freq").alias("Frecuencia")
    )
    # at most one row per taxonomy entry, hence one file
    named.orderBy("Categoría", F.desc("Frecuencia"), "Término").coalesce(1).write.mode("overwrite").csv(
        path, header=True
    )


def read_keywords(spark: SparkSession, path: str) -> DataFrame:
    schema = "term string, category string, freq long"
    return spark.read.schema(schema).csv(path, header=True)


def write_clusters(
    labels: DataFrame, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "abstract"
) -> None:
    rows = labels.join(docs.select(id_col, text_col), id_col)
    _csv(rows.select(F.col(text_col).alias("Abstract"), F.col("cluster").alias("Cluster")), path)


def write_cluster_summary(summary: DataFrame, path: str) -> None:
    _csv(
        summary.select(
            F.col("cluster").alias("Cluster ID"),
            F.col("n").alias("Número de Abstracts"),
            F.col("example").alias("Ejemplo de Abstract"),
        ),
        path,
    )


def write_comparison(comparison: DataFrame, path: str) -> None:
    """``Modelo, Índice, Similitud, Extracto del Abstract``."""
    _csv(comparison.select("Modelo", "Índice", "Similitud", "Extracto del Abstract"), path)


def write_pairs(pairs: DataFrame, path: str, block: bool = False) -> None:
    """Similar pairs as Parquet; ``block=True`` keeps one folder per block of :func:`blocked_pairs`."""
    writer = pairs.write.mode("overwrite")
    (writer.partitionBy("block") if block else writer).parquet(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pairs of all blocks together."""
    return spark.read.parquet(path)


def write_pairs_csv(pairs: DataFrame, path: str) -> None:
    """Similar pairs in the long text form, ids as ``Abstract {id}``."""
    name = lambda c: F.concat(F.lit("Abstract "), F.col(c).cast("string"))
    _csv(
        pairs.select(
            name("i").alias("Abstract ID"), name("j").alias("Similar Abstract ID"), F.col("sim").alias("Similarity")
        ),
        path,
    )


WIDE_LIMIT = 1000


def wide_matrix(pairs: DataFrame, ids: list) -> DataFrame:
    """Square matrix of a list of at most WIDE_LIMIT ids (``i, j, sim`` rows in both orders)."""
    if len(ids) > WIDE_LIMIT:
        raise ValueError(f"a wide matrix has at most {WIDE_LIMIT} columns; keep the long form")
    inside = pairs.filter(F.col("i").isin(list(ids)) & F.col("j").isin(list(ids)))
    wide = inside.groupBy("i").pivot("j", list(ids)).agg(F.first("sim")).na.fill(0.0)
    names: list[Column] = [F.col(f"`{x}`").alias(f"Abstract {x}") for x in ids]
    return wide.orderBy("i").select(F.concat(F.lit("Abstract "), F.col("i").cast("string")).alias("Abstract"), *names)


def _csv(df: DataFrame, path: str) -> None:
    # quotes inside texts are doubled and blanks kept, so that texts survive as they are
    whole = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode("overwrite").options(**whole).csv(path, header=True)
