"""Unification of records from several sources and the duplicate report.

The key is the trimmed, lower-case title. Record order is ``(src_rank, pos)``.
A key may hold any share of the rows: only its first two records are shuffled
in full (the window limit is applied before the exchange), and its list of
sources is carried as counts per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import strip_blanks

ORDER = ("src_rank", "pos")


def title_key() -> Column:
    return F.lower(strip_blanks(F.col("title")))


def with_source_rank(df: DataFrame, source_order: list[str]) -> DataFrame:
    """Add ``src_rank`` from an explicit source list; all other sources follow it with one common rank."""
    ranks = df.sparkSession.createDataFrame(
        list(zip(source_order, range(len(source_order)))), "source_file string, src_rank int"
    )
    ranked = df.drop("src_rank").join(F.broadcast(ranks), "source_file", "left")
    return ranked.withColumn("src_rank", F.coalesce("src_rank", F.lit(len(source_order))))


def without_title(df: DataFrame) -> DataFrame:
    """Records that unification leaves out because they have no title."""
    return df.filter(F.col("title").isNull())


def _nth(df: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("key").orderBy(*ORDER)
    keyed = df.filter(F.col("title").isNotNull()).withColumn("key", title_key())
    return keyed.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= n)


def unify(df: DataFrame) -> DataFrame:
    """First record of every title; the output order is ``(src_rank, pos)``."""
    return _nth(df, 1).drop("_rn")


def source_counts(df: DataFrame) -> DataFrame:
    """Records per ``key, src_rank, source_file``: the list of files, run by run."""
    keyed = df.filter(F.col("title").isNotNull())
    return keyed.groupBy(title_key().alias("key"), "src_rank", "source_file").agg(
        F.count(F.lit(1)).alias("n")
    )


def duplicates(df: DataFrame) -> DataFrame:
    """Second record of every repeated title; order it by ``(src_rank, pos)``."""
    return _nth(df, 2).filter("_rn = 2").drop("_rn")


def duplicate_files(df: DataFrame, piece_size: int = 1000) -> DataFrame:
    """Source list of every repeated title as ``key, piece, n_pieces, shared_files``.

    Repeats are kept and follow the record order. The list is cut into pieces
    of ``piece_size`` entries; almost always there is one piece.
    """
    counts = source_counts(df)
    runs = counts.groupBy("key").agg(
        # one entry per source
        F.array_sort(F.collect_list(F.struct("src_rank", "source_file", "n"))).alias("runs"),
        F.sum("n").alias("total"),
    ).filter("total > 1")
    start = F.aggregate(
        F.slice("runs", F.lit(1), F.col("run")), F.lit(0).cast("long"), lambda acc, r: acc + r["n"]
    )
    spans = runs.select("key", "total", "runs", F.posexplode("runs").alias("run", "r")).select(
        "key", "total", "r.source_file", start.alias("a"), (start + F.col("r.n")).alias("b")
    )
    size = F.lit(piece_size).cast("long")
    pieces = spans.select(
        "*",
        F.explode(
            F.sequence((F.col("a") / size).cast("long"), ((F.col("b") - 1) / size).cast("long"))
        ).alias("piece"),
    )
    low = F.greatest("a", F.col("piece") * size)
    high = F.least("b", (F.col("piece") + 1) * size)
    names = F.array_repeat("source_file", (high - low).cast("int"))
    return (
        pieces.select("key", "piece", "total", low.alias("low"), names.alias("names"))
        .groupBy("key", "piece", "total")
        .agg(F.flatten(F.array_sort(F.collect_list(F.struct("low", "names")))["names"]).alias("names"))
        .select(
            "key",
            "piece",
            F.ceil(F.col("total") / size).alias("n_pieces"),
            F.array_join("names", ", ").alias("shared_files"),
        )
    )
