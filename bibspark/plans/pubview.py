"""A publication view over the ``documents`` table (``doc_id, text, lang, source``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

TYPES = [
    "Research Article", "Conference Paper", "Book", "Book Chapter", "Chapter", "Standards",
    "Special Section", "",
]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition a table that has fewer scan partitions than the session has cores.

    A small file is one row group, hence one task; a large table stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id")


def publications(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    word = lambda n: F.regexp_extract("text", r"^[ \t\n\r]*" + r"[^ \t\n\r]+[ \t\n\r]+" * (n - 1) + r"([^ \t\n\r]+)", 1)
    author = F.when(F.col("doc_id") % 10 == 0, "View all").otherwise(
        F.concat(word(1), F.lit(" "), word(2), F.lit(" and "), word(4), F.lit(", "), word(3))
    )
    year = F.when(F.col("doc_id") % 17 == 0, "n.d.").otherwise(
        F.concat(F.lit("c. "), (2000 + F.col("doc_id") % 25).cast("string"))
    )
    return docs.select(
        F.col("doc_id"),
        F.col("text").alias("title"),
        author.alias("author"),
        year.alias("year"),
        F.concat(F.lit("journal-of "), "lang", F.lit(" "), "source").alias("journal"),
        F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.col("doc_id") % 8 + 1).cast("int")).alias("tipo"),
        F.concat("source", F.lit(" press")).alias("publisher"),
        F.col("text").alias("abstract"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("source_file"),
        F.regexp_extract("source", r"(\d+)$", 1).cast("int").alias("src_rank"),
        F.col("doc_id").alias("pos"),
    )
