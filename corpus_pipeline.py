"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bibspark.llm.decontaminate import remove_spans
from bibspark.llm.ngram_join import near_sets, text_key, with_owners
from bibspark.llm.packing import pack
from bibspark.llm.quality import keep_good
from bibspark.llm.recompress import dedup_substrings
from bibspark.llm.shared import Stages, packed, unpacked


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy."""
    return keep_good(docs)


#: Words of a shingle and hundredths of the Jaccard similarity from which documents are near copies.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked ones: the one with the smallest id, a null id being the last.

    A row that stands several times is a group, too; of rows with one id and text the first by its values stays.
    Different texts with one id or none are different documents; texts without words are linked with nothing.
    """
    _, classes = near_sets(docs, NEAR_SHINGLE, NEAR_PERCENT)
    owners = classes.groupBy("component").agg(F.min("owner").alias("owner")).select("owner.doc_id", "owner.key")
    some = F.coalesce(F.col("text").cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = with_owners(docs.where(some).select("doc_id", text_key().alias("key"), packed(docs)), owners, "left_semi")
    # rows with one id and text: the smallest stays; a single row passes through a partial minimum unchanged
    kept = kept.groupBy("doc_id", "key").agg(F.min("_row").alias("_row"))
    return kept.select(*unpacked(docs)).union(docs.where(~some).distinct())


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere, too; a text of which nothing is left goes."""
    rows = dedup_substrings(docs.select("text", packed(docs)), as_text=True).where("n_words = 0 or n_removed < n_words")
    size = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
    return rows.select(*unpacked(docs, text=F.col("kept"), n_chars=size))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark; one with any goes as a whole."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return remove_spans(docs.select("text", packed(docs)), items, drop_share=0.0).select(*unpacked(docs, text=F.col("text")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences of powers of two."""
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: Token ids and their checksums have no SQL form; the tests hold run() against a plain version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    stages = Stages(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stages.keep(stage(spark, docs, sf_dir), name)
        if k:
            stages.drop(STAGES[k - 1][0])
    return docs
