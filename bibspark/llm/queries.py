"""Registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .alignment import alignment_report
from .decontaminate import contamination_report
from .language import identify_languages
from .lattice import lattice_scores
from .licenses import license_scan
from .ngram_join import ngram_jaccard_join
from .packing import pack
from .quality import ablations, quality_report, stored_ledger, verdicts
from .recompress import dedup_substrings
from .secret_scan import secret_report
from .shared import Stages, benchmark, documents, embeddings, pages
from .tokens import token_counts
from .urls import judge_urls
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(documents(spark, sf_dir))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(documents(spark, sf_dir))


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ablations(stored_ledger(documents(spark, sf_dir), Stages(spark)))


def quality_policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(stored_ledger(documents(spark, sf_dir), Stages(spark)))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(documents(spark, sf_dir), benchmark(spark, sf_dir))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(documents(spark, sf_dir).select("doc_id", "text")).withColumnRenamed("kept", "kept_sha256")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(documents(spark, sf_dir))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(pages(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # null where the exact deviation is beyond a long; the operator has it as a decimal
    return whiten(embeddings(spark, sf_dir)).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(documents(spark, sf_dir))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_quality_rules, op3_benchmark_decontamination, op4_substring_dedup, op5_language_id,
    op6_packing, op7_license_scan, op8_lm_scoring, op9_url_filters, op10_token_counts,
    op11_secret_scan, op12_embedding_whitening, op13_cross_tokenizer_alignment,
    quality_ablations, quality_policies,
)}
