"""The complete runs: files in, report tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.tokens import non_empty, tokens
from ..operators import evaluate, keywords, linkage, paragraphs, rowmeans, similarity, stats, tfidf, unify
from ..operators.numbering import with_ref_id
from ..session import materialize
from ..sources import bibtex, sinks
from ..sources.taxonomy import Taxonomy


def run_unify(spark: SparkSession, paths: list[str], out: str) -> dict[str, int]:
    """Unify source files (order matters) into ``out/unificados.bib`` and ``out/duplicados.bib``."""
    pubs = materialize(bibtex.publications(bibtex.read_bib(spark, paths, mode="line")), "pubs")
    unified = bibtex.write_bib(unify.unify(pubs), f"{out}/unificados.bib")
    dups = with_ref_id(unify.duplicates(pubs), ["src_rank", "pos"])
    repeated = dups.count()
    if repeated:
        bibtex.write_duplicates(dups, unify.duplicate_files(pubs), f"{out}/duplicados.bib")
    return {"unified": unified, "duplicates": repeated, "without_title": unify.without_title(pubs).count()}


def run_statistics(spark: SparkSession, bib: str, out: str) -> dict[str, DataFrame]:
    """Report tables of a unified file, written below ``out``."""
    pubs = materialize(bibtex.publications(bibtex.read_bib(spark, bib, mode="brace")), "pubs")
    tables = stats.generate_statistics(pubs)
    sinks.write_stats(tables, out)
    return tables


def run_keywords(spark: SparkSession, bib: str, out: str, taxonomy: Taxonomy | None = None) -> dict[str, DataFrame]:
    """Keyword frequencies and both graphs of the abstracts of a file."""
    docs = materialize(bibtex.abstracts(bibtex.read_bib(spark, bib, mode="brace")).select("abstract"), "abstracts")
    freq = materialize(keywords.keyword_freq(docs, taxonomy), "freq")
    sinks.write_keywords(freq, f"{out}/frecuencia_keywords_categorizadas")
    nodes, edges = keywords.category_graph(freq)
    doc_nodes, doc_edges = keywords.cooccurrence_graph(docs, taxonomy)
    return {
        "freq": freq,
        "top": keywords.top_keywords(freq),
        "cloud": keywords.cloud_table(freq),
        "category_nodes": keywords.node_sizes(nodes, edges),
        "category_edges": keywords.edge_widths(edges),
        "document_nodes": keywords.node_sizes(doc_nodes, doc_edges, mode="count"),
        "document_edges": keywords.edge_widths(doc_edges),
    }


def corpus(spark: SparkSession, bib: str, profile: str = "A", drop_unknown: bool = False) -> DataFrame:
    """Numbered abstracts of a file with tokens: ``doc_id, abstract, tokens``."""
    found = bibtex.abstracts(bibtex.read_bib(spark, bib, mode="brace"), drop_unknown)
    docs = with_ref_id(found.select("src_rank", "pos", "abstract"), ["src_rank", "pos"], "doc_id")
    return materialize(docs.select("doc_id", "abstract", tokens(F.col("abstract"), profile).alias("tokens")), "corpus")


def run_similarity(spark: SparkSession, bib: str, out: str, k: int = 5, doc=None) -> dict[str, DataFrame]:
    """TF-IDF and dense models of a file: clusters, k sweep and neighbours of one document."""
    docs = materialize(non_empty(corpus(spark, bib)), "docs")
    vectors = materialize(tfidf.tfidf(docs, tfidf.vocabulary(docs, 5000, 2, 0.9)), "tfidf")
    labels, merges = linkage.agglomerate_k(vectors, "average", k)
    labels = labels.withColumnRenamed("id", "doc_id")
    sinks.write_clusters(labels, docs, f"{out}/tfidf_clustering_results")
    trained = paragraphs.paragraph_vectors(docs)
    reference = doc if doc is not None else vectors.agg(F.min("doc_id")).first()[0]
    compared = similarity.compare_models(
        {"TF-IDF": vectors, "Doc2Vec": similarity.unit_features(trained)}, docs, reference, 5
    )
    sinks.write_comparison(compared, f"{out}/comparison_results")
    return {
        "vectors": vectors,
        "labels": labels,
        "merges": merges,
        "silhouette": evaluate.silhouette(vectors, labels),
        "sizes": evaluate.cluster_sizes(labels),
        "sweep": rowmeans.sweep_k(vectors),
        "comparison": compared,
    }


def run_large_corpus(spark: SparkSession, bib: str, out: str, cut: float = 0.8) -> dict[str, DataFrame]:
    """Corpus-wide TF-IDF of a unified file: sampled dendrogram, Ward clusters, summary, central document."""
    docs = corpus(spark, bib, profile="B", drop_unknown=True)
    vectors = materialize(tfidf.tfidf(docs, tfidf.vocabulary(docs)), "tfidf")
    labels, merges = linkage.agglomerate(vectors, "ward", cut)
    labels = materialize(labels.withColumnRenamed("id", "doc_id"), "labels")
    summary = evaluate.cluster_summary(labels, docs)
    sinks.write_cluster_summary(summary, f"{out}/cluster_summary")
    sinks.write_pairs(similarity.blocked_pairs(docs), f"{out}/similarity_batches", block=True)
    return {
        "sample": linkage.sampled_linkage(vectors),
        "labels": labels,
        "merges": merges,
        "summary": summary,
        "central": similarity.most_central(vectors),
        "percent": similarity.corpus_similarity(vectors, docs.count()),
    }
