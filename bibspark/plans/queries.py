"""Queries over the driver tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable


from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import clean, text
from ..functions.tokens import ngram_range, non_empty, tokens
from ..operators import dense, evaluate, keywords, linkage, paragraphs, rowmeans, similarity, sorting, stats, tfidf, unify
from ..operators.numbering import with_ref_id
from ..session import materialize, work_folder
from ..sources import bibtex, pages, taxonomy
from .pubview import documents, publications, spread

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MIN_SIM = 0.5
DENSE_SIM = 0.4


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _r(col: Column | str) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


# --- scalar rules -----------------------------------------------------------------------------


@_query
def ascii_fold(spark, sf):
    docs = documents(spark, sf)
    return docs.select("doc_id", text.ascii_fold(F.col("text")).alias("folded"))


@_query
def clean_fields(spark, sf):
    """Authors, type, venue names and both year rules, record by record."""
    pubs = publications(spark, sf)
    return pubs.select(
        "doc_id",
        F.array_join(clean.normalize_authors(F.col("author")), "; ").alias("authors"),
        clean.classify_type(F.col("tipo")).alias("tipo_normalizado"),
        clean.clean_name(F.col("journal")).alias("journal"),
        clean.clean_name(F.col("publisher")).alias("publisher"),
        clean.extract_year(F.col("year")).alias("year"),
        clean.strict_year(F.col("year")).alias("strict_year"),
        clean.standalone_year(F.col("year")).alias("standalone_year"),
        text.snippet(F.col("abstract"), 100).alias("snippet"),
    )


@_query
def field_defaults(spark, sf):
    """The eight fields with defaults where a value is missing (empty type, no-date year)."""
    pubs = publications(spark, sf).withColumns(
        {
            "tipo": F.nullif("tipo", F.lit("")),
            "year": clean.extract_year(F.col("year")),
        }
    ).drop("url")
    return clean.with_defaults(pubs.select("doc_id", "title", "tipo", "year", "journal"))


@_query
def abstract_filter(spark, sf):
    """Entries with an abstract that does not mention "unknown", as parsed records."""
    pubs = publications(spark, sf)
    entries = pubs.select("doc_id", F.create_map(F.lit("summary"), F.col("abstract")).alias("fields"))
    found = bibtex.abstracts(entries, drop_unknown=True)
    return found.select("doc_id", F.length("abstract").alias("n_chars"))


# --- statistics -------------------------------------------------------------------------------


def _ready(spark, sf) -> DataFrame:
    return stats.prepare(publications(spark, sf))


@_query
def top_authors(spark, sf):
    return stats.top_authors(_ready(spark, sf))


@_query
def type_distribution(spark, sf):
    return stats.type_distribution(_ready(spark, sf))


@_query
def type_share(spark, sf):
    return stats.type_share(_ready(spark, sf))


@_query
def type_by_year(spark, sf):
    return stats.type_by_year_long(_ready(spark, sf))


@_query
def type_by_year_wide(spark, sf):
    return stats.type_by_year(_ready(spark, sf), [str(y) for y in range(2000, 2025)])


@_query
def top_journals(spark, sf):
    return stats.top_venues(_ready(spark, sf), "journal")


@_query
def top_publishers(spark, sf):
    return stats.top_venues(_ready(spark, sf), "publisher")


@_query
def venue_chart(spark, sf):
    return stats.venue_chart_table(stats.top_venues(_ready(spark, sf), "journal"))


@_query
def year_coverage(spark, sf):
    out = stats.year_coverage(_ready(spark, sf))
    return out.withColumn("ratio", _r("ratio"))


@_query
def corpus_counts(spark, sf):
    pubs = publications(spark, sf)
    return bibtex.corpus_counts(pubs.select(F.create_map(F.lit("abstract"), F.col("abstract")).alias("fields")))


# --- unification and BibTeX -------------------------------------------------------------------


@_query
def unify_records(spark, sf):
    out = with_ref_id(unify.unify(publications(spark, sf)), ["src_rank", "pos"])
    return out.select("idx", "key", "doc_id", "source_file")


@_query
def duplicate_records(spark, sf):
    out = with_ref_id(unify.duplicates(publications(spark, sf)), ["src_rank", "pos"])
    return out.select("idx", "key", "doc_id", "source_file")


@_query
def duplicate_files(spark, sf):
    return unify.duplicate_files(publications(spark, sf), piece_size=100)


@_query
def source_order(spark, sf):
    """Unification with three sources first, in an order of their own, and the others behind them."""
    pubs = unify.with_source_rank(publications(spark, sf), ["src7", "src3", "src11"])
    return unify.unify(pubs).select("key", "doc_id", "src_rank")


def _roundtrip(spark, sf, stray_at: str) -> DataFrame:
    path = f"{work_folder(spark)}/bib-{uuid.uuid4().hex}"
    pubs = publications(spark, sf).withColumn("idx", F.col("doc_id"))
    bibtex.write_bib(pubs, path)
    entries = bibtex.read_bib(spark, path, mode="brace", stray_at=stray_at)
    back = bibtex.publications(entries)
    return back.select("id", "title", "author", "year", "journal", "tipo", "publisher", "abstract", "url")


@_query
def bib_roundtrip(spark, sf):
    return _roundtrip(spark, sf, "keep")


@_query
def bib_roundtrip_drop(spark, sf):
    return _roundtrip(spark, sf, "drop")


@_query
def bib_line_mode(spark, sf):
    """Line reader over written records whose values are kept on one line."""
    path = f"{work_folder(spark)}/bib-{uuid.uuid4().hex}"
    pubs = publications(spark, sf).withColumn("idx", F.col("doc_id"))
    one_line = lambda c: F.btrim(F.regexp_replace(c, r"[ \t\n\r]+", " "))
    bibtex.write_bib(pubs.withColumns({c: one_line(c) for c in ("title", "author", "abstract")}), path)
    back = bibtex.publications(bibtex.read_bib(spark, path, mode="line"))
    return back.select("id", *bibtex.FIELDS)


# --- keywords ---------------------------------------------------------------------------------


def _freq(spark, sf) -> DataFrame:
    return keywords.keyword_freq(publications(spark, sf))


@_query
def taxonomy_table(spark, sf):
    """Taxonomy entries with the number of documents that hold the pattern itself."""
    docs = publications(spark, sf).select(F.lower("abstract").alias("t"))
    patterns = sorted({row[4] for row in taxonomy.taxonomy_rows()})
    hits = docs.select(F.explode(F.filter(F.array(*[F.lit(p) for p in patterns]), lambda p: F.contains(F.col("t"), p))).alias("synonym"))
    counted = hits.groupBy("synonym").agg(F.count(F.lit(1)).alias("n"))
    return taxonomy.taxonomy_df(spark).join(counted, "synonym", "left").na.fill(0, ["n"])


@_query
def term_matches(spark, sf):
    return keywords.match_terms(publications(spark, sf))


@_query
def keyword_freq(spark, sf):
    return _freq(spark, sf)


@_query
def keyword_total(spark, sf):
    return keywords.keyword_total(_freq(spark, sf))


@_query
def top_keywords(spark, sf):
    return keywords.top_keywords(_freq(spark, sf), 20)


@_query
def cloud_table(spark, sf):
    return keywords.cloud_table(_freq(spark, sf)).withColumn("weight", _r("weight"))


@_query
def terms_by_category(spark, sf):
    out = keywords.terms_by_category(_freq(spark, sf))
    return out.select("category", F.array_join("terms", "; ").alias("terms"))


@_query
def category_graph(spark, sf):
    return keywords.category_graph(_freq(spark, sf))[1]


@_query
def category_nodes(spark, sf):
    nodes, edges = keywords.category_graph(materialize(_freq(spark, sf), "freq"))
    return keywords.node_sizes(nodes, edges).withColumn("size", _r("size"))


@_query
def cooccurrence_graph(spark, sf):
    return keywords.edge_widths(keywords.cooccurrence_graph(publications(spark, sf))[1])


@_query
def cooccurrence_nodes(spark, sf):
    nodes, edges = keywords.cooccurrence_graph(publications(spark, sf))
    return keywords.node_sizes(nodes, edges, mode="count")


# --- text vectors -----------------------------------------------------------------------------


def _tokens(spark, sf, profile="A") -> DataFrame:
    docs = documents(spark, sf)
    return docs.select("doc_id", F.col("text").alias("abstract"), tokens(F.col("text"), profile).alias("tokens"))


def _full(spark, sf) -> DataFrame:
    return non_empty(_tokens(spark, sf).select("doc_id", "tokens"))


def _model(spark, sf) -> tuple[DataFrame, tfidf.Vocabulary]:
    docs = materialize(_full(spark, sf), "tokens")
    vocab = tfidf.vocabulary(docs, 5000, 2, 0.9)
    return materialize(tfidf.tfidf(docs, vocab), "tfidf"), vocab


def _vectors(spark, sf) -> DataFrame:
    return _model(spark, sf)[0]


@_query
def token_lists(spark, sf):
    return _tokens(spark, sf).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@_query
def token_lists_b(spark, sf):
    return _tokens(spark, sf, "B").select("doc_id", F.array_join("tokens", " ").alias("tokens"))


@_query
def ngram_counts(spark, sf):
    grams = _full(spark, sf).select("doc_id", ngram_range(F.col("tokens")).alias("g"))
    return grams.select("doc_id", F.size("g").alias("n"), F.size(F.array_distinct("g")).alias("n_distinct"))


@_query
def ngram_vocabulary(spark, sf):
    docs = materialize(_full(spark, sf), "tokens")
    vocab = tfidf.vocabulary(docs, 5000, 2, 0.9)
    out = tfidf.vocabulary_df(docs, vocab)
    return out.select("term", "df", "cf", _r("idf").alias("idf"))


@_query
def ngram_vocabulary_b(spark, sf):
    docs = materialize(_tokens(spark, sf, "B").select("doc_id", "tokens"), "tokens")
    out = tfidf.vocabulary_df(docs, tfidf.vocabulary(docs, 5000))
    return out.select("term", "df", "cf", _r("idf").alias("idf"))


@_query
def tfidf_weights(spark, sf):
    vectors, vocab = _model(spark, sf)
    return tfidf.weights(vectors, vocab).select("doc_id", "term", _r("w").alias("w"))


@_query
def cosine_pairs(spark, sf):
    out = similarity.cosine_pairs(_vectors(spark, sf), MIN_SIM)
    return out.withColumn("sim", _r("sim"))


@_query
def document_copies(spark, sf):
    """Documents with equal vectors, by the smallest id: the membership behind ``n_i`` and ``n_j`` of the pairs."""
    return similarity.copies(similarity.unit_arrays(_vectors(spark, sf))).withColumnRenamed("id", "doc_id")


@_query
def blocked_pairs(spark, sf):
    out = similarity.blocked_pairs(materialize(_tokens(spark, sf, "B").select("doc_id", "tokens"), "tokens"), 1000)
    return out.withColumn("sim", _r("sim"))


@_query
def most_similar(spark, sf):
    return similarity.most_similar(_vectors(spark, sf), 0, 5).withColumn("sim", _r("sim"))


def _paragraphs(spark, sf, **kw) -> DataFrame:
    return paragraphs.paragraph_vectors(materialize(_full(spark, sf), "tokens"), **kw)


@_query
def compare_models(spark, sf):
    """Neighbours of one document by TF-IDF and by paragraph vectors."""
    trained = similarity.unit_features(_paragraphs(spark, sf, epochs=8, rounds=2))
    docs = documents(spark, sf).withColumnRenamed("text", "abstract")
    out = similarity.compare_models({"TF-IDF": _vectors(spark, sf), "Doc2Vec": trained}, docs, 0, 5)
    return out.withColumn("Similitud", _r("Similitud"))


@_query
def paragraph_copies(spark, sf):
    """Documents with equal paragraph vectors, by the smallest id: those of equal words, and no others."""
    from pyspark.ml.functions import vector_to_array

    vectors = _paragraphs(spark, sf, epochs=4, rounds=2).select("doc_id", vector_to_array("features").alias("v"))
    rows = vectors.select("doc_id", F.sha2(F.concat_ws(",", F.transform("v", lambda x: F.round(x, 6)).cast("array<string>")), 256).alias("key"))
    reps = rows.groupBy("key").agg(F.min("doc_id").alias("rep"))
    return rows.join(reps, "key").select("doc_id", "rep")


@_query
def paragraph_neighbours(spark, sf):
    vectors = materialize(_paragraphs(spark, sf), "paragraphs")
    return dense.top_neighbours(vectors, 1000, "doc_id", "features").withColumn("sim", _r("sim"))


@_query
def document_neighbours(spark, sf):
    """The 1,000 most similar documents of every document."""
    return similarity.neighbours(_vectors(spark, sf), 1000).withColumn("sim", _r("sim"))


@_query
def phrase_pairs_all(spark, sf):
    """Every pair of documents of a rarer phrase that has a common term."""
    docs = documents(spark, sf).withColumnRenamed("text", "abstract")
    found = similarity.with_phrase(_vectors(spark, sf), docs, "license")
    return similarity.cosine_pairs(found, 1e-9).withColumn("sim", _r("sim"))


@_query
def centrality(spark, sf):
    return similarity.centrality(_vectors(spark, sf)).withColumn("score", _r("score"))


@_query
def most_central(spark, sf):
    return similarity.most_central(_vectors(spark, sf)).withColumn("score", _r("score"))


@_query
def corpus_similarity(spark, sf):
    out = similarity.corpus_similarity(_vectors(spark, sf))
    return out.select("n", F.round("total", 4).alias("total"), _r("percent").alias("percent"))


@_query
def heatmap_table(spark, sf):
    vectors = _vectors(spark, sf)
    ids = [r[0] for r in vectors.select("doc_id").orderBy("doc_id").limit(20).collect()]
    return similarity.heatmap_table(vectors, ids).withColumn("sim", _r("sim"))


@_query
def phrase_pairs(spark, sf):
    docs = documents(spark, sf).withColumnRenamed("text", "abstract")
    found = similarity.with_phrase(_vectors(spark, sf), docs, "the")
    return similarity.cosine_pairs(found, MIN_SIM).withColumn("sim", _r("sim"))


@_query
def svd_scores(spark, sf):
    """Length of each document in the reduced similarity space."""
    from pyspark.ml.functions import vector_to_array

    out = dense.svd_scores(_vectors(spark, sf), 50)
    norm = F.sqrt(tfidf.total(F.transform(vector_to_array("features"), lambda x: x * x)))
    return out.select("doc_id", _r(norm).alias("norm"))


@_query
def word2vec_neighbours(spark, sf):
    docs = materialize(_full(spark, sf), "tokens")
    vectors = materialize(dense.doc_vectors(docs), "w2v")
    return dense.top_neighbours(vectors, 10, "doc_id", "features").withColumn("sim", _r("sim"))


# --- dense vectors ----------------------------------------------------------------------------


def _embeddings(spark, sf) -> DataFrame:
    return spread(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id")


@_query
def dense_pairs(spark, sf):
    return dense.dense_pairs(_embeddings(spark, sf), DENSE_SIM).withColumn("sim", _r("sim"))


@_query
def top_neighbours(spark, sf):
    return dense.top_neighbours(_embeddings(spark, sf), 1000).withColumn("sim", _r("sim"))


# --- clustering -------------------------------------------------------------------------------


@_query
def cluster_single_cut(spark, sf):
    return linkage.agglomerate(_vectors(spark, sf), "single", 0.2)[0].withColumnRenamed("id", "doc_id")


@_query
def agglomerate_average(spark, sf):
    return linkage.agglomerate(_vectors(spark, sf), "average", 0.2)[0].withColumnRenamed("id", "doc_id")


@_query
def agglomerate_complete(spark, sf):
    return linkage.agglomerate(_vectors(spark, sf), "complete", 0.2)[0].withColumnRenamed("id", "doc_id")


@_query
def agglomerate_ward(spark, sf):
    return linkage.agglomerate(_vectors(spark, sf), "ward", 0.8)[0].withColumnRenamed("id", "doc_id")


@_query
def agglomerate_k5(spark, sf):
    return linkage.agglomerate_k(_vectors(spark, sf), "average", 5)[0].withColumnRenamed("id", "doc_id")


def _linkage(spark, sf, method: str) -> DataFrame:
    """All merges of the whole corpus."""
    return linkage.linkage(_vectors(spark, sf), method).withColumn("height", _r("height"))


@_query
def linkage_average(spark, sf):
    return _linkage(spark, sf, "average")


@_query
def linkage_single(spark, sf):
    return _linkage(spark, sf, "single")


@_query
def linkage_complete(spark, sf):
    return _linkage(spark, sf, "complete")


@_query
def linkage_ward(spark, sf):
    return _linkage(spark, sf, "ward")


@_query
def sampled_linkage(spark, sf):
    return linkage.sampled_linkage(_vectors(spark, sf), 100).withColumn("height", _r("height"))


@_query
def sweep_k(spark, sf):
    out = rowmeans.sweep_k(_vectors(spark, sf), 2, 10)
    return out.select("k", _r("inertia").alias("inertia"), _r("silhouette").alias("silhouette"))


@_query
def row_inertia(spark, sf):
    """Inertia and silhouette of the rows of the similarity matrix, with the language of a document as its cluster."""
    labels = documents(spark, sf).select("doc_id", F.col("lang").alias("cluster"))
    out = rowmeans.inertia_of(_vectors(spark, sf), labels)
    return out.select("n", "clusters", F.round("inertia", 4).alias("inertia"), _r("silhouette").alias("silhouette"))


def _labels(spark, sf) -> DataFrame:
    return _embeddings(spark, sf).select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster"))


@_query
def silhouette(spark, sf):
    out = evaluate.dense_silhouette(_embeddings(spark, sf), "vec_id", "embedding", "label")
    return out.withColumn("silhouette", _r("silhouette"))


@_query
def silhouette_text(spark, sf):
    """Silhouette of the TF-IDF vectors with the language of a document as its cluster."""
    labels = documents(spark, sf).select("doc_id", F.col("lang").alias("cluster"))
    return evaluate.silhouette(_vectors(spark, sf), labels).withColumn("silhouette", _r("silhouette"))


@_query
def cluster_sizes(spark, sf):
    return evaluate.cluster_sizes(_labels(spark, sf))


@_query
def cluster_summary(spark, sf):
    docs = documents(spark, sf).withColumnRenamed("text", "abstract")
    return evaluate.cluster_summary(docs.select("doc_id", F.col("lang").alias("cluster")), docs)


@_query
def cluster_head(spark, sf):
    docs = documents(spark, sf).withColumnRenamed("text", "abstract")
    return evaluate.cluster_head(docs.select("doc_id", F.col("lang").alias("cluster")), docs, 5)


# --- sorts ------------------------------------------------------------------------------------


def _orders(spark, sf) -> DataFrame:
    orders = spread(spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_orderdate"), "o_orderkey")
    return orders.select(F.col("o_orderkey").alias("pos"), F.date_format("o_orderdate", "'c. 'yyyy").alias("year"))


@_query
def sorted_titles(spark, sf):
    return sorting.ranked_field(publications(spark, sf), "title")


@_query
def sorted_authors(spark, sf):
    return sorting.ranked_field(publications(spark, sf), "author")


@_query
def sorted_years(spark, sf):
    return sorting.ranked_years(_orders(spark, sf))


@_query
def year_histogram(spark, sf):
    return sorting.year_histogram(_orders(spark, sf))


@_query
def year_expanded(spark, sf):
    """Counting sort written out and counted again."""
    out = sorting.expand_histogram(sorting.year_histogram(_orders(spark, sf)), step=1000)
    return out.groupBy("year").agg(F.count(F.lit(1)).alias("n"))


@_query
def year_buckets(spark, sf):
    return sorting.bucket_counts(sorting.bucketed(sorting.years(_orders(spark, sf))))


# --- result pages -----------------------------------------------------------------------------


def _page(spark, sf, template: str, *parts: str) -> DataFrame:
    """One result page per document, built from its publication fields."""
    pubs = publications(spark, sf)
    shown = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return pubs.select(
        F.concat(F.lit("page-"), F.col("doc_id").cast("string")).alias("url"),
        F.format_string(template, *[shown(F.col(p)) for p in parts]).alias("html"),
    )


@_query
def records_acm(spark, sf):
    html = (
        '<html><body><div class="search__item"><span class="hlFld-Title x"><a href="/doi/1"><i>%s</i></a></span>'
        '<ul class="rlist--inline"><li>%s</li></ul><div class="bookPubDate">%s</div>'
        '<div class="issue-item__detail">%s</div><div class="issue-item__abstract"><p>%s</p></div></div>'
        '<div class="search__item"><p>no parts</p></div></body></html>'
    )
    return pages.extract_records(_page(spark, sf, html, "title", "author", "year", "journal", "abstract"), "acm")


@_query
def records_ieee(spark, sf):
    html = (
        '<div class="List-results-items"><h3><a class="fw-bold" href="/document/1/">%s</a></h3>'
        '<p class="author text-base-md-lh">%s<br>last</p><div class="description"><a xplhighlight>%s</a>'
        '<div class="publisher-info-container"><span xplhighlight>Year: %s</span> | <span xplhighlight>%s</span>'
        '<button xplhighlight><span class="title">Publisher:</span><span>%s</span></button></div></div>'
        '<div class="twist-container">%s</div></div><div class="List-results-items"><b>no link</b></div>'
    )
    parts = ("title", "author", "journal", "year", "tipo", "publisher", "abstract")
    return pages.extract_records(_page(spark, sf, html, *parts), "ieee")


@_query
def records_sage(spark, sf):
    html = (
        '<div class="rlist search-result__body items-results"><div><div class="issue-item__header">'
        '<span class="issue-item-access">Open</span><span>%s</span><b>%s</b></div>'
        '<a class="sage-search-title" href="/doi/2">%s</a><div class="issue-item__authors"><p>%s</p><p>Z</p></div>'
        '<div class="issue-item__row">%s</div><div class="issue-item__abstract__content">Abstract %s</div></div></div>'
    )
    parts = ("tipo", "year", "title", "author", "journal", "abstract")
    return pages.extract_records(_page(spark, sf, html, *parts), "sage")


@_query
def records_springer(spark, sf):
    html = (
        '<article class="c-listing__content"><h3 class="c-listing__title"><a data-test="title-link" href="%s">%s</a></h3>'
        '<div class="c-listing__authors">Authors: %s</div><span data-test="published-on">%s</span>'
        '<em data-test="journal-title">%s</em><span data-test="result-list">Content type: "%s"</span><p>%s</p><p>x</p></article>'
    )
    parts = ("url", "title", "author", "year", "journal", "tipo", "abstract")
    return pages.extract_records(_page(spark, sf, html, *parts), "springer")
