"""Keyword frequencies and co-occurrence graphs.

The taxonomy is a literal, so matching is one array expression per document:
the text is streamed past it once, with no join and no exchange. A graph is a
pair of tables, ``nodes`` and ``edges``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.tokens import keep_if
from ..session import materialize
from ..sources.taxonomy import TAXONOMY, Taxonomy


def _literal(taxonomy: Taxonomy) -> Column:
    """Array of ``(category, term, synonyms)`` in taxonomy order."""
    return F.array(
        *[
            F.struct(
                F.lit(category).alias("category"),
                F.lit(term).alias("term"),
                F.array(*[F.lit(p) for p in dict.fromkeys(s.lower() for s in patterns)]).alias("syn"),
            )
            for category, terms in taxonomy.items()
            for term, patterns in terms.items()
        ]
    )


def term_hits(text: Column, taxonomy: Taxonomy | None = None) -> Column:
    """Terms with a synonym inside ``text`` (any case, no word boundary), in taxonomy order."""
    known = _literal(taxonomy or TAXONOMY)

    def hits(lowered: Column) -> Column:
        return F.filter(known, lambda t: F.exists(t["syn"], lambda s: F.contains(lowered, s)))

    # the inner array binds the lower-cased text, so it is computed once per row
    return F.transform(F.array(F.lower(text)), hits)[0]


def match_terms(
    docs: DataFrame, taxonomy: Taxonomy | None = None, id_col: str = "doc_id", text_col: str = "abstract"
) -> DataFrame:
    """One row per document and term found: ``id, category, term``."""
    found = docs.select(id_col, F.explode(term_hits(F.col(text_col), taxonomy)).alias("hit"))
    return found.select(id_col, "hit.category", "hit.term")


def keyword_freq(docs: DataFrame, taxonomy: Taxonomy | None = None, text_col: str = "abstract") -> DataFrame:
    """Documents per category and term, sorted by category, then frequency."""
    found = docs.select(F.explode(term_hits(F.col(text_col), taxonomy)).alias("hit"))
    return (
        found.groupBy("hit.category", "hit.term")
        .agg(F.count(F.lit(1)).alias("freq"))
        .orderBy("category", F.desc("freq"), "term")
    )


def keyword_total(freq: DataFrame) -> DataFrame:
    """Frequency by term alone: the sum over its categories."""
    return freq.groupBy("term").agg(F.sum("freq").alias("freq"))


def top_keywords(freq: DataFrame, n: int | None = 20) -> DataFrame:
    """Most frequent terms; all of them with ``n=None``."""
    ranked = keyword_total(freq).orderBy(F.desc("freq"), "term")
    return ranked if n is None else ranked.limit(n)


def cloud_table(freq: DataFrame) -> DataFrame:
    """Word-cloud input: the 200 most frequent terms with their weight relative to the first."""
    top = top_keywords(freq, 200)
    biggest = top.agg(F.max("freq").alias("_max"))
    return top.join(F.broadcast(biggest)).select("term", "freq", (F.col("freq") / F.col("_max")).alias("weight"))


def terms_by_category(freq: DataFrame) -> DataFrame:
    """Category -> list of its found terms, most frequent first."""
    listed = F.array_sort(F.collect_list(F.struct((-F.col("freq")).alias("f"), "term")))
    return freq.groupBy("category").agg(listed["term"].alias("terms"))


def category_graph(freq: DataFrame, min_weight: int = 1) -> tuple[DataFrame, DataFrame]:
    """Terms of one category are linked; the weight is the number of categories with the pair.

    ``freq`` has at most one row per taxonomy entry, so all work is on a table
    of literal size. Returns ``(nodes(term, category), edges(a, b, weight))``.
    """
    terms = freq.select("category", "term").distinct()
    nodes = terms.groupBy("term").agg(F.min("category").alias("category"))
    a, b = terms.alias("a"), terms.alias("b")
    edges = (
        a.join(b, (F.col("a.category") == F.col("b.category")) & (F.col("a.term") < F.col("b.term")))
        .groupBy(F.col("a.term").alias("a"), F.col("b.term").alias("b"))
        .agg(F.count(F.lit(1)).alias("weight"))
        .filter(F.col("weight") >= min_weight)
    )
    return nodes, edges


def cooccurrence_graph(
    docs: DataFrame,
    taxonomy: Taxonomy | None = None,
    text_col: str = "abstract",
    weight: str = "double",
) -> tuple[DataFrame, DataFrame]:
    """Terms found in one document are linked.

    ``weight="double"`` counts each document twice (once per direction),
    ``"docs"`` once. Documents are first counted by their set of terms, so pairs
    are formed once per distinct set, not per document. Terms that occur alone
    are not nodes.
    """
    flat: dict[str, list[str]] = {}
    for terms in (taxonomy or TAXONOMY).values():
        for term, patterns in terms.items():
            flat.setdefault(term, []).extend(patterns)
    found = F.array_sort(term_hits(F.col(text_col), {"": flat})["term"])
    sets = (
        docs.select(keep_if(found, lambda t: F.size(t) > 1).alias("terms"))
        .groupBy("terms")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    firsts = sets.select("n", "terms", F.posexplode("terms").alias("i", "a"))
    pairs = firsts.select("n", "a", F.explode(F.slice("terms", F.col("i") + 2, F.size("terms"))).alias("b"))
    factor = {"double": 2, "docs": 1}[weight]
    # at most one row per pair of taxonomy terms; stored, as nodes and charts read it again
    edges = materialize(pairs.groupBy("a", "b").agg((F.sum("n") * factor).alias("weight")), "edges")
    nodes = edges.select(F.col("a").alias("term")).union(edges.select("b")).distinct()
    return nodes, edges


def node_sizes(nodes: DataFrame, edges: DataFrame, mode: str = "weighted") -> DataFrame:
    """Degree and drawing size of every node; isolated nodes have degree 0.

    ``"weighted"``: sum of edge weights, size 100 + 1000 * degree / largest.
    ``"count"``: number of edges, size 50 * degree.
    """
    ends = edges.select(F.explode(F.array("a", "b")).alias("term"), "weight")
    value = F.sum("weight") if mode == "weighted" else F.count(F.lit(1))
    degrees = nodes.join(ends.groupBy("term").agg(value.alias("degree")), "term", "left").na.fill(0, ["degree"])
    if mode == "count":
        return degrees.withColumn("size", 50 * F.col("degree"))
    largest = degrees.agg(F.max("degree").alias("_max"))
    ratio = F.when(F.col("_max") > 0, F.col("degree") / F.col("_max")).otherwise(0.0)
    return degrees.join(F.broadcast(largest)).withColumn("size", 100 + 1000 * ratio).drop("_max")


def edge_widths(edges: DataFrame) -> DataFrame:
    """Drawing widths of both chart styles and the weight range of the colour bar."""
    span = edges.agg(F.min("weight").alias("min_weight"), F.max("weight").alias("max_weight"))
    return edges.join(F.broadcast(span)).select(
        "a", "b", "weight",
        (0.5 + 0.3 * F.col("weight")).alias("width_scaled"),
        (F.col("weight") / 2).alias("width_half"),
        "min_weight", "max_weight",
    )
