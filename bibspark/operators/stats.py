"""Publication statistics.

Input is the publication table after :func:`prepare`. Every operator is one
aggregation with map-side combining; rankings break ties by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clean import (
    TYPE_LABELS,
    classify_type,
    clean_name,
    extract_year,
    normalize_authors,
)


def prepare(pubs: DataFrame) -> DataFrame:
    """Clean author, type, year, journal and publisher; a missing column becomes null."""
    have = set(pubs.columns)

    def field(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    return pubs.withColumns(
        {
            "author": normalize_authors(field("author")),
            "tipo_normalizado": classify_type(field("tipo")),
            "year": extract_year(field("year")),
            "journal": clean_name(field("journal")),
            "publisher": clean_name(field("publisher")),
        }
    )


def top_authors(pubs: DataFrame, n: int = 15) -> DataFrame:
    return (
        pubs.select(F.explode("author").alias("author"))
        .groupBy("author")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "author")
        .limit(n)
    )


def type_distribution(pubs: DataFrame) -> DataFrame:
    return (
        pubs.groupBy("tipo_normalizado")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "tipo_normalizado")
    )


def type_share(pubs: DataFrame) -> DataFrame:
    """Share of each type in percent, one decimal, with the chart legend."""
    counts = type_distribution(pubs)
    total = counts.agg(F.sum("n").alias("_total"))
    pct = F.round(100 * F.col("n") / F.col("_total"), 1)
    legend = F.format_string("%s: %d (%.1f%%)", "tipo_normalizado", "n", 100 * F.col("n") / F.col("_total"))
    # both sides hold at most one row per type
    return counts.join(F.broadcast(total)).select(
        "tipo_normalizado", "n", pct.alias("pct"), legend.alias("legend")
    )


def type_by_year(pubs: DataFrame, years: list[str] | None = None) -> DataFrame:
    """Type x year counts, one column per year in ascending order, missing cells 0."""
    counted = type_by_year_long(pubs)
    pivot = counted.groupBy("tipo_normalizado").pivot("year", years).agg(F.first("n"))
    return pivot.na.fill(0).orderBy("tipo_normalizado")


def type_by_year_long(pubs: DataFrame) -> DataFrame:
    """The same counts as rows ``tipo_normalizado, year, n`` (non-zero cells)."""
    return (
        pubs.filter(F.col("year").isNotNull())
        .groupBy("tipo_normalizado", "year")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_venues(pubs: DataFrame, column: str = "journal", n: int = 15) -> DataFrame:
    """Largest venues (``journal`` or ``publisher``): total, then one count per type."""
    per_type = [F.count_if(F.col("tipo_normalizado") == t).alias(t) for t in sorted(TYPE_LABELS)]
    return (
        pubs.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("Total"), *per_type)
        .orderBy(F.desc("Total"), column)
        .limit(n)
    )


def venue_chart_table(venues: DataFrame, column: str = "journal") -> DataFrame:
    """Chart form of :func:`top_venues`: the types only, smallest sum first."""
    types = [c for c in venues.columns if c not in (column, "Total")]
    total = sum((F.col(c) for c in types), F.lit(0))
    return venues.select(column, *types).orderBy(total, F.desc(column))


def year_coverage(pubs: DataFrame) -> DataFrame:
    return pubs.agg(
        F.count("year").alias("with_year"),
        F.count(F.lit(1)).alias("n"),
        (F.count("year") / F.count(F.lit(1))).alias("ratio"),
    )


def generate_statistics(pubs: DataFrame) -> dict[str, DataFrame]:
    """All report tables by name."""
    ready = prepare(pubs)
    return {
        "top_15_autores": top_authors(ready),
        "tipos_existentes": type_distribution(ready),
        "añoPublicacion_Portipo": type_by_year(ready),
        "top15_journals": top_venues(ready, "journal"),
        "top15_publishers": top_venues(ready, "publisher"),
    }
