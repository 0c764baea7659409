"""Tokenisers and n-grams as array expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from .stopwords import ENGLISH
from .text import ascii_fold


def tokens(col: Column, profile: str = "A", stop_words: Iterable[str] | None = None) -> Column:
    """Lower-case alphabetic tokens without stop words.

    Profile A folds to ASCII, deletes punctuation and keeps 2-15 characters;
    profile B keeps ASCII letters, digits and blanks only and 3-15 characters.
    In both, digits separate tokens and a leading underscore discards one.
    """
    stop = list(ENGLISH if stop_words is None else stop_words)
    if profile == "A":
        text, shortest = F.regexp_replace(F.lower(ascii_fold(col)), r"[^\w\s]", ""), 2
    elif profile == "B":
        text, shortest = F.lower(F.regexp_replace(col, r"(?U)[^a-zA-Z0-9\s]", "")), 3
    else:
        raise ValueError(f"unknown profile {profile!r}")
    found = F.regexp_extract_all(text, F.lit("[a-z_]+"), F.lit(0))
    size_ok = lambda t: F.length(t).between(shortest, 15)
    kept = F.filter(found, lambda t: size_ok(t) & ~t.startswith("_") & ~t.isin(stop))
    return F.coalesce(kept, F.array().cast("array<string>"))


def lemmatize(docs: DataFrame, lemmas: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Replace tokens by their lemma from a ``(word, lemma)`` table; others stay as they are.

    Only documents that hold a listed word are rebuilt, so the shuffle carries
    hits, not the corpus.
    """
    words = docs.select(id_col, F.explode(F.array_distinct("tokens")).alias("word"))
    hits = words.join(lemmas.dropDuplicates(["word"]), "word")
    per_doc = hits.groupBy(id_col).agg(F.map_from_entries(F.collect_list(F.struct("word", "lemma"))).alias("_m"))
    swapped = F.transform("tokens", lambda t: F.coalesce(F.element_at("_m", t), t))
    out = F.when(F.col("_m").isNull(), F.col("tokens")).otherwise(swapped)
    return docs.join(per_doc, id_col, "left").withColumn("tokens", out).drop("_m")


def ngrams(col: Column, n: int) -> Column:
    """All runs of ``n`` consecutive tokens joined by a blank."""
    if n == 1:
        return col
    starts = F.when(F.size(col) >= n, F.sequence(F.lit(1), F.size(col) - (n - 1)))
    grams = F.transform(
        starts, lambda i: F.concat_ws(" ", *[F.element_at(col, i + k) for k in range(n)])
    )
    return F.coalesce(grams, F.array().cast("array<string>"))


def ngram_range(col: Column, low: int = 1, high: int = 3) -> Column:
    return F.concat(*[ngrams(col, n) for n in range(low, high + 1)])


def keep_if(value: Column, test) -> Column:
    """Generator: the value where ``test(value)`` holds, else no row.

    Unlike a filter on a computed column it cannot be pushed below the
    projection, which would compute the value a second time.
    """
    return F.explode(F.filter(F.array(value), test))


def non_empty(docs: DataFrame) -> DataFrame:
    """Documents that keep at least one token."""
    return docs.withColumn("tokens", keep_if(F.col("tokens"), lambda t: F.size(t) > 0))
