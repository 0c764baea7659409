"""Many patterns at once: one automaton, one pass over each text, whatever the number of patterns.

:mod:`keywords` holds a small taxonomy as a literal and looks for each pattern by itself. Here the patterns are a table
(``category, term, synonym``, as of :func:`taxonomy.taxonomy_df`). They are dealt into blocks of bounded size; a block is
made into an automaton, sent to every task once, and its cost per text does not depend on the number of its patterns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialize

MATCHES = ("substring", "word")
BLOCK = 200_000  # patterns of one automaton


def _in_word(text: str, place: int) -> bool:
    """Whether a letter, a digit or an underscore stands there."""
    return 0 <= place < len(text) and (text[place] == "_" or text[place].isalnum())


def _finder(known, match: str):
    """Numbers of the patterns (a broadcast list of lower-case ones) inside lower-cased texts, ascending."""
    whole = match == "word"

    @F.arrow_udf("array<int>")
    def find(texts: pa.Array) -> pa.Array:
        import ahocorasick

        made = ahocorasick.Automaton()
        for number, pattern in enumerate(known.value):
            made.add_word(pattern, (number, len(pattern)))
        made.make_automaton()
        out = []
        for text in texts.to_pylist():
            hits = set()
            for end, (number, size) in made.iter(text) if text and len(made) else ():
                if number not in hits and not (whole and (_in_word(text, end - size) or _in_word(text, end + 1))):
                    hits.add(number)
            out.append(sorted(hits))
        return pa.array(out, pa.list_(pa.int32()))

    return find


def match_patterns(
    docs: DataFrame, taxonomy: DataFrame, match: str = "substring", id_col: str = "doc_id", text_col: str = "abstract"
) -> DataFrame:
    """One row per document and term found: ``id, category, term``.

    ``match="substring"`` finds a synonym anywhere, in any case; ``"word"`` only where no letter, digit or underscore
    stands right before or behind it. Null texts have no terms; empty synonyms match nothing.
    """
    if match not in MATCHES:
        raise ValueError(f"unknown match {match!r}")
    spark = docs.sparkSession
    rows = taxonomy.select("category", "term", F.lower("synonym").alias("synonym")).filter("synonym <> ''").distinct()
    patterns = materialize(rows.groupBy("synonym").agg(F.collect_set(F.struct("category", "term")).alias("terms")), "patterns")
    blocks = max(1, -(-patterns.count() // BLOCK))
    texts = docs.select(id_col, F.lower(F.col(text_col)).alias("_text"))
    found = []
    for k in range(blocks):
        own = patterns.filter(F.pmod(F.xxhash64("synonym"), F.lit(blocks)) == k).select("synonym").orderBy("synonym")
        names = [r[0] for r in own.collect()]  # about BLOCK patterns
        hits = texts.select(id_col, F.explode(_finder(spark.sparkContext.broadcast(names), match)(F.col("_text"))).alias("at"))
        listed = spark.createDataFrame(list(enumerate(names)), "at int, synonym string")
        found.append(hits.join(listed, "at").select(id_col, "synonym"))
    return reduce(DataFrame.unionByName, found).join(patterns, "synonym").select(id_col, F.inline("terms")).distinct()


def _counter(known, match: str):
    """``at, n``: how many texts hold a pattern of each term; one automaton and one list of counts a task."""
    whole = match == "word"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        made, found = ahocorasick.Automaton(), Counter()
        for pattern, terms in known.value.items():
            made.add_word(pattern, (terms, len(pattern)))
        made.make_automaton()
        for batch in batches:
            for text in batch.column("_text"):
                text, hits = text.as_py(), set()
                for end, (terms, size) in made.iter(text) if text and len(made) else ():
                    if terms not in hits and not (whole and (_in_word(text, end - size) or _in_word(text, end + 1))):
                        hits.add(terms)
                found.update(set(chain.from_iterable(hits)))
        yield pa.record_batch([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["at", "n"])

    return count


def pattern_freq(docs: DataFrame, taxonomy: DataFrame, match: str = "substring", id_col: str = "doc_id", text_col: str = "abstract") -> DataFrame:
    """Documents per category and term: ``category, term, freq``; rows with one id are one document.

    A document of one row is counted where it is read. Only those of several rows are matched and compared by their ids.
    """
    if match not in MATCHES:
        raise ValueError(f"unknown match {match!r}")
    spark = docs.sparkSession
    several = materialize(docs.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1").select("_id"), "several")
    single, freqs = docs, []
    if not several.isEmpty():
        same = F.col(id_col).eqNullSafe(F.col("_id"))
        single = docs.join(several, same, "left_anti")
        freqs.append(match_patterns(docs.join(several, same, "left_semi"), taxonomy, match, id_col, text_col).groupBy("category", "term").agg(F.count(F.lit(1)).alias("freq")))
    rows = taxonomy.select("category", "term", F.lower("synonym").alias("synonym")).filter("synonym <> ''").distinct()
    patterns = materialize(rows, "patterns")
    blocks = max(1, -(-patterns.count() // BLOCK))
    texts = single.select(F.lower(F.col(text_col)).alias("_text"))
    kinds = patterns.select(F.lit(0).alias("at"), "category", "term").schema
    for k in range(blocks):
        # the patterns of a term are in one block
        terms: dict[tuple, int] = {}
        known: dict[str, tuple[int, ...]] = {}
        for r in patterns.filter(F.pmod(F.xxhash64("category", "term"), F.lit(blocks)) == k).collect():  # about BLOCK rows
            known[r.synonym] = (*known.get(r.synonym, ()), terms.setdefault((r.category, r.term), len(terms)))
        hits = texts.mapInArrow(_counter(spark.sparkContext.broadcast(known), match), "at int, n long").groupBy("at").agg(F.sum("n").alias("freq"))
        listed = spark.createDataFrame([(at, *term) for term, at in terms.items()], kinds)
        freqs.append(hits.join(listed, "at").select("category", "term", "freq"))
    whole = reduce(DataFrame.unionByName, freqs)
    return whole.groupBy("category", "term").agg(F.sum("freq").alias("freq"))
