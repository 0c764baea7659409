"""Queries that write a report, read it back and return what was read; lemmas and the remaining sorts.

Importing this module adds them to the registered queries and their SQL.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.tokens import lemmatize, tokens
from ..operators import dense, evaluate, keywords, matcher, similarity, sorting, stats, unify
from ..operators.numbering import with_ref_id
from ..session import materialize, work_folder
from ..sources import bibformat, bibtex, items, sinks, taxonomy
from .oracles import _KEYED, _UNITS, HITS, ORACLES, PUBS, READY, TAXONOMY, WEIGHTS, _fold, _one_line, _tokens, _top_venues
from .pubview import documents, publications
from .queries import DENSE_SIM, QUERIES, Query, _embeddings, _freq, _r, _vectors

SHORT = ["title", "author", "year", "journal", "abstract", "url"]


def _query(sql: str):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__], ORACLES[fn.__name__] = fn, sql
        return fn

    return register


def _path(spark, name: str) -> str:
    return f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _csv(spark, path: str, schema: str) -> DataFrame:
    """A folder that a table sink wrote."""
    return spark.read.schema(schema).options(header=True, multiLine=True, escape='"').csv(path)


# --- BibTeX -----------------------------------------------------------------------------------


@_query(f"""WITH {_KEYED}, second AS (
  SELECT row_number() OVER (ORDER BY src_rank, doc_id) - 1 AS idx, * FROM keyed WHERE rn = 2),
files AS (SELECT key, string_agg(source_file, ', ' ORDER BY rn) AS shared_files FROM keyed GROUP BY 1)
SELECT 'ref_dup' || idx AS id, {", ".join(f"{_fold(f)} AS {f}" for f in bibtex.FIELDS)}, shared_files
FROM second JOIN files USING (key)""")
def duplicates_roundtrip(spark, sf):
    pubs, path = publications(spark, sf), _path(spark, "dups")
    dups = materialize(with_ref_id(unify.duplicates(pubs), ["src_rank", "pos"]), "dups")
    bibtex.write_duplicates(dups, unify.duplicate_files(pubs), path)
    back = bibtex.publications(bibtex.read_bib(spark, path, mode="brace"), [*bibtex.FIELDS, "shared_files"])
    files = F.regexp_replace("shared_files", r",\s+", ", ")  # pieces stand on lines of their own
    return back.select("id", *bibtex.FIELDS, files.alias("shared_files"))


@_query(f"WITH {PUBS} SELECT 'ref' || doc_id AS id, {', '.join(f'{_fold(f)} AS {f}' for f in SHORT)} FROM pubs")
def short_bib(spark, sf):
    path = _path(spark, "short")
    bibtex.write_bib(publications(spark, sf).withColumn("idx", F.col("doc_id")), path, fields=SHORT)
    return bibtex.publications(bibtex.read_bib(spark, path, mode="brace"), SHORT).select("id", *SHORT)


@_query(f"WITH {PUBS} SELECT 'ref' || doc_id AS id, {', '.join(f'{_one_line(f)} AS {f}' for f in SHORT)} FROM pubs")
def bib_line_prefix(spark, sf):
    """Line reader that takes any line starting with a brace as the end of a record."""
    path = _path(spark, "lines")
    pubs = publications(spark, sf).withColumn("idx", F.col("doc_id"))
    one_line = lambda c: F.btrim(F.regexp_replace(c, r"[ \t\n\r]+", " "))
    bibtex.write_bib(pubs.withColumns({c: one_line(c) for c in ("title", "author", "abstract")}), path, fields=SHORT)
    return bibtex.publications(bibtex.read_bib(spark, path, mode="line", close="prefix"), SHORT).select("id", *SHORT)


@_query(f"WITH {PUBS} SELECT doc_id::VARCHAR AS id, {', '.join(bibtex.FIELDS)} FROM pubs")
def bib_format(spark, sf):
    """Records written and read through the data source, values as they are."""
    bibformat.register(spark)
    path, pubs = _path(spark, "format"), publications(spark, sf)
    fields = F.create_map(*[x for f in bibtex.FIELDS for x in (F.lit(f), F.col(f))])
    pubs.select(F.col("doc_id").cast("string").alias("cite_key"), fields.alias("fields")).write.format("bibtex").mode("overwrite").save(path)
    back = spark.read.format("bibtex").load(path)
    return back.select(F.col("cite_key").alias("id"), *[F.col("fields")[f].alias(f) for f in bibtex.FIELDS])


# --- items of crawled pages -------------------------------------------------------------------


def _visible(html: str) -> str:
    out = f"regexp_replace({html}, '(?s)<!--.*?-->|<[^>]*>', ' ', 'g')"
    for entity, sign in items.ENTITIES:
        out = f"replace({out}, '{entity}', '{sign.replace(chr(39), chr(39) * 2)}')"
    return f"trim(regexp_replace({out}, '[ \\t\\r\\n]+', ' ', 'g'))"


def _items_sql(rule: items.ItemRule) -> str:
    fields = ", ".join(f"CASE WHEN regexp_matches(item, '{p}') THEN {_visible(f"regexp_extract(item, '{p}', 1)")} END AS {n}" for n, p in rule.fields.items())
    return f"""WITH cut AS (SELECT page_id, regexp_extract_all(html, '{rule.item}') AS found FROM pages),
one AS (SELECT page_id, unnest(found) AS item, generate_subscripts(found, 1) - 1 AS index FROM cut)
SELECT page_id, index::INTEGER AS index, {fields} FROM one"""


def _items(spark, sf, rule: items.ItemRule) -> DataFrame:
    return items.cut_items(spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "html"), rule)


@_query(_items_sql(items.LINKS))
def page_links(spark, sf):
    """The listed links of every crawled page."""
    return _items(spark, sf, items.LINKS)


@_query(_items_sql(items.ARTICLES))
def page_articles(spark, sf):
    """Title and text of the articles of every crawled page."""
    return _items(spark, sf, items.ARTICLES)


@_query(f"""WITH links AS ({_items_sql(items.LINKS)}) SELECT link, count(*) AS n, count(DISTINCT page_id) AS pages FROM links GROUP BY 1""")
def linked_places(spark, sf):
    """How often each place is linked, and from how many pages."""
    return _items(spark, sf, items.LINKS).groupBy("link").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("pages"))


# --- keywords by an automaton -----------------------------------------------------------------

_BESIDE = r"[^\p{L}\p{N}_]"
_WORD_HITS = f"""{TAXONOMY}, hits AS (
  SELECT DISTINCT doc_id, category, term FROM (SELECT doc_id, lower(text) AS t FROM documents) d
  JOIN tax ON contains(d.t, tax.synonym)
  WHERE CASE WHEN contains(d.t, tax.synonym) THEN regexp_matches(d.t, '(^|{_BESIDE})' || regexp_escape(tax.synonym) || '($|{_BESIDE})') END)"""


def _matches(spark, sf, match: str) -> DataFrame:
    return matcher.match_patterns(documents(spark, sf), taxonomy.taxonomy_df(spark), match, text_col="text")


@_query(f"WITH {_WORD_HITS} SELECT * FROM hits")
def word_matches(spark, sf):
    """Terms whose synonym stands as a word of its own."""
    return _matches(spark, sf, "word")


@_query(f"WITH {_WORD_HITS} SELECT category, term, count(*) AS freq FROM hits GROUP BY 1, 2")
def word_freq(spark, sf):
    return matcher.pattern_freq(documents(spark, sf), taxonomy.taxonomy_df(spark), "word", text_col="text")


@_query(f"WITH {HITS} SELECT * FROM hits")
def automaton_matches(spark, sf):
    """The terms of the literal taxonomy, found by the automaton."""
    return _matches(spark, sf, "substring")


_LOWER_WORDS = "SELECT doc_id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS w FROM documents"


def _corpus_words(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Texts, and the words of three letters or more that stand in two of them, as a table of patterns."""
    docs = materialize(documents(spark, sf).select("doc_id", "text"), "texts")
    words = docs.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)))).alias("w"))
    often = words.filter("length(w) >= 3").groupBy("w").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")
    return docs, often.select(F.lit("words").alias("category"), F.col("w").alias("term"), F.col("w").alias("synonym"))


@_query(f"""WITH words AS ({_LOWER_WORDS}), often AS (SELECT w FROM words WHERE length(w) >= 3 GROUP BY 1 HAVING count(*) >= 2),
whole AS (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+'))) AS w FROM documents)
SELECT w AS term, count(*) AS freq FROM whole JOIN often USING (w) GROUP BY 1""")
def corpus_whole_words(spark, sf):
    """A large table of patterns: documents that contain each word of two documents as a word of its own."""
    docs, table = _corpus_words(spark, sf)
    return matcher.pattern_freq(docs, table, "word", text_col="text").select("term", "freq")


@_query(f"""WITH words AS ({_LOWER_WORDS}), often AS (SELECT w FROM words WHERE length(w) >= 3 GROUP BY 1 HAVING count(*) >= 2)
SELECT w AS term, count(*) AS freq FROM documents JOIN often ON contains(lower(text), w) GROUP BY 1""")
def corpus_word_freq(spark, sf):
    """A large table of patterns: documents that contain each word of two documents, also inside other words."""
    docs, table = _corpus_words(spark, sf)
    return matcher.pattern_freq(docs, table, text_col="text").select("term", "freq")


# --- table sinks ------------------------------------------------------------------------------


@_query(f"""WITH {READY}
SELECT 'tipos_existentes' AS report, tipo_normalizado AS name, count(*) AS n FROM ready GROUP BY 2
UNION ALL SELECT 'top15_journals', journal, "Total" FROM ({_top_venues('journal')})
UNION ALL SELECT 'top15_publishers', publisher, "Total" FROM ({_top_venues('publisher')})""")
def stats_csv(spark, sf):
    folder = _path(spark, "stats")
    written = sinks.write_stats(stats.generate_statistics(materialize(publications(spark, sf), "pubs")), folder)
    parts = [
        spark.read.schema("name string, n long").csv(path, header=True, enforceSchema=True).select(F.lit(path.rsplit("/", 1)[1]).alias("report"), "name", "n")
        for path in written
        if path.endswith(("tipos_existentes", "top15_journals", "top15_publishers"))
    ]
    return parts[0].union(parts[1]).union(parts[2])


def _cells(report: str, key: str, sql: str) -> str:
    return f"""SELECT '{report}' AS report, {key} AS entry, field, value::BIGINT AS value
FROM (UNPIVOT ({sql}) ON COLUMNS(* EXCLUDE {key}) INTO NAME field VALUE value)"""


@_query(f"""WITH {READY}, dated AS (SELECT tipo_normalizado, year FROM ready WHERE year IS NOT NULL),
years AS (SELECT DISTINCT year FROM dated), types AS (SELECT DISTINCT tipo_normalizado FROM dated)
SELECT 'top_15_autores' AS report, author AS entry, 'n' AS field, n AS value
FROM (SELECT author, count(*) AS n FROM (SELECT unnest(author) AS author FROM ready) GROUP BY author ORDER BY n DESC, author LIMIT 15)
UNION ALL SELECT 'tipos_existentes', tipo_normalizado, 'n', count(*) FROM ready GROUP BY 2
UNION ALL SELECT 'añoPublicacion_Portipo', t.tipo_normalizado, y.year, count(d.year)
FROM types t CROSS JOIN years y LEFT JOIN dated d ON d.tipo_normalizado = t.tipo_normalizado AND d.year = y.year GROUP BY 2, 3
UNION ALL {_cells("top15_journals", "journal", _top_venues("journal"))}
UNION ALL {_cells("top15_publishers", "publisher", _top_venues("publisher"))}""")
def stats_csv_cells(spark, sf):
    """Every cell of all five written report tables."""
    written = sinks.write_stats(stats.generate_statistics(materialize(publications(spark, sf), "pubs")), _path(spark, "stats"))
    parts = []
    for path in written:
        table = spark.read.csv(path, header=True, escape='"')
        key, *fields = table.columns
        long = table.unpivot(key, fields, "field", "value")
        parts.append(long.select(F.lit(path.rsplit("/", 1)[1]).alias("report"), F.col(f"`{key}`").alias("entry"), "field", F.col("value").cast("long").alias("value")))
    return reduce(DataFrame.unionByName, parts)


@_query(f"WITH {HITS} SELECT term, category, freq FROM freq")
def keywords_csv(spark, sf):
    path = _path(spark, "keywords")
    sinks.write_keywords(_freq(spark, sf), path)
    return sinks.read_keywords(spark, path)


def _languages(spark, sf) -> tuple[DataFrame, DataFrame]:
    docs = documents(spark, sf)
    return docs.select("doc_id", F.col("lang").alias("cluster")), docs.select("doc_id", F.col("text").alias("abstract"))


@_query("SELECT text AS abstract, lang AS cluster FROM documents")
def clusters_csv(spark, sf):
    """Cluster labels (here the language) with their texts."""
    path = _path(spark, "clusters")
    sinks.write_clusters(*_languages(spark, sf), path)
    return _csv(spark, path, "abstract string, cluster string")


@_query("SELECT lang AS cluster, count(*) AS n, arg_min(text, doc_id) AS example FROM documents GROUP BY 1")
def cluster_summary_csv(spark, sf):
    path = _path(spark, "summary")
    sinks.write_cluster_summary(evaluate.cluster_summary(*_languages(spark, sf)), path)
    return _csv(spark, path, "cluster string, n long, example string")


@_query(f"""WITH {WEIGHTS}, near AS (
  SELECT b.doc_id, round(sum(a.w * b.w), 6) AS sim FROM weights a JOIN weights b ON a.term = b.term
  WHERE a.doc_id = 0 AND b.doc_id <> 0 GROUP BY 1 ORDER BY sum(a.w * b.w) DESC, b.doc_id LIMIT 5)
SELECT 'TF-IDF' AS model, doc_id AS id, sim, left(text, 100) AS excerpt FROM near JOIN documents USING (doc_id)""")
def comparison_csv(spark, sf):
    path = _path(spark, "comparison")
    docs = documents(spark, sf).select("doc_id", F.col("text").alias("abstract"))
    sinks.write_comparison(similarity.compare_models({"TF-IDF": _vectors(spark, sf)}, docs, 0, 5), path)
    return _csv(spark, path, "model string, id long, sim double, excerpt string").withColumn("sim", _r("sim"))


_NEAR_VECTORS = f"WITH {_UNITS}, near AS (SELECT i, j, round(sim, 6) AS sim FROM sims WHERE i < j AND sim >= {DENSE_SIM})"


def _pairs(spark, sf) -> DataFrame:
    return dense.dense_pairs(_embeddings(spark, sf), DENSE_SIM).withColumn("sim", _r("sim"))


@_query(_NEAR_VECTORS + " SELECT 'Abstract ' || i AS i, 'Abstract ' || j AS j, sim FROM near")
def pairs_csv(spark, sf):
    path = _path(spark, "pairs")
    sinks.write_pairs_csv(_pairs(spark, sf), path)
    return _csv(spark, path, "i string, j string, sim double")


@_query(_NEAR_VECTORS + " SELECT i, j, sim, CAST(i // 100 AS INTEGER) AS block FROM near")
def pairs_blocks(spark, sf):
    """Similar pairs, one folder per hundred ids, read as one table."""
    path = _path(spark, "blocks")
    sinks.write_pairs(_pairs(spark, sf).withColumn("block", F.floor(F.col("i") / 100).cast("int")), path, block=True)
    return sinks.read_pairs(spark, path)


# --- sorts and lemmas -------------------------------------------------------------------------


def _sorted_sql(field: str) -> str:
    return f"""WITH {PUBS}
SELECT row_number() OVER (ORDER BY lower({field}), doc_id) - 1 AS idx, lower({field}) AS {field} FROM pubs WHERE {field} <> ''"""


@_query(_sorted_sql("journal"))
def sorted_journals(spark, sf):
    return sorting.ranked_field(publications(spark, sf), "journal")


@_query(_sorted_sql("year"))
def sorted_year_text(spark, sf):
    return sorting.ranked_field(publications(spark, sf), "year")


@_query(f"""WITH {HITS}
SELECT CAST(row_number() OVER (ORDER BY category, freq DESC, term) AS INTEGER) AS rank, category, term, freq FROM freq""")
def ranked_keywords(spark, sf):
    """Two-key order with its rank; the table has one row per taxonomy entry at most."""
    order = Window.orderBy("category", F.desc("freq"), "term")
    return keywords.keyword_freq(publications(spark, sf)).select(F.row_number().over(order).alias("rank"), "category", "term", "freq")


@_query(f"""WITH toks AS (SELECT doc_id, {_tokens('B')} AS t FROM documents),
placed AS (SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS pos FROM toks),
words AS (SELECT DISTINCT w FROM placed),
lemmas AS (SELECT p.w, s.w AS lemma FROM words p JOIN words s ON p.w = s.w || 's')
SELECT toks.doc_id, coalesce(string_agg(coalesce(lemma, placed.w), ' ' ORDER BY pos), '') AS tokens
FROM toks LEFT JOIN placed ON placed.doc_id = toks.doc_id LEFT JOIN lemmas USING (w) GROUP BY 1""")
def lemma_tokens(spark, sf):
    """Tokens with a lemma table from the corpus: a word in -s whose form without it occurs, too, becomes that."""
    docs = materialize(documents(spark, sf).select("doc_id", tokens(F.col("text"), "B").alias("tokens")), "tokens")
    words = docs.select(F.explode("tokens").alias("word")).distinct()
    lemmas = words.join(words.select(F.concat("word", F.lit("s")).alias("word"), F.col("word").alias("lemma")), "word")
    return lemmatize(docs, lemmas).select("doc_id", F.array_join("tokens", " ").alias("tokens"))
