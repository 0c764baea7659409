"""Equivalent SQL (DuckDB) for the registered queries, over whole tables."""

from __future__ import annotations

from ..functions.clean import DEFAULTS, TYPE_LABELS, TYPE_WORDS
from ..functions.stopwords import ENGLISH
from ..sources.taxonomy import taxonomy_rows
from .pubview import TYPES
from .queries import DENSE_SIM, MIN_SIM

ORACLES: dict[str, str] = {}


def _q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_q(v) for v in values) + "]"


_BLANKS = r"' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12) || chr(28) || chr(29) || chr(30) || chr(31)"
_SPACE = r"[ \t\n\r\x0B\f\x1C-\x1F]"


def _word(n: int) -> str:
    return r"regexp_extract(text, '^[ \t\n\r]*" + r"[^ \t\n\r]+[ \t\n\r]+" * (n - 1) + r"([^ \t\n\r]+)', 1)"


def _fold(col: str) -> str:
    return rf"trim(regexp_replace(strip_accents({col}), '[^\x00-\x7F]', '', 'g'), {_BLANKS})"


PUBS = f"""pubs AS (
  SELECT doc_id, text AS title,
    CASE WHEN doc_id % 10 = 0 THEN 'View all'
         ELSE {_word(1)} || ' ' || {_word(2)} || ' and ' || {_word(4)} || ', ' || {_word(3)} END AS author,
    CASE WHEN doc_id % 17 = 0 THEN 'n.d.' ELSE 'c. ' || (2000 + doc_id % 25) END AS year,
    'journal-of ' || lang || ' ' || source AS journal,
    {_list(TYPES)}[doc_id % 8 + 1] AS tipo,
    source || ' press' AS publisher, text AS abstract,
    'https://example.org/' || doc_id AS url, source AS source_file,
    CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS src_rank
  FROM documents)"""


def _type(col: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches(lower({col}), {_q('|'.join(words))}) THEN {_q(label)}"
        for label, words in TYPE_WORDS.items()
    )
    return f"CASE {cases} ELSE 'Otro' END"


def _authors(col: str) -> str:
    clean = rf"""trim(regexp_replace(regexp_replace({col}, '[{{}}"\\]', '', 'g'), '{_SPACE}+', ' ', 'g'))"""
    parts = (
        f"CASE WHEN regexp_matches({clean}, '(?i) and ') THEN regexp_split_to_array({clean}, '(?i) +and +') "
        f"WHEN contains({clean}, ',') THEN string_split(regexp_replace({clean}, ', *([A-Z][a-z])', chr(1) || '\\1', 'g'), chr(1)) "
        f"ELSE [{clean}] END"
    )
    kept = (
        f"list_filter(list_transform({parts}, lambda a: trim(a)), "
        "lambda a: a <> '' AND NOT regexp_full_match(a, '(?i)view +all'))"
    )
    return (
        f"list_transform({kept}, lambda a: CASE WHEN contains(a, ',') "
        "THEN trim(substr(a, strpos(a, ',') + 1)) || ' ' || trim(substr(a, 1, strpos(a, ',') - 1)) ELSE a END)"
    )


def _venue(col: str) -> str:
    text = rf"trim(regexp_replace(regexp_replace({col}, '[^\w\s-]', '', 'g'), '\s+', ' ', 'g'))"
    return (
        f"nullif(array_to_string(list_transform(regexp_extract_all({text}, '[A-Za-z]+|[^A-Za-z]+'), "
        "lambda r: upper(r[1]) || lower(r[2:])), ''), '')"
    )


def _year(col: str) -> str:
    return rf"nullif(regexp_extract({col}, '(\d{{4}})', 1), '')"


READY = PUBS + f""", ready AS (
  SELECT doc_id, {_authors('author')} AS author, {_type('tipo')} AS tipo_normalizado, {_year('year')} AS year,
    {_venue('journal')} AS journal, {_venue('publisher')} AS publisher, abstract
  FROM pubs)"""

ORACLES["ascii_fold"] = f"SELECT doc_id, {_fold('text')} AS folded FROM documents"

ORACLES["clean_fields"] = rf"""WITH {READY}
SELECT r.doc_id, array_to_string(r.author, '; ') AS authors, r.tipo_normalizado, r.journal, r.publisher, r.year,
  CASE WHEN length(regexp_replace(p.year, '\D', '', 'g')) = 4
       THEN CAST(regexp_replace(p.year, '\D', '', 'g') AS INTEGER) END AS strict_year,
  nullif(regexp_extract(p.year, '\b(\d{{4}})\b', 1), '') AS standalone_year,
  left(p.abstract, 100) AS snippet
FROM ready r JOIN pubs p USING (doc_id)"""

ORACLES["field_defaults"] = f"""WITH {PUBS}
SELECT doc_id, title, {_q(DEFAULTS['author'])} AS author, coalesce({_year('year')}, {_q(DEFAULTS['year'])}) AS year,
  journal, coalesce(nullif(tipo, ''), {_q(DEFAULTS['tipo'])}) AS tipo, {_q(DEFAULTS['publisher'])} AS publisher,
  {_q(DEFAULTS['abstract'])} AS abstract, {_q(DEFAULTS['url'])} AS url
FROM pubs"""

ORACLES["abstract_filter"] = """SELECT doc_id, length(text) AS n_chars FROM documents
WHERE text <> '' AND NOT contains(lower(text), 'unknown')"""

ORACLES["top_authors"] = f"""WITH {READY}
SELECT author, count(*) AS n FROM (SELECT unnest(author) AS author FROM ready)
GROUP BY author ORDER BY n DESC, author LIMIT 15"""

ORACLES["type_distribution"] = f"""WITH {READY}
SELECT tipo_normalizado, count(*) AS n FROM ready GROUP BY 1"""

ORACLES["type_share"] = f"""WITH {READY}, c AS (SELECT tipo_normalizado, count(*) AS n FROM ready GROUP BY 1)
SELECT tipo_normalizado, n, round(100.0 * n / sum(n) OVER (), 1) AS pct,
  printf('%s: %d (%.1f%%)', tipo_normalizado, n, CAST(100.0 * n / sum(n) OVER () AS DOUBLE)) AS legend FROM c"""

ORACLES["type_by_year"] = f"""WITH {READY}
SELECT tipo_normalizado, year, count(*) AS n FROM ready WHERE year IS NOT NULL GROUP BY 1, 2"""

ORACLES["type_by_year_wide"] = f"""WITH {READY}
SELECT tipo_normalizado, {", ".join(f'count(*) FILTER (year = {_q(str(y))}) AS "{y}"' for y in range(2000, 2025))}
FROM ready WHERE year IS NOT NULL GROUP BY 1"""

_TYPE_COUNTS = ", ".join(
    f'count(*) FILTER (tipo_normalizado = {_q(t)}) AS "{t}"' for t in sorted(TYPE_LABELS)
)


def _top_venues(col: str) -> str:
    return f"""SELECT {col}, count(*) AS "Total", {_TYPE_COUNTS} FROM ready WHERE {col} IS NOT NULL
GROUP BY 1 ORDER BY count(*) DESC, {col} LIMIT 15"""


ORACLES["top_journals"] = f"WITH {READY} {_top_venues('journal')}"
ORACLES["top_publishers"] = f"WITH {READY} {_top_venues('publisher')}"
ORACLES["venue_chart"] = f'WITH {READY} SELECT * EXCLUDE ("Total") FROM ({_top_venues("journal")})'
ORACLES["year_coverage"] = f"""WITH {READY}
SELECT count(year) AS with_year, count(*) AS n, round(count(year) / count(*), 6) AS ratio FROM ready"""
ORACLES["corpus_counts"] = "SELECT count(*) AS n_entries, count(nullif(text, '')) AS n_abstracts FROM documents"

_KEYED = PUBS + f""", keyed AS (
  SELECT *, lower(trim(title, {_BLANKS})) AS key,
    row_number() OVER (PARTITION BY lower(trim(title, {_BLANKS})) ORDER BY src_rank, doc_id) AS rn
  FROM pubs)"""


def _nth(n: int) -> str:
    return f"""WITH {_KEYED}
SELECT row_number() OVER (ORDER BY src_rank, doc_id) - 1 AS idx, key, doc_id, source_file FROM keyed WHERE rn = {n}"""


ORACLES["unify_records"] = _nth(1)
ORACLES["duplicate_records"] = _nth(2)
ORACLES["duplicate_files"] = f"""WITH {_KEYED}, sized AS (SELECT *, count(*) OVER (PARTITION BY key) AS total FROM keyed)
SELECT key, (rn - 1) // 100 AS piece, CAST(ceil(total / 100) AS BIGINT) AS n_pieces,
  string_agg(source_file, ', ' ORDER BY rn) AS shared_files
FROM sized WHERE total > 1 GROUP BY 1, 2, 3"""
ORACLES["source_order"] = f"""WITH {PUBS}, ranked AS (
  SELECT lower(trim(title, {_BLANKS})) AS key, doc_id,
    CAST(coalesce(list_position(['src7', 'src3', 'src11'], source_file) - 1, 3) AS INTEGER) AS src_rank
  FROM pubs)
SELECT key, doc_id, src_rank FROM ranked
QUALIFY row_number() OVER (PARTITION BY key ORDER BY src_rank, doc_id) = 1"""

_FIELDS = ", ".join(f"{_fold(f)} AS {f}" for f in DEFAULTS)
ORACLES["bib_roundtrip"] = f"WITH {PUBS} SELECT 'ref' || doc_id AS id, {_FIELDS} FROM pubs"
ORACLES["bib_roundtrip_drop"] = ORACLES["bib_roundtrip"] + " WHERE NOT contains(abstract, '@')"


def _one_line(col: str) -> str:
    return rf"trim(trim(trim(trim(regexp_replace({col}, '[ \t\n\r]+', ' ', 'g')), ','), '{{}}'), ',')"


ORACLES["bib_line_mode"] = rf"""WITH {PUBS}
SELECT 'ref' || doc_id AS id, {", ".join(f"{_one_line(f)} AS {f}" for f in DEFAULTS)} FROM pubs"""

# --- keywords ---------------------------------------------------------------------------------

TAXONOMY = "tax(category, cat_pos, term, term_pos, synonym) AS (VALUES " + ", ".join(
    f"({_q(c)}, {cp}, {_q(t)}, {tp}, {_q(s)})" for c, cp, t, tp, s in taxonomy_rows()
) + ")"
HITS = f"""{TAXONOMY}, hits AS (
  SELECT DISTINCT doc_id, category, term FROM (SELECT doc_id, lower(text) AS t FROM documents) d
  JOIN tax ON contains(d.t, tax.synonym)),
freq AS (SELECT category, term, count(*) AS freq FROM hits GROUP BY 1, 2),
totals AS (SELECT term, sum(freq)::BIGINT AS freq FROM freq GROUP BY 1)"""

ORACLES["taxonomy_table"] = f"""WITH {TAXONOMY}, n AS (
  SELECT synonym, count(*) AS n FROM (SELECT DISTINCT synonym FROM tax) s
  JOIN documents d ON contains(lower(d.text), s.synonym) GROUP BY 1)
SELECT tax.*, coalesce(n, 0) AS n FROM tax LEFT JOIN n USING (synonym)"""
ORACLES["term_matches"] = f"WITH {HITS} SELECT * FROM hits"
ORACLES["keyword_freq"] = f"WITH {HITS} SELECT * FROM freq"
ORACLES["keyword_total"] = f"WITH {HITS} SELECT * FROM totals"
ORACLES["top_keywords"] = f"WITH {HITS} SELECT * FROM totals ORDER BY freq DESC, term LIMIT 20"
ORACLES["cloud_table"] = f"""WITH {HITS}, top AS (SELECT * FROM totals ORDER BY freq DESC, term LIMIT 200)
SELECT term, freq, round(freq / max(freq) OVER (), 6) AS weight FROM top"""
ORACLES["terms_by_category"] = f"""WITH {HITS}
SELECT category, string_agg(term, '; ' ORDER BY freq DESC, term) AS terms FROM freq GROUP BY 1"""
_CAT_EDGES = """edges AS (SELECT x.term AS a, y.term AS b, count(*) AS weight
  FROM freq x JOIN freq y ON x.category = y.category AND x.term < y.term GROUP BY 1, 2)"""
ORACLES["category_graph"] = f"WITH {HITS}, {_CAT_EDGES} SELECT * FROM edges"
ORACLES["category_nodes"] = f"""WITH {HITS}, {_CAT_EDGES},
nodes AS (SELECT term, min(category) AS category FROM freq GROUP BY 1),
ends AS (SELECT a AS term, weight FROM edges UNION ALL SELECT b, weight FROM edges),
deg AS (SELECT n.term, n.category, coalesce(sum(weight), 0)::BIGINT AS degree
  FROM nodes n LEFT JOIN ends USING (term) GROUP BY 1, 2)
SELECT *, round(100 + 1000 * CASE WHEN max(degree) OVER () > 0 THEN degree / max(degree) OVER () ELSE 0 END, 6) AS size
FROM deg"""
_DOC_EDGES = """pairs AS (SELECT DISTINCT doc_id, term FROM hits), edges AS (
  SELECT x.term AS a, y.term AS b, 2 * count(*) AS weight
  FROM pairs x JOIN pairs y ON x.doc_id = y.doc_id AND x.term < y.term GROUP BY 1, 2)"""
ORACLES["cooccurrence_graph"] = f"""WITH {HITS}, {_DOC_EDGES}
SELECT a, b, weight, 0.5::DOUBLE + 0.3::DOUBLE * weight AS width_scaled, weight / 2 AS width_half,
  min(weight) OVER () AS min_weight, max(weight) OVER () AS max_weight FROM edges"""
ORACLES["cooccurrence_nodes"] = f"""WITH {HITS}, {_DOC_EDGES}
SELECT term, count(*) AS degree, 50 * count(*) AS size
FROM (SELECT a AS term FROM edges UNION ALL SELECT b FROM edges) GROUP BY 1"""

# --- text vectors -----------------------------------------------------------------------------

_STOP = "(" + ", ".join(_q(w) for w in ENGLISH) + ")"


def _tokens(profile: str) -> str:
    if profile == "A":
        text, low = rf"regexp_replace(lower({_fold('text')}), '[^\w\s]', '', 'g')", 2
    else:
        text, low = r"lower(regexp_replace(text, '[^a-zA-Z0-9\s]', '', 'g'))", 3
    return (
        f"list_filter(regexp_extract_all({text}, '[a-z_]+'), lambda t: length(t) BETWEEN {low} AND 15 "
        f"AND NOT starts_with(t, '_') AND t NOT IN {_STOP})"
    )


def _grams(profile: str, keep_empty: bool = False) -> str:
    full = "" if keep_empty else "WHERE len(t) > 0"
    return f"""toks AS (SELECT * FROM (SELECT doc_id, {_tokens(profile)} AS t FROM documents) {full}),
size AS (SELECT count(*) AS n FROM toks),
grams AS (
  SELECT doc_id, unnest(t) AS term FROM toks
  UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM toks
  UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(t) - 1),
    lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) FROM toks),
tf AS (SELECT doc_id, term, count(*) AS tf FROM grams GROUP BY 1, 2)"""


def _vocab(limits: str) -> str:
    return f"""vocab AS (
  SELECT term, df, cf, ln((1 + n) / (1 + df)) + 1 AS idf
  FROM (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM tf GROUP BY 1), size
  {limits} ORDER BY cf DESC, term LIMIT 5000)"""


VOCAB = f"{_grams('A')}, {_vocab('WHERE df >= 2 AND df <= 0.9 * n')}"
WEIGHTS = VOCAB + """, raw AS (SELECT doc_id, term, tf, tf * idf AS x FROM tf JOIN vocab USING (term)),
weights AS (SELECT doc_id, term, tf, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS w FROM raw)"""

ORACLES["token_lists"] = f"SELECT doc_id, array_to_string({_tokens('A')}, ' ') AS tokens FROM documents"
ORACLES["token_lists_b"] = f"SELECT doc_id, array_to_string({_tokens('B')}, ' ') AS tokens FROM documents"
ORACLES["ngram_counts"] = f"""WITH {_grams('A')}
SELECT doc_id, sum(tf)::BIGINT AS n, count(*) AS n_distinct FROM tf GROUP BY 1"""
ORACLES["ngram_vocabulary"] = f"WITH {VOCAB} SELECT term, df, cf, round(idf, 6) AS idf FROM vocab"
ORACLES["ngram_vocabulary_b"] = f"WITH {_grams('B', True)}, {_vocab('')} SELECT term, df, cf, round(idf, 6) AS idf FROM vocab"
ORACLES["tfidf_weights"] = f"WITH {WEIGHTS} SELECT doc_id, term, round(w, 6) AS w FROM weights"

_OF_ALL = "FROM weights GROUP BY 1),"
_OF_PHRASE = "FROM weights WHERE doc_id IN (SELECT doc_id FROM documents WHERE contains(lower(text), 'the')) GROUP BY 1),"
# equal vectors have proportional term counts; quotients of equal ratios are equal doubles
REPS = WEIGHTS + f""", counts AS (SELECT doc_id, list(term ORDER BY term) AS ts, list(tf ORDER BY term) AS tfs {_OF_ALL}
vecs AS (SELECT doc_id, ts, list_transform(tfs, lambda c: c::DOUBLE / tfs[1]) AS ws FROM counts),
reps AS (SELECT min(doc_id) AS id, count(*) AS n FROM vecs GROUP BY ts, ws),
rw AS (SELECT id, n, term, w FROM reps JOIN weights ON id = doc_id)"""
_PAIRS = f"""SELECT a.id AS i, b.id AS j, a.n AS n_i, b.n AS n_j, round(sum(a.w * b.w), 6) AS sim
FROM rw a JOIN rw b ON a.term = b.term AND a.id < b.id GROUP BY 1, 2, 3, 4 HAVING sum(a.w * b.w) >= {MIN_SIM}
UNION ALL SELECT id, id, n, n, 1.0 FROM reps WHERE n > 1"""
ORACLES["cosine_pairs"] = f"WITH {REPS} {_PAIRS}"
ORACLES["document_copies"] = f"WITH {REPS} SELECT doc_id, min(doc_id) OVER (PARTITION BY ts, ws) AS rep FROM vecs"
ORACLES["blocked_pairs"] = f"""WITH {_grams('B', True)},
blk AS (SELECT doc_id // 1000 AS block, count(*) AS n FROM documents GROUP BY 1),
terms AS (SELECT doc_id // 1000 AS block, term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY block ORDER BY cf DESC, term) <= 5000),
raw AS (SELECT t.block, doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS x
  FROM tf JOIN terms t USING (term) JOIN blk b ON b.block = t.block WHERE doc_id // 1000 = t.block),
w AS (SELECT block, doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS w FROM raw)
SELECT a.block, a.doc_id AS i, b.doc_id AS j, round(sum(a.w * b.w), 6) AS sim
FROM w a JOIN w b ON a.block = b.block AND a.term = b.term AND a.doc_id < b.doc_id
GROUP BY 1, 2, 3 HAVING sum(a.w * b.w) > 0"""
ORACLES["most_similar"] = f"""WITH {WEIGHTS}
SELECT b.doc_id, round(sum(a.w * b.w), 6) AS sim FROM weights a JOIN weights b ON a.term = b.term
WHERE a.doc_id = 0 AND b.doc_id <> 0 GROUP BY 1 ORDER BY sum(a.w * b.w) DESC, b.doc_id LIMIT 5"""
_SCORES = WEIGHTS + """, sums AS (SELECT term, sum(w) AS s FROM weights GROUP BY 1),
scores AS (SELECT doc_id, sum(w * s) AS score FROM weights JOIN sums USING (term) GROUP BY 1)"""
ORACLES["centrality"] = f"WITH {_SCORES} SELECT doc_id, round(score, 6) AS score FROM scores"
ORACLES["most_central"] = f"""WITH {_SCORES}
SELECT doc_id, round(score, 6) AS score FROM scores ORDER BY scores.score DESC, doc_id LIMIT 1"""
ORACLES["corpus_similarity"] = f"""WITH {_SCORES}
SELECT count(*) AS n, round(sum(score), 4) AS total, round(100 * sum(score) / (count(*) * (count(*) - 1)), 6) AS percent
FROM scores"""
ORACLES["heatmap_table"] = f"""WITH {WEIGHTS}, ids AS (SELECT DISTINCT doc_id FROM weights ORDER BY 1 LIMIT 20),
h AS (SELECT * FROM weights WHERE doc_id IN (SELECT doc_id FROM ids))
SELECT i.doc_id AS i, j.doc_id AS j, coalesce(round(sum(a.w * b.w), 6), 0) AS sim
FROM ids i CROSS JOIN ids j LEFT JOIN h a ON a.doc_id = i.doc_id LEFT JOIN h b ON b.doc_id = j.doc_id AND a.term = b.term
GROUP BY 1, 2"""
ORACLES["phrase_pairs"] = f"""WITH {REPS.replace(_OF_ALL, _OF_PHRASE)}
{_PAIRS}"""

# --- dense vectors and clusters ---------------------------------------------------------------

_UNITS = """e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label FROM embeddings),
sims AS (SELECT a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.v, b.v) AS sim
  FROM e a JOIN e b ON a.vec_id <> b.vec_id)"""
ORACLES["dense_pairs"] = f"WITH {_UNITS} SELECT i, j, round(sim, 6) AS sim FROM sims WHERE i < j AND sim >= {DENSE_SIM}"
ORACLES["top_neighbours"] = f"""WITH {_UNITS}
SELECT i, CAST(row_number() OVER (PARTITION BY i ORDER BY sim DESC, j) AS INTEGER) AS rank, j, round(sim, 6) AS sim
FROM sims QUALIFY rank <= 1000"""
ORACLES["silhouette"] = f"""WITH {_UNITS}, m AS (
  SELECT s.i, a.label AS own, b.label AS other, avg(1 - s.sim) AS d
  FROM sims s JOIN e a ON a.vec_id = s.i JOIN e b ON b.vec_id = s.j GROUP BY 1, 2, 3),
ab AS (SELECT i, max(d) FILTER (own = other) AS a, min(d) FILTER (own <> other) AS b FROM m GROUP BY 1)
SELECT count(*) AS n, (SELECT count(DISTINCT label) FROM e) AS clusters,
  round(avg(CASE WHEN a IS NULL OR greatest(a, b) <= 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM ab"""
ORACLES["silhouette_text"] = f"""WITH {WEIGHTS}, l AS (SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM weights)),
sz AS (SELECT lang, count(*) AS m FROM l GROUP BY 1),
sums AS (SELECT lang, term, sum(w) AS s FROM weights JOIN l USING (doc_id) GROUP BY 1, 2),
dots AS (SELECT w.doc_id, s.lang AS other, sum(w.w * s.s) AS dot FROM weights w JOIN sums s USING (term) GROUP BY 1, 2),
d AS (SELECT l.doc_id, l.lang AS own, sz.lang AS other, sz.m, coalesce(dot, 0) AS dot
  FROM l CROSS JOIN sz LEFT JOIN dots ON dots.doc_id = l.doc_id AND dots.other = sz.lang),
ab AS (SELECT doc_id, max(1 - (dot - 1) / (m - 1)) FILTER (own = other AND m > 1) AS a,
  min(1 - dot / m) FILTER (own <> other) AS b FROM d GROUP BY 1)
SELECT count(*) AS n, (SELECT count(*) FROM sz) AS clusters,
  round(avg(CASE WHEN a IS NULL OR greatest(a, b) <= 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette
FROM ab"""
ORACLES["cluster_single_cut"] = f"""WITH RECURSIVE {REPS}, near AS (
  SELECT a.id AS i, b.id AS j FROM rw a JOIN rw b ON a.term = b.term AND a.id <> b.id
  GROUP BY 1, 2 HAVING sum(a.w * b.w) >= 0.8),
reach AS (SELECT id AS i, id AS j FROM reps UNION SELECT r.i, n.j FROM reach r JOIN near n ON r.j = n.i),
comp AS (SELECT i, min(j) AS cluster FROM reach GROUP BY 1),
grp AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY ts, ws) AS rep FROM vecs)
SELECT doc_id, cluster FROM grp JOIN comp ON rep = i"""
# Pairs of clusters by their ids (kind 0), and the merges (kind 1). Each turn merges the nearest pair; what is gone is far.
_FAR = "1e300"
_JOINED = {
    "average": "(na * ha + nb * hb) / (na + nb)",
    "single": "least(ha, hb)",
    "complete": "greatest(ha, hb)",
    "ward": "sqrt(greatest(0, ((na + nx) * ha * ha + (nb + nx) * hb * hb - nx * h * h) / (na + nb + nx)))",
}


def _hierarchy(method: str, cut: float | None = None) -> str:
    first = "sqrt(2.0 * na * nb / (na + nb)) * h" if method == "ward" else "h"
    return f"""WITH RECURSIVE {REPS}, sims AS (
  SELECT a.id AS a, b.id AS b, greatest(0, 1 - sum(a.w * b.w)) AS h FROM rw a JOIN rw b ON a.term = b.term AND a.id < b.id GROUP BY 1, 2),
dist AS (
  SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, coalesce(h, 1.0) AS h
  FROM reps a JOIN reps b ON a.id < b.id LEFT JOIN sims ON sims.a = a.id AND sims.b = b.id),
state(kind, a, b, h, na, nb) USING KEY (kind, a, b) AS (
  SELECT 0, a, b, ({first})::DOUBLE, na::DOUBLE, nb::DOUBLE FROM dist
  UNION
  (WITH pick AS (
    SELECT a, b, h, na, nb FROM recurring.state WHERE kind = 0 AND round(h, 9) <= {_FAR if cut is None else cut} AND h < {_FAR}
    ORDER BY round(h, 9), a, b LIMIT 1),
  near AS (
    SELECT CASE WHEN s.a IN (pick.a, pick.b) THEN s.b ELSE s.a END AS x,
      CASE WHEN s.a IN (pick.a, pick.b) THEN s.nb ELSE s.na END AS nx,
      max(s.h) FILTER (s.a = pick.a OR s.b = pick.a) AS ha, max(s.h) FILTER (s.a = pick.b OR s.b = pick.b) AS hb,
      any_value(pick.a) AS a, any_value(pick.b) AS b, any_value(pick.h) AS h, any_value(pick.na) AS na, any_value(pick.nb) AS nb
    FROM recurring.state s, pick
    WHERE s.kind = 0 AND s.h < {_FAR} AND (s.a IN (pick.a, pick.b)) <> (s.b IN (pick.a, pick.b)) GROUP BY 1, 2)
  SELECT 1, a, b, h, na + nb, 0.0 FROM pick
  UNION ALL SELECT 0, a, b, {_FAR}, na, nb FROM pick
  UNION ALL SELECT 0, least(b, x), greatest(b, x), {_FAR}, 0, 0 FROM near
  UNION ALL SELECT 0, least(a, x), greatest(a, x), {_JOINED[method]},
    CASE WHEN a < x THEN na + nb ELSE nx END, CASE WHEN a < x THEN nx ELSE na + nb END FROM near)),
merges AS (SELECT a AS l, b AS r, h, na::BIGINT AS size FROM state WHERE kind = 1),
grp AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY ts, ws) AS rep FROM vecs)"""


def _cluster_labels(merges: str) -> str:
    return f""", used AS ({merges}),
follow(id, c) AS (SELECT id, id FROM reps UNION SELECT f.id, u.l FROM follow f JOIN used u ON f.c = u.r),
ends AS (SELECT id, min(c) AS cluster FROM follow GROUP BY 1)
SELECT doc_id, cluster FROM grp JOIN ends ON rep = id"""


for _method in _JOINED:
    ORACLES[f"linkage_{_method}"] = f"""{_hierarchy(_method)}
SELECT l AS "left", r AS "right", round(h, 6) AS height, size FROM merges"""
for _method, _cut in (("average", 0.2), ("complete", 0.2), ("ward", 0.8)):
    ORACLES[f"agglomerate_{_method}"] = _hierarchy(_method, _cut) + _cluster_labels("SELECT l, r FROM merges")
ORACLES["agglomerate_k5"] = _hierarchy("average") + _cluster_labels(
    "SELECT l, r FROM merges QUALIFY row_number() OVER (ORDER BY round(h, 9) DESC, l DESC, r DESC) > 4"
)
ORACLES["document_neighbours"] = f"""WITH {WEIGHTS}, ids AS (SELECT DISTINCT doc_id FROM weights),
sims AS (SELECT a.doc_id AS i, b.doc_id AS j, sum(a.w * b.w) AS sim FROM weights a JOIN weights b ON a.term = b.term GROUP BY 1, 2)
SELECT a.doc_id AS i, CAST(row_number() OVER (PARTITION BY a.doc_id ORDER BY coalesce(round(sim, 9), 0) DESC, b.doc_id) AS INTEGER) AS rank,
  b.doc_id AS j, coalesce(round(sim, 6), 0) AS sim
FROM ids a JOIN ids b ON a.doc_id <> b.doc_id LEFT JOIN sims ON i = a.doc_id AND j = b.doc_id QUALIFY rank <= 1000"""
ORACLES["phrase_pairs_all"] = f"""WITH {REPS.replace(_OF_ALL, _OF_PHRASE.replace("'the'", "'license'"))}
{_PAIRS.replace(f">= {MIN_SIM}", ">= 1e-9")}"""
ORACLES["row_inertia"] = f"""WITH {WEIGHTS}, docs AS (SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM weights)),
s AS (SELECT a.doc_id AS i, b.doc_id AS j, sum(a.w * b.w) AS s FROM weights a JOIN weights b ON a.term = b.term GROUP BY 1, 2),
sizes AS (SELECT lang, count(*) AS m FROM docs GROUP BY 1),
means AS (SELECT lang, j, sum(s) / any_value(m) AS mean FROM s JOIN docs ON i = doc_id JOIN sizes USING (lang) GROUP BY 1, 2),
q AS (SELECT i, sum(s * s) AS q FROM s GROUP BY 1),
mq AS (SELECT lang, sum(mean * mean) AS mm FROM means GROUP BY 1),
qs AS (SELECT lang, avg(q) AS mean_q FROM q JOIN docs ON i = doc_id GROUP BY 1),
d AS (SELECT i, lang AS other, sum(s * mean) AS dot FROM s JOIN means USING (j) GROUP BY 1, 2),
e AS (SELECT docs.doc_id, docs.lang AS own, sizes.lang AS other, m, q - 2 * coalesce(dot, 0) + mean_q AS dist
  FROM docs JOIN q ON i = docs.doc_id CROSS JOIN sizes JOIN qs ON qs.lang = sizes.lang LEFT JOIN d ON d.i = docs.doc_id AND d.other = sizes.lang),
ab AS (SELECT doc_id, max(dist * m / (m - 1)) FILTER (own = other AND m > 1) AS a, min(dist) FILTER (own <> other) AS b FROM e GROUP BY 1)
SELECT (SELECT count(*) FROM docs) AS n, (SELECT count(*) FROM sizes)::INTEGER AS clusters,
  round((SELECT sum(q) FROM q) - (SELECT sum(m * mm) FROM mq JOIN sizes USING (lang)), 4) AS inertia,
  (SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) <= 0 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) FROM ab) AS silhouette"""
ORACLES["paragraph_copies"] = f"""WITH {_grams('A')}, words AS (SELECT term FROM (SELECT unnest(t) AS term FROM toks) GROUP BY 1 HAVING count(*) >= 2),
lists AS (
  SELECT doc_id, list(term ORDER BY pos) AS t FROM (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) AS pos FROM toks)
  WHERE term IN (SELECT term FROM words) GROUP BY 1)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS rep FROM lists"""
ORACLES["cluster_sizes"] = "SELECT label AS cluster, count(*) AS n FROM embeddings GROUP BY 1"
ORACLES["cluster_summary"] = """SELECT lang AS cluster, count(*) AS n, min(doc_id) AS first_id, arg_min(text, doc_id) AS example
FROM documents GROUP BY 1"""
ORACLES["cluster_head"] = """SELECT lang AS cluster,
  CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS INTEGER) AS rank, doc_id AS id, text
FROM documents QUALIFY rank <= 5"""

# --- sorts ------------------------------------------------------------------------------------

ORACLES["sorted_titles"] = f"""WITH {PUBS}
SELECT row_number() OVER (ORDER BY lower(title), doc_id) - 1 AS idx, lower(title) AS title FROM pubs WHERE title <> ''"""
ORACLES["sorted_authors"] = f"""WITH {PUBS}
SELECT row_number() OVER (ORDER BY lower(author), doc_id) - 1 AS idx, lower(author) AS author FROM pubs WHERE author <> ''"""
_YEARS = "y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey FROM orders)"
ORACLES["sorted_years"] = f"WITH {_YEARS} SELECT row_number() OVER (ORDER BY year, o_orderkey) - 1 AS idx, year FROM y"
ORACLES["year_histogram"] = f"WITH {_YEARS} SELECT year, count(*) AS n FROM y GROUP BY 1"
ORACLES["year_expanded"] = ORACLES["year_histogram"]
ORACLES["year_buckets"] = f"""WITH {_YEARS}, s AS (SELECT max(year)::DOUBLE AS hi, count(*) AS n FROM y)
SELECT CAST(least(floor(year / (hi / n)), n - 1) AS BIGINT) AS bucket, count(*) AS n FROM y, s GROUP BY 1"""

# --- result pages -----------------------------------------------------------------------------


def _shown(col: str) -> str:
    return rf"trim(regexp_replace({col}, '\s+', ' ', 'g'))"


def _orun(col: str) -> str:
    return f"coalesce({col}, 'Unknown')"


_SITE_YEAR = r"coalesce(nullif(regexp_extract(year, '\b(\d{4})\b', 1), ''), 'Unknown')"
_PAGE = "'page-' || doc_id AS page_url, 0 AS index"
ORACLES["records_acm"] = f"""WITH {PUBS}
SELECT {_PAGE}, {_shown('title')} AS title, {_shown('author')} AS author, {_SITE_YEAR} AS year, journal,
  NULL::VARCHAR AS tipo, NULL::VARCHAR AS publisher, {_shown('abstract')} AS abstract, 'https://dl.acm.org/doi/1' AS url FROM pubs
UNION ALL SELECT 'page-' || doc_id, 1, 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL, 'Unknown', 'https://dl.acm.orgUnknown' FROM pubs"""
ORACLES["records_ieee"] = f"""WITH {PUBS}
SELECT {_PAGE}, {_shown('title')} AS title, {_shown('author')} || ' last' AS author, {_SITE_YEAR} AS year, journal, tipo,
  publisher, {_shown('abstract')} AS abstract, 'https://ieeexplore.ieee.org/document/1/' AS url FROM pubs"""
ORACLES["records_sage"] = f"""WITH {PUBS}
SELECT {_PAGE}, {_shown('title')} AS title, {_shown('author')} || ', Z' AS author, {_SITE_YEAR} AS year, journal, tipo,
  'Unknown' AS publisher, {_shown('abstract')} AS abstract, 'https://journals.sagepub.com/doi/2' AS url FROM pubs"""
ORACLES["records_springer"] = f"""WITH {PUBS}
SELECT {_PAGE}, {_shown('title')} AS title, {_shown('author')} AS author, {_SITE_YEAR} AS year, journal, tipo,
  'Unknown' AS publisher, {_shown('abstract')} AS abstract, url FROM pubs"""
