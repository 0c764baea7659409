"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

from .quality import CURRENT, POLICIES, RULES, mask
from .recompress import WINDOW
from .secret_scan import BASE, RULES as SECRETS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_PLAIN}) AS w FROM documents),
g AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM w WHERE len(w) > 0)
),
s AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
e AS (SELECT * FROM g JOIN s USING (doc_id)),
p AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM e AS a JOIN e AS b ON a.g = b.g AND a.doc_id < b.doc_id
    WHERE 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
),
both_ways AS (SELECT x, y FROM p UNION SELECT y, x FROM p),
reach(x, y) AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach AS r JOIN both_ways AS b ON r.y = b.x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(m.low, w.doc_id)) AS component_id
FROM w LEFT JOIN s USING (doc_id) LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) AS m ON m.x = w.doc_id
"""

_BITS = " + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(RULES))

QUALITY = f"""
WITH w AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_PLAIN}) AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, {_PLAIN})) AS lines
    FROM documents
),
win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM w)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
steps AS (SELECT r, least(8, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 8)) AS s FROM twice),
covered AS (SELECT r, sum(s) AS n FROM steps GROUP BY r),
m AS (
    SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
        len(lines)::BIGINT AS n_lines, length(regexp_replace(t, '\\P{{Lu}}+', '', 'g'))::BIGINT AS n_upper,
        length(regexp_replace(t, '\\P{{L}}+', '', 'g'))::BIGINT AS n_letters
    FROM w LEFT JOIN covered USING (r)
),
b AS (SELECT *, ({_BITS})::INTEGER AS fail_bits FROM m)
"""
_LEDGER = QUALITY
QUALITY += f"""SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & {mask("base")}) <> 0 AS base_failed,
    (fail_bits & {mask("base") | mask(CURRENT)}) = 0 AS kept, fail_bits
FROM b
"""

_RULES = ", ".join(f"('{p}', '{r}', {mask(names)}, {mask([r])})" for p, names in POLICIES.items() for r in names)

ABLATIONS = f"""{_LEDGER}, rules(policy, rule, all_bits, bit) AS (VALUES {_RULES})
SELECT policy, rule, count(*) FILTER ((fail_bits & bit) <> 0) AS n_failed, count(*) FILTER ((fail_bits & all_bits) = bit) AS n_only
FROM rules CROSS JOIN b GROUP BY 1, 2
"""

POLICY_VERDICTS = f"""{_LEDGER}
SELECT doc_id, {", ".join(f"(fail_bits & {mask(p)}) = 0 AS {p}" for p in POLICIES)} FROM b
"""

CONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes)),
hits AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

SUBSTRINGS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {_PLAIN}) AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM d)),
often AS (SELECT g FROM win GROUP BY g HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, p FROM (SELECT r, unnest(range(i, i + {WINDOW})) AS p FROM win JOIN often USING (g))),
words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

_MARKED = " UNION ALL ".join(
    f"""SELECT r, {k} AS k, string_split(regexp_replace(t, '{s.search.replace("'", "''")}', chr(1) || '\\0' || chr(2), 'g'), chr(1)) AS parts,
        '{s.kind}' AS kind, '{s.whole.replace("'", "''")}' AS whole FROM d"""
    for k, s in enumerate(SECRETS)
)

#: Matches are marked in the text; the signs of the marks are no part of any rule.
SECRET_SPANS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), chr(1) || chr(2), chr(3) || chr(3)) AS t FROM documents),
m AS ({_MARKED}),
p AS (SELECT r, k, kind, whole, unnest(parts) AS part, unnest(range(len(parts))) AS i FROM m WHERE len(parts) > 1),
s AS (
    SELECT r, k, kind, whole, i, split_part(part, chr(2), 1) AS match,
        sum(length(replace(part, chr(2), ''))) OVER (PARTITION BY r, k ORDER BY i) - length(replace(part, chr(2), '')) AS start
    FROM p
),
f AS (
    SELECT r, k, kind, start, kind || ':' || start::BIGINT || ':' || (start + length(match))::BIGINT AS span FROM s
    WHERE i > 0 AND regexp_full_match(match, whole)
),
g AS (
    SELECT r, string_agg(span, ',' ORDER BY start, k) AS spans, string_agg(span, ',' ORDER BY start, k) FILTER (k < {BASE}) AS base,
        {", ".join(f"count(*) FILTER (k = {k}) AS n_{s.kind}" for k, s in enumerate(SECRETS[:BASE]))}
    FROM f GROUP BY r
)
SELECT doc_id, {", ".join(f"coalesce(n_{s.kind}, 0) AS n_{s.kind}" for s in SECRETS[:BASE])}, sha256(coalesce(base, '')) AS base_sha256,
    coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""

ORACLES = {
    "op1_ngram_jaccard_join": JACCARD,
    "op2_quality_rules": QUALITY,
    "op3_benchmark_decontamination": CONTAMINATION,
    "op4_substring_dedup": SUBSTRINGS,
    "op11_secret_scan": SECRET_SPANS,
    "quality_ablations": ABLATIONS,
    "quality_policies": POLICY_VERDICTS,
}
