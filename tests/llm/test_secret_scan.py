"""The secret scan against Python's expressions, the automata against them, and the SQL on odd texts."""

import random
import re

import brute
import pytest

from bibspark.llm.automaton import Scanner, search, whole_match
from bibspark.llm.secret_scan import BASE, RULES, redacted, secret_report, secret_spans, span_finder

PARTS = [
    "token", "TOKEN", "Secret", "api_key", "apikey", "passwd", "password", '"', "'", " ", "  ", "=", ":", '= "', "AKIA", "AKIAKIA", "A1B2C3D4",
    "deadbeef", "0123456789abcdef", "ghp_", "gho_", "x" * 18, "-----", "BEGIN", " RSA", " PRIVATE KEY", "://", "user", "@", ".", "/", "\n", "é",
    "日本", "😀", "-", "_", "abcdefgh", "ABC", "1", "\x01", "\x02",
]


def plain(text):
    """``(start, kind, end)`` of all spans, in the order of the report."""
    found = [(m.start(), k, m.end()) for k, r in enumerate(RULES) for m in re.finditer(r.search, text or "") if re.fullmatch(r.whole, m.group())]
    return [(RULES[k].kind, a, b) for a, k, b in sorted(found)]


def texts():
    rng = random.Random(7)
    some = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    return [None, "", "x", *some, "ab " * 50_000 + 'token = "' + "f" * 70_000 + '"', "token=abcdefgh" * 3000, "deadbeef" * 2000 + "é" + "deadbeef" * 8, some[5], some[5]]


def report(text, i):
    spans = plain(text)
    line = lambda own: ",".join(f"{k}:{a}:{b}" for k, a, b in own)
    base = [r.kind for r in RULES[:BASE]]
    return (i, *(sum(k == kind for kind, _, _ in spans) for k in base), brute.sha(line([s for s in spans if s[0] in base])), line(spans))


def test_report_and_sql(spark, tmp_path):
    import duckdb

    from bibspark.llm.oracles import SECRET_SPANS

    rows = [(i if i % 50 else None, t, "clash", "x") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, `a.b` string").repartition(3)
    columns = "doc_id n_assign n_access n_hex base_sha256 spans".split()
    mine = sorted((tuple(r) for r in secret_report(docs).select(*columns).collect()), key=repr)
    assert mine == sorted((report(t, i) for i, t, _, _ in rows), key=repr)
    assert sum(r[-1] != "" for r in mine) > 100
    docs.write.parquet(f"{tmp_path}/d")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert mine == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({SECRET_SPANS})").fetchall(), key=repr)
    assert secret_report(docs.limit(0)).count() == 0


def test_redaction_keeps_the_rest(spark):
    docs = spark.createDataFrame([(1, 'é token = "abcdefgh1" é', 0), (2, None, 0), (3, "token=0123456789abcdef0123456789abcdef", 0)], "doc_id long, text string, found int")
    out = {r.doc_id: (r.text, r.n) for r in docs.withColumn("n", secret_spans("text")).withColumn("text", redacted("text")).collect()}
    assert out[1][0] == 'é [secret]" é' and out[2][0] is None and not out[2][1]
    # overlapping spans of two rules are one mark
    assert out[3][0] == "[secret]" and [s.kind for s in out[3][1]] == ["assign", "hex"]


def test_whole_matches_equal_python():
    rng = random.Random(3)

    def some(depth=0):
        k = rng.randrange(6 if depth < 3 else 2)
        if k < 2:
            return rng.choice("abc")
        inner = some(depth + 1)
        return [f"[{''.join(rng.sample('abc', 2))}]", f"({inner}|{some(depth + 1)})", inner + some(depth + 1), f"({inner}){rng.choice(['*', '+', '?', '{2}', '{1,3}', '{2,}', '{0,2}'])}"][k - 2]

    for _ in range(400):
        pattern = some()
        (forth, accepts), (back, begins) = whole_match(pattern), whole_match(pattern, backwards=True)
        for _ in range(10):
            word = "".join(rng.choice("abc") for _ in range(rng.randrange(8))).encode()
            a = b = 1
            for x, y in zip(word, reversed(word)):
                a, b = forth[a, x], back[b, y]
            assert bool(accepts[a]) == bool(begins[b]) == bool(re.fullmatch(pattern, word.decode())), (pattern, word)


def test_minimal_and_refused():
    # "ab" and "cb" lead to the same states: start, one sign read, match
    assert len(search("[ac]b")[0]) == 3 and len(search("ab|cb")[0]) == 3
    assert len(Scanner.of(["[0-9]{4,}"]).table) == 5
    for pattern in ("a", "a*", "ab|abcd", "abcd|bc", "[^a]b", "(ab", "ab)", r"\d\d", "+ab"):
        with pytest.raises(ValueError):
            search(pattern)


def test_linear_on_long_runs():
    spans = span_finder()()
    assert spans(b"token=" + b"a" * 300_000) == [(0, 0, 300_006), (6, 2, 300_006)]
    assert len(spans(b"token=abcdefgh " * 20_000)) == 20_000
