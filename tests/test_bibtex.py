import pyarrow as pa
from pyspark.sql import functions as F

from bibspark.operators import stats, unify
from bibspark.plans import workflows
from bibspark.sources import bibtex

BRACE = """@article{k1,
  title = {A {nested {deep} value} here},
  author = "Quoted Name",
  YEAR = 2020,
  note = {},
  abstract = {first
second line},
  year = {2021}
}

@book{k2, title = {Foo}},
  summary = {Café}
}
@misc{k3,
  title = {Mail},
  abstract = {write to a@b.org now}
}
  @inproceedings{k4, title={Indented}, abstract={cut
@ here and
@there too}, year = 1999
}
"""


def read(spark, tmp_path, content, **options):
    path = tmp_path / "x.bib"
    path.write_text(content, encoding="utf-8")
    rows = bibtex.read_bib(spark, str(path), **options).orderBy("src_rank", "pos").collect()
    return [(r.entry_type, r.cite_key, r.fields) for r in rows]


def test_brace_mode(spark, tmp_path):
    got = read(spark, tmp_path, BRACE, mode="brace")
    assert [g[:2] for g in got] == [("article", "k1"), ("book", "k2"), ("misc", "k3"), ("inproceedings", "k4")]
    assert got[0][2] == {
        "title": "A {nested {deep} value} here", "author": "Quoted Name", "note": "",
        "abstract": "first\nsecond line", "year": "2021",
    }
    assert got[1][2] == {"title": "Foo", "summary": "Cafe"}
    assert got[2][2]["abstract"] == "write to a@b.org now"
    assert got[3][2] == {"title": "Indented", "abstract": "cut\n@ here and\n@there too", "year": "1999"}
    dropped = read(spark, tmp_path, BRACE, mode="brace", stray_at="drop")
    assert [g[1] for g in dropped] == ["k1", "k2"]


def test_values_of_any_depth(spark, tmp_path):
    """Five levels of braces, a value that is never closed, empty values, and an equals sign inside a value."""
    nested = "A {b {c {d {e} d} c} b} rest, tail = 5"
    text = f"@article{{k1, title = {{{nested}}}, note = {{}}, month=, year = , pages = {{ }}, url = {{open, tipo = \"a {{b\"\n"
    assert read(spark, tmp_path, text, mode="brace") == [
        ("article", "k1", {"title": nested, "note": "", "year": "", "pages": "", "url": "{open", "tipo": "a {b"}),
    ]


def test_brace_mode_over_many_splits(spark, tmp_path):
    entries = [f"@article{{k{i},\n title = {{T{i}}},\n abstract = {{a\n@b {i}\n@c}},\n}}\n" for i in range(300)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read(spark, tmp_path, "\n".join(entries), mode="brace")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [g[1] for g in got] == [f"k{i}" for i in range(300)]
    assert [g[2]["abstract"] for g in got] == [f"a\n@b {i}\n@c" for i in range(300)]


LINE = """@article{a1,
  title = {First, one},
  note = {x = y},
  url = {http://z}
}

@book{b1,
  title = {Not an article}
}
  @article{a2,
  title = {Second},
  title = {Last wins}
} % end
@article{a3,
  title = {Third}
}
"""


def test_line_mode(spark, tmp_path):
    exact = read(spark, tmp_path, LINE, mode="line")
    assert [(g[1], g[2]["title"]) for g in exact] == [("a1", "First, one"), ("a3", "Third")]
    assert exact[0][2] == {"title": "First, one", "note": "x = y", "url": "http://z"}
    prefix = read(spark, tmp_path, LINE, mode="line", close="prefix")
    assert [(g[1], g[2]["title"]) for g in prefix] == [("a1", "First, one"), ("a2", "Last wins"), ("a3", "Third")]


def entry(**fields):
    body = ",\n".join(f"  {k} = {{{v}}}" for k, v in fields.items())
    return f"@article{{x,\n{body}\n}}\n\n"


def test_unify_run(spark, tmp_path):
    sources = {
        "A": [entry(title="Alpha", year="1"), entry(title="Beta", year="2")],
        "B": [entry(title="alpha ", year="3"), entry(title="Gamma", year="4")],
        "C": [entry(title="Beta", year="5"), entry(title="ALPHA", year="6"), entry(year="7")],
    }
    paths = []
    for name, entries in sources.items():
        (tmp_path / f"{name}.bib").write_text("".join(entries))
        paths.append(str(tmp_path / f"{name}.bib"))
    out = str(tmp_path / "out")
    assert workflows.run_unify(spark, paths, out) == {"unified": 3, "duplicates": 2, "without_title": 1}
    unified = bibtex.read_bib(spark, f"{out}/unificados.bib", mode="line")
    rows = bibtex.publications(unified).orderBy("src_rank", "pos").collect()
    assert [(r.id, r.title, r.year, r.publisher) for r in rows] == [
        ("ref0", "Alpha", "1", "Unkown Publisher"), ("ref1", "Beta", "2", "Unkown Publisher"),
        ("ref2", "Gamma", "4", "Unkown Publisher"),
    ]
    dups = bibtex.read_bib(spark, f"{out}/duplicados.bib", mode="line").orderBy("src_rank", "pos").collect()
    assert [(d.cite_key, d.fields["year"], d.fields["shared_files"].split(", ")) for d in dups] == [
        ("ref_dup0", "3", paths), ("ref_dup1", "5", [paths[0], paths[2]]),
    ]


def test_hot_title_keeps_every_source(spark):
    """A third of the rows share one title; the list comes back whole in bounded pieces."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("t"), "id")).alias("title"),
        F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("source_file"),
        (F.col("id") % 4).cast("int").alias("src_rank"), F.col("id").alias("pos"),
    )
    pieces = unify.duplicate_files(rows, 700).orderBy("piece").collect()
    assert [p.piece for p in pieces] == [0, 1, 2, 3, 4] and pieces[0].n_pieces == 5
    names = ", ".join(p.shared_files for p in pieces).split(", ")
    assert names == [f"s{k}" for k in range(4) for _ in range(750)]
    assert unify.unify(rows).count() == 6001 and unify.duplicates(rows).first().pos == 12


def test_missing_columns_give_empty_tables(spark):
    pubs = spark.createDataFrame([("A B and C D", "Book")], "author string, tipo string")
    tables = stats.generate_statistics(pubs)
    assert tables["top15_journals"].count() == 0 and tables["top_15_autores"].count() == 2


def test_abstract_choice_and_counts(spark):
    rows = [({"abstract": "", "summary": "S"},), ({"abstr": "Unknown thing"},), ({"title": "t"},)]
    entries = spark.createDataFrame(rows, "fields map<string,string>")
    assert sorted(r.abstract for r in bibtex.abstracts(entries).collect()) == ["S", "Unknown thing"]
    assert bibtex.abstracts(entries, drop_unknown=True).count() == 1
    assert tuple(bibtex.corpus_counts(entries).first()) == (3, 2)


def test_long_records_are_taken_apart_some_at_a_time():
    """A batch counts rows; what is held of it at a time goes by bytes. Pieces without a record give none."""
    pieces = [f"@book{{k{i},\n  title = {{{'x' * 400_000}}}\n}}" if i % 4 else "no record" for i in range(12)]
    rows = [{"file": "f", "block": 0, "row": i, "part": 0, "piece": p} for i, p in enumerate(pieces)]
    parts = list(bibtex._entries(iter([pa.RecordBatch.from_pylist(rows)])))
    assert len(parts) > 3 and max(p.num_rows for p in parts) <= 3
    got = [(r["row"], r["cite_key"], len(r["pairs"][0]["v"])) for p in parts for r in p.to_pylist()]
    assert got == [(i, f"k{i}", 400_000) for i in range(12) if i % 4]
