"""The data source: splits at any place give the same records, round trips keep them, failed writes leave nothing."""

import os

import pytest
from pyspark.sql import functions as F

from bibspark.sources import bibformat, bibtex

TEXT = """@comment{none}
@article{a1,
  title = {One {nested} title},
  note = "quoted @ here",
  abstract = {mail me
@home, or at
  @work x today},
  year = 2020
}
  @InProceedings { b-2 ,title={Två}}
@book{c3, title = {Last}, title = {Really last}}"""


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bib").write_text(TEXT)
    (tmp_path / "in" / "b.bib").write_text("@misc{z9,\n  url = {http://x/}\n}\n")
    (tmp_path / "in" / "_hidden").write_text("@misc{no, x = {y}}")
    return str(tmp_path / "in")


def whole(path):
    with open(path, "rb") as f:
        data = f.read()
    begins = [m.start() + m.group().index(b"@") for m in bibformat._BEGIN.finditer(data)]
    return [(a, data[a:b].decode()) for a, b in zip(begins, [*begins[1:], len(data)])]


def test_every_split_gives_the_same_records(folder, monkeypatch):
    path = f"{folder}/a.bib"
    expected, size = whole(path), os.path.getsize(path)
    assert len(expected) == 4
    for block in (7, 1 << 20):
        monkeypatch.setattr(bibformat, "_BLOCK", block)
        for step in (1, 3, 10, 64, size):
            parts = [bibformat.records(path, at, min(at + step, size)) for at in range(0, size, step)]
            assert [r for p in parts for r in p] == expected, (block, step)


def test_reads_as_the_reader_does(spark, folder):
    bibformat.register(spark)
    for split in (20, 1 << 20):
        rows = spark.read.format("bibtex").option("splitBytes", split).load(folder).orderBy("source_file", "start").collect()
        assert [(r.entry_type, r.cite_key) for r in rows] == [("article", "a1"), ("inproceedings", "b-2"), ("book", "c3"), ("misc", "z9")]
        assert rows[0].fields == {"title": "One {nested} title", "note": "quoted @ here", "abstract": rows[0].fields["abstract"], "year": "2020"}
        assert rows[2].fields == {"title": "Really last"}


def test_round_trip(spark, tmp_path):
    bibformat.register(spark)
    rows = [(f"k{i}", {"title": f"T {{{i}}}", "abstract": "line\none" if i % 3 else None}) for i in range(50)]
    df = spark.createDataFrame(rows, "cite_key string, fields map<string,string>").repartition(4)
    out = str(tmp_path / "out")
    for _ in range(2):
        df.write.format("bibtex").mode("overwrite").save(out)
        back = {r.cite_key: r.fields for r in spark.read.format("bibtex").load(out).collect()}
        assert back == {k: {n: v for n, v in f.items() if v is not None} for k, f in rows}
    df.limit(3).write.format("bibtex").mode("append").save(out)
    assert spark.read.format("bibtex").load(out).count() == 53
    assert not [x for x in os.listdir(out) if x.startswith("_")]
    # the other reader takes the same files
    assert bibtex.read_bib(spark, out, mode="brace").count() == 53


def test_failed_write_leaves_nothing(spark, tmp_path):
    bibformat.register(spark)
    out = str(tmp_path / "out")
    df = spark.range(40).select(F.col("id").cast("string").alias("cite_key"), F.create_map(F.lit("n"), F.when(F.col("id") == 33, F.raise_error(F.lit("stop"))).otherwise(F.lit("v"))).alias("fields"))
    with pytest.raises(Exception, match="stop"):
        df.repartition(4).write.format("bibtex").mode("append").save(out)
    assert not os.path.exists(out) or not os.listdir(out)
