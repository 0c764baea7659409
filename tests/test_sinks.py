from test_queries import write_corpus

from bibspark.plans import workflows
from bibspark.sources import bibtex, sinks


def test_table_sinks(spark, tmp_path):
    freq = spark.createDataFrame([("c2", "x", 3), ("c1", "z", 1), ("c1", "y", 5)], "category string, term string, freq long")
    sinks.write_keywords(freq, str(tmp_path / "k"))
    got = [tuple(r) for r in sinks.read_keywords(spark, str(tmp_path / "k")).collect()]
    assert got == [("y", "c1", 5), ("z", "c1", 1), ("x", "c2", 3)]

    pairs = spark.createDataFrame([(0, 1, 2, 0.5), (1, 3, 4, 0.25)], "block long, i long, j long, sim double")
    sinks.write_pairs(pairs, str(tmp_path / "p"), block=True)
    assert sorted(r.sim for r in sinks.read_pairs(spark, str(tmp_path / "p")).collect()) == [0.25, 0.5]
    sinks.write_pairs_csv(pairs, str(tmp_path / "c"))
    text = spark.read.csv(str(tmp_path / "c"), header=True)
    assert text.columns == ["Abstract ID", "Similar Abstract ID", "Similarity"]
    assert ("Abstract 1", "Abstract 2", "0.5") in {tuple(r) for r in text.collect()}

    square = spark.createDataFrame([(1, 1, 1.0), (1, 2, 0.5), (2, 1, 0.5), (2, 2, 1.0)], "i long, j long, sim double")
    assert [tuple(r) for r in sinks.wide_matrix(square, [1, 2]).collect()] == [
        ("Abstract 1", 1.0, 0.5), ("Abstract 2", 0.5, 1.0),
    ]


def test_short_records_and_empty_input(spark, tmp_path):
    rows = spark.createDataFrame([("T", 0, 0)], "title string, src_rank int, pos int")
    six = ["title", "author", "year", "journal", "abstract", "url"]
    assert bibtex.write_bib(rows.filter("false"), str(tmp_path / "none"), fields=six) == 0
    assert not (tmp_path / "none").exists()
    assert bibtex.write_bib(rows, str(tmp_path / "one"), fields=six) == 1
    entry = bibtex.read_bib(spark, str(tmp_path / "one"), mode="line").first()
    assert set(entry.fields) == set(six) and entry.fields["author"] == "Unknown Authors"
    text = "\n".join(r.value for r in spark.read.text(str(tmp_path / "one"), wholetext=True).collect())
    assert [line.split(" = ")[0].strip() for line in text.splitlines() if " = " in line] == six


def test_similarity_run(spark, tmp_path):
    bib, out = str(tmp_path / "d.bib"), str(tmp_path / "out")
    write_corpus(bib, 40)
    result = workflows.run_similarity(spark, bib, out, k=4)
    assert result["labels"].select("cluster").distinct().count() == 4
    assert {r.Modelo for r in result["comparison"].collect()} == {"TF-IDF", "Doc2Vec"}
    assert result["silhouette"].first().clusters == 4
    assert spark.read.option("escape", '"').csv(f"{out}/tfidf_clustering_results", header=True).count() == 40
