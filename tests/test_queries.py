"""Registered queries against their SQL on the smallest tables, and the end-to-end runs."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry_module
from bibspark.operators import sorting
from bibspark.plans import workflows

SF = "/root/testdata/sf0.001"
FAST = [
    "clean_fields", "type_share", "top_journals", "unify_records", "duplicate_files", "bib_roundtrip",
    "bib_roundtrip_drop", "bib_line_mode", "keyword_freq", "cooccurrence_graph", "token_lists", "sorted_titles",
    "year_expanded", "year_buckets", "records_acm", "records_ieee", "records_sage", "records_springer",
    "bib_format", "page_links", "page_articles", "word_freq", "corpus_whole_words", "automaton_matches", "stats_csv_cells",
    "document_copies", "phrase_pairs_all", "document_neighbours", "linkage_single", "linkage_ward", "agglomerate_k5", "row_inertia",
]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, duck, name):
    verdict = compare(spark, duck, name, SF)
    assert verdict.startswith("ok"), verdict


def test_entry_and_names(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_zero_maximum_goes_to_one_bucket(spark):
    df = spark.createDataFrame([(0,), (0,)], "year int")
    assert [r.bucket for r in sorting.bucketed(df).collect()] == [0, 0]


def write_corpus(path, n=24):
    words = ["logic", "loops", "coding", "robotics", "school", "games", "music", "paint"]
    with open(path, "w") as f:
        for i in range(n):
            text = " ".join(words[(i * k + k) % 8] for k in range(1, 9)) + f" topic{i % 5}x"
            f.write(f"@article{{ref{i},\n  title = {{T{i}}},\n  author = {{A B and C D}},\n  year = {{{2000 + i % 3}}},\n")
            f.write(f"  journal = {{J}},\n  tipo = {{Article}},\n  publisher = {{P}},\n  abstract = {{{text}}}\n}}\n\n")


def test_workflows(spark, tmp_path):
    bib, out = str(tmp_path / "u.bib"), str(tmp_path / "out")
    write_corpus(bib)
    stats = workflows.run_statistics(spark, bib, out)
    assert stats["tipos_existentes"].first().n == 24
    words = workflows.run_keywords(spark, bib, out)
    assert words["freq"].count() > 2 and words["document_edges"].count() > 0
    large = workflows.run_large_corpus(spark, bib, out)
    assert large["labels"].count() == 24 and large["summary"].count() == large["labels"].select("cluster").distinct().count()
