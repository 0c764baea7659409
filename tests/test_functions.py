import unicodedata

import pytest
from pyspark.sql import functions as F

from bibspark.functions import clean, text
from bibspark.functions.stopwords import ENGLISH
from bibspark.functions.tokens import lemmatize, ngrams, tokens


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v")).alias("x")).collect()]


def test_ascii_fold_is_nfkd(spark):
    values = ["plain", " Événement ñandú ", "ﬁne ½ ㎏ №5", "𝐀𝐛c", "日本", "áb", "Å x", "…“q”", "", None]
    want = [
        None if v is None else unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().strip()
        for v in values
    ]
    assert column(spark, values, text.ascii_fold) == want


@pytest.mark.parametrize(
    "value, label",
    [
        ("Research Article", "Articulo"), ("Book Review", "Articulo"), ("Newsletter", "Articulo"),
        ("Conferences", "Conference Paper"), ("Special Section", "Conference Paper"),
        ("Book Chapter", "Libro"), ("Monograph", "Libro"), ("Chapter", "Capitulo de libro"),
        ("Unknown Type", "Otro"), ("Standards", "Otro"), ("", "Otro"), (None, "Otro"),
    ],
)
def test_types(spark, value, label):
    assert column(spark, [value], clean.classify_type) == [label]


def test_authors(spark):
    cases = {
        "Perez, Ana and Ruiz, Luis": ["Ana Perez", "Luis Ruiz"],
        "Ana Perez, Luis Ruiz": ["Ana Perez", "Luis Ruiz"],
        "J. Smith, A. Doe": ["A. Doe J. Smith"],
        "Alexander Anderson": ["Alexander Anderson"],
        "View all": [],
        "": [],
        None: [],
        "Ana Perez and View All": ["Ana Perez"],
        "Smith, and Doe": [" Smith", "Doe"],
        '{Ana "X" Perez}': ["Ana X Perez"],
    }
    assert column(spark, list(cases), clean.normalize_authors) == list(cases.values())


def test_names_and_years(spark):
    names = {
        "IEEE Trans. Educ.": "Ieee Trans Educ",
        "computer-aided 3d learning": "Computer-Aided 3D Learning",
        "J. of C & S": "J Of C S",
        "***": None,
        "": None,
        None: None,
    }
    assert column(spark, list(names), clean.clean_name) == list(names.values())
    years = ["12 March 2021", "20201", "c. 1999-2001", "Unknown Year", None]
    assert column(spark, years, clean.extract_year) == ["2021", "2020", "1999", None, None]
    assert column(spark, years, clean.strict_year) == [None, None, None, None, None]
    assert column(spark, ["c. 2004", " 1999 "], clean.strict_year) == [2004, 1999]
    assert column(spark, years, clean.standalone_year) == ["2021", None, "1999", None, None]


def test_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_and_ngrams(spark):
    got = column(spark, ["The e-mail of VR2x rooms, é _x a averyveryverylongword"], lambda c: tokens(c, "A"))
    assert got == [["email", "vr", "rooms"]]
    got = column(spark, ["The VR2lab of e-mail rooms"], lambda c: tokens(c, "B"))
    assert got == [["lab", "email", "rooms"]]
    grams = column(spark, ["red blue green"], lambda c: ngrams(F.split(c, " "), 2))
    assert grams == [["red blue", "blue green"]]
    assert column(spark, ["red"], lambda c: ngrams(F.split(c, " "), 3)) == [[]]


def test_lemmas_replace_listed_words(spark):
    docs = spark.createDataFrame([(1, ["games", "red"]), (2, ["x"])], "doc_id int, tokens array<string>")
    lemmas = spark.createDataFrame([("games", "game")], "word string, lemma string")
    got = {r.doc_id: r.tokens for r in lemmatize(docs, lemmas).collect()}
    assert got == {1: ["game", "red"], 2: ["x"]}
