from bibspark.operators import keywords
from bibspark.sources.taxonomy import TAXONOMY, taxonomy_rows

TEXTS = [
    "Logic and loops in education.",
    "Technological effects in the virtual semester.",
    "Block programming: a primary school pilot with Scratch",
    "Parallelism in STEM classes",
]


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id int, abstract string")


def test_taxonomy_size():
    assert len(TAXONOMY) == 10 and sum(map(len, TAXONOMY.values())) == 126 and len(taxonomy_rows()) == 172


def test_matches(spark):
    got = {(r.doc_id, r.category, r.term) for r in keywords.match_terms(docs(spark, TEXTS)).collect()}
    assert got == {
        (0, "Habilidades", "Logic"), (0, "Conceptos Computacionales", "Loops"),
        (1, "Habilidades", "Logic"), (1, "Propiedades Psicométricas", "Item Response Theory"),
        (1, "Propiedades Psicométricas", "Structural Equation Model"),
        (1, "Herramientas de Evaluación", "Computational Thinking Scale"),
        (1, "Herramientas de Evaluación", "Computational Thinking Skill Levels Scale"),
        (1, "Herramientas de Evaluación", "CT Scale"),
        (2, "Habilidades", "Programming"), (2, "Nivel de Escolaridad", "Primary School"),
        (2, "Medio", "Block programming"), (2, "Medio", "Programming"), (2, "Herramientas Tecnológicas", "Scratch"),
    }
    totals = {r.term: r.freq for r in keywords.keyword_total(keywords.keyword_freq(docs(spark, TEXTS))).collect()}
    assert totals.pop("Logic") == 2 and totals.pop("Programming") == 2 and set(totals.values()) == {1}


def test_document_cooccurrence(spark):
    corpus = [
        "A robot arm and a line sensor, sold as one school kit.",
        "The school kits hold no motor; the line sensor is apart.",
        "Painting murals takes a wall and patience.",
    ]
    words = {
        "robot arm": ["robot arm", "robotic arm"],
        "sensor": ["line sensor"],
        "kit": ["school kit", "teaching kit"],
        "motor": ["motor"],
        "wall": ["wall"],
        "drone": ["drone"],
    }
    nodes, edges = keywords.cooccurrence_graph(docs(spark, corpus), {"": words})
    # by hand: text 1 has kit, robot arm, sensor; text 2 kit, motor, sensor; text 3 wall alone
    assert {(r.a, r.b) for r in edges.collect()} == {
        ("kit", "robot arm"), ("kit", "sensor"), ("robot arm", "sensor"), ("kit", "motor"), ("motor", "sensor"),
    }
    weights = {(r.a, r.b): r.weight for r in edges.collect()}
    assert weights["kit", "sensor"] == 2 * weights["kit", "motor"]
    sizes = {r.term: r["size"] for r in keywords.node_sizes(nodes, edges, mode="count").collect()}
    assert sizes["kit"] == 150 and sizes["motor"] == 100


def test_category_graph(spark):
    freq = spark.createDataFrame(
        [("c1", "a", 1), ("c1", "b", 1), ("c2", "a", 1), ("c2", "b", 1), ("c3", "z", 1)],
        "category string, term string, freq long",
    )
    nodes, edges = keywords.category_graph(freq)
    assert [tuple(r) for r in edges.collect()] == [("a", "b", 2)]
    assert keywords.category_graph(freq, 3)[1].count() == 0
    sizes = {r.term: (r.category, r.degree, r["size"]) for r in keywords.node_sizes(nodes, edges).collect()}
    assert sizes == {"a": ("c1", 2, 1100.0), "b": ("c1", 2, 1100.0), "z": ("c3", 0, 100.0)}
