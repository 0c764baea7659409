import pyarrow as pa

from bibspark.sources import pages


def springer(body):
    return f'<article class="c-listing__content"><h3 class="c-listing__title"><a data-test="title-link" href="/1">T</a></h3>{body}</article>'


def test_unclosed_and_deep_pages(spark):
    """Start tags end open paragraphs, items and cells; nesting of any depth is read."""
    rows = [
        ("p", springer("<p>one<p>two<div>three</div>")),
        ("items", springer("<p>" + "<ul><li>a<li>b</ul>")),
        ("deep", springer("<p>" + "<b>" * 5000 + "bold")),
        ("list", "<li>" * 2000 + springer("<p>last")),
        ("empty", ""), ("null", None),
    ]
    got = pages.extract_records(spark.createDataFrame(rows, "url string, html string"), "springer").collect()
    assert {r.page_url: r.abstract for r in got} == {"p": "one", "items": "", "deep": "bold", "list": "last"}


def test_cells_and_nested_lists():
    tree = pages._Tree("<table><tr><td>1<td>2<tr><td>3<table><tr><td>x</table>y</table><ul><li>a<ul><li>b</ul><li>c</ul>")
    rows = tree.root.findall("table/tr")
    assert [[pages._text(c) for c in r] for r in rows] == [["1", "2"], ["3\nx\ny"]]
    assert [pages._text(i) for i in tree.root.findall("ul/li")] == ["a\nb", "c"]


def test_long_pages_are_taken_apart_some_at_a_time():
    """A batch counts rows; what is held of it at a time goes by bytes."""
    rows = [{"url": str(i), "html": springer("<p>" + "x" * 300_000) * 2} for i in range(10)] + [{"url": "null", "html": None}]
    parts = list(pages._pick("springer")(iter([pa.RecordBatch.from_pylist(rows)])))
    assert len(parts) > 5 and max(p.num_rows for p in parts) <= 4
    whole = [r for p in parts for r in p.to_pylist()]
    assert [(r["url"], r["index"]) for r in whole] == [(str(i), k) for i in range(10) for k in (0, 1)]
    assert {r["abstract"] for r in whole} == {"x" * 300_000}
