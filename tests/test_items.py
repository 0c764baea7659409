from bibspark.sources import items

HTML = """<ul><li class="x"><a rel="n" href="/a?b=1&amp;c">One &lt;b&gt; <i>two</i>
 three</a></li><li>no link</li><LI>other</LI></ul><!-- <li><a href="/no">no</a></li> -->
<article id="7"><h1>T</h1><p>a<br>b</p><!-- gone --></article><article><p>no head</p></article>"""


def test_items(spark):
    pages = spark.createDataFrame([(1, HTML, "k"), (2, None, "k"), (3, "", "k"), (4, "<li>open", "k")], "page_id int, html string, `a.b` string")
    links = [tuple(r) for r in items.cut_items(pages, items.LINKS).orderBy("index").collect()]
    assert links == [(1, "k", 0, "One <b> two three", "/a?b=1&c"), (1, "k", 1, None, None), (1, "k", 2, "no", "/no")]
    articles = [tuple(r) for r in items.cut_items(pages.drop("a.b"), items.ARTICLES).orderBy("index").collect()]
    assert articles == [(1, 0, "T", "a b"), (1, 1, None, None)]
