"""Records from the result pages of four digital libraries.

An Arrow stage parses the HTML of ``pages(url, html)`` and picks the raw text of
each part of a result; the field rules are column expressions on top.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree as ET

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.batches import by_bytes
from ..functions.clean import standalone_year
from ..functions.text import strip_blanks

# Where each site keeps its parts. A step is tag.class[attr=value];
# ">" asks for a child, "+" for the next sibling, a blank for any descendant.
SITES = {
    "acm": {
        "result": ".search__item",
        "title": ".hlFld-Title a",
        "authors": ".rlist--inline",
        "date": ".bookPubDate",
        "journal": ".issue-item__detail",
        "abstract": ".issue-item__abstract",
    },
    "ieee": {
        "result": ".List-results-items",
        "title": "a.fw-bold",
        "authors": ".text-base-md-lh",
        "date": ".publisher-info-container",
        "journal": "div.description > a[xplhighlight]",
        "kinds": "span[xplhighlight]",
        "publisher_label": "button[xplhighlight] span.title",
        "publisher": "button[xplhighlight] span.title + span",
        "abstract": ".twist-container",
    },
    "sage": {
        "result": ".rlist.search-result__body.items-results > div",
        "title": ".sage-search-title",
        "authors": ".issue-item__authors",
        "date": ".issue-item__header",
        "journal": ".issue-item__row",
        "kinds": ".issue-item-access + span",
        "abstract": ".issue-item__abstract__content",
    },
    "springer": {
        "result": "article.c-listing__content",
        "title": "h3.c-listing__title a[data-test=title-link]",
        "authors": "div.c-listing__authors",
        "date": "span[data-test=published-on]",
        "journal": "em[data-test=journal-title]",
        "kinds": "span[data-test=result-list]",
        "abstract": "p",
    },
}
HOSTS = {
    "acm": "https://dl.acm.org",
    "ieee": "https://ieeexplore.ieee.org",
    "sage": "https://journals.sagepub.com",
    "springer": "https://www.springeropen.com",
}
UNKNOWN = "Unknown"

_PARTS = ("title", "link", "authors", "date", "journal", "publisher_label", "publisher", "abstract")
_RAW = "index int, " + ", ".join(f"{p} string" for p in _PARTS) + ", kinds array<string>"
_ARROW = pa.schema([("url", pa.string()), ("index", pa.int32()), *[(p, pa.string()) for p in _PARTS], ("kinds", pa.list_(pa.string()))])
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = {"address", "article", "div", "dd", "dl", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ol", "p", "section", "table", "tr", "ul"}
_HIDDEN = {"script", "style", "template"}
# Fixed values of HTML: open elements that a start tag ends, and those beyond which it ends none.
_ENDS = {
    "li": ({"li"}, {"ul", "ol"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_ENDS_P = ({"p"}, {"button", "table", "td", "th"})


class _Tree(HTMLParser):
    """Lenient HTML to an element tree; unclosed elements end with their parent, or where a start tag implies it."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = ET.Element("root")
        self.open = [self.root]
        self.feed(html)
        self.close()

    def _end(self, tags, beyond=()):
        """End the innermost open element with one of ``tags``, unless one of ``beyond`` is further in."""
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in tags:
                del self.open[depth:]
                return
            if self.open[depth].tag in beyond:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._end(*_ENDS_P)
        if tag in _ENDS:
            self._end(*_ENDS[tag])
        node = ET.SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})
        if tag not in _VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        self._end({tag})

    def handle_data(self, data):
        top = self.open[-1]
        if len(top):
            top[-1].tail = (top[-1].tail or "") + data
        else:
            top.text = (top.text or "") + data


def _steps(path: str) -> list[tuple[str, str, list[str], list[tuple[str, str, str]]]]:
    """A path as ``(relation, tag, classes, attributes)`` steps."""
    steps, how = [], " "
    for part in path.split():
        if part in ">+":
            how = part
            continue
        tag, classes, attrs = re.match(r"([\w-]*)((?:\.[\w-]+)*)((?:\[[^]]+\])*)$", part).groups()
        wanted = [a.partition("=") for a in re.findall(r"\[([^]]+)\]", attrs)]
        steps.append((how, tag, classes.split(".")[1:], wanted))
        how = " "
    return steps


def _select(scope: ET.Element, steps: list) -> list[ET.Element]:
    """Elements below ``scope`` that the steps lead to, in document order."""
    found = [scope]
    for how, tag, classes, attrs in steps:
        following = []
        for node in found:
            if how == ">":
                near = list(node)
            elif how == "+":
                siblings = list(next(p for p in scope.iter() if node in list(p)))
                near = siblings[siblings.index(node) + 1 :][:1]
            else:
                near = [n for n in node.iter() if n is not node]
            for n in near:
                own = n.get("class", "").split()
                fits = (not tag or n.tag == tag) and all(c in own for c in classes)
                if fits and all(k in n.attrib and (not eq or n.get(k) == v) for k, eq, v in attrs):
                    following.append(n)
        found = list(dict.fromkeys(following))
    return found


def _text(node: ET.Element) -> str:
    """Text as shown: blanks collapsed, block elements and line breaks on lines of their own."""
    out: list[str] = []
    todo: list[ET.Element | str] = [node]  # elements to open, and text to write, last first
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
        elif n.tag not in _HIDDEN:
            edge = "\n" if n.tag in _BLOCK or n.tag == "br" else ""
            out.append(edge + re.sub(r"\s+", " ", n.text or ""))
            todo.append(edge if n.tag != "br" else "")
            for child in reversed(n):
                todo += (re.sub(r"\s+", " ", child.tail or ""), child)
    return re.sub(r" *\n[\n ]*", "\n", "".join(out)).strip()


def _pick(site: str):
    paths = {part: _steps(path) for part, path in SITES[site].items()}

    def records(url: str, html: str | None) -> Iterator[dict]:
        for index, result in enumerate(_select(_Tree(html or "").root, paths["result"])):
            row = dict.fromkeys(_PARTS) | {"url": url, "index": index, "kinds": []}
            for part, path in paths.items():
                hits = _select(result, path) if part != "result" else []
                if part == "kinds":
                    row[part] = [_text(h) for h in hits]
                elif hits:
                    row[part] = _text(hits[0])
                    if part == "title":
                        row["link"] = hits[0].get("href")
            yield row

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in by_bytes(batch, "html"):
                pages = zip(some.column("url").to_pylist(), some.column("html").to_pylist())
                yield pa.RecordBatch.from_pylist([row for page in pages for row in records(*page)], schema=_ARROW)

    return pick


def _or_unknown(col: Column) -> Column:
    return F.coalesce(col, F.lit(UNKNOWN))


def _rules(site: str) -> dict[str, Column]:
    """Field rules of a site over the raw parts."""
    raw = {p: F.col(p) for p in _PARTS}
    host = F.lit(HOSTS[site])
    kinds = F.transform("kinds", strip_blanks)
    rules = {
        "title": _or_unknown(raw["title"]),
        "author": _or_unknown(raw["authors"]),
        "year": _or_unknown(standalone_year(raw["date"])),
        "journal": _or_unknown(raw["journal"]),
        "tipo": F.lit(UNKNOWN),
        "publisher": F.lit(UNKNOWN),
        "abstract": _or_unknown(raw["abstract"]),
        "url": F.concat(host, _or_unknown(raw["link"])),
    }
    if site == "acm":
        rules["tipo"] = rules["publisher"] = F.lit(None).cast("string")
    elif site == "ieee":
        rules["author"] = _or_unknown(strip_blanks(F.replace(raw["authors"], F.lit("\n"), F.lit(" "))))
        plain = F.filter(kinds, lambda k: ~k.rlike(r"Year:|Volume:|Issue:|\d"))
        rules["tipo"] = _or_unknown(F.get(plain, 0))
        named = F.contains(raw["publisher_label"], F.lit("Publisher:"))
        rules["publisher"] = _or_unknown(F.when(named, strip_blanks(raw["publisher"])))
    elif site == "sage":
        rules["author"] = _or_unknown(strip_blanks(F.replace(raw["authors"], F.lit("\n"), F.lit(", "))))
        rules["tipo"] = _or_unknown(F.get(kinds, 0))
        flat = F.btrim(F.regexp_replace(raw["abstract"], r"\s+", " "))
        rules["abstract"] = _or_unknown(F.btrim(F.regexp_replace(flat, "(?i)^abstract", "")))
    else:
        rules["author"] = _or_unknown(strip_blanks(F.replace(strip_blanks(raw["authors"]), F.lit("Authors:"), F.lit(""))))
        kind = F.get(kinds, 0)
        labelled = F.when(F.contains(kind, F.lit("Content type:")), F.substring_index(kind, "Content type:", -1))
        rules["tipo"] = _or_unknown(F.btrim(strip_blanks(labelled), F.lit('"')))
        link = _or_unknown(raw["link"])
        rules["url"] = F.when(link.startswith("http"), link).otherwise(F.concat(host, link))
    return rules


def extract_records(pages: DataFrame, site: str) -> DataFrame:
    """Publication fields of every result on the pages of ``site``.

    ``pages`` needs ``url, html``; the page address comes back as ``page_url``
    with the place of the result as ``index``. IEEE results without a title
    link are skipped; elsewhere a missing part reads ``Unknown``.
    """
    raw = pages.select("url", "html").mapInArrow(_pick(site), "url string, " + _RAW)
    if site == "ieee":
        raw = raw.filter(F.col("title").isNotNull())
    raw = raw.withColumnRenamed("url", "page_url")
    return raw.select("page_url", "index", *[col.alias(name) for name, col in _rules(site).items()])
