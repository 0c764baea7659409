"""Result items of pages by column expressions: cut, explode, and one pattern per field.

For pages whose items are marked plainly this needs no tree: an item is what its pattern takes, and only its own text is
looked at for the fields. Everything stays in the JVM; a page with many items becomes many small rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of HTML: signs written as entities, "&" last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&"))


@dataclass(frozen=True)
class ItemRule:
    """What an item is, and the first group of each field's pattern inside it; a field that is not found is null."""

    item: str
    fields: dict[str, str]


LINKS = ItemRule(r"(?s)<li\b.*?</li>", {"title": r"(?s)<a\b[^>]*>(.*?)</a>", "link": r'<a\b[^>]*?href="([^"]*)"'})
ARTICLES = ItemRule(r"(?s)<article\b.*?</article>", {"title": r"(?s)<h1\b[^>]*>(.*?)</h1>", "abstract": r"(?s)</h1>(.*)</article>"})


def visible(html: Column) -> Column:
    """The text of a piece of HTML: no tags and comments, entities as signs, runs of white space as one blank."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->|<[^>]*>", " ")
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return F.btrim(F.regexp_replace(text, r"[ \t\r\n]+", " "))


def cut_items(pages: DataFrame, rule: ItemRule, html: str = "html") -> DataFrame:
    """A row per item: all columns of ``pages`` but ``html``, ``index`` from 0, and the fields' visible text."""
    others = [F.col(f"`{c}`") for c in pages.columns if c != html]
    cut = pages.select(*others, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(rule.item), F.lit(0))).alias("index", "_item"))
    found = {name: F.when(F.col("_item").rlike(p), visible(F.regexp_extract("_item", p, 1))) for name, p in rule.fields.items()}
    return cut.withColumns(found).drop("_item")
