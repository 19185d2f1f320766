"""Main text of an HTML page: the text nodes of one container, joined by spaces.

``pattern_text`` is a native expression. It is exact for containers that hold no
further element of their own tag and for the entities listed here. ``nested_text`` is
native too and follows containers inside containers. ``parsed_text`` takes any page, by a
small HTML parser inside an Arrow-batched UDF.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.functions.text import clean_text

# Entities decoded natively, as patterns. Those from before HTML 4 stand
# without their semicolon too. "&amp;" comes last so that nothing is decoded twice.
ENTITIES = [
    ("&lt;?", "<"),
    ("&gt;?", ">"),
    ("&quot;?", '"'),
    ("&#39;?", "'"),
    ("&apos;", "'"),
    ("&nbsp;?", "\u00a0"),
    ("&copy;?", "©"),
    ("&middot;?", "·"),
    ("&amp;?", "&"),
]
# One "<" before all alternatives: other characters fail at once.
MARKUP = (
    r"(?is)<(?:!--.*?-->|script\b.*?</script\s*>|style\b.*?</style\s*>"
    r"|template\b.*?</template\s*>|[^>]*>)"
)
#: Elements and comments whose text is not shown, and the markup that stands for what is cut.
HIDDEN = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>"
)
MARK = "<br>"
SPACES = " \t\n\r\f\u000b\u00a0"
HIDDEN_TAGS = ("script", "style", "template")


def pattern_text(html: Column, tag: str = "article", css_class: str | None = None) -> Column:
    """Container text by patterns, all in the JVM; ``''`` if there is no container."""
    wanted = (
        rf"""\s[^>]*?\bclass\s*=\s*["'](?:[^"']*\s)?{re.escape(css_class)}(?:\s[^"']*)?["'][^>]*"""
        if css_class
        else r"(?:\s[^>]*)?"
    )
    return _joined_nodes(F.regexp_extract(html, rf"(?is)<{tag}{wanted}>(.*?)</{tag}\s*>", 1))


def _joined_nodes(body: Column) -> Column:
    nodes = F.transform(F.split(body, MARKUP), lambda node: F.trim(_decoded(node), F.lit(SPACES)))
    return clean_text(F.array_join(F.filter(nodes, lambda node: node != ""), " "))


def nested_text(html: Column, tag: str = "article", css_class: str | None = None) -> Column:
    """Container text with containers inside it, all in the JVM; ``''`` if there is none.

    Comments and hidden elements give way to a mark first. The page is then cut at the
    container's own tags alone, and a fold over these few tags counts how deep they lie: the
    first wanted one opens the text, and the tag that closes it ends it, or else the page.
    Containers inside count as markup, as for :func:`parsed_text`.
    """
    page = F.regexp_replace(html, HIDDEN, MARK)
    own = rf"""(?is)</?{tag}(?:\s(?:[^>"']|"[^"]*"|'[^']*')*)?/?>"""
    # One pattern for both, so that the text after mark ``i`` is part ``i + 1``.
    marks, parts = F.regexp_extract_all(page, F.lit(own), F.lit(0)), F.split(page, own)
    wanted = rf"""(?is)\sclass\s*=\s*(?:["'](?:[^"']*\s)?{re.escape(css_class)}(?:\s[^"']*)?["']|{re.escape(css_class)}[\s>])""" if css_class else ""

    def step(state: Column, mark: Column) -> Column:
        closes, empty = F.startswith(mark, F.lit("</")), F.endswith(mark, F.lit("/>"))
        opens = ~closes & ~empty
        before, inside = state["first"] < 0, (state["first"] >= 0) & (state["last"] < 0)
        starts = before & opens & (F.rlike(mark, F.lit(wanted)) if css_class else F.lit(True))
        depth = state["depth"] + F.when(starts | (inside & opens), 1).when(inside & closes, -1).otherwise(0)
        return F.struct(
            (state["at"] + 1).alias("at"),
            F.when(starts, state["at"]).otherwise(state["first"]).alias("first"),
            F.when(inside & closes & (depth == 0), state["at"]).otherwise(state["last"]).alias("last"),
            depth.alias("depth"),
        )

    def body(state: Column) -> Column:
        end = F.when(state["last"] < 0, state["at"]).otherwise(state["last"])
        return F.when(state["first"] >= 0, F.array_join(F.slice(parts, state["first"] + 2, end - state["first"]), MARK)).otherwise("")

    start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.lit(0).alias("depth"))
    return _joined_nodes(F.aggregate(marks, start, step, body))


def _decoded(node: Column) -> Column:
    """Entities decoded, where the node has any: most have none and skip the passes."""
    decoded = reduce(lambda c, e: F.regexp_replace(c, *e), ENTITIES, node)
    return F.when(F.contains(node, F.lit("&")), decoded).otherwise(node)


class _ContainerText(HTMLParser):
    """Collects the visible text nodes of the first matching container."""

    def __init__(self, tag: str, css_class: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.tag, self.css_class = tag, css_class
        self.depth, self.closed, self.hidden = 0, False, None
        self.node, self.nodes = "", []

    def _end_node(self) -> None:
        if self.node.strip():
            self.nodes.append(self.node.strip())
        self.node = ""

    def handle_starttag(self, tag, attrs):
        self._end_node()
        if self.depth:
            self.depth += tag == self.tag
            self.hidden = self.hidden or (tag if tag in HIDDEN_TAGS else None)
        elif tag == self.tag and not self.closed:
            classes = (dict(attrs).get("class") or "").split()
            self.depth = int(self.css_class is None or self.css_class in classes)

    def handle_endtag(self, tag):
        self._end_node()
        if tag == self.hidden:
            self.hidden = None
        elif self.depth and tag == self.tag:
            self.depth -= 1
            self.closed = self.depth == 0

    def handle_startendtag(self, tag, attrs):
        self._end_node()

    def handle_comment(self, data):
        self._end_node()

    def handle_data(self, data):
        if self.depth and not self.hidden:
            self.node += data

    def text(self, page: str) -> str:
        self.feed(page)
        self.close()
        self._end_node()
        return " ".join(self.nodes)


def parsed_text(html: Column, tag: str = "article", css_class: str | None = None) -> Column:
    """Container text by a parser: nested containers, any entity; ``''`` if no container."""

    @F.pandas_udf("string")
    def container_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pages.map(lambda p: None if p is None else _ContainerText(tag, css_class).text(p))

    return clean_text(container_text(html))


def extract_article(
    df: DataFrame,
    html_col: str,
    tag: str = "article",
    css_class: str | None = None,
    parse: bool = True,
    out_col: str = "article",
    nested: bool = False,
) -> DataFrame:
    """Add the container's text; ``parse=False`` for pages known to suit ``pattern_text``, with
    ``nested`` for those that suit ``nested_text``."""
    text = parsed_text if parse else nested_text if nested else pattern_text
    return df.withColumn(out_col, text(F.col(html_col), tag, css_class))
