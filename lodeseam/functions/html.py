"""HTML columns.

`parsed` is exact: an event parser in an Arrow-batched function gives title, visible text and links
with what stands before and after them. `titles`, `hrefs` and `visible` are native, for plain markup
(double-quoted attributes, no tags within titles).
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINK = T.StructType([T.StructField(n, T.StringType()) for n in ("href", "text", "title", "before", "after")])
PAGE = T.StructType([T.StructField("title", T.StringType()), T.StructField("text", T.StringType()), T.StructField("links", T.ArrayType(LINK))])
HIDDEN = ("script", "style", "template")
BEFORE_NODES, BEFORE_CHARS, AFTER_CHARS = 6, 300, 180


class _Events(HTMLParser):
    """Writes down a page as events: ("text", string, in title), ("open", href, title), ("close",)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[tuple] = []
        self.hidden, self.titles = "", 0

    def handle_starttag(self, tag, attrs):
        if self.hidden:
            return
        if tag in HIDDEN:
            self.hidden = tag
        elif tag == "title":
            self.titles += 1
        elif tag == "a" and (named := dict(attrs)).get("href"):
            self.events.append(("open", named["href"], (named.get("title") or "").strip()))

    def handle_endtag(self, tag):
        if self.hidden:
            self.hidden = "" if tag == self.hidden else self.hidden
        elif tag == "title":
            self.titles = max(0, self.titles - 1)
        elif tag == "a":
            self.events.append(("close",))

    def handle_data(self, data):
        if not self.hidden and (text := " ".join(data.split())):
            self.events.append(("text", text, self.titles > 0))


def _following(nodes: list[str]) -> str:
    """The nodes joined until `AFTER_CHARS` characters are reached; the space between two isn't counted."""
    out = ""
    for node in nodes:
        if len(out) >= AFTER_CHARS:
            break
        out = f"{out} {node[: AFTER_CHARS - len(out)]}".strip()
    return out


def parse(html: str) -> dict:
    parser = _Events()
    parser.feed(html)
    events = parser.events
    opened = [i for i, e in enumerate(events) if e[0] == "open"]
    links = []
    for i, nxt in zip(opened, [*opened[1:], len(events)], strict=False):
        seen = _last_texts(events, i)
        close = next((k for k in range(i + 1, nxt) if events[k][0] == "close"), None)
        inside = [e[1] for e in events[i + 1 : nxt if close is None else close] if e[0] == "text"]
        behind = [] if close is None else [e[1] for e in events[close + 1 : nxt] if e[0] == "text"]
        links.append({"href": events[i][1], "text": " ".join(inside), "title": events[i][2], "before": " ".join(seen)[-BEFORE_CHARS:], "after": _following(behind)})
    texts = [e for e in events if e[0] == "text"]
    return {"title": " ".join(e[1] for e in texts if e[2]), "text": " ".join(e[1] for e in texts), "links": links}


def _last_texts(events: list[tuple], end: int) -> list[str]:
    out: list[str] = []
    k = end - 1
    while k >= 0 and len(out) < BEFORE_NODES:
        if events[k][0] == "text":
            out.append(events[k][1])
        k -= 1
    return out[::-1]


@F.pandas_udf(PAGE)
def parsed(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse(x or "") for x in html], columns=["title", "text", "links"])


BLOCK = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("level", T.IntegerType()), T.StructField("text", T.StringType())]))
#: Elements whose texts are blocks of their own, and those that aren't content.
BLOCK_TAGS = {**{f"h{i}": ("heading", i) for i in range(1, 7)}, "li": ("item", 0), "p": ("paragraph", 0), "td": ("cell", 0), "th": ("cell", 0), "blockquote": ("quote", 0), "pre": ("code", 0)}
SITE_TAGS = (*HIDDEN, "nav", "header", "footer", "aside", "form", "title")


class _Blocks(HTMLParser):
    """The blocks of a page: a text belongs to the innermost block that is open, or is a paragraph."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, list[str]]] = []
        self.open: list[str] = []
        self.outside = 0

    def handle_starttag(self, tag, attrs):
        if tag in SITE_TAGS:
            self.outside += 1
        elif tag in BLOCK_TAGS:
            self.open.append(tag)
            depth = self.open.count("li") if tag == "li" else BLOCK_TAGS[tag][1]
            self.blocks.append((BLOCK_TAGS[tag][0], depth, []))
        elif tag in ("div", "section", "ul", "ol", "table", "br"):
            self.blocks.append(("paragraph", 0, []))

    def handle_endtag(self, tag):
        if tag in SITE_TAGS:
            self.outside = max(0, self.outside - 1)
        elif tag in self.open:
            while self.open.pop() != tag:
                pass
            self.blocks.append(("paragraph", 0, []))

    def handle_data(self, data):
        if not self.outside and data.strip():
            if not self.blocks:
                self.blocks.append(("paragraph", 0, []))
            self.blocks[-1][2].append(data)


def content_blocks(html: str) -> list[dict]:
    """The headings (with their level), list items (with their depth), paragraphs and cells of a page, without navigation."""
    parser = _Blocks()
    parser.feed(html)
    made = ((kind, level, " ".join("".join(parts).split())) for kind, level, parts in parser.blocks)
    return [{"kind": kind, "level": level, "text": text} for kind, level, text in made if text]


@F.pandas_udf(BLOCK)
def blocks(html: pd.Series) -> pd.Series:
    return html.map(lambda x: content_blocks(x or ""))


def context(link: Column) -> Column:
    """All that is known of a link as one text."""
    return F.array_join(F.filter(F.array(link["text"], link["title"], link["before"], link["after"]), lambda x: x != ""), " ")


ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", "\""), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")]


def unescaped(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def _shown(html: Column) -> Column:
    return F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>|<!--.*?-->", "")


def titles(html: Column) -> Column:
    return F.trim(F.regexp_replace(unescaped(F.regexp_extract(_shown(html), r"(?is)<title[^>]*>(.*?)</title>", 1)), r"\s+", " "))


def hrefs(html: Column) -> Column:
    """The targets of all anchors, in their order."""
    return F.transform(F.regexp_extract_all(_shown(html), F.lit(r'(?is)<a\s[^>]*?href="([^"]+)"'), F.lit(1)), unescaped)


def visible(html: Column) -> Column:
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(_shown(html), r"(?s)<[^>]*>", " ")), r"\s+", " "))
