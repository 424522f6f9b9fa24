"""Tag-soup parsing with the standard library, as Arrow-batched functions.

Spark's own XPath functions need well-formed XML, so these few are Python: one pass over a page
yields its titles or its schedule table.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from typing import NamedTuple
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_CLOSES = {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": {"tr", "td", "th"}, "tfoot": {"tr", "td", "th", "tbody"}, "li": {"li"}, "p": {"p"}, "option": {"option"}}


class Node:
    """An element: tag, attributes, children (elements and text), its place in document order and its parent's.

    Below it are the elements from ``place + 1`` to ``end`` and the texts from ``first`` to ``last`` of its page.
    Parents are places, as cycles of elements would be left to the garbage collector.
    """

    __slots__ = ("attrs", "end", "first", "kids", "last", "place", "tag", "up")

    def __init__(self, tag: str, attrs: dict[str, str], up: int, place: int, first: int) -> None:
        self.tag, self.attrs, self.up, self.place, self.first, self.kids = tag, attrs, up, place, first, []


class Page(NamedTuple):
    """A page's root, and all its elements and texts in document order."""

    root: Node
    nodes: list[Node]
    texts: list[str]

    def below(self, n: Node) -> list[Node]:
        return self.nodes[n.place + 1 : n.end]

    def texts_of(self, n: Node) -> list[str]:
        return self.texts[n.first : n.last]


# What a tag does: it opens an element, adds one that holds nothing, ends one, or nothing.
_OPEN, _ADD, _END, _NONE = range(4)


class _Builder(HTMLParser):
    """What the standard library's parser meets, as steps of ``_tree``."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.met: list[tuple[int, str, dict[str, str], str]] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.met.append((_ADD if tag in _VOID else _OPEN, tag, {k: v or "" for k, v in attrs}, ""))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.met.append((_ADD, tag, {k: v or "" for k, v in attrs}, ""))

    def handle_endtag(self, tag: str) -> None:
        self.met.append((_END, tag, {}, ""))

    def handle_data(self, data: str) -> None:
        self.met.append((_NONE, "", {}, data))

    @property
    def root(self) -> Node:
        return _tree(self.met).root


def _tree(met: list[tuple[int, str, dict[str, str], str]]) -> Page:
    """The page of these steps: what a tag does, the tag, its attributes and the text behind it."""
    at = Node("", {}, -1, -1, 0)
    nodes: list[Node] = []
    texts: list[str] = []
    open_ = [at]

    def close(k: int) -> None:
        for n in open_[k:]:
            n.end, n.last = len(nodes), len(texts)
        del open_[k:]

    for what, tag, attrs, text in met:
        if what == _END:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    close(k)
                    at = open_[-1]
                    break
        elif what != _NONE:
            if what == _OPEN and tag in _CLOSES:
                shut, cut = _CLOSES[tag], 0
                for k in range(len(open_) - 1, 0, -1):
                    known = open_[k].tag
                    if known == "table":
                        break
                    if known in shut:
                        cut = k
                if cut:
                    close(cut)
                    at = open_[-1]
            n = Node(tag, attrs, at.place, len(nodes), len(texts))
            nodes.append(n)
            at.kids.append(n)
            if what == _OPEN:
                open_.append(n)
                at = n
            else:
                n.end, n.last = len(nodes), len(texts)
        if text:
            kids = at.kids
            if kids and kids[-1].__class__ is str:
                kids[-1] += text
                texts[-1] = kids[-1]
            else:
                kids.append(text)
                texts.append(text)
    root = open_[0]
    close(0)
    return Page(root, nodes, texts)


_PLAIN = re.compile(
    r"""(?:/([a-zA-Z][a-zA-Z0-9]*)"""
    r"""|([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n]+[a-zA-Z][-a-zA-Z0-9_:]*(?:="[^"]*"|='[^']*')?)*)[ \t\r\n]*(/?)"""
    r"""|![dD][oO][cC][tT][yY][pP][eE][^>]*)"""
)
_PLAIN_ATTR = re.compile(r"""([a-zA-Z][-a-zA-Z0-9_:]*)(?:=("[^"]*"|'[^']*'))?""")
# Elements whose content some version of the standard library takes as text.
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}
_LONG = 64  # characters of a piece that is not remembered


def _step(piece: str) -> tuple[int, str, dict[str, str], str] | None:
    """The step of ``_tree`` that a plain tag and the text behind it are, None of any other; ``piece`` has no opening bracket."""
    inner, shut, text = piece.partition(">")
    m = _PLAIN.fullmatch(inner) if shut else None
    if m is None:
        return None
    text = unescape(text) if "&" in text else text
    end, tag, attrs, closed = m.groups()
    if end:
        return _END, end.lower(), {}, text
    if not tag:
        return _NONE, "", {}, text
    tag = tag.lower()
    if tag in _RAW:
        return None
    found = {k.lower(): unescape(v[1:-1]) for k, v in _PLAIN_ATTR.findall(attrs)} if attrs else {}
    return _ADD if closed or tag in _VOID else _OPEN, tag, found, text


_known_step = lru_cache(1 << 14)(_step)  # pages repeat their tags


def _read(html: str | None) -> Page:
    """The page's tree. Plain tags are told by one pattern; from the first tag
    that is anything else, the standard library's parser reads the rest, so that the tree is always its own."""
    text, *pieces = (html or "").split("<")
    met = [_known_step(p) if len(p) < _LONG else _step(p) for p in pieces]
    if None in met:
        k = met.index(None)
        rest = _Builder()
        rest.feed("<" + "<".join(pieces[k:]))
        rest.close()
        met[k:] = rest.met
    if text:
        met.insert(0, (_NONE, "", {}, unescape(text)))
    return _tree(met)


def parse(html: str | None) -> Node:
    """The page's root."""
    return _read(html).root


def cell_text(texts: list[str]) -> str:
    return " ".join([t for x in texts if (t := x.strip())])


def schedule_rows(html: str | None) -> dict:
    """Rows of the schedule tables (index, cells, the opponent's link) and all links in their bodies.

    A schedule table has header cells that contain ``Opponent`` and ``Date``; the first such table
    of each parent counts. Rows with fewer than two cells keep their index but are left out.
    """
    rows, links, seen, index = [], [], set(), 0
    page = _read(html)
    for table in page.nodes:
        if table.tag != "table" or table.up in seen:
            continue
        inside = page.below(table)
        heads = [" ".join(page.texts_of(n)) for n in inside if n.tag == "th"]
        if not (any("Opponent" in h for h in heads) and any("Date" in h for h in heads)):
            continue
        seen.add(table.up)
        for n in inside:
            if n.tag == "tr":
                cells = [k for k in n.kids if k.__class__ is Node and k.tag == "td"]
                if cells or page.nodes[n.up].tag == "tbody":
                    if len(cells) >= 2:
                        href = next((a.attrs["href"] for a in page.below(cells[1]) if a.tag == "a" and "/" in a.attrs.get("href", "")), None)
                        rows.append({"game_index": index, "cells": [cell_text(page.texts_of(c)) for c in cells], "opp_href": href})
                    index += 1
            elif n.tag == "tbody":
                links += [a.attrs["href"] for a in page.below(n) if a.tag == "a" and "href" in a.attrs]
    return {"rows": rows, "links": links}


SCHEDULE = T.StructType(
    [
        T.StructField("rows", T.ArrayType(T.StructType([T.StructField("game_index", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType())), T.StructField("opp_href", T.StringType())]))),
        T.StructField("links", T.ArrayType(T.StringType())),
    ]
)


def schedule_table(html: Column) -> Column:
    @F.pandas_udf(SCHEDULE)
    def run(pages: pd.Series) -> pd.DataFrame:
        found = [schedule_rows(p) for p in pages]
        return pd.DataFrame({"rows": [f["rows"] for f in found], "links": [f["links"] for f in found]})

    return run(html)


def titles_of(html: str | None) -> dict:
    """The four metadata titles, the title's and the first heading's first text node."""
    out = dict.fromkeys(("og_site", "og_title", "name_site", "name_title", "title", "h1"))
    page = _read(html)
    for n in page.nodes:
        if n.tag == "meta" and "content" in n.attrs:
            for key, attr, want in (("og_site", "property", "og:site_name"), ("og_title", "property", "og:title"), ("name_site", "name", "og:site_name"), ("name_title", "name", "og:title")):
                if out[key] is None and n.attrs.get(attr) == want:
                    out[key] = n.attrs["content"]
        elif n.tag == "title" and out["title"] is None:
            out["title"] = next((k for k in n.kids if isinstance(k, str)), None)
        elif n.tag == "h1" and out["h1"] is None:
            out["h1"] = next(iter(page.texts_of(n)), None)
    return out


def titles(html: Column) -> Column:
    schema = T.StructType([T.StructField(k, T.StringType()) for k in ("og_site", "og_title", "name_site", "name_title", "title", "h1")])

    @F.pandas_udf(schema)
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([titles_of(p) for p in pages], columns=schema.names)

    return run(html)


def url_join(base: Column, href: Column) -> Column:
    @F.pandas_udf("string")
    def run(bases: pd.Series, hrefs: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(bases, hrefs, strict=True)], dtype=object)

    return run(base, href)


EMBEDDED = r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>'


def embedded(html: Column) -> Column:
    """The text of the embedded document; empty if there is none."""
    return F.regexp_extract(F.coalesce(html, F.lit("")), EMBEDDED, 1)


def is_page(content_type: Column) -> Column:
    return F.lower(F.coalesce(content_type, F.lit(""))).rlike("html|xml")
