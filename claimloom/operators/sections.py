"""Sections of documents and the version headings that govern them."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urldefrag, urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions import versions as v

_LEVELS = 6


def lines(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, line (from 0) and text of every line."""
    return documents.select(key, F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)).alias("line", "text"))


def markdown_sections(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, section (from 0), heading, path (ancestor headings, outermost first) and text of each section with a body.

    A document is one row throughout: its lines are folded inside the row, so nothing is shuffled.
    """
    empty = F.array().cast("array<string>")
    start = F.struct(
        F.array().cast("array<struct<heading:string,path:array<string>,text:string>>").alias("done"),
        F.lit(None).cast("string").alias("heading"),
        empty.alias("path"),
        empty.alias("body"),
        F.array_repeat(F.lit(""), _LEVELS).alias("stack"),
    )

    def closed(a: Column) -> Column:
        own = F.struct(a.heading.alias("heading"), a.path.alias("path"), F.array_join(a.body, "\n").alias("text"))
        return F.when(F.exists(a.body, lambda x: F.trim(x) != ""), F.concat(a.done, F.array(own))).otherwise(a.done)

    def step(a: Column, x: Column) -> Column:
        marks = F.length(F.regexp_extract(x, r"^(#{1,6})\s+", 1))
        heading = F.regexp_replace(x, r"^#{1,6}\s+", "")
        above = F.slice(a.stack, F.lit(1), F.greatest(marks - 1, F.lit(0)))
        stack = F.concat(above, F.array(heading), F.array_repeat(F.lit(""), _LEVELS - marks))
        opened = F.struct(closed(a).alias("done"), heading.alias("heading"), F.filter(above, lambda h: h != "").alias("path"), empty.alias("body"), stack.alias("stack"))
        grown = F.struct(a.done.alias("done"), a.heading.alias("heading"), a.path.alias("path"), F.concat(a.body, F.array(x)).alias("body"), a.stack.alias("stack"))
        return F.when(marks > 0, opened).otherwise(grown)

    folded = F.aggregate(F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1), start, step, closed)
    return documents.select(key, F.posexplode(folded).alias("section", "s")).select(key, "section", "s.heading", "s.path", "s.text")


def governing(marked: DataFrame, by: str, at: str, mark: str, name: str) -> DataFrame:
    """Adds ``name``: the last value of ``mark`` at or before the row, null before the first."""
    order = Window.partitionBy(by).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn(name, F.last(mark, ignorenulls=True).over(order))


def heading_versions(heading: Column, path: Column, resolved: Column) -> Column:
    """Labels of ``resolved`` that the nearest heading with versions names.

    Null if no heading names a version; empty if the one that does names none of ``resolved``.
    """
    chain = F.concat(F.array(heading), F.reverse(path))
    named = F.filter(F.transform(chain, lambda h: F.filter(v.version_tokens(h), lambda t: v.numeric_label(t).isNotNull())), lambda t: F.size(t) > 0)
    keys = F.transform(F.get(named, F.lit(0)), lambda t: v.version_key(t))
    inside = F.filter(resolved, lambda r: F.array_contains(keys, v.version_key(r)))
    return F.when(F.size(named) > 0, F.sort_array(F.array_distinct(inside)))


# Fixed values of the markup language: elements without content, and those whose start ends an open paragraph.
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ENDS_PARAGRAPH = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table ul".split())
_HEADINGS = frozenset(f"h{n}" for n in range(1, 7))
_FRAME = frozenset("script style nav footer header aside form".split())
_WHOLE = frozenset(("li", "pre", "table"))
_GUIDES, _FEEDS = re.compile("upgrad|migrat|changelog", re.I), ("application/rss+xml", "application/atom+xml")


class _Tree(HTMLParser):
    """A page as its nodes in order: tag (or none and a text), attributes, parent, and the number behind its last descendant.

    Paragraphs are flat, as the language has them: one that the page does not close ends where the next block
    starts; items and headings likewise. End tags without an open element are left out.
    """

    def __init__(self, page: str):
        super().__init__(convert_charrefs=True)
        self.tags: list[str | None] = ["document"]
        self.values: list = [{}]
        self.parents, self.ends, self.open = [-1], [0], [0]
        self.joint = False  # whether more text belongs to the last node
        self.feed(page)
        super().close()
        for node in self.open:
            self.ends[node] = len(self.tags)

    def _end(self, tags: frozenset, within: frozenset = frozenset()) -> None:
        """Ends the innermost open element of ``tags`` and what is open in it, unless one of ``within`` is met before."""
        self.joint = False
        for place in range(len(self.open) - 1, 0, -1):
            tag = self.tags[self.open[place]]
            if tag in tags:
                while len(self.open) > place:
                    self.ends[self.open.pop()] = len(self.tags)
                return
            if tag in within:
                return

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if tag in _ENDS_PARAGRAPH:
            self._end(frozenset(("p",)), _WHOLE | {"blockquote", "td", "th"})
        if tag == "li":
            self._end(frozenset(("li",)), frozenset(("ul", "ol", "menu")))
        if tag in _HEADINGS and self.tags[self.open[-1]] in _HEADINGS:
            self._end(_HEADINGS)
        own, self.joint = len(self.tags), False
        self.tags.append(tag)
        self.values.append({name: value or "" for name, value in reversed(attributes)})
        self.parents.append(self.open[-1])
        self.ends.append(own + 1)
        if tag not in _EMPTY:
            self.open.append(own)

    def handle_startendtag(self, tag: str, attributes: list) -> None:
        self.handle_starttag(tag, attributes)
        if tag not in _EMPTY:
            self._end(frozenset((tag,)))

    def handle_endtag(self, tag: str) -> None:
        self._end(frozenset((tag,)))

    def handle_data(self, data: str) -> None:
        if self.joint:
            self.values[-1] += data
            return
        self.joint = True
        self.tags.append(None)
        self.values.append(data)
        self.parents.append(self.open[-1])
        self.ends.append(len(self.tags))

    def handle_comment(self, data: str) -> None:
        self.joint = False

    handle_decl = handle_pi = unknown_decl = handle_comment

    def below(self, node: int, hidden: bool = False) -> Iterator[int]:
        """The nodes inside of an element in order, without the page's frame unless that is asked for."""
        at = node + 1
        while at < self.ends[node]:
            if not hidden and self.tags[at] in _FRAME:
                at = self.ends[at]
            else:
                yield at
                at += 1

    def text(self, node: int, hidden: bool = False) -> str:
        return " ".join(text for n in self.below(node, hidden) if self.tags[n] is None and (text := self.values[n].strip()))

    def above(self, node: int) -> Iterator[int]:
        while node > 0:
            node = self.parents[node]
            yield node

    def first(self, wanted: Callable[[str, dict], bool], node: int = 0, hidden: bool = False) -> int | None:
        return next((n for n in self.below(node, hidden) if self.tags[n] and wanted(self.tags[n], self.values[n])), None)


def _is_main(tag: str, has: dict) -> bool:
    return tag in ("main", "article") or has.get("role") == "main" or not {"chapter", "sect1"}.isdisjoint(has.get("class", "").split())


class _Page:
    """A page's title, its main part, sections, links and feeds."""

    def __init__(self, page: str, url: str):
        tree = self.tree = _Tree(page)
        title = tree.first(lambda tag, _: tag == "title", hidden=True)
        self.title = " ".join(tree.text(title, True).split()) if title else url
        base = tree.first(lambda tag, has: tag == "base" and "href" in has, hidden=True)
        self.base = _joined(url, tree.values[base]["href"]) if base else url
        found = tree.first(_is_main)
        self.main = found if found is not None else tree.first(lambda tag, _: tag == "body") or 0

    def _anchor(self, node: int) -> str | None:
        """Of a heading: its id, else that or the name of a link in it, else the id of what it stands in."""
        tree = self.tree
        if tree.values[node].get("id"):
            return tree.values[node]["id"]
        inner = tree.first(lambda tag, has: tag == "a" and "id" in has, node) or tree.first(lambda tag, has: tag == "a" and "name" in has, node)
        if inner:
            return tree.values[inner].get("id", tree.values[inner].get("name"))
        return next((tree.values[n]["id"] for n in tree.above(node) if "id" in tree.values[n]), None)

    def sections(self) -> list[tuple]:
        """(heading, anchor, path, text) of each section with a text; one of the whole main part for a page without any."""
        tree, out, stack, whole = self.tree, [], [""] * _LEVELS, 0
        heading, anchor, path, texts = self.title, None, [], []
        for node in tree.below(self.main):
            tag = tree.tags[node]
            if node < whole or not (tag in _HEADINGS or tag in _WHOLE or tag == "p"):
                continue
            if tag in _WHOLE:
                whole = tree.ends[node]
            text = tree.text(node)
            if not text:
                continue
            if tag in _HEADINGS:
                if texts:
                    out.append((heading, anchor, path, "\n".join(texts)))
                level = int(tag[1])
                heading, anchor, path, texts = text, self._anchor(node), [h for h in stack[: level - 1] if h], []
                stack[level - 1 :] = [text] + [""] * (_LEVELS - level)
            else:
                texts.append(text)
        if texts:
            out.append((heading, anchor, path, "\n".join(texts)))
        rest = tree.text(self.main) if not out else ""
        return out or ([(self.title, None, [], rest)] if rest else [])

    def links(self) -> list[tuple]:
        """(kind, address, label): navigation to guides, then what the main part links to, then feeds; addresses are whole."""
        tree = self.tree
        frames = [n for n in tree.below(0, True) if tree.tags[n] == "nav"]
        told = [(n, tree.text(n, True)) for frame in frames if not any(tree.tags[n] == "nav" for n in tree.above(frame)) for n in tree.below(frame, True) if tree.tags[n] == "a" and "href" in tree.values[n]]
        out = [("navigation", n, label) for n, label in told if _GUIDES.search(label)]
        out += [("link", n, f"{tree.text(n)} {tree.values[n].get('title', '')}".strip()) for n in tree.below(self.main) if tree.tags[n] == "a" and "href" in tree.values[n]]
        out += [("feed", n, "") for n in tree.below(0, True) if tree.tags[n] == "link" and "href" in tree.values[n] and tree.values[n].get("type") in _FEEDS]
        return [(kind, _joined(self.base, tree.values[n]["href"]), label) for kind, n, label in out]


def _joined(base: str, href: str) -> str:
    try:
        return urljoin(base, href.strip())
    except ValueError:  # an address that is none
        return href


def _of_pages(pages: DataFrame, key: str, html: str, url: str | None, columns: str, rows_of: Callable[[_Page, str], list[tuple]]) -> DataFrame:
    kind = pages.select(F.col(key)).schema[0].dataType.simpleString()
    schema = f"`{key}` {kind}, {columns}"
    names = [key, *(c.split()[0] for c in columns.split(", "))]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for own, body, address in zip(batch["key"], batch["html"], batch["url"], strict=True):
                out += [(own, n, *row) for n, row in enumerate(rows_of(_Page(body, address), address))]
            yield pd.DataFrame(out, columns=names)

    given = pages.select(F.col(key).alias("key"), F.coalesce(F.col(html), F.lit("")).alias("html"), F.coalesce(F.col(url), F.lit("")).alias("url") if url else F.lit("").alias("url"))
    return given.mapInPandas(rows, schema)


def html_sections(pages: DataFrame, key: str = "page_id", html: str = "html", url: str | None = None) -> DataFrame:
    """key, section, heading, anchor, path, text and address of each section with a text.

    The main part alone is read (``main``, ``article``, a chapter, else the body), without the frame; the first heading is the
    page's title, its address where it has none. The address is the page's with the anchor: a heading's own, that of a link in it, or the nearest above it.
    A page without headings and paragraphs is one section. Null pages have none.
    """

    def rows(page: _Page, address: str) -> list[tuple]:
        whole = urldefrag(address)[0]
        return [(*s, f"{whole}#{s[1]}" if s[1] else whole) for s in page.sections()]

    return _of_pages(pages, key, html, url, "section int, heading string, anchor string, path array<string>, text string, address string", rows)


def html_links(pages: DataFrame, key: str = "page_id", html: str = "html", url: str | None = None) -> DataFrame:
    """key, place, kind (``navigation``, ``link``, ``feed``), address and label of what a page leads to.

    Addresses are resolved against the page's base; of the navigation only links to guides count, a label has the link's title.
    """
    return _of_pages(pages, key, html, url, "place int, kind string, address string, label string", lambda page, _: page.links())


def links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, place and href of every link of a page, by pattern: as it is written, in quotes of either kind or none."""
    found = F.regexp_extract_all(F.col(html), F.lit("(?i)<a\\s(?:[^>]*?\\s)?href\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s>\"']+)"), F.lit(1))
    return pages.select(key, F.posexplode(found).alias("place", "href")).withColumn("href", F.regexp_replace("href", "^[\"']|[\"']$", ""))


def page_title(html: Column) -> Column:
    return F.regexp_extract(html, "<title>([^<]*)</title>", 1)


def sitemap_links(xml: Column) -> Column:
    """Locations of a sitemap or feed; null where it declares a document type or entities."""
    found = F.concat(F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<]*?)\s*</loc>"), F.lit(1)), F.regexp_extract_all(xml, F.lit(r'<link[^>]*?href="([^"]*)"'), F.lit(1)), F.regexp_extract_all(xml, F.lit(r"<link>\s*([^<]*?)\s*</link>"), F.lit(1)))
    return F.when(~xml.rlike("(?i)<!DOCTYPE|<!ENTITY"), found)


def markdown_links(text: Column) -> Column:
    """Targets of Markdown links."""
    return F.regexp_extract_all(text, F.lit(r"\[[^\]]*\]\((https?://[^\s)]+)\)"), F.lit(1))
