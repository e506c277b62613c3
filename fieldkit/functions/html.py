"""HTML extraction over an ``html`` column (HT-*).

A small tokeniser walks the markup (any quoting, comments, raw script and
style text), so nested elements, single quotes and all character references
are read as a browser reads them. What is wanted of a page are readers of its
tokens; ``extract`` runs any number of them over one walk, which ends early where all have
what they need (a title). The functions are Arrow-batched columns.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>=]+|=\s*(?:\"[^\"]*\"|'[^']*')|=)*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?P<name>[^\s=/>]+)(?:\s*=\s*(?:\"(?P<dq>[^\"]*)\"|'(?P<sq>[^']*)'|(?P<bare>[^\s\"'>]+)))?")
_RAW_TEXT = ("script", "style")
_HAS_RAW_TEXT = re.compile(r"<(?:" + "|".join(_RAW_TEXT) + r")(?:[\s/>]|\Z)", re.I)
_SPACE = " \t\n\r\f\xa0"
_SPACES = re.compile(f"[{_SPACE}]+")
_UNEVEN = re.compile(r"[\t\n\r\f\xa0]|  ")
PAGES = 256   # read together: no more of them are Python objects at a time
_TABLE = frozenset(("td", "th", "tr", "table"))
_NO_END = frozenset("area base br col embed hr img input link meta source track wbr".split())


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", "", content), ("start", tag, attributes) and ("end", tag, "") in page order; comments are left out."""
    at = 0
    while True:
        m = _MARKUP.search(page, at)
        if m is None:
            if at < len(page):
                yield "text", "", page[at:]
            return
        if m.start() > at:
            yield "text", "", page[at:m.start()]
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        yield ("end", tag, "") if m["end"] else ("start", tag, m["attrs"])
        if tag in _RAW_TEXT and not m["end"]:
            stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = stop.end() if stop else len(page)
            yield "end", tag, ""


def _split(page: str) -> list[tuple[str, str, str]]:
    """The ``tokens`` of a page without raw text, from one split: text, then the three groups of the markup after it."""
    pieces = _MARKUP.split(page)
    found = []
    for text, end, tag, attrs in zip(pieces[::4], pieces[1::4], pieces[2::4], pieces[3::4]):
        if text:
            found.append(("text", "", text))
        if tag:
            found.append(("end", tag.lower(), "") if end else ("start", tag.lower(), attrs))
    if pieces[-1]:
        found.append(("text", "", pieces[-1]))
    return found


def attribute(source: str, name: str) -> str | None:
    for m in _ATTRIBUTE.finditer(source):
        if m["name"].lower() == name:
            value = next((v for v in (m["dq"], m["sq"], m["bare"]) if v is not None), "")
            return _html.unescape(value)
    return None


def _clean(parts: list[str]) -> str:
    """Text pieces between tags: one space apart, references decoded, white space collapsed."""
    s = " ".join(parts)
    if "&" in s:
        s = _html.unescape(s)
    s = s.strip(_SPACE)
    return _SPACES.sub(" ", s) if _UNEVEN.search(s) else s


class Reader:
    """Takes the tokens of one page; ``done`` once nothing that follows can change its result."""

    kind = "string"   # of the column
    arrow = pa.string()
    early = False     # may be done before the page ends
    done = False

    def take(self, kind: str, tag: str, rest: str) -> None:
        raise NotImplementedError

    def take_all(self, tokens: list[tuple[str, str, str]]) -> None:
        for token in tokens:
            self.take(*token)

    def result(self):
        raise NotImplementedError


class Title(Reader):
    """The text of the first title element (HT-1); NULL when the page has none."""

    early = True

    def __init__(self):
        self.inside, self.parts = False, []

    def take(self, kind, tag, rest):
        if tag == "title":
            self.done = kind == "end" and self.inside
            self.inside = kind == "start" or self.done
        elif self.inside:
            self.parts.append(rest)

    def result(self):
        return _clean(self.parts) if self.done else None


class Text(Reader):
    """All text of the page but scripts, styles and comments (HT-2)."""

    def __init__(self):
        self.parts = []

    def take(self, kind, tag, rest):
        if kind == "text":
            self.parts.append(rest)

    def result(self):
        return _clean(self.parts)


class Links(Reader):
    """href and anchor text of all ``<a href>`` elements (HT-3)."""

    kind = "array<struct<href: string, anchor: string>>"
    arrow = pa.list_(pa.struct([("href", pa.string()), ("anchor", pa.string())]))

    def __init__(self):
        self.found, self.href, self.parts = [], None, []

    def _close(self):
        if self.href is not None:
            self.found.append({"href": self.href, "anchor": _clean(self.parts)})

    def take(self, kind, tag, rest):
        if tag == "a":
            self._close()
            self.href, self.parts = (attribute(rest, "href") if kind == "start" else None), []
        elif kind == "text" and self.href is not None:
            self.parts.append(rest)

    def result(self):
        self._close()
        return self.found


class NestedLinks(Reader):
    """Targets of the links inside ``outer`` elements."""

    kind = "array<string>"
    arrow = pa.list_(pa.string())

    def __init__(self, outer: str):
        self.outer, self.depth, self.found = outer, 0, []

    def take(self, kind, tag, rest):
        if tag == self.outer:
            self.depth = max(0, self.depth + (1 if kind == "start" else -1))
        elif self.depth and tag == "a" and kind == "start":
            href = attribute(rest, "href")
            if href is not None:
                self.found.append(href)

    def result(self):
        return self.found


class Elements(Reader):
    """Texts of ``name`` elements that carry the class (HT-4), nested ones included in the outer and listed on their own."""

    kind = "array<string>"
    arrow = pa.list_(pa.string())

    def __init__(self, name: str, css_class: str):
        self.name, self.css_class = name, css_class
        self.found: list[list[str]] = []          # parts of open and closed matches
        self.open: list[int | None] = []          # per open element of that name: its match, if any

    def take(self, kind, tag, rest):
        if kind == "text":
            for k in self.open:
                if k is not None:
                    self.found[k].append(rest)
        elif tag == self.name and kind == "start":
            if self.css_class in (attribute(rest, "class") or "").split():
                self.found.append([])
                self.open.append(len(self.found) - 1)
            else:
                self.open.append(None)
            if tag in _NO_END:
                self.open.pop()
        elif tag == self.name and self.open:
            self.open.pop()

    def result(self):
        return [_clean(parts) for parts in self.found]


class Rows(Reader):
    """Per table row, the texts of its ``cell`` elements (HT-5), rows with more than ``min_cells`` of them; a new cell
    or row closes the one before."""

    kind = "array<array<string>>"
    arrow = pa.list_(pa.list_(pa.string()))

    def __init__(self, cell: str = "td", min_cells: int = 0):
        self.cell, self.min_cells = cell, min_cells
        self.rows: list[list[str]] = []
        self.row: list[str] | None = None
        self.parts: list[str] | None = None

    def take(self, kind, tag, rest):
        self.take_all([(kind, tag, rest)])

    def take_all(self, tokens):
        row, parts = self.row, self.parts
        for kind, tag, rest in tokens:
            if kind == "text":
                if parts is not None:
                    parts.append(rest)
            elif tag in _TABLE:
                if parts is not None:
                    if row is not None:
                        row.append(_clean(parts))
                    parts = None
                if tag == "tr" or tag == "table":
                    if row is not None:
                        self.rows.append(row)
                    row = [] if tag == "tr" and kind == "start" else None
                elif kind == "start" and tag == self.cell:
                    row = [] if row is None else row
                    parts = []
        self.row, self.parts = row, parts

    def result(self):
        self.take_all([("end", "table", "")])   # closes what is open
        return [r for r in self.rows if len(r) > self.min_cells]


class Header(Rows):
    """Header cell texts (HT-6)."""

    kind = "array<string>"
    arrow = pa.list_(pa.string())

    def __init__(self):
        super().__init__("th")

    def result(self):
        return [c for r in super().result() for c in r]


def read_page(page: str, readers: list[Reader]) -> list:
    """The results of all readers from one walk over the page, which ends once all of them are done."""
    if any(r.early for r in readers) or _HAS_RAW_TEXT.search(page):
        waiting = [r for r in readers if not r.done]
        for token in tokens(page):
            for r in waiting:
                r.take(*token)
            if any(r.done for r in waiting):
                waiting = [r for r in waiting if not r.done]
                if not waiting:
                    break
        return [r.result() for r in readers]
    found = _split(page)
    for r in readers:
        r.take_all(found)
    return [r.result() for r in readers]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def extract(html, **readers: tuple) -> Column:
    """A struct with a field per reader, all from one pass over each page.

    A reader is given as its class and arguments: ``extract("html", title=(Title,), ads=(Elements, "div", "ad"))``.
    Fields of a NULL page are NULL.
    """
    names = list(readers)
    made = [(r[0], r[1:]) for r in readers.values()]

    fields = [pa.field(n, cls.arrow) for n, (cls, _) in zip(names, made, strict=True)]

    def read(pages: list[str | None]) -> pa.Array:
        none = [None] * len(names)
        rows = [none if p is None else read_page(p, [cls(*args) for cls, args in made]) for p in pages]
        return pa.StructArray.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(fields)], fields=fields)

    @F.arrow_udf("struct<" + ", ".join(f"{n}: {cls.kind}" for n, (cls, _) in zip(names, made, strict=True)) + ">")
    def run(pages: pa.Array) -> pa.Array:
        return pa.concat_arrays([read(pages.slice(k, PAGES).to_pylist()) for k in range(0, max(len(pages), 1), PAGES)])
    return run(_c(html))


def _one(html, *reader) -> Column:
    return extract(html, value=reader)["value"]


def title(html) -> Column:
    """Page title text (HT-1); NULL when the page has none."""
    return _one(html, Title)


def visible_text(html) -> Column:
    """All text of the page but scripts, styles and comments (HT-2)."""
    return _one(html, Text)


def links(html) -> Column:
    """array<struct<href, anchor>> of all ``<a href>`` elements (HT-3)."""
    return _one(html, Links)


def nested_links(html, outer: str) -> Column:
    """array<string>: targets of the links inside ``<outer>`` elements."""
    return _one(html, NestedLinks, outer)


def element_text(html, tag: str, css_class: str) -> Column:
    """Texts of ``<tag>`` elements whose class list holds ``css_class`` (HT-4)."""
    return _one(html, Elements, tag, css_class)


def table_rows(html, min_cells: int = 0) -> Column:
    """Rows of ``<td>`` cells, each cell cleaned on its own (so a comma inside a
    cell never splits it); rows with more than ``min_cells`` cells (HT-5)."""
    return _one(html, Rows, "td", min_cells)


def table_header(html) -> Column:
    """Header cell texts (HT-6)."""
    return _one(html, Header)


def clean_text(s) -> Column:
    """Tags to spaces, references decoded, white space collapsed, trimmed."""
    return visible_text(s)
