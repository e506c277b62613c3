"""Visible text of HTML pages, laid out as a browser would block it.

A small tokeniser feeds a tree builder that knows void elements, raw text,
implied end tags (a new paragraph, list item, row or cell closes the last) and
misnested ones. The renderer walks the tree without recursion: hidden elements
are left out, runs of white space collapse outside <pre>, blocks start on new
lines with their spacing, list items carry markers and indents, and table
cells are padded to columns.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element classes of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title plaintext".split())
RAW_ENTITIES = frozenset(("textarea", "title"))
HIDDEN = frozenset("head title script style template noscript noembed noframes iframe object audio video canvas "
                   "datalist area base link meta param source track rp dialog-closed".split())
PARAGRAPHS = frozenset("p blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol pre table ul".split())
BLOCKS = PARAGRAPHS | frozenset("address article aside body caption center dd details dialog dir div dt figcaption "
                                "footer form header hgroup html legend li listing main nav optgroup option search "
                                "section summary tbody tfoot thead tr td th xmp plaintext".split())
# a start tag closes these, as far as the barriers let it see
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "body": (("head",), ()),
}
CLOSE_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
                    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt".split())
HEAD_ONLY = frozenset("head title base link meta style script noscript template".split())
TABLE_ENDS = frozenset("table tr tbody thead tfoot td th body html".split())   # end tags that reach out of a cell
P_BARRIERS = frozenset("td th table caption button object body html".split())
PADDING = 16       # a table's padding is held to so many times its text and cells
MAX_SPAN = 1000

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    # a quote counts only where a value may begin; elsewhere it is part of a name
    r"|<(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))|[^>])*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
SPACE = re.compile(r"[ \t\n\f\r]+")


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []


def attributes(source: str) -> dict:
    found: dict = {}
    if source and not source.isspace():
        for m in ATTRIBUTE.finditer(source):
            value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
            found.setdefault(m[1].lower(), html.unescape(value) if value else "")
    return found


def tree(page: str) -> Element:
    """The page's elements under one root; text is kept as strings among the children."""
    root = Element("#root", {})
    stack = [root]
    opened: Counter = Counter()   # tags on the stack, so that a search without a hit costs nothing
    at, end = 0, len(page)

    def push(e: Element) -> None:
        stack[-1].children.append(e)
        stack.append(e)
        opened[e.tag] += 1

    def cut(k: int) -> None:
        for e in stack[k:]:
            opened[e.tag] -= 1
        del stack[k:]

    def put(text: str) -> None:
        if text:
            if stack[-1].tag == "head" and not text.isspace():
                cut(len(stack) - 1)
            stack[-1].children.append(text)

    def close(tags, barriers) -> None:
        k = len(stack) - 1
        while k and any(opened[t] for t in tags):
            if stack[k].tag in tags:
                cut(k)   # an outer one of the list may be open too (a cell, then its row)
            elif stack[k].tag in barriers:
                return
            k -= 1

    while at < end:
        m = TOKEN.search(page, at)
        if not m:
            put(html.unescape(page[at:]))
            break
        if m.start() > at:
            put(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = m[2]
        if tag is None:
            if page.startswith("<![CDATA[", m.start()):
                put(page[m.start() + 9:at].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "br":
                stack[-1].children.append(Element("br", {}))
            elif tag == "p" and not opened["p"]:
                stack[-1].children.append(Element("p", {}))
            elif opened[tag]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        cut(k)
                        break
                    if stack[k].tag in ("td", "th", "table") and tag not in TABLE_ENDS:
                        break
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            cut(len(stack) - 1)
        if tag in CLOSE_P:
            close(("p",), P_BARRIERS)
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
            push(Element("tr", {}))
        element = Element(tag, attributes(m[3]))
        if tag in VOID:
            stack[-1].children.append(element)
            continue
        if tag in RAW:
            stack[-1].children.append(element)
            stop = re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at) if tag != "plaintext" else None
            text = page[at:stop.start() if stop else end]
            element.children.append(html.unescape(text) if tag in RAW_ENTITIES else text)
            at = stop.end() if stop else end
            continue
        push(element)
        if m[3].endswith("/") and tag in ("svg", "path", "math"):
            cut(len(stack) - 1)
    return root


def hidden(e: Element) -> bool:
    a = e.attrs
    if e.tag in HIDDEN or (a and ("hidden" in a or UNSEEN.search(a.get("style", "")))):
        return True
    return (e.tag == "input" and a.get("type", "").lower() == "hidden") or (e.tag == "dialog" and "open" not in a)


class Page:
    """Lines under construction: spacing between blocks, indents and markers."""

    __slots__ = ("lines", "line", "gap", "space", "indent", "marker", "pre")

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0           # blank lines owed before the next line
        self.space = False     # a collapsed space is owed
        self.indent: list[str] = []
        self.marker = ""
        self.pre = 0

    def end_line(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip())
            self.line = []
        self.space = False

    def block(self, blank: int) -> None:
        self.end_line()
        self.gap = max(self.gap, blank)

    def _start(self) -> None:
        if self.lines and self.gap and self.lines[-1]:
            self.lines += [""] * self.gap
        self.gap = 0
        lead = "".join(self.indent)
        if self.marker:
            lead = lead[:max(0, len(lead) - len(self.marker))] + self.marker
            self.marker = ""
        if lead:
            self.line.append(lead)

    def text(self, s: str) -> None:
        if self.pre:
            for k, part in enumerate(s.split("\n")):
                if k:
                    if not self.line:
                        self.lines.append("")
                    self.end_line()
                if part:
                    if not self.line:
                        self._start()
                    self.line.append(part)
            return
        body = SPACE.sub(" ", s)
        if body == " " or not body:
            self.space = self.space or bool(body and self.line)
            return
        if not self.line:
            self._start()
            body = body.lstrip(" ")
        elif self.space and body[0] != " ":
            self.line.append(" ")
        elif self.space or (self.line[-1][-1:] == " " and body[0] == " "):
            body = " " + body.lstrip(" ")
        self.space = body[-1] == " "
        self.line.append(body.rstrip(" "))

    def newline(self) -> None:
        if self.line:
            self.end_line()
        elif self.lines:
            self.lines.append("")

    def done(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


class Grid:
    """Cells of one table, with column and row spans."""

    __slots__ = ("rows", "taken", "caption")

    def __init__(self):
        self.rows: list[dict[int, tuple[str, int]]] = []
        self.taken: dict[int, int] = {}
        self.caption = ""

    def row(self) -> None:
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.rows.append({})

    def cell(self, text: str, attrs: dict) -> None:
        if not self.rows:
            self.row()
        wide, high = span(attrs.get("colspan")), span(attrs.get("rowspan"))
        row = self.rows[-1]
        at = max((c + w for c, (_, w) in row.items()), default=0)
        while at in self.taken and at not in row:
            at += 1
        row[at] = (text, wide)
        if high > 1:
            for c in range(at, at + wide):
                self.taken[c] = high

    def widths(self) -> dict[int, int]:
        """The longest line of each column. Only where one vast cell would blow up a table by ``PADDING`` times are the
        widest columns held to less, so that memory follows the page: text that is longer pushes its row to the right."""
        width: dict[int, int] = {}
        size, lines, columns = 0, 0, 0
        for row in self.rows:
            high = 1
            for c, (text, wide) in row.items():
                parts = text.split("\n")
                size += len(text) + 1
                high = max(high, len(parts))
                if wide == 1:
                    width[c] = max(width.get(c, 0), *map(len, parts))
            lines += high
        columns = sum(width.values())
        most = max(width.values(), default=0)
        while lines * columns > PADDING * (size + 1000) and most > 1:
            most //= 2
            columns = sum(min(w, most) for w in width.values())
        return {c: min(w, most) for c, w in width.items()}

    def lines(self) -> list[str]:
        width = self.widths()
        out = []
        for row in self.rows:
            cells = [(c, text.split("\n")) for c, (text, _) in sorted(row.items())]
            begin, left = {}, 0
            for c in range(max(row, default=-1) + 1):
                begin[c] = left
                if c in width:
                    left += width[c] + 2
            for k in range(max((len(t) for _, t in cells), default=0)):
                line = ""
                for c, t in cells:
                    if k < len(t) and t[k]:
                        line = line.ljust(begin[c]) if len(line) <= begin[c] else line + "  "
                        line += t[k]
                out.append(line.rstrip())
        return out


def span(value: str | None) -> int:
    m = re.match(r"\s*(\d{1,6})", value or "")
    return min(MAX_SPAN, max(1, int(m[1]))) if m else 1


def render(page: str) -> str:
    """The visible text of a page."""
    outs = [Page()]
    grids: list[Grid] = []
    lists: list[list] = []
    todo: list[tuple] = [("open", tree(page))]
    while todo:
        what, e = todo.pop()
        out = outs[-1]
        if what == "close":
            _close(e, outs, grids, lists)
            continue
        if isinstance(e, str):
            out.text(e)
            continue
        if hidden(e):
            continue
        tag = e.tag
        if tag == "br":
            out.newline()
            continue
        if tag in ("td", "th", "caption") and grids:
            outs.append(Page())
        elif tag == "table":
            out.block(1)
            grids.append(Grid())
            outs.append(Page())     # text that strays between cells comes before the table
        elif tag == "tr" and grids:
            grids[-1].row()
        elif tag in BLOCKS:
            out.block(1 if tag in PARAGRAPHS and not (tag in ("ul", "ol") and lists) else 0)
        if tag in ("ul", "ol", "menu", "dir"):
            start = e.attrs.get("start", "")
            lists.append([tag, int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
        elif tag == "li":
            mark = "- "
            if lists and lists[-1][0] == "ol":
                value = e.attrs.get("value", "")
                if re.fullmatch(r"-?\d{1,9}", value):
                    lists[-1][1] = int(value)
                mark = f"{lists[-1][1]}. "
                lists[-1][1] += 1
            out.indent.append(" " * len(mark))
            out.marker = mark
        elif tag in ("blockquote", "dd"):
            out.indent.append("    ")
        elif tag in ("pre", "listing", "xmp", "plaintext", "textarea"):
            out.pre += 1
            if e.children and isinstance(e.children[0], str):
                e.children[0] = e.children[0].removeprefix("\n")
        elif tag == "q":
            out.text('"')
        todo.append(("close", e))
        todo += [("open", c) for c in reversed(e.children)]
    return outs[0].done()


def _close(e: Element, outs: list[Page], grids: list[Grid], lists: list[list]) -> None:
    tag = e.tag
    if tag in ("td", "th", "caption") and grids:
        text = outs.pop().done()
        if tag == "caption":
            grids[-1].caption = text
        else:
            grids[-1].cell(text, e.attrs)
        return
    if tag == "table":
        stray, grid, out = outs.pop().done(), grids.pop(), outs[-1]
        out.pre += 1
        for text in (stray, grid.caption, "\n".join(grid.lines())):
            if text.strip("\n"):
                out.block(0)
                out.text(text)
                out.end_line()
        out.pre -= 1
        out.block(1)
        return
    out = outs[-1]
    if tag in ("ul", "ol", "menu", "dir"):
        lists.pop()
    elif tag == "q":
        out.text('"')
    if tag in ("pre", "listing", "xmp", "plaintext", "textarea"):
        out.end_line()
        out.pre -= 1
    if tag in BLOCKS and not (tag == "tr" and grids):
        out.block(1 if tag in PARAGRAPHS and not (tag in ("ul", "ol") and lists) else 0)
    if tag == "li":
        out.indent.pop()
        out.marker = ""
    elif tag in ("blockquote", "dd"):
        out.indent.pop()


def page_text(pages: DataFrame, column: str = "html") -> DataFrame:
    """The rows of ``pages`` without the HTML column, with ``text`` and ``n_chars``.

    Null HTML gives null text and no characters; empty and broken pages give
    what text they hold; repeated rows are rendered each; an empty table gives
    no rows. Columns of ``pages`` named like the two new ones are replaced.
    """
    keep = [c for c in pages.columns if c not in (column, "text", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [None if s is None else render(s) for s in b.column("__html").to_pylist()]
            sizes = [0 if t is None else len(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [b.column("__row"), pa.array(texts, pa.string()), pa.array(sizes, pa.int64())],
                names=["__row", "__text", "__n"])

    source = pages.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row"),
                          F.col(f"`{column}`").cast("string").alias("__html"))
    row = source.schema["__row"].dataType.simpleString()
    return (source.mapInArrow(run, f"__row {row}, __text string, __n bigint")
            .select("__row.*", F.col("__text").alias("text"), F.col("__n").alias("n_chars")))
