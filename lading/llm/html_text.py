"""Layout-aware text of HTML pages.

A tokenizer and a tree builder with implied tags turn a page into a tree
(omitted end tags of paragraphs, list items, definition lists, options and
table parts; omitted rows around cells).  Visibility rules drop what a browser
does not show: head, scripts, styles, templates, comments, ``hidden``,
``display:none``, ``visibility:hidden`` (but for ``visibility:visible`` inside),
hidden inputs, ``dialog`` and the body of ``details`` unless open, and inside ``svg`` and
``math`` what is not drawn (titles, descriptions, definitions, metadata,
annotations).  Formulas and labels are inline text.  The renderer emits all
other text: block elements are set apart by line breaks or blank lines,
list items carry their marks and indentation, ``pre`` keeps its white space,
and cells of a table are aligned in columns.

Null pages give null text, empty pages empty text.  Elements may nest without a
limit; only layout has bounds, whose text is all kept: indentation grows up to
``MAX_INDENT`` characters, tables inside ``TABLE_DEPTH`` tables are laid out a
cell a line, and a column of which all cells padded to the widest would take more
than ``MAX_PADDED`` characters is padded to ``NARROW``.  Cells span columns and
rows; a cell's text stands in its first.  Extra columns are ignored; repeated
rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lading.session import ship_package

MAX_INDENT = 400
TABLE_DEPTH = 100
MAX_PADDED, NARROW = 1_000_000, 60
#: Columns and rows that one cell may span (fixed values of the HTML grammar).
MAX_COLSPAN, MAX_ROWSPAN = 1000, 65534

# Fixed sets of the HTML grammar.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style xmp iframe noembed noframes noscript textarea title".split())
_UNSEEN = frozenset("head script style template noscript iframe noembed noframes title datalist object canvas audio video".split())
_FOREIGN = frozenset({"svg", "math"})
#: Not drawn inside svg or math.
_FOREIGN_UNSEEN = frozenset("desc defs metadata symbol annotation annotation-xml".split())
_BLANK_LINE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote ul ol dl table pre figure hr article section form fieldset".split())
_BLOCK = _BLANK_LINE | frozenset("html body div li dt dd tr td th thead tbody tfoot caption header footer nav main aside address details summary dialog center dir menu figcaption option optgroup select legend hgroup search".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An opening tag closes these open elements, up to the first of the bounds.
_CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"})),
    "tr": (frozenset({"tr", "td", "th", "caption"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
} | {k: (frozenset({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}), frozenset({"table"})) for k in ("thead", "tbody", "tfoot")}
_SCOPE = frozenset({"table", "td", "th", "caption", "button"})

_OPEN = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^>"'])*+)>""")
_ATTR = re.compile(r"""([^\s=/"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"[ \t\n\f\r]+")
_HIDES = re.compile(r"display\s*:\s*none", re.I)
_SHOWS = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
_UNQUOTED_END = re.compile(r"""=\s*[^\s"'>]+$""")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}


class Node:
    __slots__ = ("tag", "attrs", "children", "hidden", "foreign", "shown")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.foreign = tag in _FOREIGN
        self.hidden = (tag in _UNSEEN or "hidden" in attrs and attrs["hidden"].lower() != "until-found"
                       or tag == "dialog" and "open" not in attrs
                       or "style" in attrs and _HIDES.search(attrs["style"]) is not None)
        # Visibility set here; None leaves the parent's.
        said = _SHOWS.findall(attrs["style"]) if "style" in attrs else []
        self.shown = said[-1].lower() == "visible" if said else None


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(text):
        out.setdefault(name.lower(), html.unescape(value.strip("\"'")) if value else "")
    return out


class Tree:
    """Builds the tree of a page; ``stack`` holds the open elements."""

    def __init__(self, page: str):
        self.root = Node("#root", {})
        self.stack = [self.root]
        self.open: Counter[str] = Counter()  # their tags
        self._read(page)

    def _text(self, text: str) -> None:
        if text:
            self.stack[-1].children.append(html.unescape(text))

    def _read(self, page: str) -> None:
        at, end = 0, len(page)
        while at < end:
            lt = page.find("<", at)
            if lt < 0:
                self._text(page[at:])
                return
            self._text(page[at:lt])
            mark = page[lt + 1: lt + 2]
            if mark.isalpha() and mark.isascii():
                m = _OPEN.match(page, lt)
                if m:
                    name, attrs, at = m[1].lower(), m[2], m.end()
                else:  # an unclosed quote: the tag ends at the next bracket
                    gt = page.find(">", lt)
                    gt = end if gt < 0 else gt
                    name, _, attrs = page[lt + 1: gt].partition(" ")
                    name, at = name.lower(), gt + 1
                if self.stack[-1].foreign and self._open_foreign(name, attrs):
                    continue
                self._open(name, attrs)
                if name in _RAW:
                    m = _RAW_END[name].search(page, at)
                    stop = m.start() if m else end
                    if name in ("textarea", "title", "xmp"):
                        self._text(page[at:stop])
                    self._close(name)
                    gt = page.find(">", stop)
                    at = end if gt < 0 else gt + 1
            elif mark == "/" and page[lt + 2: lt + 3].isalpha():
                gt = page.find(">", lt)
                gt = end if gt < 0 else gt
                self._close(page[lt + 2: gt].split("/")[0].split(None, 1)[0].lower())
                at = gt + 1
            elif page.startswith("<!--", lt):
                gt = page.find("-->", lt + 2)
                at = end if gt < 0 else gt + 3
            elif mark in ("!", "?", "/"):
                gt = page.find(">", lt)
                at = end if gt < 0 else gt + 1
            else:
                self._text("<")
                at = lt + 1

    def _pop_to(self, k: int) -> None:
        for node in self.stack[k:]:
            self.open[node.tag] -= 1
        del self.stack[k:]

    def _any_open(self, tags: frozenset[str]) -> bool:
        return any(self.open[t] for t in tags)

    def _imply(self, tag: str) -> None:
        closes, bounds = _CLOSES.get(tag, (frozenset(), frozenset()))
        if closes and self._any_open(closes):
            for k in range(len(self.stack) - 1, 0, -1):
                t = self.stack[k].tag
                if t in bounds:
                    break
                if t in closes:
                    self._pop_to(k)
        if self.open["p"] and (tag in _BLOCK and tag not in _CLOSES or tag in ("li", "dt", "dd")):
            for k in range(len(self.stack) - 1, 0, -1):
                t = self.stack[k].tag
                if t == "p":
                    self._pop_to(k)
                    break
                if t in _SCOPE:
                    break
        if tag in _HEADINGS and self.stack[-1].tag in _HEADINGS:
            self._pop_to(len(self.stack) - 1)
        if self.open["head"] and (tag == "body" or tag in _BLOCK and tag != "html"):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag == "head":
                    self._pop_to(k)
                    break
        if tag in ("td", "th") and (self.open["tr"] or self.open["table"]):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].tag in ("tr", "table"):
                    if self.stack[k].tag == "table":
                        self._push(Node("tr", {}))
                    break

    def _push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.stack.append(node)
        self.open[node.tag] += 1

    def _open_foreign(self, tag: str, attr_text: str) -> bool:
        """Opens an element inside svg or math; False leaves it to the rules of
        HTML (raw text, and blocks, which end foreign content)."""
        closed = attr_text.endswith("/") and not _UNQUOTED_END.search(attr_text)
        if not closed and (tag in _RAW or tag in _BLOCK or tag in _VOID):
            return False
        if not closed:
            attrs = _attributes(attr_text)
            node = Node(tag, attrs)
            node.foreign = tag != "foreignobject"
            node.hidden = node.hidden or tag in _FOREIGN_UNSEEN or attrs.get("display") == "none"
            if node.shown is None and "visibility" in attrs:
                node.shown = attrs["visibility"] == "visible"
            self._push(node)
        return True

    def _open(self, tag: str, attr_text: str) -> None:
        attrs = _attributes(attr_text) if attr_text.strip(" /\t\n") else {}
        self._imply(tag)
        node = Node(tag, attrs)
        if tag in _VOID:
            self.stack[-1].children.append(node)
        elif tag in _BLOCK or tag in _RAW or tag in _UNSEEN or tag in _FOREIGN or node.hidden or node.shown is not None or tag in ("q", "button", "summary"):
            self._push(node)
        # other inline elements change nothing in the text and need no node

    def _close(self, tag: str) -> None:
        if tag == "br":
            self.stack[-1].children.append(Node("br", {}))
        if not (self.open[tag] or tag in _HEADINGS and self._any_open(_HEADINGS)):
            return
        for k in range(len(self.stack) - 1, 0, -1):
            t = self.stack[k].tag
            if t == tag or tag in _HEADINGS and t in _HEADINGS:
                self._pop_to(k)
                return
            if t in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
                return


class Writer:
    """Collects lines; white space collapses except in ``pre``."""

    def __init__(self, shown: bool = True, tables: int = 0):
        self.shown = shown  # visibility of the text that comes
        self.tables = tables  # tables around
        self.lines: list[str] = []
        self.line: list[str] = []
        self.indent = ""
        self.mark = ""  # list mark for the next line
        self.gap = 0  # line ends owed before the next text
        self.space = False

    def text(self, s: str) -> None:
        if not self.shown:
            return
        s = _SPACE.sub(" ", s)
        body = s.strip(" ")
        if not body:
            self.space = self.space or bool(s)
            return
        if self.gap:
            self._settle()
        if (self.space or s[0] == " ") and self.line:
            self.line.append(" ")
        if not self.line:
            self.line.append(self._lead())
        self.line.append(body)
        self.space = s[-1] == " "

    def _lead(self) -> str:
        lead = self.indent
        if self.mark:
            lead = lead[: max(0, len(lead) - len(self.mark))] + self.mark
            self.mark = ""
        return lead

    def _settle(self) -> None:
        if self.line:
            self.lines.append("".join(self.line))
            self.line = []
        if self.lines:
            self.lines += [""] * (self.gap - 1)
        self.gap, self.space = 0, False

    def end(self, lines: int) -> None:
        """Owe at least so many line ends (2: a blank line)."""
        if self.line or self.lines:
            self.gap = max(self.gap, lines)

    def hard_break(self) -> None:
        if self.gap:
            self._settle()
        self.lines.append("".join(self.line) if self.line else self.indent)
        self.line, self.space = [], False

    def block(self, lines: list[str]) -> None:
        """Ready lines, kept as they are."""
        if self.line:
            self.gap = max(self.gap, 1)
        self._settle()
        for k, s in enumerate(lines):
            lead = self._lead() if s or k == 0 else ""
            self.lines.append((lead + s).rstrip())

    def result(self) -> list[str]:
        self.gap = max(self.gap, 1)
        self._settle()
        out = [s.rstrip() for s in self.lines]
        while out and not out[-1]:
            out.pop()
        return out


# The walks below are generators that yield the walks inside them; ``_run`` keeps
# them on a stack of its own, so pages may nest without a limit.

def _run(walk: Iterator) -> None:
    stack = [walk]
    while stack:
        inner = next(stack[-1], None)
        if inner is None:
            stack.pop()
        else:
            stack.append(inner)


def _pre_text(node: Node, shown: bool, out: list[str]) -> Iterator:
    for c in node.children:
        if isinstance(c, str):
            if shown:
                out.append(c)
        elif c.tag == "br":
            out.append("\n")
        elif not c.hidden:
            yield _pre_text(c, shown if c.shown is None else c.shown, out)


def _span(cell: Node, name: str, most: int) -> int:
    text = cell.attrs.get(name, "1").strip()
    return min(int(text), most) if text.isascii() and text.isdigit() and len(text) < 9 else 1


def _rows(table: Node) -> Iterator[tuple[Node, Node | None]]:
    """Rows of a table with the part they lie in, not those of tables inside its
    cells."""
    for c in table.children:
        if isinstance(c, str) or c.hidden:
            continue
        if c.tag == "tr":
            yield c, None
        elif c.tag in ("thead", "tbody", "tfoot"):
            yield from ((r, c) for r in c.children if not isinstance(r, str) and r.tag == "tr" and not r.hidden)


def _shown(w_shown: bool, *nodes: Node | None) -> bool:
    for n in nodes:
        if n is not None and n.shown is not None:
            w_shown = n.shown
    return w_shown


def _table(node: Node, w: Writer) -> Iterator:
    grid: list[dict[int, list[str]]] = []
    held: list[tuple[int, int, int]] = []  # columns from, to, and rows still held by cells above
    for row, part in _rows(node):
        cells: dict[int, list[str]] = {}
        held.sort()
        at, k, new = 0, 0, []
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th") or cell.hidden:
                continue
            while k < len(held) and held[k][0] <= at:
                at = max(at, held[k][1])
                k += 1
            inner = Writer(_shown(w.shown, part, row, cell), w.tables + 1)
            yield _children(cell, inner)
            cells[at] = inner.result()
            end = at + max(1, _span(cell, "colspan", MAX_COLSPAN))
            down = _span(cell, "rowspan", MAX_ROWSPAN)
            if down != 1:  # 0: all rows that follow
                new.append((at, end, (down or MAX_ROWSPAN) - 1))
            at = end
        held = [(a, b, n - 1) for a, b, n in held if n > 1] + new
        if any(cells.values()):
            grid.append(cells)
    stray = Writer(w.shown, w.tables)  # captions and text between rows come first, as browsers place them
    for c in node.children:
        if isinstance(c, str):
            stray.text(c)
        elif c.tag not in ("tr", "thead", "tbody", "tfoot"):
            yield _render(c, stray)
        elif not c.hidden:
            rows = [c] if c.tag == "tr" else [r for r in c.children if not isinstance(r, str) and r.tag == "tr" and not r.hidden]
            loose = [x for r in rows for x in r.children] + ([] if c.tag == "tr" else [x for x in c.children if isinstance(x, str) or x.tag != "tr"])
            for d in loose:
                if isinstance(d, str):
                    stray.text(d)
                elif d.tag not in ("td", "th"):
                    yield _render(d, stray)
    w.block(stray.result())
    used = sorted({k for cells in grid for k in cells})
    width = {}
    for k in used:
        sizes = [max(map(len, cells.get(k) or [""])) for cells in grid]
        width[k] = max(sizes)
        if width[k] * len(grid) > MAX_PADDED:
            width[k] = max((n for n in sizes if n <= NARROW), default=0)
    out = []
    for cells in grid:
        last = max(cells)
        across = [k for k in used if k <= last]
        for n in range(max(len(lines) for lines in cells.values())):
            out.append("  ".join((cells[k][n] if k in cells and n < len(cells[k]) else "").ljust(width[k]) for k in across).rstrip())
    w.block(out)


def _children(node: Node, w: Writer) -> Iterator:
    for c in node.children:
        if isinstance(c, str):
            w.text(c)
        else:
            yield _render(c, w)


def _list(node: Node, w: Writer) -> Iterator:
    number = node.attrs.get("start", "")
    number = int(number) if re.fullmatch(r"-?[0-9]{1,9}", number) else 1
    outer, shown = w.indent, w.shown
    for c in node.children:
        if isinstance(c, str):
            w.text(c)
        elif c.tag == "li" and not c.hidden:
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            w.end(1)
            w.indent, w.mark, w.shown = _deeper(outer, len(mark)), mark, _shown(shown, c)
            yield _children(c, w)
            w.mark, w.indent, w.shown = "", outer, shown
            w.end(1)
        else:
            yield _render(c, w)


def _deeper(indent: str, by: int) -> str:
    return indent + " " * by if len(indent) + by <= MAX_INDENT else indent


def _render(node: Node, w: Writer) -> Iterator:
    if node.hidden:
        return
    tag, outer_shown = node.tag, w.shown
    if tag == "br":
        w.hard_break()
        return
    if tag in _VOID and tag != "hr":
        return
    w.shown = _shown(w.shown, node)
    gap = 2 if tag in _BLANK_LINE and not (tag in ("ul", "ol") and w.indent) else 1 if tag in _BLOCK else 0
    if gap:
        w.end(gap)
    if tag == "hr":
        if w.shown:
            w.block(["---"])
    elif tag == "pre":
        text: list[str] = []
        yield _pre_text(node, w.shown, text)
        lines = "".join(text).removeprefix("\n").rstrip("\n").split("\n")
        w.block(lines if w.shown or any(lines) else [])
    elif tag in ("ul", "ol", "menu", "dir"):
        yield _list(node, w)
    elif tag == "table" and w.tables < TABLE_DEPTH:
        yield _table(node, w)
    elif tag == "details" and "open" not in node.attrs:
        title = next((c for c in node.children if not isinstance(c, str) and c.tag == "summary"), None)
        if title is not None:
            yield _render(title, w)
    elif tag in ("blockquote", "dd"):
        outer, w.indent = w.indent, _deeper(w.indent, 2)
        yield _children(node, w)
        w.indent = outer
    elif tag == "text" and node.foreign:  # labels stand apart
        w.space = True
        yield _children(node, w)
        w.space = True
    elif tag == "q":
        w.text('"')
        w.space = False
        yield _children(node, w)
        w.text('"')
    else:
        yield _children(node, w)
    w.shown = outer_shown
    if gap:
        w.end(gap)


def page_text(page: str) -> str:
    """All visible text of a page, laid out."""
    w = Writer()
    _run(_children(Tree(page).root, w))
    return "\n".join(w.result())


def extract_text(pages: DataFrame, *, id_col: str = "page_id", html_col: str = "html", text_col: str = "text") -> DataFrame:
    """One row per page: the id, the laid-out text and n_chars."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 256):
                some = b.slice(k, 256)
                text = [None if p is None else page_text(p) for p in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(text, pa.string())], names=["id", "text"])

    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(lay_out, f"id {kind}, text string")
    return out.select(F.col("id").alias(id_col), F.col("text").alias(text_col), F.length("text").cast("long").alias("n_chars"))
