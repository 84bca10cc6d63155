"""The visible text of HTML pages, laid out as a reader sees it.

A small tree builder adds the tags that HTML leaves out (a list item ends the one
before, a cell opens its row), and a renderer walks the tree: it leaves out what is
not shown, keeps blocks apart, indents lists, and aligns the cells of tables.
"""

import re
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from flowtide.llm.common import column

# What the HTML standard says of its elements
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
HIDDEN = frozenset(
    "head script style template noscript title meta link base datalist iframe noembed noframes "
    "object audio video canvas map area param source track rp".split()
)
BLOCK = frozenset(
    "html body address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search "
    "section summary table tbody td tfoot th thead tr ul xmp caption".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp".split())
ENDS_PARAGRAPH = BLOCK - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "legend"}
# An element ends those open ones, unless one of the second kind lies between
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
    "body": ({"head"}, set()),
}
FENCE = {"table", "td", "th", "caption", "button", "object", "html"}  # no end tag but their own reaches beyond
TABLE_TAGS = {"table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th"}
DEEPEST = 200  # levels of nesting; elements below become siblings, and no text is lost
WIDEST = 1000  # columns that one cell may span

_OPEN = re.compile(r"<(?:!--|[!?]|/?[A-Za-z])")
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_UNSEEN = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


def _tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """("text" | "raw" | "start" | "end", name or text, attributes)."""
    at, n = 0, len(html)
    while at < n:
        found = _OPEN.search(html, at)
        if not found:
            break
        if found.start() > at:
            yield "text", html[at : found.start()], ""
        at = found.start()
        if found[0] == "<!--":
            stop = html.find("-->", at + 4)
            at = n if stop < 0 else stop + 3
            continue
        if found[0] in ("<!", "<?"):
            stop = html.find(">", at)
            at = n if stop < 0 else stop + 1
            continue
        tag = _TAG.match(html, at) or _LOOSE_TAG.match(html, at)
        if not tag:
            at = n  # a tag that never ends is not shown
            return
        name = tag[2].lower()
        at = tag.end()
        if tag[1]:
            yield "end", name, ""
            continue
        yield "start", name, tag[3]
        if name in RAW:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
            stop = close.start() if close else n
            yield "raw", html[at:stop], ""
            at = stop
    if at < n:
        yield "text", html[at:], ""


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def parse(html: str) -> Node:
    """The tree of a page. Tags that were left out are implied."""
    root = Node("html", {})
    stack = [root]

    def close(names, fence) -> None:
        """Close open elements down to the lowest of these names, if no fence hides it."""
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in names:
                del stack[depth:]
                return
            if stack[depth].tag in fence:
                return

    def push(tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        stack[-1].children.append(node)
        if tag not in VOID and len(stack) < DEEPEST:
            stack.append(node)

    for kind, name, rest in _tokens(html):
        if kind == "text":
            stack[-1].children.append(unescape(name))
        elif kind == "raw":
            # its text is of one element, also where that is too deep to be open
            holder = stack[-1].children[-1] if len(stack) >= DEEPEST and stack[-1].children else stack[-1]
            if isinstance(holder, Node):
                holder.children.append(unescape(name) if holder.tag in ("textarea", "title") else name)
        elif kind == "end":
            if name == "br":
                push("br", {})
            elif name not in ("html", "body"):
                close({name}, {"table"} - {name} if name in TABLE_TAGS else FENCE - {name})
        else:
            if name == "html":
                root.attributes |= _attributes(rest)
                continue
            if name in ENDS_PARAGRAPH:
                close({"p"}, FENCE)
            if name in ENDS:
                names, fence = ENDS[name]
                while True:
                    before = len(stack)
                    close(names, fence)
                    if len(stack) == before:
                        break
            inner = stack[-1].tag
            if name in ("td", "th") and inner in ("table", "tbody", "thead", "tfoot"):
                push("tr", {})
            push(name, _attributes(rest) if rest.strip() else {})
    return root


class _Flow:
    """Lines of text within one column of the page."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0
        self.indent: list[str] = []
        self.marker: str | None = None

    def text(self, text: str) -> None:
        for i, part in enumerate(_BLANKS.split(text)):
            self.space |= i > 0
            if part:
                if self.space and self.line:
                    self.line.append(" ")
                self.line.append(part)
                self.space = False

    def verbatim(self, text: str) -> None:
        for i, part in enumerate(text.replace("\r\n", "\n").split("\n")):
            if i:
                self.end_line(keep_empty=True)
            if part:
                self.line.append(part)

    def end_line(self, keep_empty: bool = False) -> None:
        text = "".join(self.line).replace("\xa0", " ").rstrip()
        self.line, self.space = [], False
        if not text and not keep_empty:
            return
        if self.gap and self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        before = "".join(self.indent)
        if self.marker is not None:
            before = "".join(self.indent[:-1]) + self.marker
            self.marker = None
        self.lines.append((before + text).rstrip())

    def block(self, spaced: bool) -> None:
        self.end_line()
        if spaced and self.marker is None:
            self.gap = 1


def _shown(node: Node) -> bool:
    attributes = node.attributes
    if node.tag in HIDDEN:
        return False
    if not attributes:
        return node.tag != "dialog"
    if "hidden" in attributes or _UNSEEN.search(attributes.get("style", "")):
        return False
    return node.tag != "dialog" or "open" in attributes


def _number(text: str | None, default: int) -> int:
    return int(text) if text and text.isascii() and text.isdigit() and len(text) < 7 else default


def _render(node: Node, flow: _Flow, kept: bool, lists: int) -> None:
    """``kept``: blanks count. ``lists``: how many lists are open."""
    tag = node.tag
    if tag == "br":
        flow.end_line(keep_empty=True)
        return
    if tag == "hr":
        flow.block(True)
        return
    if tag == "table":
        flow.block(True)
        for line in _table(node):
            flow.line.append(line)
            flow.end_line(keep_empty=True)
        flow.block(True)
        return
    is_block = tag in BLOCK
    spaced = tag in SPACED and not (tag in ("ul", "ol", "menu", "dl") and lists)
    if is_block:
        flow.block(spaced)
    indent = {"blockquote": "  ", "dd": "  "}.get(tag)
    if indent:
        flow.indent.append(indent)
    lists += tag in ("ul", "ol", "menu", "dl")
    kept = kept or tag in ("pre", "xmp", "textarea")
    closed = tag == "details" and "open" not in node.attributes
    number = _number(node.attributes.get("start"), 1)
    for child in node.children:
        if isinstance(child, str):
            if closed:
                continue
            if kept:
                flow.verbatim(child)
            else:
                flow.text(child)
            continue
        if not _shown(child) or (closed and child.tag != "summary"):
            continue
        if child.tag == "li":
            flow.end_line()
            marker = f"{number}. " if tag == "ol" else "- "
            number += 1
            flow.marker, before = marker, flow.marker
            flow.indent.append(" " * len(marker))
            _render(child, flow, kept, lists)
            flow.end_line()
            flow.indent.pop()
            flow.marker = before
        else:
            _render(child, flow, kept, lists)
    if indent:
        flow.end_line()
        flow.indent.pop()
    if is_block:
        flow.block(spaced)


def _rows(table: Node) -> Iterator[Node]:
    """Rows in order, and anything else that stands in a table as a row of its own."""
    for child in table.children:
        if isinstance(child, str):
            if child.strip():
                loose = Node("tr", {})
                loose.children.append(child)
                yield loose
        elif not _shown(child):
            continue
        elif child.tag in ("tbody", "thead", "tfoot"):
            yield from _rows(child)
        elif child.tag == "tr":
            yield child
        elif child.tag not in ("colgroup", "col"):
            loose = Node("tr", {})
            loose.children.append(child)
            yield loose


def _table(table: Node) -> list[str]:
    """Cells in aligned columns. Spanned columns are left empty."""
    grid: list[dict[int, list[str]]] = []
    down: dict[int, int] = {}  # rows for which a column is still taken
    for row in _rows(table):
        cells: dict[int, list[str]] = {}
        place = 0
        taken = {c for c, rows in down.items() if rows > 0}
        down = {c: rows - 1 for c, rows in down.items() if rows > 1}
        for child in row.children:
            if isinstance(child, str):
                if not child.strip():
                    continue
                cell = Node("td", {})
                cell.children.append(child)
            elif not _shown(child):
                continue
            else:
                cell = child
            while place in taken:
                place += 1
            flow = _Flow()
            _render(cell, flow, False, 0)
            flow.end_line()
            cells[place] = flow.lines
            wide = min(_number(cell.attributes.get("colspan"), 1) or 1, WIDEST)
            tall = _number(cell.attributes.get("rowspan"), 1)
            if tall > 1:
                down |= {c: tall - 1 for c in range(place, place + wide)}
            place += wide
        if any(cells.values()):
            grid.append(cells)
    columns = sorted({c for cells in grid for c, lines in cells.items() if lines})
    width = {c: max(len(line) for cells in grid for line in cells.get(c, [""]) or [""]) for c in columns}
    lines = []
    for cells in grid:
        height = max(len(cell) for cell in cells.values())
        for i in range(height):
            parts = [(cells.get(c, [])[i : i + 1] or [""])[0].ljust(width[c]) for c in columns]
            lines.append(" | ".join(parts).rstrip(" |") if len(columns) > 1 else parts[0].rstrip())
    return lines


def visible_text(html: str | None) -> str:
    """What a page shows. A null or empty page shows nothing."""
    flow = _Flow()
    _render(parse(html or ""), flow, False, 0)
    flow.end_line()
    lines = flow.lines
    while lines and not lines[-1]:
        lines.pop()
    return "\n".join(lines)


@F.pandas_udf(StringType())
def _visible(pages: pd.Series) -> pd.Series:
    return pd.Series([visible_text(p) for p in pages], dtype=object)


def extract(pages: DataFrame, html_col: str = "html", out: str = "content") -> DataFrame:
    """``pages`` with one more column: the visible text of the whole page.

    Null and empty pages have empty texts; every row keeps its place and its columns.
    Text outside of any tag is text like any other.
    """
    return pages.withColumn(out, _visible(column(html_col)))
