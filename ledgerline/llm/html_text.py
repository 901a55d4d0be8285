"""Layout-aware text of web pages.

A small tree builder reads the markup with implied end tags (a ``p`` ends at
the next block, ``li``, ``td``, ``option`` ... at their next sibling, an
unknown end tag is ignored) and a renderer walks the tree: hidden elements are
left out, blocks stand on lines of their own with one empty line around
paragraphs, headings, lists and tables, list items carry their mark and
indent, table cells are padded into columns, ``pre`` keeps its blanks, and
all other white space collapses.

Time and output are linear in the page: indents stop growing at INDENT
characters, a cell line wider than CELL does not widen its column, a row that
would be mostly padding has its cells one below another, and in tables nested
deeper than TABLES every cell stands on lines of its own.

Visibility: ``head``, scripts, styles, templates and form values do not
show; neither do elements with ``hidden``, ``aria-hidden=true`` or an inline
style of ``display:none`` or ``visibility:hidden``.

Defined results: null and empty pages give empty text; broken markup never
fails; each row is rendered on its own, repeated rows alike; other columns
are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Generator, Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by the role they play.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = set("head script style template title noscript iframe object svg math canvas audio video select datalist "
             "textarea noembed noframes".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr".split())
BLOCK = SPACED | set("address article aside body caption center dd details dialog div dt fieldset figcaption footer form "
                     "header hgroup html legend li main menu nav option section summary tbody td tfoot th thead tr".split())
# An open element ends when one of these begins directly inside it.
ENDED_BY = {"p": BLOCK - {"body", "html", "option", "td", "th", "tr"} | {"table"}, "li": {"li"}, "dt": {"dt", "dd"},
            "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
            "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
            "head": {"body"}}
# Implied ends do not reach outside of these.
SCOPE = set("table td th caption ul ol dl div section article body html blockquote button".split())
PARENT_SCOPE = {"li": {"ul", "ol", "menu", "table"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
                "thead": {"table"}, "tbody": {"table"}, "option": {"select"}, "head": {"html"}, "p": SCOPE}
COLUMN_GAP = "  "
INDENT = 64  # widest indent of list items, in characters
CELL = 200  # widest column that cells are padded to
PADDED, PADDED_FLOOR = 32, 2000  # a row may take that many times its text, or the floor, as padded columns
TABLES = 16  # tables nested deeper are not laid out in columns

# By start tag: what it ends, and how far out that reaches.
_ENDS = defaultdict(set)
for _tag, _by in ENDED_BY.items():
    for _next in _by:
        _ENDS[_next].add(_tag)
_ENDS = dict(_ENDS)
_REACH = {tag: PARENT_SCOPE.get(tag, SCOPE) - ends for tag, ends in _ENDS.items()}
_CELLS = ("td", "th", "table")
_THROUGH_CELLS = set("tr table tbody thead tfoot body".split())  # end tags that leave a cell

_token = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
                    r"|<([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']|[\"'])*?)(/?)(?:>|\Z)", re.S)
_attribute = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_unseen = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
_white = re.compile(r"[ \t\n\r\f\v]+")


@dataclass
class Node:
    tag: str
    hidden: bool = False
    start: int = 1  # first number of an ordered list
    children: list = field(default_factory=list)  # Node or str


def _attributes(source: str) -> dict[str, str]:
    return {k.lower(): unescape(v[1:-1] if v[:1] in "\"'" and v else v) for k, v in reversed(_attribute.findall(source))}


class _Open:
    """The open elements, and the places of each tag among them (the root has none)."""

    def __init__(self, root: Node):
        self.stack, self.places = [root], defaultdict(list)

    def push(self, node: Node) -> None:
        self.places[node.tag].append(len(self.stack))
        self.stack.append(node)

    def cut(self, k: int) -> None:
        while len(self.stack) > k:
            self.places[self.stack.pop().tag].pop()

    def last(self, tags) -> int:
        """Place of the innermost open element of ``tags``; 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)

    def first_within(self, tags, outer: int) -> int | None:
        """Place of the outermost open element of ``tags`` inside of ``outer``."""
        inside = (p[k] for t in tags if (p := self.places.get(t)) and (k := bisect_right(p, outer)) < len(p))
        return min(inside, default=None)


def parse(html: str) -> Node:
    """The element tree of ``html``."""
    root = Node("html")
    opened, at = _Open(root), 0
    stack = opened.stack
    while at < len(html):
        m = _token.search(html, at)
        text = html[at:m.start() if m else len(html)]
        if text:
            stack[-1].children.append(unescape(text))
        if m is None:
            break
        at = m.end()
        end, tag, source = (m[1] or "").lower(), (m[2] or "").lower(), m[3] or ""
        if end:
            k = opened.last((end,))
            if k and (end in _THROUGH_CELLS or k >= opened.last(_CELLS)):
                opened.cut(k)
        elif tag:
            if tag in _ENDS and (k := opened.first_within(_ENDS[tag], opened.last(_REACH[tag]))):
                opened.cut(k)
            a = _attributes(source) if source.strip() else {}
            unseen = tag in HIDDEN or "hidden" in a or a.get("aria-hidden", "").lower() == "true" \
                or bool(_unseen.search(a.get("style", ""))) or tag == "input" and a.get("type", "").lower() == "hidden"
            first = a.get("start", "1")
            node = Node(tag, unseen, int(first) if re.fullmatch(r"-?[0-9]{1,9}", first) else 1)
            if tag == "img" and a.get("alt"):
                node.children.append(a["alt"])
            stack[-1].children.append(node)
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(html, at)
                inner = html[at:close.start() if close else len(html)]
                node.children.append(inner)
                at = html.find(">", close.start()) + 1 or len(html) if close else len(html)
            elif tag not in VOID and not m[4]:
                opened.push(node)
    return root


class _Lines:
    """Text under construction: finished lines, the open one, pending blanks."""

    def __init__(self):
        self.lines: list[str] = []
        self.open, self.gap = [], False
        # Marks of open list items without a line so far, and the indent of the others.
        self.marks, self.indent = [], 0

    def add(self, text: str, keep: bool = False) -> None:
        if keep:
            first, *rest = text.split("\n")
            self.open.append(first)
            for line in rest:
                self.end(always=True)
                self.open.append(line)
            return
        for k, word in enumerate(_white.split(text)):
            self.gap |= k > 0
            if word:
                if self.gap and self.open:
                    self.open.append(" ")
                self.open.append(word)
                self.gap = False

    def end(self, always: bool = False) -> None:
        line = "".join(self.open).rstrip(" ")
        if line or always:
            self.put(line)
        self.open, self.gap = [], False

    def put(self, line: str) -> None:
        if line:
            line = " " * min(self.indent, INDENT) + "".join(self.marks) + line
            self.indent += sum(map(len, self.marks))
            self.marks = []
        self.lines.append(line)

    def close_item(self, mark: str) -> None:
        if self.marks:
            self.marks.pop()
        else:
            self.indent -= len(mark)

    def space(self) -> None:
        self.end()
        if self.lines and self.lines[-1]:
            self.lines.append("")


def _table(node: Node, depth: int) -> Generator[Generator, list[str], list[str]]:
    """Rows with their cells padded into columns; a caption and text outside
    of cells stand above. ``depth``: the tables around it. Yields what is to be
    rendered first (see ``render``)."""
    rows, above, todo = [], [], list(reversed(node.children))
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            if c.strip():
                above.append(_white.sub(" ", c).strip())
        elif not c.hidden and c.tag in ("thead", "tbody", "tfoot"):
            todo += reversed(c.children)
        elif not c.hidden and c.tag == "tr":
            rows.append([])
            for x in c.children:
                if isinstance(x, str):
                    if x.strip():
                        above.append(_white.sub(" ", x).strip())
                elif not x.hidden:
                    rows[-1].append((yield _lines(x, depth + 1)))
        elif not c.hidden:
            above += [line for line in (yield _lines(c, depth + 1)) if line]
    widths: list[int] = []
    for cells in rows:
        for k, cell in enumerate(cells):
            if k == len(widths):
                widths.append(0)
            widths[k] = max([widths[k], *(len(line) for line in cell if len(line) <= CELL)])
    out = above
    for cells in rows:
        high = max(map(len, cells), default=0)
        text = sum(len(line) + 1 for cell in cells for line in cell) + len(cells)
        if high * sum(w + len(COLUMN_GAP) for _, w in zip(cells, widths)) > max(PADDED * text, PADDED_FLOOR):
            out += [line for cell in cells for line in cell]
            continue
        for k in range(high):
            out.append(COLUMN_GAP.join((c[k] if k < len(c) else "").ljust(w) for c, w in zip(cells, widths)).rstrip())
    return out


def render(node: Node) -> list[str]:
    """Visible lines of ``node``. Walks with its own stacks, so deep markup and
    tables in tables are no danger."""
    stack, lines = [_lines(node)], None
    while stack:
        try:
            inner = stack[-1].send(lines)
        except StopIteration as done:
            stack.pop()
            lines = done.value
        else:
            stack.append(inner)
            lines = None
    return lines


def _lines(node: Node, depth: int = 0) -> Generator[Generator, list[str], list[str]]:
    """Lines of ``node``, which stands in ``depth`` tables; yields the tables in
    it, to be sent their lines."""
    out = _Lines()
    # (node, next child, number of the next item)
    stack: list[list] = [[node, 0, node.start]]
    marks: list[str] = []  # of the open items
    inside = {"pre": int(node.tag == "pre"), "li": int(node.tag == "li")}  # how many are open

    def close(n: Node) -> None:
        if n.tag in SPACED:
            out.space()
        elif n.tag in BLOCK:
            out.end()
        if n.tag in inside:
            inside[n.tag] -= 1
        if n.tag == "li":
            out.close_item(marks.pop())

    while stack:
        top = stack[-1]
        n, k = top[0], top[1]
        if k >= len(n.children):
            stack.pop()
            if stack:
                close(n)
            continue
        top[1] += 1
        c = n.children[k]
        if isinstance(c, str):
            out.add(c, keep=inside["pre"] > 0)
        elif c.hidden:
            continue
        elif c.tag == "br":
            out.end(always=bool(out.open))
        elif c.tag == "table" and depth < TABLES:
            out.space()
            for line in (yield _table(c, depth)):
                out.put(line)
            out.space()
        else:
            if c.tag in SPACED and not (c.tag in ("ul", "ol", "dl") and inside["li"]):
                out.space()
            elif c.tag in BLOCK:
                out.end()
            if c.tag == "li":
                mark = "- "
                if n.tag == "ol":
                    mark, top[2] = f"{top[2]}. ", top[2] + 1
                marks.append(mark)
                out.marks.append(mark)
            if c.tag in inside:
                inside[c.tag] += 1
            stack.append([c, 0, c.start])
    out.end()
    lines = out.lines
    while lines and not lines[-1]:
        lines.pop()
    while lines and not lines[0]:
        lines.pop(0)
    return lines


def page_text(html: str | None) -> str:
    return "\n".join(render(parse(html))) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_lines, n_chars) of every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 500):
                b = whole.slice(k, 500)
                texts = [page_text(h) for h in b.column(2).to_pylist()]
                lines = np.array([t.count("\n") + 1 if t else 0 for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(lines),
                     pa.array(np.array([len(t) for t in texts], np.int64))],
                    names=["page_id", "url", "text", "n_lines", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(
        run, "page_id bigint, url string, text string, n_lines bigint, n_chars bigint")
