"""Visible text of web pages, laid out as a browser would place it."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import slices, spread

# Element names of the HTML standard, by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
ESCAPABLE = frozenset("title textarea".split())
HIDDEN = frozenset(
    "area audio base canvas datalist embed head iframe img link math meta noembed noframes noscript "
    "object param rp script source style svg template title track video".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre search section summary table ul".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 ol p pre table ul hr fieldset".split())
CLOSES_P = (BLOCK - frozenset("body html option optgroup legend".split())) | {"table"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title head html".split())
INLINE = frozenset("a b big code em font i nobr s small span strike strong tt u".split())
LISTS = frozenset("ul ol menu dir".split())
CELLS = frozenset(("td", "th"))
ROW_GROUPS = frozenset("thead tbody tfoot".split())
SCOPE = frozenset("table td th caption html template button object marquee".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>=]|=\s*\"[^\"]*(?:\"|\Z)|=\s*'[^']*(?:'|\Z)|[\"'=])*)(?:>|\Z)",
    re.S)
_ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_NOT_SHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)", re.I)
#: Columns are aligned up to this width; longer cells stick out, nothing is cut.
ALIGNED = 40


class Flow:
    """Lines of one block context: the page, or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space, self.gap = False, 0
        self.indents: list[str] = []
        self.marker: str | None = None

    def text(self, raw: str) -> None:
        words = _BLANKS.sub(" ", raw)
        if words == " ":
            self.space = True
            return
        if words[0] == " ":
            self.space, words = True, words[1:]
        if self.space and self.parts and self.parts[-1]:
            self.parts.append(" ")
        self.space = words[-1] == " "
        self.parts.append(words[:-1] if self.space else words)

    def verbatim(self, raw: str) -> None:
        first, *rest = raw.split("\n")
        self.parts.append(first)
        for line in rest:
            self.end_line(keep=True)
            self.parts.append(line)
        self.space = False

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.parts)
        self.parts, self.space = [], False
        if line.strip() or keep:
            self.put(line)

    def put(self, line: str) -> None:
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0
        lead = "".join(self.indents)
        if self.marker is not None:
            lead = lead[:len(lead) - len(self.marker)] + self.marker
            self.marker = None
        self.lines.append((lead + line).rstrip())

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def done(self) -> list[str]:
        self.end_line()
        return self.lines


class Table:
    """Rows of cells; ``place`` aligns the columns."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[int, list[str]]]] = []
        self.taken: dict[int, int] = {}  # column: rows that a cell above still covers
        self.column = 0
        self.caption: list[str] = []

    def row(self) -> None:
        self.rows.append([])
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.column = 0

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        while self.taken.get(self.column):
            self.column += 1
        self.rows[-1].append((self.column, lines))
        for c in range(self.column, self.column + across):
            if down > 1:
                self.taken[c] = down
        self.column += across

    def place(self) -> list[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for column, lines in row:
                width = max((len(x) for x in lines), default=0)
                if width <= ALIGNED:
                    widths[column] = max(widths.get(column, 0), width)
        starts, at = {}, 0
        used = sorted({c for row in self.rows for c, _ in row})
        for c in used:
            starts[c] = at
            if widths.get(c):
                at += widths[c] + 2
        out = list(self.caption)
        for row in self.rows:
            for k in range(max((len(lines) for _, lines in row), default=0)):
                line = ""
                for column, lines in row:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(starts[column]) if len(line) < starts[column] else (
                            line + "  " if line else line)
                        line += lines[k]
                if line.strip():
                    out.append(line)
        return out


class Page:
    """Builds the tree of a page, as a stack of open elements, and lays its text out."""

    def __init__(self) -> None:
        # Name, whether it hides what it holds, whether it was laid out itself.
        self.open: list[tuple[str, bool, bool]] = []
        self.count: Counter = Counter()  # open elements by name
        self.hidden = 0
        self.flows = [Flow()]
        self.tables: list[tuple[Table, int]] = []  # table, number of flows below it
        self.cells: list[tuple[int, int]] = []
        self.lists: list[int | None] = []
        self.steps: list[int] = []
        self.pre = 0
        self.fresh_pre = False

    def render(self, html: str) -> str:
        at, end = 0, len(html)
        while at < end:
            m = _TOKEN.search(html, at)
            stop = m.start() if m else end
            if stop > at:
                self.text(html[at:stop])
            if not m:
                break
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if m[1]:
                self.end(name)
                continue
            self.start(name, m[3])
            if name in RAW or name in ESCAPABLE:
                close = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, at)
                stop = close.start() if close else end
                if name == "textarea":
                    self.text(html[at:stop])
                at = stop
        while self.open:
            self.pop()
        return "\n".join(self.flows[0].done()).strip("\n")

    def text(self, raw: str) -> None:
        if self.open and self.open[-1][0] == "head" and raw.strip():
            self.pop()
        if self.hidden or self.open and self.open[-1][0] == "details-closed":
            return
        raw = unescape(raw) if "&" in raw else raw
        flow = self.flows[-1]
        if self.pre:
            raw = raw.replace("\r\n", "\n").replace("\r", "\n")
            if self.fresh_pre and raw.startswith("\n"):
                raw = raw[1:]
            flow.verbatim(raw)
        elif raw:
            flow.text(raw)
        self.fresh_pre = False

    def within(self, names: frozenset | set, borders: frozenset | set) -> int | None:
        """Place of the innermost open element of the names, inside the innermost border."""
        if not any(self.count[n] for n in names):
            return None
        for i in range(len(self.open) - 1, -1, -1):
            name = self.open[i][0]
            if name in names:
                return i
            if name in borders:
                return None
        return None

    def close_to(self, at: int | None) -> None:
        while at is not None and len(self.open) > at:
            self.pop()

    def imply(self, name: str) -> None:
        """Ends, and row starts, that the page leaves out."""
        if self.open and self.open[-1][0] == "head" and name not in HEAD_ONLY:
            self.pop()
        if name in CLOSES_P:
            self.close_to(self.within({"p"}, SCOPE))
        if name == "li":
            self.close_to(self.within({"li"}, LISTS | SCOPE))
        elif name in ("dt", "dd"):
            self.close_to(self.within({"dt", "dd"}, SCOPE | {"dl"}))
        elif name in ("option", "optgroup"):
            self.close_to(self.within({"option"} if name == "option" else {"option", "optgroup"},
                                      SCOPE | {"select", "datalist"}))
        elif name in HEADINGS and self.open and self.open[-1][0] in HEADINGS:
            self.pop()
        elif name in CELLS:
            self.close_to(self.within(CELLS | {"caption"}, {"table"}))
            if self.tables and self.within({"tr"}, {"table"}) is None:
                self.push("tr", "")
        elif name == "tr":
            self.close_to(self.within({"tr", "caption"}, {"table"}))
        elif name in ROW_GROUPS or name in ("caption", "colgroup"):
            self.close_to(self.within(ROW_GROUPS | {"caption", "colgroup"}, {"table"}))
            self.close_to(self.within({"tr"}, {"table"}))

    def start(self, name: str, attrs: str) -> None:
        self.imply(name)
        if name == "br":
            if not self.hidden:
                flow = self.flows[-1]
                flow.end_line(keep=bool(flow.parts) or bool(flow.lines) and not flow.gap)
            return
        if name == "hr" and not self.hidden:
            self.flows[-1].block(1)
        if name not in VOID:
            self.push(name, attrs)

    def push(self, name: str, attrs: str) -> None:
        found = {}
        if attrs.strip(" /\n\t"):
            for k, a, b, c in _ATTR.findall(attrs):
                found.setdefault(k.lower(), unescape(a or b or c))
        hides = (name in HIDDEN or "hidden" in found
                 or bool(_NOT_SHOWN.search(found.get("style", "")))
                 or name == "dialog" and "open" not in found)
        if (self.open and self.open[-1][0] == "details-closed" and name != "summary"):
            hides = True
        kept = "details-closed" if name == "details" and "open" not in found else name
        self.hidden += hides
        self.open.append((kept, hides, not self.hidden))
        self.count[kept] += 1
        if self.hidden:
            return
        flow = self.flows[-1]
        if name in CELLS and self.tables:
            self.cells.append(tuple(min(max(self._number(found.get(k), 1), 1), 1000)
                                    for k in ("colspan", "rowspan")))
            self.flows.append(Flow())
        elif name == "caption" and self.tables:
            self.flows.append(Flow())
        elif name == "tr" and self.tables:
            self.tables[-1][0].row()
        elif name == "table":
            flow.block(1)
            self.tables.append((Table(), len(self.flows)))
        elif name == "li":
            flow.block(0)
            marker = "- "
            if self.lists and self.lists[-1] is not None:
                self.lists[-1] = self._number(found.get("value"), self.lists[-1])
                marker = f"{self.lists[-1]}. "
                self.lists[-1] += self.steps[-1]
            flow.indents.append(" " * len(marker))
            flow.marker = marker
        elif name in BLOCK:
            flow.block(1 if name in SPACED and not (name in LISTS and self.lists) else 0)
            if name in LISTS:
                step = -1 if name == "ol" and "reversed" in found else 1
                self.lists.append(self._number(found.get("start"), 1) if name == "ol" else None)
                self.steps.append(step)
            elif name in ("dd", "blockquote"):
                flow.indents.append("  ")
            elif name == "pre":
                self.pre, self.fresh_pre = self.pre + 1, True
        elif name == "textarea":
            self.pre, self.fresh_pre = self.pre + 1, True

    @staticmethod
    def _number(raw: str | None, default: int) -> int:
        m = re.match(r"\s*([+-]?\d{1,9})", raw or "")
        return int(m[1]) if m else default

    def pop(self) -> None:
        name, hides, laid = self.open.pop()
        self.count[name] -= 1
        self.hidden -= hides
        if not laid:
            return
        name = "details" if name == "details-closed" else name
        flow = self.flows[-1]
        if name in CELLS and self.tables:
            lines = self.flows.pop().done()
            self.tables[-1][0].cell(lines, *self.cells.pop())
        elif name == "caption" and self.tables:
            self.tables[-1][0].caption += self.flows.pop().done()
        elif name == "table" and self.tables:
            table, depth = self.tables.pop()
            del self.flows[depth:]
            flow = self.flows[-1]
            flow.block(1)
            for line in table.place():
                flow.put(line)
            flow.block(1)
        elif name == "li":
            flow.block(0)
            flow.marker = None
            flow.indents.pop()
        elif name in BLOCK:
            if name in ("dd", "blockquote"):
                flow.end_line()
                flow.indents.pop()
            elif name == "pre":
                self.pre -= 1
            if name in LISTS:
                self.lists.pop()
                self.steps.pop()
            flow.block(1 if name in SPACED and not (name in LISTS and self.lists) else 0)
        elif name == "textarea":
            self.pre -= 1

    def end(self, name: str) -> None:
        if name in ("br", "p") and (name == "br" or self.within({"p"}, SCOPE) is None):
            if not self.hidden:
                self.flows[-1].block(0 if name == "br" else 1)
            return
        wanted = {name, "details-closed"} if name == "details" else {name}
        if name in HEADINGS:
            wanted = HEADINGS
        borders = frozenset() if name in ("table", "html", "body") else (
            {"table"} if name in CELLS or name in ROW_GROUPS or name in ("tr", "caption")
            else (SCOPE - {name}) | CELLS)
        at = self.within(wanted, borders - wanted)
        if at is None:
            return
        if name in INLINE and any(x in BLOCK or x in CELLS for x, *_ in self.open[at + 1:]):
            # Ends inside a block that it holds: the block goes on without it.
            self.hidden -= self.open[at][1]
            self.count[name] -= 1
            del self.open[at]
            return
        if name in ("body", "html"):
            return
        self.close_to(at)


def visible_text(html: str) -> str:
    return Page().render(html)


def extract_text(pages: DataFrame) -> DataFrame:
    """``(page_id, n_chars, text)`` for each row of ``pages`` (page_id, html).

    The text holds everything a reader would see, in order: blocks on lines of their own, paragraphs
    and headings set off by an empty line, lists with markers and indentation, tables row by row
    with aligned columns, preformatted text as it stands. Left out are scripts, styles, the head,
    comments, hidden elements (attribute or inline style), closed details and dialogs. Missing end
    tags and row starts are implied; unknown elements are inline. A null or empty page gives an
    empty text; broken markup never fails. Repeated rows count each; an empty table gives an empty
    result; other columns are ignored.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], "html"):
                texts = [visible_text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array(texts, pa.string())], ["page_id", "n_chars", "text"])

    pages = pages.select(F.col("page_id").cast("long").alias("page_id"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    return spread(pages).mapInArrow(render, "page_id long, n_chars long, text string")
