"""Layout-aware text of HTML pages: a tree builder with implied tags, visibility rules, and a block renderer.

Visibility comes from the element, its attributes, its style and the page's
style sheets, as far as their selectors name elements, classes and ids (without
combinators and at-rules). What is not displayed takes its contents with it;
what is displayed but not visible may hold visible parts.

The tree follows the usual repairs: void elements, raw text, end tags implied by
a following start tag, table rows implied around cells, unclosed elements closed
by their parents. The renderer emits all visible text: blocks on lines of their
own, a blank line around paragraphs, headings, lists and tables, list markers
with indentation, preformatted text as it is, and table cells padded to columns.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordflow.llm.common import on_workers, rows_of

#: Deeper elements are flattened: their text, line breaks and visibility stay, their layout does not.
MAX_DEPTH = 120
#: Holds the text of a flattened element whose visibility is its own.
SHELL = "#text"

_words = lambda text: frozenset(text.split())
VOID = _words("area base br col embed hr img input link meta param source track wbr")
#: Raw text in which character references count.
DECODED = _words("textarea title")
PREFORMATTED = _words("pre xmp listing textarea")
RAW = _words("script style textarea title noscript template iframe xmp noembed noframes")
HIDDEN = _words("script style template head title noscript iframe noembed noframes datalist object audio video canvas annotation annotation-xml rp")
SPACED = _words("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr fieldset xmp listing")
BLOCK = SPACED | _words(
    "html body div section article aside nav header footer main address li dt dd tr caption figcaption form legend details summary"
    " center dir menu option optgroup select thead tbody tfoot dialog hgroup search"
)
CLOSES_P = BLOCK - _words("html body option optgroup select")
TABLE_PARTS = _words("thead tbody tfoot")
CELLS = _words("td th")
#: A start tag ends these open elements, searched up to an element of the scope.
IMPLIED = {
    "li": (_words("li"), _words("ul ol menu dir table")),
    "dt": (_words("dt dd"), _words("dl table")),
    "dd": (_words("dt dd"), _words("dl table")),
    "option": (_words("option"), _words("select optgroup datalist")),
    "optgroup": (_words("option optgroup"), _words("select")),
    "tr": (_words("tr td th caption"), _words("table thead tbody tfoot")),
    "td": (CELLS, _words("tr table")),
    "th": (CELLS, _words("tr table")),
    "thead": (TABLE_PARTS | _words("tr td th caption"), _words("table")),
    "tbody": (TABLE_PARTS | _words("tr td th caption"), _words("table")),
    "tfoot": (TABLE_PARTS | _words("tr td th caption"), _words("table")),
}
#: What a head holds; any other start tag, or text, ends it.
IN_HEAD = _words("base link meta title style script noscript noframes template")
#: A start tag of a table ends what strays open inside it, up to these.
CONTEXT = dict.fromkeys(TABLE_PARTS | _words("caption colgroup"), _words("table")) | {"tr": TABLE_PARTS | {"table"}} | dict.fromkeys(CELLS, TABLE_PARTS | _words("tr table"))
FOREIGN = _words("svg math")
#: HTML goes on inside these elements of a drawing or formula.
INTEGRATION = _words("foreignobject desc title mi mo mn ms mtext annotation-xml")
#: These start tags end a drawing or formula.
BREAKOUT = _words(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s"
    " small span strong strike sub sup table tt u ul var"
)
UNDRAWN = _words("defs desc metadata symbol clippath mask pattern marker")
HEADINGS = _words("h1 h2 h3 h4 h5 h6")

_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)", re.DOTALL)
# The end of a tag, an opened quote, or a value without quotes.
_STOP = re.compile(r"""(>)|=\s*(?:(["'])|[^\s>"'][^\s>]*)""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SELF_CLOSED = re.compile(r"""(?:^|[\s"'])/$""")
_BLANKS = re.compile(r"[ \t\n\r\f]+")
_PROPERTY = re.compile(r"(?:^|[;{\s])(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.IGNORECASE)
_CSS_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_SELECTOR = re.compile(r"([a-zA-Z][a-zA-Z0-9]*|\*)?((?:[.#][\w-]+)*)")
#: Bounds of HTML for spans of cells, and of whole numbers.
MAX_COLSPAN, MAX_ROWSPAN, MAX_INT = 1000, 65534, 2147483647
#: A column counts as this wide at most for where the next one starts; longer lines push the rest of their own row.
COLUMN = 80


class Node:
    __slots__ = ("tag", "attributes", "children", "depth", "displayed", "visibility")

    def __init__(self, tag: str, attributes: str = "", depth: int = 0):
        self.tag, self.attributes, self.depth = tag, attributes, depth
        self.children: list[Node | str] = []
        self.style(())

    def style(self, rules: "tuple | Rules") -> None:
        """Settle whether the element is displayed, and its own visibility if it has one."""
        self.visibility: bool | None = None
        self.displayed = self.tag not in HIDDEN and self.tag != "input"
        if not self.displayed:
            return
        if self.tag == "dialog" and self.get("open") is None or self.get("hidden") is not None:
            self.displayed = False
        found = {}
        if rules:
            found = rules.of(self)
        if self.attributes and (style := self.get("style")):
            for name, (value, important) in properties(style).items():
                if important or not found.get(name, ("", False))[1]:
                    found[name] = value, important
        if "display" in found:
            self.displayed = found["display"][0] != "none"
        if "visibility" in found:
            self.visibility = {"visible": True, "hidden": False, "collapse": False}.get(found["visibility"][0])

    def get(self, name: str) -> str | None:
        """An attribute's value, empty if it has none, None if it is missing."""
        if not self.attributes or name not in self.attributes.lower():
            return None
        for m in _ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return unescape(m[2] or m[3] or m[4] or "")
        return None


def properties(style: str) -> dict[str, tuple[str, bool]]:
    """``display`` and ``visibility`` of a list of declarations, with whether they are important; the last one counts."""
    out: dict[str, tuple[str, bool]] = {}
    for m in _PROPERTY.finditer(style):
        name, important = m[1].lower(), bool(m[3])
        if important or not out.get(name, ("", False))[1]:
            out[name] = m[2].lower(), important
    return out


class Rules:
    """Rules of style sheets that name an element, classes and ids, by the rarest part of their selector."""

    def __init__(self, sheets: list[str]):
        self.by_part: dict[str, list[tuple]] = {}
        number = 0
        for selectors, body in (pair for sheet in sheets for pair in _rule_sets(sheet)):
            declared = properties(body)
            for selector in selectors.split(",") if declared else ():
                m = _SELECTOR.fullmatch(selector.strip())
                if not m or not m.group():
                    continue
                tag, parts = (m[1] or "*").lower(), re.findall(r"[.#][\w-]+", m[2])
                number += 1
                rank = sum(x[0] == "#" for x in parts), sum(x[0] == "." for x in parts), tag != "*", number
                self.by_part.setdefault(parts[0] if parts else tag, []).append((tag, frozenset(parts), rank, declared))

    def __bool__(self) -> bool:
        return bool(self.by_part)

    def of(self, node: Node) -> dict[str, tuple[str, bool]]:
        parts = {f".{c}" for c in (node.get("class") or "").split()}
        if own := (node.get("id") or "").strip():
            parts.add(f"#{own}")
        best: dict[str, tuple] = {}
        for part in (*parts, node.tag, "*"):
            for tag, needed, rank, declared in self.by_part.get(part, ()):
                if tag in ("*", node.tag) and needed <= parts:
                    for name, (value, important) in declared.items():
                        if (important, rank) > best.get(name, ((False, ()),))[0]:
                            best[name] = (important, rank), value, important
        return {name: found[1:] for name, found in best.items()}


def _rule_sets(sheet: str) -> Iterator[tuple[str, str]]:
    """``(selectors, declarations)`` of a style sheet, without at-rules."""
    sheet, at = _CSS_COMMENT.sub(" ", sheet), 0
    while (brace := sheet.find("{", at)) >= 0:
        head = sheet[at:brace].rpartition(";")[2].strip()
        end = sheet.find("}", brace)
        if head.startswith("@"):  # it may hold rules of its own
            depth = 0
            for m in re.finditer("[{}]", sheet[brace:]):
                depth += 1 if m.group() == "{" else -1
                if not depth:
                    at = brace + m.end()
                    break
            else:
                return
            continue
        yield head, sheet[brace + 1 : end if end >= 0 else len(sheet)]
        if end < 0:
            return
        at = end + 1


class TagEnds:
    """Finds the ends of a page's tags, in time linear in the page: no piece is searched twice for the same thing."""

    def __init__(self, html: str):
        self.html = html
        self.first: tuple[int, re.Match | None] = (len(html) + 1, None)  # the stop after a place
        self.endless: set[int] = set()  # stops from which no tag ends
        self.unclosed: set[str] = set()  # quotes of which no further one comes
        self.closes = True  # does a ">" follow?

    def after(self, at: int) -> int:
        """The place of the ``>`` of the tag whose name ends at ``at``, outside quoted values; -1 if none follows.

        Where quotes leave no end, the tag ends at the next ``>``.
        """
        since, stop = self.first
        if not (since <= at and (stop is None or at <= stop.start())):
            stop = _STOP.search(self.html, at)
            self.first = at, stop
        passed = []
        while stop and stop.start() not in self.endless:
            if stop[1]:
                return stop.start()
            passed.append(stop.start())
            past = stop.end()
            if stop[2]:
                past = -1 if stop[2] in self.unclosed else self.html.find(stop[2], past)
                if past < 0:
                    self.unclosed.add(stop[2])
                    break
                past += 1
            stop = _STOP.search(self.html, past)
        self.endless.update(passed)
        end = self.html.find(">", at) if self.closes else -1
        self.closes = end >= 0
        return end


class TreeBuilder:
    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.foreign = False  # has a drawing or formula been seen?
        self.sheets: list[str] = []
        self.rules, self.known = Rules([]), 0
        # Open elements below the greatest depth: tag, displayed, visibility.
        self.buried: list[tuple[str, bool, bool | None]] = []
        self.counts: Counter = Counter()

    def build(self, html: str) -> Node:
        root = self.tree(html)
        if self.sheets and (rules := Rules(self.sheets)):
            todo = [root]
            while todo:
                node = todo.pop()
                if node.tag != SHELL:
                    node.style(rules)
                todo += [c for c in node.children if isinstance(c, Node)]
        return root

    def tree(self, html: str) -> Node:
        at, ends = 0, TagEnds(html)
        while True:
            m = _TOKEN.search(html, at)
            close = ends.after(m.end()) if m and m[2] else 0
            if m is None or close < 0:  # where no ">" follows, an open comment is all that can
                comment = html.find("<!--", at)
                self.text(html[at:comment] if comment >= 0 else html[at:])
                return self.root
            self.text(html[at : m.start()])
            at = close + 1 if m[2] else m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                self.end(tag)
                continue
            self.start(tag, html[m.end() : close])
            if tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(html, at)
                inside = html[at : close.start() if close else len(html)]
                if tag == "style":
                    self.sheets.append(inside)
                self.add(unescape(inside) if tag in DECODED else inside)
                self.end(tag)
                at = close.end() if close else len(html)

    def text(self, raw: str) -> None:
        if raw:
            if self.open[-1].tag == "head" and raw.strip(" \t\n\r\f"):
                self.open.pop()
            self.add(unescape(raw) if "&" in raw else raw)

    def add(self, child: Node | str) -> None:
        """Into the innermost open element, if that is displayed."""
        if self.buried:
            _, displayed, visibility = self.buried[-1]
            if not displayed:
                return
            if visibility is not None:
                shell = Node(SHELL)
                shell.visibility, shell.children = visibility, [child]
                child = shell
        self.open[-1].children.append(child)

    def start(self, tag: str, attributes: str) -> None:
        if tag in ("html", "body") and any(n.tag == tag for n in self.open):
            return
        if tag == "head" and any(isinstance(c, Node) or c.strip(" \t\n\r\f") for c in self.root.children):
            return  # a page has one head, before all else
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self.open.pop()
        if self.buried:
            # A row, cell or item of a table or list further up ends what strays open in it.
            scope = CONTEXT.get(tag) or IMPLIED.get(tag, ((), ()))[1]
            if not scope or any(self.counts[x] for x in scope) or not self.nearest(scope):
                self.bury(tag, attributes)
                return
            self.unbury()
        if self.foreign and tag in BREAKOUT:
            while (k := self.nearest(FOREIGN | INTEGRATION)) and self.open[k].tag in FOREIGN:
                del self.open[k:]
        self.foreign = self.foreign or tag in FOREIGN
        if tag in CLOSES_P:
            self.close({"p"}, _words("table td th caption li button object"))
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        if tag in IMPLIED:
            self.close(*IMPLIED[tag])
        if tag in CONTEXT and (k := self.nearest(CONTEXT[tag])):
            del self.open[k + 1 :]
        if tag in CELLS and self.open[-1].tag in TABLE_PARTS | {"table"}:
            self.push(Node("tr", depth=len(self.open)))
        node = Node(tag, attributes.rstrip("/"), len(self.open))
        empty = tag in VOID
        if tag == "form":  # between rows or cells it holds nothing
            empty = self.open[-1].tag in TABLE_PARTS | _words("table tr")
        elif self.foreign and _SELF_CLOSED.search(attributes):
            k = self.nearest(FOREIGN | {"foreignobject"})
            empty = empty or tag in FOREIGN or bool(k) and self.open[k].tag in FOREIGN
        if empty:
            self.open[-1].children.append(node)
        else:
            self.push(node)

    def push(self, node: Node) -> None:
        if len(self.open) > MAX_DEPTH:
            self.bury(node.tag, node.attributes)
            return
        self.open[-1].children.append(node)
        self.open.append(node)

    def bury(self, tag: str, attributes: str) -> None:
        """Open an element below the greatest depth; style sheets that stand before it count."""
        node = Node(tag, attributes.rstrip("/"))
        if len(self.sheets) > self.known:
            self.rules, self.known = Rules(self.sheets), len(self.sheets)
        if self.rules:
            node.style(self.rules)
        if tag in VOID:
            if node.displayed:
                self.add(node)
            return
        _, displayed, visibility = self.buried[-1] if self.buried else ("", True, None)
        self.buried.append((tag, displayed and node.displayed, visibility if node.visibility is None else node.visibility))
        self.counts[tag] += 1
        self.add(Node("div") if tag in BLOCK else " " if tag in CELLS else "")

    def unbury(self) -> None:
        self.buried, self.counts = [], Counter()

    def nearest(self, tags) -> int:
        """The place of the innermost open element of ``tags``, 0 if there is none."""
        return next((k for k in range(len(self.open) - 1, 0, -1) if self.open[k].tag in tags), 0)

    def close(self, tags, scope) -> None:
        """End the outermost open element of ``tags`` above the nearest one of ``scope``."""
        found = None
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                found = k
            elif self.open[k].tag in scope:
                break
        if found:
            del self.open[found:]

    def end(self, tag: str) -> None:
        if tag == "br":
            if self.open[-1].tag == "head":
                self.open.pop()
            self.add(Node("br"))
            return
        if self.counts[tag]:
            while True:
                last, *_ = self.buried[-1]
                if last in BLOCK:
                    self.add(Node("div"))
                self.buried.pop()
                self.counts[last] -= 1
                if last == tag:
                    return
        inner = tag not in ("table", "body", "html")
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                self.unbury()
                return
            if inner and (self.open[k].tag == "table" or self.open[k].tag in CELLS and tag not in TABLE_PARTS | {"tr"}):
                break
        if tag == "p":
            self.add(Node("p"))


def visible(node: Node) -> bool:
    """Is the element displayed? Whether its text shows is the page's state, see :func:`inside`."""
    return node.displayed


class Page:
    """Lines under construction."""

    def __init__(self, shows: bool = True):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = -1  # -1: a line is open; 0: the next text opens a line; 1: after a blank line
        self.blank = False  # white space seen since the last text of the open line
        self.indent, self.marker = "", ""
        self.shows = shows  # is text visible here?

    def put(self, text: str) -> None:
        if not self.shows:
            return
        pieces = _BLANKS.sub(" ", text)
        if pieces.strip(" ") == "":
            self.blank = self.blank or bool(pieces)
            return
        if self.gap >= 0 or not self.line:
            self.open_line()
        elif self.blank or pieces[0] == " ":
            self.line.append(" ")
        self.line.append(pieces.strip(" "))
        self.blank = pieces[-1] == " "

    def open_line(self) -> None:
        if self.gap == 1 and self.lines and self.lines[-1] != "":
            self.lines.append("")
        self.gap, self.blank = -1, False
        self.line = [self.indent[: len(self.indent) - len(self.marker)] + self.marker if self.marker else self.indent]
        self.marker = ""

    def end_line(self, gap: int) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        self.gap, self.blank = max(self.gap, gap), False

    def line_break(self) -> None:
        if self.line:
            self.end_line(0)
        elif self.lines:
            self.lines.append("")

    def whole(self, lines: list[str], gap: int) -> None:
        """Finished lines as a block of their own."""
        self.end_line(gap)
        for line in lines:
            self.open_line()
            self.line.append(line)
            self.end_line(0)
        self.gap = gap

    def finish(self) -> list[str]:
        self.end_line(0)
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def render(node: Node, page: Page) -> None:
    before = page.shows
    if node.visibility is not None:
        page.shows = node.visibility
    laid_out(node, page)
    page.shows = before


def laid_out(node: Node, page: Page) -> None:
    tag = node.tag
    gap = 1 if tag in SPACED else 0
    if tag in BLOCK:
        # A list inside a list item follows without a blank line.
        if tag in ("ul", "ol") and page.indent:
            gap = 0
        page.end_line(gap)
    if tag == "table":
        page.whole(table_lines(node, page.shows), 1)
        return
    if tag == "svg":
        for part in drawn(node):
            page.put(" ")
            render(part, page)
            page.put(" ")
        return
    if tag in PREFORMATTED:
        text = "".join(plain(node, page.shows))
        page.whole(text.removeprefix("\n").rstrip("\n").replace("\t", "    ").split("\n") if text.strip() else [], gap)
        return
    if tag == "details" and node.get("open") is None:
        for child in node.children:
            if isinstance(child, Node) and child.tag == "summary":
                render(child, page)
    elif tag in ("ul", "ol", "menu", "dir"):
        render_list(node, page)
    elif tag in ("blockquote", "dd"):
        within(node, page, "  ")
    else:
        if tag == "q":
            page.put("“")
        inside(node, page)
        if tag == "q":
            page.put("”")
    if tag in BLOCK:
        page.end_line(gap)


def inside(node: Node, page: Page) -> None:
    put_all(node.children, page)


def put_all(children, page: Page) -> None:
    for child in children:
        if isinstance(child, str):
            page.put(child)
        elif child.tag == "br":
            page.line_break()
        elif child.tag == "hr":
            page.end_line(1)
        elif visible(child):
            if child.tag in CELLS:  # a cell outside any table
                page.put(" ")
            render(child, page)


def within(node: Node, page: Page, more: str, marker: str = "") -> None:
    before = page.indent
    page.indent, page.marker = before + more, marker
    inside(node, page)
    page.end_line(0)
    page.indent, page.marker = before, ""


def whole_number(text: str | None) -> int | None:
    """A whole number as HTML reads it, if it lies in its bounds."""
    m = re.match(r"\s*([+-]?[0-9]{1,12})(?![0-9])", text or "")
    return int(m[1]) if m and abs(int(m[1])) <= MAX_INT else None


def render_list(node: Node, page: Page) -> None:
    items = [c for c in node.children if isinstance(c, Node) and c.tag == "li" and visible(c)]
    down = node.tag == "ol" and node.get("reversed") is not None
    start = whole_number(node.get("start"))
    count = start if start is not None else len(items) if down else 1
    for child in node.children:
        if isinstance(child, str):
            page.put(child)
        elif child.tag == "li" and visible(child):
            if (value := whole_number(child.get("value"))) is not None:
                count = value
            marker = f"{count}. " if node.tag == "ol" else "- "
            count += -1 if down else 1
            page.end_line(0)
            before = page.shows
            page.shows = before if child.visibility is None else child.visibility
            within(child, page, " " * len(marker), marker)
            page.shows = before
        elif visible(child):
            render(child, page)


def plain(node: Node, shows: bool) -> Iterator[str]:
    for child in node.children:
        if isinstance(child, str):
            if shows:
                yield child
        elif child.tag == "br":
            yield "\n"
        elif visible(child):
            here = shows if child.visibility is None else child.visibility
            if child.tag == "svg":
                for part in drawn(child):
                    yield " "
                    yield from plain(part, here)
            else:
                yield from plain(child, here)


def drawn(node: Node) -> Iterator[Node]:
    """The elements of a drawing whose text is shown; text elsewhere in it is not."""
    for child in node.children:
        if isinstance(child, Node) and child.tag not in UNDRAWN and visible(child):
            if child.visibility is None:
                child.visibility = node.visibility  # the parts between are not rendered themselves
            if child.tag in ("text", "foreignobject"):
                yield child
            else:
                yield from drawn(child)


def table_rows(node: Node, shows: bool) -> Iterator[tuple[Node, bool]]:
    """The rows of a table, with whether their text is visible."""
    for child in node.children:
        if isinstance(child, Node) and visible(child):
            here = shows if child.visibility is None else child.visibility
            if child.tag == "tr":
                yield child, here
            elif child.tag in TABLE_PARTS:
                yield from table_rows(child, here)


def strays(node: Node) -> Iterator[Node | str]:
    """What stands in a table, its parts and rows outside cells, in order."""
    for child in node.children:
        if isinstance(child, str):
            yield child
        elif node.tag == "tr":
            if child.tag not in CELLS:
                yield child
        elif child.tag == "tr" or child.tag in TABLE_PARTS:
            if visible(child):
                yield from strays(child)
        else:
            yield child


def table_lines(node: Node, shows: bool) -> list[str]:
    """The caption, what stands in the table outside its cells, then rows with cells padded to columns."""
    page = Page(shows)
    put_all(strays(node), page)
    out = page.finish()
    rows, taken = [], {}
    for row, shown in table_rows(node, shows):
        cells, column = [], 0
        for cell in row.children:
            if not isinstance(cell, Node) or cell.tag not in CELLS or not visible(cell):
                continue
            while taken.get(column, 0):  # held by a cell of a row above
                taken[column] -= 1
                column += 1
            sub = Page(shown)
            render(cell, sub)
            span, down = (min(max(whole_number(cell.get(n)) or 1, 1), most) for n, most in (("colspan", MAX_COLSPAN), ("rowspan", MAX_ROWSPAN)))
            cells.append((column, span, sub.finish()))
            for c in range(column, column + span if down > 1 else column):
                taken[c] = taken.get(c, 0) + down - 1
            column += span
        for c in [c for c in taken if c >= column and taken[c]]:
            taken[c] -= 1
        rows.append(cells)
    widths: dict[int, int] = {}
    for cells in rows:
        for column, span, lines in cells:
            if span == 1:
                widths[column] = max([widths.get(column, 0), *map(len, lines)])
    starts, at = {}, 0
    for column in range(max(widths, default=-1) + 1):
        starts[column] = at
        at += min(widths[column], COLUMN) + 2 if widths.get(column) else 0
    for cells in rows:
        for k in range(max((len(lines) for *_, lines in cells), default=0)):
            line = ""
            for column, _, lines in cells:
                if k < len(lines) and lines[k]:
                    line = (line.ljust(starts.get(column, 0)) if len(line) + 2 <= starts.get(column, 0) or not line else line + "  ") + lines[k]
            out.append(line.rstrip(" "))
    return out


def visible_text(html: str) -> str:
    """All visible text of a page, laid out."""
    page = Page()
    render(TreeBuilder().build(html), page)
    return "\n".join(page.finish())


def page_texts(pages: DataFrame) -> DataFrame:
    """``(page_id, text, n_lines)`` for every row of ``pages(page_id, html, ...)``.

    Null or empty HTML has an empty text without lines. Broken markup is
    repaired, never an error. Repeated rows and null ids are kept; other columns
    are ignored; an empty table gives no rows. Pages are handled one at a time.
    """
    on_workers(pages.sparkSession)
    schema = pa.schema([("page_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64())])

    def build(batch) -> Iterator[tuple]:
        for page_id, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = visible_text(cell.as_py() or "")
            yield page_id, text, text.count("\n") + 1 if text else 0

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(lambda batches: rows_of(batches, schema, build, 200), "page_id long, text string, n_lines long")
