"""HTML extraction by layout-aware rendering.

A tree builder reads a page with the implied tags of HTML (``<p>`` closed by the next
block, ``<li>``, ``<tr>``, ``<td>``, ``<option>``... by their likes, missing end tags at the
end); ``html_tags.py`` cuts its tags. Visibility rules (``html_visibility.py``) leave out what
a browser doesn't show. The tree is rendered as
text: blocks on lines of their own with blank lines where margins are, lists with markers
and indents, table cells in aligned columns, preformatted text as it stands.
"""

from __future__ import annotations

import hashlib
import html
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.html_tags import Tag, raw_end, tokens
from kestrel.llm.html_visibility import Rules, keep_visible

# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head script style template title noscript iframe object audio video canvas datalist "
    "noembed noframes meta link base param source track area annotation annotation-xml mphantom".split())
#: Start tags that an open <head> holds; any other ends it.
HEAD = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: Of svg and math: start tags that end them, elements with HTML inside, and svg that isn't drawn in place.
BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu "
    "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
INTEGRATION = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
UNDRAWN = frozenset("defs symbol clippath mask pattern marker metadata desc lineargradient radialgradient filter".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol p "
    "pre search section summary table tbody td tfoot th thead tr ul caption xmp optgroup".split())
SPACED = frozenset("p blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol pre table ul menu dir fieldset".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
#: Start tags that close an open <p>.
CLOSES_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption optgroup".split())
#: start tag -> (open elements it closes, elements beyond which it doesn't look)
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select",)), "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "thead": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "body": (("head",), ("html",)),
}
SCOPE = frozenset("table td th caption html object template".split())  # end tags don't reach out
P_SCOPE = SCOPE | {"button"}
MAX_INDENT = 400  # columns; text that is nested deeper is indented by as many
MAX_TABLES = 64   # within one another; cells of deeper ones stand one below another
COLUMN_GAP = "  "

MATH_PARTS = frozenset("mfrac mroot mtable mtr mlabeledtr".split())
_SHEET = re.compile(r"\s*(?:text/css)?\s*", re.IGNORECASE)
_MEDIA = re.compile(r"\s*(?:(?:only\s+)?(?:all|screen)\s*(?:,.*)?)?", re.IGNORECASE | re.DOTALL)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "rows", "foreign", "hidden")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []
        self.rows = False  # has rows of the table that it is in
        self.foreign = False  # svg or math, where tags follow other rules
        self.hidden = False   # it is there for the visible elements in it, or for its place


class Open(list):
    """The open elements, and where those of each tag stand: no look-up walks through the
    elements, of which a page that leaves out end tags has as many as tags."""

    def __init__(self, root: Node):
        super().__init__()
        self.at: dict[str, list[int]] = defaultdict(list)
        self.blocks: list[int] = []
        self.ended: set[int] = set()  # formatting that ended while blocks inside are open
        self.push(root)

    def push(self, node: Node) -> None:
        self.at[node.tag].append(len(self))
        if node.tag in BLOCK:
            self.blocks.append(len(self))
        self.append(node)

    def last(self, tags) -> int:
        return max([places[-1] for t in tags if (places := self.at.get(t))], default=-1)

    def first_beyond(self, edge: int, tags) -> int | None:
        found = [places[i] for t in tags if (places := self.at.get(t))
                 and (i := bisect_right(places, edge)) < len(places)]
        return min(found, default=None)

    def cut(self, i: int) -> None:
        """Close the elements from the i-th on, and ended ones that are then the innermost."""
        while len(self) > i or len(self) - 1 in self.ended:
            tag = self.pop().tag
            if len(self) in self.ended:
                self.ended.remove(len(self))
                continue
            self.at[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def leave(self) -> None:
        self.cut(len(self) - 1)

    def end_formatting(self, i: int) -> None:
        self.at[self[i].tag].pop()
        self.ended.add(i)


def parse(source: str, sheets: list[str] | None = None) -> Node:
    """The element tree of a page; the texts of its style sheets are added to ``sheets``."""
    root = Node("html")
    stack, at = Open(root), 0

    def text(piece: str, unescape=html.unescape) -> None:
        if piece:
            piece = unescape(piece)
            if stack[-1].tag in ("colgroup", "head") and piece.strip(" \t\n\r\f"):
                stack.leave()
            stack[-1].children.append(piece)

    markup = tokens(source)
    for start, end, what in markup:
        text(source[at:start])
        at = end
        if not isinstance(what, Tag):
            text(what or "", str)  # a CDATA section
            continue
        tag, attrs = what.name, what.attrs
        if what.end:
            _end(stack, tag)
            continue
        if tag in ("html", "body") and stack.at.get(tag):
            continue
        foreign = stack[-1].foreign and stack[-1].tag not in INTEGRATION
        if foreign and (tag in BREAKOUT or tag == "font" and not attrs.keys().isdisjoint(("color", "face", "size"))):
            while stack[-1].foreign and stack[-1].tag not in INTEGRATION:
                stack.leave()
            foreign = False
        if stack[-1].tag == "head" and tag not in HEAD:
            stack.leave()  # its end tag and the start tag of the body may be left out
        if stack[-1].tag == "colgroup" and tag not in ("col", "template"):
            stack.leave()  # its end tag may be left out
        if tag in ("tr", "td", "th") or tag in CLOSES_P or tag in IMPLIED:
            _implied(stack, tag)
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag == "tr":
            _has_row(stack)
        node.foreign = foreign or tag in ("svg", "math")
        if tag in VOID or node.foreign and what.closed:
            continue
        if tag in RAW:
            start = at
            end, at = raw_end(source, tag, at)
            body = source[start:end]
            node.children.append(html.unescape(body) if tag in ("textarea", "title") else body)
            if sheets is not None and tag == "style" and not (stack.at.get("template") or stack.at.get("noscript")) \
                    and _SHEET.fullmatch(attrs.get("type", "")) and _MEDIA.fullmatch(attrs.get("media", "")):
                sheets.append(body)
            markup.send(at)
            continue
        stack.push(node)
    text(source[at:])
    return root


def _implied(stack: Open, tag: str) -> None:
    """End tags that a start tag implies, and the rows of tables."""
    if tag in CLOSES_P and stack.at.get("p") and (i := stack.last(("p",))) > stack.last(P_SCOPE):
        stack.cut(i)
    if tag in IMPLIED:
        closes, edge = IMPLIED[tag]
        i = stack.first_beyond(max(0, stack.last(edge)), closes)
        if i is not None:
            stack.cut(i)
    if tag in ("td", "th") and stack[-1].tag in ("table", "tbody", "thead", "tfoot"):
        row = Node("tr")
        stack[-1].children.append(row)
        _has_row(stack)
        stack.push(row)


def _has_row(stack: list[Node]) -> None:
    for node in reversed(stack):
        if node.tag == "table" or node.rows:
            break
        node.rows = True


def _end(stack: Open, tag: str) -> None:
    if tag == "br":
        stack[-1].children.append(Node("br"))
        return
    if tag in ("html", "body"):
        return  # what follows still belongs to the page
    i = stack.last((tag,))
    if tag not in SCOPE and tag not in ("tr", "tbody", "thead", "tfoot") and stack.last(SCOPE) > max(i, 0):
        return
    if i > 0:
        if tag in FORMATTING and stack.blocks[-1] > i:
            stack.end_formatting(i)  # the blocks that it opened stay open
        else:
            stack.cut(i)
        return
    if tag == "p":
        stack[-1].children.append(Node("p"))


class Page:
    """Lines of text under construction. Margins collapse: only the largest pending one is
    laid out, when the next text comes."""

    def __init__(self, tables: int = 0):
        self.tables = tables      # that it stands in
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0              # blank lines due before the next line
        self.space = False        # a collapsed space is due before the next word
        self.indent = 0
        self.marker = ""          # of a list item, for its first line

    def text(self, s: str, pre: bool) -> None:
        if pre:
            first, *more = s.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.line.append(first)
            for piece in more:
                self.end_line(keep=True)
                self.line.append(piece)
            return
        words = _SPACE.sub(" ", s)
        if not words:
            return
        if words[0] == " ":
            self.space = True
            words = words[1:]
        if not words:
            return
        if self.space and self.line:
            self.line.append(" ")
        self.space = words[-1] == " "
        self.line.append(words[:-1] if self.space else words)

    def end_line(self, keep: bool = False) -> None:
        """Finish the line; an empty one stays only where ``keep`` asks for it."""
        line = "".join(self.line).rstrip()
        self.line, self.space = [], False
        if line or keep:
            if self.lines and self.gap:
                self.lines += [""] * self.gap
            self.gap = 0
            indent = min(self.indent, MAX_INDENT) - len(self.marker)
            self.lines.append((" " * indent + self.marker + line).rstrip())
            if line:
                self.marker = ""

    def margin(self, lines: int) -> None:
        self.end_line()
        self.gap = max(self.gap, lines)

    def done(self) -> str:
        self.end_line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return "\n".join(self.lines)


#: Rendering functions yield what is to be rendered before they go on, so that no nesting
#: of a page is too deep for the interpreter's stack.
Steps = Iterator["Steps"]


def _run(steps: Steps) -> None:
    open_steps = [steps]
    while open_steps:
        inner = next(open_steps[-1], None)
        if inner is None:
            open_steps.pop()
        else:
            open_steps.append(inner)


def _render(node: Node, page: Page, pre: bool, depth: int) -> Steps:
    for child in node.children:
        if isinstance(child, str):
            page.text(child, pre)
        else:
            yield _element(child, page, pre, depth)


def _element(node: Node, page: Page, pre: bool, depth: int) -> Steps:
    tag = node.tag
    if tag == "br":
        page.end_line(keep=True)
        return
    if tag == "hr":
        page.margin(1)
        return
    if tag == "img" or tag == "wbr":
        return
    if tag == "input":
        if node.attrs.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
            page.text(node.attrs.get("value", ""), False)
        return
    if node.foreign and (tag == "svg" or tag in MATH_PARTS):
        yield (_svg if tag == "svg" else _math_parts)(node, page, depth)
        return
    if tag == "table":
        page.margin(1)
        yield _table(node, page, depth)
        page.margin(1)
        return
    if tag in ("ul", "ol", "menu", "dir"):
        page.margin(1 if not depth else 0)
        yield _list(node, page, pre, depth)
        page.margin(1 if not depth else 0)
        return
    if tag == "details" and "open" not in node.attrs:
        for child in node.children:  # closed: only its summary shows
            if isinstance(child, Node) and child.tag == "summary":
                page.margin(0)
                yield _render(child, page, pre, depth)
                page.margin(0)
                break
        return
    if tag == "option" or tag == "legend":
        page.margin(0)
    if tag == "optgroup" and not node.hidden:
        page.margin(0)
        page.text(node.attrs.get("label", ""), False)
    spaced = 1 if tag in SPACED else 0
    if tag in BLOCK:
        page.margin(spaced)
        inner = 2 if tag in ("blockquote", "dd") else 0
        page.indent += inner
        yield _render(node, page, pre or tag in ("pre", "xmp"), depth)
        page.margin(spaced)
        page.indent -= inner
        return
    if tag == "textarea":
        pre = True
    if tag == "q" and not node.hidden:
        page.text("“", False)
    yield _render(node, page, pre, depth)
    if tag == "q" and not node.hidden:
        page.text("”", False)


def _svg(node: Node, page: Page, depth: int) -> Steps:
    """The texts of a drawing, each on a line of its own, and HTML inside of it."""
    for child in node.children:
        if isinstance(child, str) or child.tag in UNDRAWN:
            continue
        if child.tag in ("text", "foreignobject"):
            page.margin(0)
            yield (_svg_text if child.tag == "text" else _render)(child, page, False, depth)
            page.margin(0)
        else:
            yield _svg(child, page, depth)


def _svg_text(node: Node, page: Page, pre: bool, depth: int) -> Steps:
    for child in node.children:
        if isinstance(child, str):
            page.text(child, pre)
        elif child.tag not in UNDRAWN:
            if not child.attrs.keys().isdisjoint(("x", "y", "dy")):
                page.space = True  # it stands elsewhere
            yield _svg_text(child, page, pre, depth)


def _math_parts(node: Node, page: Page, depth: int) -> Steps:
    """Parts of a formula that stand apart."""
    for child in node.children:
        page.space = True
        if isinstance(child, str):
            page.text(child, False)
        else:
            yield _element(child, page, False, depth)
    page.space = True


def _number(value: str | None, default: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return int(m[1]) if m else default


def _marker(kind: str, number: int) -> str:
    """Of an item of a numbered list: figures, letters (a to z, aa, ...) or Roman numerals;
    figures where a number has no such form."""
    if kind in ("a", "A") and number > 0:
        out = ""
        while number:
            number, letter = divmod(number - 1, 26)
            out = chr(ord(kind) + letter) + out
        return out + ". "
    if kind in ("i", "I") and 0 < number < 4000:
        out = ""
        for value, sign in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"),
                            (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
            out += sign * (number // value)
            number %= value
        return (out if kind == "i" else out.upper()) + ". "
    return f"{number}. "


def _list(node: Node, page: Page, pre: bool, depth: int) -> Steps:
    step = -1 if node.tag == "ol" and "reversed" in node.attrs else 1
    items = sum(isinstance(child, Node) and child.tag == "li" for child in node.children)
    number = _number(node.attrs.get("start"), 1 if step == 1 else items)
    for child in node.children:
        if isinstance(child, str):
            page.text(child, pre)
            continue
        if child.tag != "li":
            yield _element(child, page, pre, depth + 1)
            continue
        if node.tag == "ol":
            number = _number(child.attrs.get("value"), number)
        marker = _marker(child.attrs.get("type", node.attrs.get("type", "")), number) if node.tag == "ol" else "- "
        number += step
        page.margin(0)
        page.indent += len(marker)
        page.marker = marker if not child.hidden else ""
        yield _render(child, page, pre, depth + 1)
        page.margin(0)
        page.marker = ""
        page.indent -= len(marker)


def _table_parts(table: Node) -> tuple[list[Node], list[Node | str | None]]:
    """The rows of a table, also through row groups and any other element that they stand
    in, and its other content; None where a line ends."""
    rows, stray = [], []
    todo = [iter(table.children)]
    while todo:
        child = next(todo[-1], None)
        if child is None:
            todo.pop()
            stray.append(None)
        elif isinstance(child, str):
            stray.append(child)
        elif child.tag == "col":
            continue
        elif child.tag == "tr":
            rows.append(child)
            stray.append(None)
        elif child.tag in ("tbody", "thead", "tfoot", "colgroup") \
                or child.rows and child.tag != "table" and (child.tag != "details" or "open" in child.attrs):
            stray.append(None)
            todo.append(iter(child.children))
        else:
            stray.append(child)
    return rows, stray


def _table(node: Node, page: Page, depth: int) -> Steps:
    """Rows of cells in columns as wide as their widest line; captions and stray content
    come first."""
    rows, stray = _table_parts(node)
    for child in stray:
        if child is None:
            page.margin(0)
        elif isinstance(child, str):
            page.text(child, False)
        else:
            yield _element(child, page, False, depth)
            page.margin(0)
    page.end_line()
    if page.tables >= MAX_TABLES:
        for row in rows:
            yield _element(row, page, False, depth + 1)
        return
    grid: list[list[tuple[int, int, list[str]]]] = []  # per row: (column, span, lines)
    busy: dict[int, int] = {}  # column -> rows that a cell above still covers
    for row in rows:
        cells, column = [], 0
        stray = Node("td")
        for cell in row.children:
            if isinstance(cell, Node) and cell.tag in ("td", "th"):
                while busy.get(column, 0) > 0:
                    column += 1
                span = max(1, min(1000, _number(cell.attrs.get("colspan"), 1)))
                down = max(1, _number(cell.attrs.get("rowspan"), 1))
                own = Page(page.tables + 1)
                yield _render(cell, own, False, depth + 1)
                cells.append((column, span, own.done().split("\n")))
                if down > 1:
                    for c in range(column, column + span):
                        busy[c] = down
                column += span
            else:
                stray.children.append(cell)
        for c in list(busy):
            busy[c] -= 1
        own = Page(page.tables + 1)
        yield _render(stray, own, False, depth + 1)
        if text := own.done():  # content outside of cells
            page.text(text, True)
            page.end_line()
        if cells:
            grid.append(cells)
    if not grid:
        return
    width = [0] * max(c + s for cells in grid for c, s, _ in cells)
    spanning = sorted(((s, c, max(map(len, lines))) for cells in grid for c, s, lines in cells))
    for span, column, need in spanning:  # single cells first, then the spans' missing part
        have = sum(width[column:column + span]) + len(COLUMN_GAP) * (span - 1)
        if need > have:
            width[column + span - 1] += need - have
    start = [0]
    for w in width:
        start.append(start[-1] + (w + len(COLUMN_GAP) if w else 0))
    for cells in grid:
        for i in range(max(len(lines) for _, _, lines in cells)):
            line = ""
            for column, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(start[column]) + lines[i]
            page.line = [line]
            page.end_line()


def extract(source: str | None) -> str:
    """The visible text of a page as laid out lines."""
    if not source:
        return ""
    sheets: list[str] = []
    root, rules = parse(source, sheets), Rules()
    for sheet in sheets:
        rules.add(sheet)
    keep_visible(root, rules, UNSEEN)
    page = Page()
    _run(_render(root, page, False, 0))
    return page.done()


def extract_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """page_id, text, n_lines, text_sha256 of every row.

    Null and empty pages, and pages with nothing to see, give an empty text of no lines.
    Every row stands alone: repeated rows give repeated results, a null id stays null,
    other columns are ignored whatever their names, an empty table gives no rows. Long pages
    are read whole, in time that grows with their length; a page is one value of a task.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [extract(s) for s in batch["html"]]
            yield pd.DataFrame({
                "page_id": batch["page_id"], "text": texts,
                "n_lines": [t.count("\n") + 1 if t else 0 for t in texts],
                "text_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in texts]})

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col).cast("string").alias("page_id"),
                        F.col(html_col).cast("string").alias("html")) \
                .mapInPandas(run, "page_id string, text string, n_lines int, text_sha256 string") \
                .withColumn("page_id", F.col("page_id").cast(kind))
