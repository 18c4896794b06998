"""Visible text of web pages, laid out as a browser would.

A tree builder reads the tags in one pass and supplies what authors leave out: a new paragraph,
item, row, cell or option ends the open one, void elements have no content, an end tag closes
what is still open inside its element, a stray one is ignored. Elements that are never shown
(scripts, style sheets, templates, anything hidden by attribute or inline style) are kept out of
the tree, without losing what follows them. Rendering then emits all other text: blocks on
lines of their own, paragraphs and headings apart by an empty line, lists with marks and indents,
preformatted text as it is, and tables as aligned columns. Cells that span rows or columns hold their
places in the grid: a row span ends with its row group, a wide cell widens the last column it spans, and a
high one the last row.

Defined results: null and empty pages give the empty text; malformed markup never fails, text
outside any element is visible; character references without meaning stay as written. White space
at line ends is dropped, more than one empty line becomes one (but for preformatted text).
Nesting of every depth is kept: the tree builder knows the place of each open tag, and the layout's
functions are generators that hand their inner calls to a work list, so no page exhausts the stack.
"""

import re
import unicodedata
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Generator, Iterator
from html import unescape
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript".split())
RAW_WITH_REFERENCES = frozenset("textarea title".split())
UNSEEN = frozenset(
    "head title script style template noscript iframe object applet audio video canvas "
    "noembed noframes svg math datalist rp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol optgroup option p pre search section summary table ul xmp "
    "caption thead tbody tfoot tr".split())
APART = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote ul ol dl menu dir pre xmp table figure fieldset hr".split())
LISTS = frozenset("ul ol menu dir".split())
KEEP_DISPLAY = LISTS | frozenset("table pre xmp hr details textarea".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ENDS_PARAGRAPH = BLOCK - frozenset(
    "body html option optgroup legend caption thead tbody tfoot tr".split())
# A start tag ends the nearest open one of these, unless a boundary lies between.
ENDS = {
    "li": (("li",), LISTS | {"table"}),
    "dt": (("dt", "dd"), frozenset(("dl", "table"))),
    "dd": (("dt", "dd"), frozenset(("dl", "table"))),
    "option": (("option",), frozenset(("select", "datalist", "optgroup"))),
    "optgroup": (("optgroup", "option"), frozenset(("select",))),
    "tr": (("tr",), frozenset(("table",))),
    "td": (("td", "th"), frozenset(("table", "tr"))),
    "th": (("td", "th"), frozenset(("table", "tr"))),
    "thead": (("thead", "tbody", "tfoot", "caption", "colgroup"), frozenset(("table",))),
    "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup"), frozenset(("table",))),
    "tfoot": (("thead", "tbody", "tfoot", "caption", "colgroup"), frozenset(("table",))),
}
# End tags that do not reach beyond the cell they stand in.
SCOPE = frozenset(("table", "td", "th", "caption"))
TABLE_PARTS = {"table": frozenset()} | dict.fromkeys(
    ("caption", "thead", "tbody", "tfoot", "tr", "td", "th"), frozenset(("table",)))

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|</(?P<end>[A-Za-z][^\s/>]*)[^>]*(?:>|\Z)"
    r"|</[^A-Za-z>][^>]*(?:>|\Z)"
    r"|<(?P<start>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?", re.DOTALL)
_SUSPECT = re.compile(r"hidden|style|type|span|start|value|reversed|open", re.IGNORECASE)
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_WHITE = re.compile(r"[ \t\n\f\r]+")
_DISPLAY = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)", re.I)
_BLOCK_DISPLAYS = frozenset("block flex grid flow-root list-item table".split())
# Limits that HTML itself sets.
_MOST_COLUMNS, _MOST_ROWS, _LARGEST_NUMBER = 1000, 65534, 2**31 - 1


class Node:
    __slots__ = ("tag", "attributes", "children", "hidden")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None, hidden: bool = False):
        self.tag = tag
        self.attributes = attributes or {}
        self.children: list[Node | str] = []
        self.hidden = hidden


def _attributes(source: str) -> dict[str, str]:
    if not source or not _SUSPECT.search(source):
        return {}
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def _is_hidden(tag: str, attributes: dict[str, str]) -> bool:
    if tag in UNSEEN or "hidden" in attributes and attributes["hidden"].lower() != "until-found":
        return True
    style = attributes.get("style")
    return bool(style and _HIDING.search(style))


def parse(html: str) -> Node:
    """The tree below an unnamed root; hidden elements stay, marked, until their end is known."""
    root = Node("")
    stack = [root]
    at, size = 0, len(html)
    places: dict[str, list[int]] = defaultdict(list)  # of open elements on the stack, by tag

    def innermost(tags) -> int:
        return max((places[tag][-1] for tag in tags if places.get(tag)), default=0)

    def close(tags, boundary=frozenset()) -> None:
        depth = innermost(tags)
        if depth and depth >= innermost(boundary):
            for node in stack[depth:]:
                places[node.tag].pop()
            del stack[depth:]

    def add_text(text: str) -> None:
        if text and not stack[-1].hidden:
            stack[-1].children.append(text)

    while at < size:
        match = _MARKUP.search(html, at)
        if not match:
            add_text(unescape(html[at:]))
            break
        if match.start() > at:
            add_text(unescape(html[at:match.start()]))
        at = match.end()
        kind = match.lastgroup
        if kind == "cdata":
            add_text(match["cdata"])
        elif match["end"]:
            tag = match["end"].lower()
            if tag == "br":
                stack[-1].children.append(Node("br"))
            elif tag == "p" and not places["p"]:
                stack[-1].children.append(Node("p"))
            elif tag in HEADINGS:
                close(HEADINGS, SCOPE)
            elif tag not in ("body", "html"):
                close((tag,), TABLE_PARTS.get(tag, SCOPE))
        elif match["start"]:
            tag = match["start"].lower()
            source = match["attributes"] or ""
            if tag in ENDS_PARAGRAPH:
                close(("p",), SCOPE | {"button", "object"})
            if tag in ENDS:
                close(*ENDS[tag])
            if tag in ("body", "html"):
                if tag == "body":
                    close(("head",))
                continue
            if tag not in UNSEEN and stack[-1].tag == "head" and tag not in (
                    "meta", "link", "base"):
                close(("head",))
            attributes = _attributes(source)
            node = Node(tag, attributes, stack[-1].hidden or _is_hidden(tag, attributes))
            if not node.hidden:
                stack[-1].children.append(node)
            if tag in VOID or source.endswith("/") and tag in ("svg", "math", "path"):
                continue
            if tag in RAW or tag in RAW_WITH_REFERENCES:
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(html, at)
                text = html[at:end.start() if end else size]
                at = end.end() if end else size
                if not node.hidden:
                    node.children.append(
                        unescape(text) if tag in RAW_WITH_REFERENCES else text)
                continue
            places[tag].append(len(stack))
            stack.append(node)
    return root


def width(text: str) -> int:
    """Columns that a text takes; wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1
        for c in text)


class Layout:
    """Lines of one block, inline text being gathered, and the space still owed between them."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.owed = 0  # empty lines before the next text
        self.pending_blank = False

    def text(self, text: str) -> None:
        words = _WHITE.split(text)
        if len(words) > 1 and not words[0]:
            self.pending_blank = True
        joined = " ".join(w for w in words if w)
        if joined:
            if self.pending_blank and self.inline and not self.inline[-1].endswith("\n"):
                self.inline.append(" ")
            self.inline.append(joined)
            self.pending_blank = len(words) > 1 and not words[-1]

    def line_break(self) -> None:
        self.inline.append("\n")
        self.pending_blank = False

    def flush(self) -> None:
        if self.inline:
            text = "".join(self.inline).replace("\xa0", " ")
            if text.endswith("\n"):
                text = text[:-1]
            self.put([line.rstrip() for line in text.split("\n")])
            self.inline = []
        self.pending_blank = False

    def put(self, lines: list[str]) -> None:
        if lines:
            if self.lines:
                self.lines += [""] * self.owed
            self.owed = 0
            self.lines += lines

    def apart(self, lines: int = 1) -> None:
        self.flush()
        if self.lines:
            self.owed = max(self.owed, lines)


def _preformatted(node: Node) -> str:
    parts, open_lists = [], [iter(node.children)]
    while open_lists:
        for child in open_lists[-1]:
            if isinstance(child, str):
                parts.append(child)
            elif child.tag == "br":
                parts.append("\n")
            else:
                open_lists.append(iter(child.children))
                break
        else:
            open_lists.pop()
    return "".join(parts)


def _run(call: Generator):
    """The result of a layout function. What it yields are the calls that it needs, in order."""
    calls, result = [call], None
    while calls:
        try:
            inner = calls[-1].send(result)
        except StopIteration as done:
            calls.pop()
            result = done.value
        else:
            calls.append(inner)
            result = None
    return result


def _children(node: Node, out: Layout) -> Generator:
    for child in node.children:
        if isinstance(child, str):
            out.text(child)
        else:
            yield _element(child, out)


def _block(node: Node) -> Generator:
    inner = Layout()
    yield _children(node, inner)
    inner.flush()
    return inner.lines


def _list(node: Node, out: Layout) -> Generator:
    numbered = node.tag == "ol"
    items = [c for c in node.children if isinstance(c, Node) and c.tag == "li"]
    step = -1 if "reversed" in node.attributes else 1
    number = _int(node.attributes.get("start"), len(items) if step < 0 else 1)
    loose = Layout()
    for child in node.children:
        if isinstance(child, Node) and child.tag == "li":
            out.put(_flushed(loose))
            loose = Layout()
            number = _int(child.attributes.get("value"), number)
            mark = f"{number}. " if numbered else "- "
            number += step
            lines = (yield _block(child)) or [""]
            indent = " " * len(mark)
            out.put([(mark + lines[0]).rstrip(),
                     *((indent + line).rstrip() for line in lines[1:])])
        elif isinstance(child, str):
            loose.text(child)
        else:
            yield _element(child, loose)
    out.put(_flushed(loose))


def _flushed(layout: Layout) -> list[str]:
    layout.flush()
    return layout.lines


def _int(text: str | None, default: int) -> int:
    """An attribute's number; one beyond 32 bits counts as missing."""
    match = re.match(r"\s*([+-]?)0*(\d{1,11})", text or "", re.ASCII)
    number = int(match[1] + match[2]) if match else default
    return number if abs(number) <= _LARGEST_NUMBER else default


def _rows(node: Node, rows: list, captions: list, loose: Layout) -> Generator:
    row = None
    for child in node.children:
        if isinstance(child, str):
            loose.text(child)
        elif child.tag == "tr":
            rows.append((yield _cells(child, loose)))
            row = None
        elif child.tag in ("thead", "tbody", "tfoot", "form"):
            rows.append(None)  # row spans end here
            yield _rows(child, rows, captions, loose)
            rows.append(None)
            row = None
        elif child.tag in ("td", "th"):  # a cell without a row
            if row is None:
                row = []
                rows.append(row)
            row.append(_cell(child, (yield _block(child))))
        elif child.tag == "caption":
            captions.append((yield _block(child)))
        elif child.tag not in ("col", "colgroup"):
            yield _element(child, loose)


def _cells(node: Node, loose: Layout) -> Generator:
    cells = []
    for child in node.children:
        if isinstance(child, str):
            loose.text(child)
        elif child.tag in ("td", "th"):
            cells.append(_cell(child, (yield _block(child))))
        else:
            yield _element(child, loose)
    return cells


def _table(node: Node, out: Layout) -> Generator:
    rows: list = []
    captions: list = []
    loose = Layout()
    yield _rows(node, rows, captions, loose)
    out.put(_flushed(loose))
    for caption in captions:
        out.put(caption)
    for line in _grid_lines(*_placed(rows)):
        out.put([line])


def _cell(node: Node, lines: list[str]) -> tuple[list[str], int, int]:
    """A cell's lines and the columns and rows it asks for; 0 rows: all of its group."""
    columns = _int(node.attributes.get("colspan"), 1)
    rows = _int(node.attributes.get("rowspan"), 1)
    return (lines, min(max(columns, 1), _MOST_COLUMNS),
            min(rows, _MOST_ROWS) if rows >= 0 else 1)


def _placed(rows: list) -> tuple[list[tuple], int]:
    """The cells in their places of the grid, as (row, rows, column, columns, lines), and the
    number of rows. None in `rows` ends a row group."""
    cells, groups, group = [], [], []
    for row in rows:
        if row is None:
            groups.append(group)
            group = []
        else:
            group.append(row)
    groups.append(group)
    first = 0
    for group in groups:
        taken: dict[int, int] = {}  # column: the row from which it is free again
        for n, row in enumerate(group):
            column = 0
            for lines, columns, height in row:
                while taken.get(column, 0) > n:
                    column += 1
                height = min(height or len(group), len(group) - n)
                cells.append((first + n, height, column, columns, lines))
                if height > 1:
                    for c in range(column, column + columns):
                        taken[c] = max(taken.get(c, 0), n + height)
                column += columns
        first += len(group)
    return cells, first


def _grid_lines(cells: list[tuple], number: int) -> list[str]:
    """The text lines of a table."""
    widths: dict[int, int] = {}
    heights = [0] * number
    for row, rows, column, columns, lines in cells:
        if columns == 1:
            widths[column] = max([widths.get(column, 0), *map(width, lines)])
        if rows == 1:
            heights[row] = max(heights[row], len(lines))
    for row, rows, column, columns, lines in sorted(cells, key=lambda c: (c[3], c[1], c[:3])):
        if columns > 1:
            own = range(column, column + columns)
            short = max(map(width, lines), default=0) - 2 * (columns - 1) - sum(
                widths.get(c, 0) for c in own)
            if short > 0:
                widths[own[-1]] = widths.get(own[-1], 0) + short
    for row, rows, column, columns, lines in sorted(cells, key=lambda c: (c[1], c[0])):
        if rows > 1:
            heights[row + rows - 1] += max(0, len(lines) - sum(heights[row:row + rows]))
    used = sorted(widths)
    before = [0, *accumulate(widths[c] for c in used)]
    tops = [0, *accumulate(heights)]
    out = [""] * tops[-1]
    filled = [0] * tops[-1]
    for row, rows, column, columns, lines in sorted(cells, key=lambda c: c[2]):
        start = 2 * column + before[bisect_left(used, column)]
        for n, line in enumerate(lines, start=tops[row]):
            if line:
                out[n] += " " * max(start - filled[n], 2 if filled[n] else 0) + line
                filled[n] = width(out[n])
    return [line.rstrip() for line in out]


def _is_block(node: Node) -> bool:
    """By its tag, unless its style says otherwise. Lists and tables stay what they are."""
    found = _DISPLAY.search(node.attributes.get("style") or "")
    if found and node.tag not in KEEP_DISPLAY:
        display = found[1].lower()
        if display in _BLOCK_DISPLAYS:
            return True
        if display.startswith("inline"):
            return False
    return node.tag in BLOCK


def _element(node: Node, out: Layout) -> Generator:
    tag = node.tag
    if tag == "br":
        out.line_break()
        return
    if tag == "wbr" or tag == "input" and node.attributes.get("type", "").lower() == "hidden":
        return
    if tag == "input":
        if node.attributes.get("type", "").lower() in ("submit", "button", "reset"):
            out.text(node.attributes.get("value", ""))
        return
    if not _is_block(node):
        if tag == "textarea":
            out.inline.append(node.children[0] if node.children else "")
        else:
            yield _children(node, out)
        return
    apart = 1 if tag in APART else 0
    out.apart(apart)
    if tag in ("pre", "xmp"):
        text = _preformatted(node)
        lines = text.removeprefix("\n").rstrip().split("\n")
        out.put([line.rstrip("\r") for line in lines] if text.strip() else [])
    elif tag in LISTS:
        yield _list(node, out)
    elif tag == "table":
        yield _table(node, out)
    elif tag == "hr":
        out.put(["---"])
    elif tag in ("dd", "blockquote"):
        out.put([f"    {line}".rstrip() for line in (yield _block(node))])
    elif tag == "details" and "open" not in node.attributes:
        shut = Node("div")
        shut.children = [c for c in node.children if isinstance(c, Node) and c.tag == "summary"]
        out.put((yield _block(shut)))
    else:
        yield _children(node, out)
    out.apart(apart)


def render(html: str | None) -> str:
    """The visible text of a page."""
    if not html:
        return ""
    return "\n".join(_run(_block(parse(html.replace("\x00", ""))))).strip("\n")


def visible_text(html: Column) -> Column:
    @F.pandas_udf("string")
    def rendered(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([render(page) for page in batch], dtype=object)

    return rendered(html)
