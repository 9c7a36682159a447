"""Visible text of web pages: a tree builder with implied tags, then a layout of blocks."""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import ref
from millrace.llm.batches import fresh, map_texts

# Element classes of the HTML standard that decide parsing and layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes plaintext".split())
RCDATA = frozenset("textarea title".split())
#: Raw elements that browsers show as they stand, without character references.
SHOWN_RAW = frozenset("xmp plaintext".split())
HIDDEN = frozenset(
    "head script style template noscript iframe noembed noframes object audio video canvas datalist "
    "textarea title link meta base area param source track dialog".split()
)
#: Parts of pictures and formulas that are not drawn, by the element they must be inside.
UNDRAWN = {"desc": "svg", "defs": "svg", "annotation": "math", "annotation-xml": "math"}
BLOCK = frozenset(
    "address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol p plaintext pre search section "
    "summary table ul caption tbody thead tfoot tr optgroup option xmp text".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr details listing xmp".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul listing li dd dt".split()
)
PREFORMATTED = frozenset("pre listing xmp plaintext".split())
# Open elements that a start tag closes, and the ancestors that shield them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist", "table", "td", "th"}),
    "optgroup": ({"option", "optgroup"}, {"select", "table", "td", "th"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "colgroup": ({"colgroup", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
TABLE_PARTS = frozenset("table caption colgroup tbody thead tfoot tr td th".split())
HEAD_ONLY = frozenset("base link meta title style script noscript template head html".split())
SCOPE = frozenset("table td th caption button object template html".split())

_TAG = re.compile(r"<(?:!--.*?(?:--!?>|\Z)|[!?][^>]*(?:>|\Z)|(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(/?)(?:>|\Z))", re.S)
_LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")

#: Buttons whose caption is an attribute.
BUTTONS = frozenset("submit reset button".split())
#: Fixed values of the HTML standard: the most columns and rows that a cell spans.
COLUMNS, ROWS = 1_000, 65_534
#: A wider cell does not push its column further out, nor is any column further out than a line;
#: what comes behind then follows after two blanks. No text is lost by that.
CELL, LINE = 200, 4_000


class Node:
    """An element; ``front`` is what a table has to be preceded by, ``hide`` whether its own text
    is invisible, ``lines`` the laid out table."""

    __slots__ = ("tag", "attrs", "children", "front", "hide", "lines")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.front, self.hide, self.lines = [], False, []


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        out.setdefault(m[1].lower(), html.unescape(value))
    return out


def tokens(page: str):
    """``(kind, name, rest)``: "text", "raw", "start" or "end"; comments and declarations are left out."""
    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:], ""
            return
        m = _TAG.match(page, lt)
        if m is None or (m.end() == n and m[2] and not m[0].endswith(">")):
            # An unclosed quote: take the tag up to the next ">"; without one the page ends in it.
            unended = m is not None
            m = _LOOSE.match(page, lt)
            if m is None and unended:
                yield "text", page[at:lt], ""
                return
        if m is None:
            yield "text", page[at : lt + 1], ""
            at = lt + 1
            continue
        if lt > at:
            yield "text", page[at:lt], ""
        at = m.end()
        name = m[2]
        if not name:
            continue
        name = name.lower()
        if m[1]:
            yield "end", name, ""
            continue
        yield "start", name, m[3] or ""
        if name in RAW or name in RCDATA:
            # Nothing ends plaintext.
            stop = name != "plaintext" and re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>?", re.I).search(page, at)
            body = page[at : stop.start() if stop else n]
            if name in RCDATA:
                yield "text", body, ""
            elif name in SHOWN_RAW:
                yield "raw", body, ""
            at = stop.end() if stop else n
            yield "end", name, ""


class Tree:
    """Elements as a browser would nest them, close enough for layout."""

    def __init__(self):
        self.root = Node("html", {})
        self.open = [self.root]
        #: Whether anything stands loose in a table.
        self.loose = False
        #: Open elements by tag, so that closing what is not open costs nothing.
        self.held = Counter()

    def _push(self, node: Node) -> None:
        self.open.append(node)
        self.held[node.tag] += 1

    def _pop(self, k: int) -> None:
        """Close the open elements from place ``k`` on."""
        self.held.subtract(x.tag for x in self.open[k:])
        del self.open[k:]

    def _pop_to(self, names, shield) -> bool:
        if not any(self.held[x] for x in names):
            return False
        for k in range(len(self.open) - 1, 0, -1):
            tag = self.open[k].tag
            if tag in names:
                self._pop(k)
                return True
            if tag in shield:
                return False
        return False

    def start(self, name: str, attrs: dict[str, str], empty: bool = False) -> None:
        if name == "html" or (name == "body" and self.held["body"]):
            for k, v in attrs.items():
                self.open[0].attrs.setdefault(k, v)
            return
        if name not in HEAD_ONLY and self.held["head"]:
            self._pop_to({"head"}, set())
        if name in ENDS_P:
            self._pop_to({"p"}, SCOPE)
        if name == "table" and self.open[-1].tag in TABLE_PARTS - {"td", "th", "caption"}:
            self._pop_to({"table"}, set())
        if name in CLOSES:
            names, shield = CLOSES[name]
            while self._pop_to(names, shield):
                pass
        if name in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self.start("tr", {})
        if len(name) == 2 and name[0] == "h" and name[1] in "123456":
            if self.open[-1].tag[0] == "h" and self.open[-1].tag[1:] in tuple("123456"):
                self._pop(len(self.open) - 1)
        node = Node(name, attrs)
        if name in TABLE_PARTS or name in ("col", "style", "script", "template"):
            self.open[-1].children.append(node)
        else:
            self._place(node)
        if name not in VOID and not empty:
            self._push(node)

    def end(self, name: str) -> None:
        if name == "br":
            self.start("br", {})
        elif name == "p" and not self.held["p"]:
            self.start("p", {})
            self._pop(len(self.open) - 1)
        elif name not in ("html", "body"):
            # Blocks are not closed by the end of an inline element around them.
            if name in TABLE_PARTS:
                shield = {"table"}
            elif name in BLOCK or name in SCOPE:
                shield = SCOPE
            else:
                shield = BLOCK | SCOPE
            self._pop_to({name}, shield - {name})

    def text(self, data: str) -> None:
        if not data.strip(" \t\n\r\f"):
            self.open[-1].children.append(data)
            return
        if self.open[-1].tag == "head":
            self._pop(len(self.open) - 1)
        self._place(data)

    def _place(self, child) -> None:
        """Into the open element, or, between the parts of a table, in front of the table."""
        if self.open[-1].tag in TABLE_PARTS - {"td", "th", "caption"}:
            table = next((x for x in reversed(self.open) if x.tag == "table"), None)
            if table is not None:
                table.front.append(child)
                self.loose = True
                return
        self.open[-1].children.append(child)


def build(page: str) -> Node:
    tree = Tree()
    for kind, name, rest in tokens(page):
        if kind == "text":
            tree.text(name)
        elif kind == "raw":
            tree.text(name.replace("&", "&amp;"))
        elif kind == "end":
            tree.end(name)
        else:
            svg = rest.rstrip().endswith("/") and (tree.held["svg"] or tree.held["math"])
            attrs = attributes(rest) if rest.strip(" /\t\n\r\f") else {}
            if name in UNDRAWN and tree.held[UNDRAWN[name]]:
                attrs["hidden"] = ""
            tree.start(name, attrs, svg or (rest.rstrip().endswith("/") and name in ("svg", "math")))
    if tree.loose:
        settle(tree.root)
    return tree.root


def shown_options(select: Node) -> list[Node]:
    """What a closed select shows: the last selected option, else the first; a list shows all."""
    options, stack = [], [select]
    while stack:
        node = stack.pop()
        if node is not select and not seen(node):
            continue
        if node.tag == "option":
            options.append(node)
        else:
            stack += [x for x in reversed(node.children) if isinstance(x, Node)]
    a = select.attrs
    if "multiple" in a or (re.fullmatch("[0-9]{1,9}", a.get("size", "")) and int(a["size"]) > 1):
        return options
    chosen = [x for x in options if "selected" in x.attrs]
    return (chosen or options[:1])[-1:]


def laid_children(node: Node) -> list:
    """What an element lays out, in order."""
    return shown_options(node) if node.tag == "select" else node.children


def settle(root: Node) -> None:
    """Loose text of tables moved in front of them, each table once."""
    stack, opened = [root], set()
    while stack:
        node = stack.pop()
        todo, settled = node.children[::-1], []
        while todo:
            child = todo.pop()
            if isinstance(child, Node) and child.front and child not in opened:
                opened.add(child)
                todo += [child, *reversed(child.front)]
            else:
                settled.append(child)
        node.children = settled
        stack += [x for x in settled if isinstance(x, Node)]


def seen(node: Node) -> bool:
    """Whether an element is laid out at all."""
    a = node.attrs
    if node.tag in HIDDEN and not (node.tag == "dialog" and "open" in a):
        return False
    if not a:
        return True
    if "hidden" in a or (node.tag == "input"):
        return False
    return not ("style" in a and _UNSEEN.search(a["style"]))


class Page:
    """Lines of text; blank lines between spaced blocks are never doubled."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.indent: list[str] = []
        self.bullet = ""

    def write(self, text: str) -> None:
        text = _BLANKS.sub(" ", text)
        if not self.line:
            text = text.lstrip(" ")
        elif self.line[-1].endswith(" "):
            text = text.lstrip(" ")
        if text:
            self.line.append(text)

    def flush(self) -> None:
        text = "".join(self.line).rstrip(" ")
        self.line = []
        if text:
            self.put(text)

    def put(self, text: str) -> None:
        if self.lines and self.gap:
            self.lines.append("")
        self.gap = 0
        lead = "".join(self.indent)
        if self.bullet:
            lead = lead[: len(lead) - len(self.bullet)] + self.bullet
            self.bullet = ""
        self.lines.append(lead + text)

    def space(self) -> None:
        self.flush()
        self.gap = 1

    def text(self) -> str:
        self.flush()
        return "\n".join(self.lines)


def table_rows(table: Node):
    """The visible rows of a table in order, as ``(group, cells)``; a caption has no group."""
    stack, group = [iter(table.children)], 0
    while stack:
        node = next(stack[-1], None)
        if node is None:
            stack.pop()
            group += 1
        elif isinstance(node, Node) and seen(node):
            if node.tag in ("td", "th"):
                yield group, [node]
            elif node.tag == "tr":
                yield group, [c for c in node.children if isinstance(c, Node) and c.tag in ("td", "th") and seen(c)]
            elif node.tag == "caption":
                yield None, [node]
            elif node.tag in ("tbody", "thead", "tfoot"):
                group += 1
                stack.append(iter(node.children))


def span(cell: Node, name: str, most: int) -> int:
    value = cell.attrs.get(name, "1").strip()
    return min(int(value), most) if re.fullmatch("[0-9]{1,9}", value) else 1


def placed_rows(table: Node) -> list[list[tuple[int, int, list[str]]]]:
    """Each row's cells as first column, columns, lines: a cell takes the first columns that no
    cell of a row above reaches down into. Captions are rows of column -1."""
    out, busy, last = [], {}, None
    for r, (group, cells) in enumerate(table_rows(table)):
        if group is None:
            out.append([(-1, 1, render_lines(cells[0]))])
            continue
        if group != last:
            busy, last = {}, group
        x, row = 0, []
        for c in cells:
            while busy.get(x, 0) > r:
                x += 1
            wide, high = max(1, span(c, "colspan", COLUMNS)), span(c, "rowspan", ROWS)
            row.append((x, wide, render_lines(c) or [""]))
            if high != 1:
                until = r + high if high else 1 << 62
                busy.update(dict.fromkeys(range(x, x + wide), until))
            x += wide
        out.append(row)
    return out


def lay_table(table: Node) -> list[str]:
    """Lines of a table, columns padded to their widest cell; cells may have many lines and span
    columns and rows. A row of one cell in the first column is not aligned."""
    rows = placed_rows(table)
    alone = lambda row: len(row) == 1 and row[0][0] <= 0
    cells = [c for row in rows if not alone(row) for c in row]
    # Only columns in which a cell begins or ends matter.
    edges = sorted({x for x, _, _ in cells} | {x + w for x, w, _ in cells})
    at = {x: k for k, x in enumerate(edges)}
    widths = [0] * len(edges)
    spanning = []
    for x, w, lines in cells:
        size = min(CELL, max(map(len, lines)))
        if at[x + w] == at[x] + 1:
            widths[at[x]] = max(widths[at[x]], size)
        else:
            spanning.append((at[x], at[x + w], size))
    for first, stop, size in spanning:
        held = sum(widths[first:stop]) + 2 * (stop - first - 1)
        widths[stop - 1] += max(0, min(size, CELL) - held)
    starts, place = [], 0
    for w in widths:
        starts.append(min(place, LINE))
        place += w + 2
    out = []
    for row in rows:
        if alone(row):
            out += [x for x in row[0][2] if x]
            continue
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            parts, length = [], 0
            for x, _, lines in row:
                text = lines[k] if k < len(lines) else ""
                if text:
                    gap = max(starts[at[x]] - length, 2 if length else 0)
                    parts += [" " * gap, text]
                    length += gap + len(text)
            line = "".join(parts).rstrip()
            if line:
                out.append(line)
    return out


def lay_out(root: Node) -> None:
    """What is hidden, and all tables, the inner ones first, whatever their depth."""
    tables, stack = [], [root]
    while stack:
        node = stack.pop()
        for child in laid_children(node):
            if child.__class__ is Node and seen(child):
                child.hide = node.hide
                if "style" in child.attrs and (style := _VISIBILITY.findall(child.attrs["style"])):
                    child.hide = style[-1].lower() != "visible"
                if child.tag == "table":
                    tables.append(child)
                if child.children:
                    stack.append(child)
    # A table is found before those inside it.
    for table in reversed(tables):
        table.lines = lay_table(table)


def render_lines(root: Node) -> list[str]:
    """All visible text below a node, of which ``lay_out`` laid the tables. The walk keeps its own
    stack, so nesting has no limit."""
    page = Page()
    # Entries: (node, iterator, what to do at its end).
    stack = [(root, iter(laid_children(root)), None)]
    pre = 0
    counters: list[int] = []
    while stack:
        node, rest, leave = stack[-1]
        child = next(rest, None)
        if child is None:
            stack.pop()
            if leave:
                pre -= node.tag in PREFORMATTED
                if node.tag in ("ul", "ol", "menu", "dir"):
                    counters.pop()
                if node.tag in SPACED and not (node.tag in ("ul", "ol") and counters):
                    page.space()
                elif node.tag in BLOCK:
                    page.flush()
                if node.tag in ("li", "blockquote", "dd"):
                    page.indent.pop()
                    page.bullet = ""
            continue
        if isinstance(child, str):
            if node.hide:
                continue
            data = html.unescape(child)
            if pre:
                first, *more = data.replace("\r\n", "\n").split("\n")
                page.line.append(first)
                for x in more:
                    text = "".join(page.line).rstrip()
                    page.line = [x]
                    page.put(text) if text else page.lines.append("")
            else:
                page.write(data)
            continue
        tag = child.tag
        if tag == "input":
            a = child.attrs
            hidden = "hidden" in a or node.hide or _UNSEEN.search(a.get("style", "")) or _VISIBILITY.search(a.get("style", ""))
            if a.get("type", "").lower() in BUTTONS and not hidden:
                page.write(f" {a.get('value', '')} ")
            continue
        if not seen(child):
            continue
        if tag == "br":
            if page.line:
                page.flush()
            elif page.lines and not page.gap:
                page.gap = 1
            continue
        if tag == "hr":
            page.space()
            continue
        if tag == "table":
            page.space()
            for line in child.lines:
                page.put(line)
            page.space()
            continue
        if tag in ("td", "th") and page.line:
            page.line.append("  ")
        if tag in SPACED and not (tag in ("ul", "ol") and counters):
            page.space()
        elif tag in BLOCK:
            page.flush()
        if tag in ("ul", "ol", "menu", "dir"):
            start = child.attrs.get("start", "1")
            counters.append(int(start) if tag == "ol" and re.fullmatch(r"-?[0-9]{1,9}", start) else 0 if tag != "ol" else 1)
            if tag == "ol" and counters[-1] == 0:
                counters[-1] = 1 if start != "0" else 0
        if tag == "li":
            ordered = node.tag == "ol" and bool(counters)
            page.bullet = f"{counters[-1]}. " if ordered else "- "
            if ordered:
                counters[-1] += 1
            page.indent.append(" " * len(page.bullet))
        elif tag in ("blockquote", "dd"):
            page.indent.append("  ")
        pre += tag in PREFORMATTED
        stack.append((child, iter(laid_children(child)), True))
    page.flush()
    return page.lines


def visible_text(page: str) -> str:
    root = build(page)
    lay_out(root)
    return "\n".join(render_lines(root))


def extract(pages: DataFrame, page: str = "html", out: str = "content") -> DataFrame:
    """``pages`` with the visible text of each page (a clashing name gets a ``_``).

    Null and empty pages give an empty text, and so does a page without visible text.
    Broken markup never fails: unclosed tags, quotes and comments end with the page. Rows
    are independent, so repeated rows, null keys and an empty table need no rule.
    """
    column = fresh(pages, out)

    def make():
        def work(part, raw):
            texts = [visible_text(t.decode("utf-8", "replace").replace("\x00", "�")) for t in raw]
            return pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(texts, pa.string())], [*part.schema.names, column]
            )

        return work

    schema = pages.select("*", F.lit(None).cast("string").alias(column)).schema
    return map_texts(pages, make, schema, page)


def extracted(pages: DataFrame, key: str = "page_id", page: str = "html") -> DataFrame:
    """Per row: key, ``n_lines``, ``n_chars``, ``text_sha256`` and ``content``."""
    found = extract(pages.select(ref(key), ref(page)), page)
    text = ref(found.columns[-1])
    return found.select(
        ref(key), F.when(text == "", 0).otherwise(F.size(F.split(text, "\n"))).alias("n_lines"),
        F.length(text).alias("n_chars"), F.sha2(text, 256).alias("text_sha256"), text.alias("content"),
    )
