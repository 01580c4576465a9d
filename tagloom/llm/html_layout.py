"""Layout-aware text of HTML pages (op4).

A tree builder with implied tags (open paragraphs, list items, rows and cells end where the next one
begins; rows, sections, head and body are supplied) feeds a renderer that lays visible text out:
blocks on lines of their own, blank lines around paragraphs and headings, markers and indents for
lists, aligned columns for tables, white space as it is in preformatted text. All visible text comes
out, navigation and advertisements included; what a browser would not show (head, scripts, styles,
templates, hidden elements) does not.

Inside svg and math the rules of foreign content hold: empty tags close themselves, CDATA is text, HTML
tags end the drawing unless they stand in a foreignObject, a MathML token or the like. The labels of a
drawing and the tokens of a formula come out, each label and matrix row on a line of its own; titles,
descriptions, definitions, metadata and annotations do not. Definitions stay out also where a drawing
refers to them by ``use``.

Visibility goes by the tree and by inline styles: in a style the last valid declaration counts, important ones first, comments
and quoted or bracketed values set aside. ``display: none`` hides a subtree, and a display of its own shows what ``hidden`` or
a closed dialog would hide; ``visibility`` is handed down, and a descendant may be visible again. Of a closed ``details`` the
first summary comes out. Buttons made by ``input`` show their value, fields their value or else their placeholder (passwords
and other kinds of input none); all options of a ``select`` come out. Style sheets are not read: what rules by class, id or
tag hide or show is taken as if they were not there, a limit of these rules.

Nothing recurses and nothing is cut: nesting may be as deep as the page is long. Column padding and
list indents have a largest width, beyond which text just runs on, so the result stays linear in the
page's length.

Defined results: a null or empty page has the text ''; repeated rows and null ids are rendered row by row.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.batches import map_texts, strings

COLUMN = 40  # widest padding of a table column
DEEPEST = 12  # list levels that get an indent of their own

# in a tag a quote opens a value only after "=", anywhere else (or never closed) it is a character like others
_MARKUP = re.compile(
    r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))"  # comment
    r"|[!?][^>]*+(?:>|\Z)|/(?![A-Za-z])[^>]*+(?:>|\Z)"  # declaration, processing instruction, bogus comment
    r"|(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*+)"
    r"(?P<rest>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?+)?+)*+(?:>|\Z)))", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"'][^\s>]*+))?+)?+")
_TELLING = re.compile(r"(?i)hidden|style|span|open|start|value|reversed")
_STYLE_NOISE = re.compile(r"/\*.*?(?:\*/|\Z)|\"[^\"]*+\"|'[^']*+'|\([^()]*+\)", re.S)
_DECLARATION = re.compile(r"(?i)(?:^|;)\s*(display|visibility)\s*:\s*([a-z -]+?)\s*(!\s*important\s*)?(?=;|\Z)")
#: Valid values, as CSS has them.
_VISIBILITIES = frozenset("visible hidden collapse inherit initial unset revert revert-layer".split())
_DISPLAYS = frozenset(
    "none block inline inline-block flex inline-flex grid inline-grid flow-root contents list-item run-in table inline-table table-row "
    "table-cell table-caption table-row-group table-header-group table-footer-group table-column table-column-group ruby ruby-base "
    "ruby-text ruby-base-container ruby-text-container math inherit initial unset revert revert-layer".split())
_BUTTONS = frozenset("submit reset button".split())
_FIELDS = frozenset("text search email url tel number date month week time datetime-local".split())
_OTHER_INPUTS = frozenset("password hidden checkbox radio range color file image".split())
_SPACE = re.compile(r"[ \t\n\r\f]+")

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I) for t in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
_UNSEEN = frozenset("head script style template title noembed noframes iframe datalist object audio video canvas rp".split()) | {
    *(f"svg {t}" for t in "title desc defs metadata style script".split()), *(f"math {t}" for t in "annotation annotation-xml mphantom".split())}
_IN_HEAD = frozenset("base link meta script style template title noscript".split())
_PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure hr fieldset".split())
_BLOCKS = _PARAGRAPHS | frozenset(
    "address article aside body caption center dd details dialog dir div dt figcaption footer form header hgroup html legend li "
    "listing main menu nav optgroup option section summary".split()) | {"svg text", "svg foreignobject", "math mtr", "math mlabeledtr"}
_HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
_ENDS_P = (_BLOCKS | {"xmp"}) - frozenset("body caption html legend optgroup option".split())
_TOKENS = frozenset(f"math {t}" for t in "mi mo mn ms mtext".split())
#: Foreign elements (their tags have their space before them) whose content is HTML again.
_HTML_INSIDE = _TOKENS | {"svg foreignobject", "svg desc", "svg title"}
_SCOPE = frozenset("table td th caption button html".split()) | _HTML_INSIDE
#: HTML tags that end a drawing or formula.
_BREAKOUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split())
#: What a start tag ends if open, and where the search for it stops.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"} | _SCOPE), "dd": ({"dd", "dt"}, {"dl"} | _SCOPE), "dt": ({"dd", "dt"}, {"dl"} | _SCOPE),
    "option": ({"option"}, {"select", "optgroup"} | _SCOPE), "optgroup": ({"option", "optgroup"}, {"select"} | _SCOPE),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "caption", "colgroup"}, {"table"}),
    **{t: ({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot", "caption", "colgroup")},
    **{h: (_HEADINGS, _BLOCKS - _HEADINGS) for h in _HEADINGS},
}
_SECTIONS = frozenset(("thead", "tbody", "tfoot"))
_TABLE_PARTS = _SECTIONS | frozenset("tr td th caption colgroup col".split())


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes, self.children = tag, attributes, []


class Builder:
    """Builds the tree of one page from its markup."""

    def __init__(self):
        self.root = Node("html", {})
        self.stack = [self.root]
        self.open = Counter({"html": 1})
        self.in_body = False

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        self.stack[-1].children.append(node)
        self.stack.append(node)
        self.open[tag] += 1

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.open[self.stack.pop().tag] -= 1

    def find(self, tags, stops) -> int:
        """Depth of the innermost open element of tags, not looking past stops; 0 if none."""
        if not any(self.open[t] for t in tags):
            return 0
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag in tags:
                return depth
            if self.stack[depth].tag in stops:
                return 0
        return 0

    def end(self, tags, stops) -> None:
        depth = self.find(tags, stops)
        if depth:
            self.pop_to(depth)

    def enter_body(self) -> None:
        if not self.in_body:
            self.in_body = True
            self.pop_to(1)
            self.push("body", {})

    def html_inside(self, node: Node) -> bool:
        return node.tag in _HTML_INSIDE or (
            node.tag == "math annotation-xml" and node.attributes.get("encoding", "").lower() in ("text/html", "application/xhtml+xml"))

    def break_out(self) -> None:
        """Leave foreign elements up to HTML."""
        while " " in self.stack[-1].tag and not self.html_inside(self.stack[-1]):
            self.pop_to(len(self.stack) - 1)

    def space(self, tag: str, attributes: dict[str, str]) -> str:
        """The space of the element that a start tag makes: svg, math or none, after leaving what it ends."""
        node = self.stack[-1]
        if " " in node.tag and not self.html_inside(node):
            if tag in _BREAKOUT or (tag == "font" and not attributes.keys().isdisjoint(("color", "face", "size"))):
                self.break_out()
            elif tag != "svg" or node.tag != "math annotation-xml":
                return node.tag.partition(" ")[0]
        return tag if tag in ("svg", "math") else ""

    def start_foreign(self, space: str, tag: str, attributes: dict[str, str], closed: bool) -> None:
        if not self.in_body:
            self.enter_body()
        self.push(f"{space} {tag}", attributes)
        if closed:
            self.pop_to(len(self.stack) - 1)

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag == "html":
            return
        if tag == "head":
            if not self.in_body and not self.open["head"]:
                self.push("head", {})
            return
        if tag == "body":
            if not self.in_body:
                self.enter_body()
                self.stack[-1].attributes = attributes
            return
        if not self.in_body:
            if tag in _IN_HEAD:
                if not self.open["head"]:
                    self.push("head", {})
            else:
                self.enter_body()
        if tag in _TABLE_PARTS:
            if not self.open["table"]:
                return  # no table: the tag means nothing, its content stays
        elif tag in _ENDS_P:
            self.end({"p"}, _SCOPE)
        if tag in _ENDS:
            self.end(*_ENDS[tag])
        if tag in ("tr", "td", "th"):
            # rows and cells stand in a section, cells in a row
            if tag == "tr":
                self.end({"td", "th", "tr"}, {"table"})
            depth = self.find({"tr"} if tag != "tr" else _SECTIONS, {"table"})
            if depth:
                self.pop_to(depth + 1)
            else:
                section = self.find(_SECTIONS, {"table"})
                self.pop_to((section or self.find({"table"}, ())) + 1)
                if not section:
                    self.push("tbody", {})
                if tag != "tr":
                    self.push("tr", {})
        elif tag in _TABLE_PARTS:
            self.pop_to(self.find({"table"}, ()) + 1)
        if tag in _VOID:
            self.stack[-1].children.append(Node(tag, attributes))
        else:
            self.push(tag, attributes)

    def stop(self, tag: str) -> None:
        if " " in self.stack[-1].tag:
            if tag in ("br", "p"):
                self.break_out()
            elif self.open[f"svg {tag}"] or self.open[f"math {tag}"]:
                for depth in range(len(self.stack) - 1, 0, -1):
                    space, _, name = self.stack[depth].tag.rpartition(" ")
                    if not space:
                        break
                    if name == tag:
                        return self.pop_to(depth)
        if tag == "br":
            return self.start("br", {})
        if tag == "head":
            return self.end({"head"}, ())
        if tag in _VOID or tag in ("html", "body"):
            return
        stops = () if tag in _TABLE_PARTS or tag == "table" else {"td", "th", "caption"}
        if tag in _TABLE_PARTS:
            stops = {"table"}
        depth = self.find(_HEADINGS if tag in _HEADINGS else {tag, f"svg {tag}", f"math {tag}"}, stops)
        if depth:
            self.pop_to(depth)
        elif tag == "p":
            self.start("p", {})
            self.pop_to(len(self.stack) - 1)

    def text(self, text: str) -> None:
        if not text:
            return
        if not self.in_body and self.stack[-1].tag in ("html", "head"):
            if not text.strip(" \t\n\r\f"):
                return
            self.enter_body()
        space = self.stack[-1].tag.partition(" ")[0] if " " in self.stack[-1].tag else ""
        if space == "svg" and not self.open["svg text"] and not self.html_inside(self.stack[-1]):
            return  # not drawn
        if space == "math" and self.stack[-1].tag not in _TOKENS and not text.strip(" \t\n\r\f"):
            return  # between tokens
        self.stack[-1].children.append(text)


def parse(html: str) -> Node:
    """The tree of a page."""
    builder, at = Builder(), 0
    while True:
        m = _MARKUP.search(html, at)
        if not m:
            builder.text(unescape(html[at:]))
            return builder.root
        builder.text(unescape(html[at : m.start()]))
        at = m.end()
        tag = m["tag"]
        if tag is None:
            if " " in builder.stack[-1].tag and html.startswith("<![CDATA[", m.start()):
                end = html.find("]]>", m.start() + 9)
                end = len(html) if end < 0 else end
                builder.text(html[m.start() + 9 : end])
                at = end + 3
            continue
        tag = tag.lower()
        if m["close"]:
            builder.stop(tag)
            continue
        rest, attributes = m["rest"], {}
        if tag in ("svg", "math") or " " in builder.stack[-1].tag:
            closed = rest.endswith("/>")
            for a in _ATTRIBUTE.finditer(rest):
                attributes.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
                closed = closed and a.end(4) != len(rest) - 1  # the slash is not a value's
            space = builder.space(tag, attributes)
            if space:
                builder.start_foreign(space, tag, attributes, closed)
                continue
        elif len(rest) > 1 and (tag == "input" or _TELLING.search(rest)):
            for name, a, b, c in _ATTRIBUTE.findall(rest):
                attributes.setdefault(name.lower(), unescape(a or b or c))
        builder.start(tag, attributes)
        if tag in _RAW:
            m = _RAW[tag].search(html, at)
            inside = html[at : m.start() if m else len(html)]
            at = m.start() if m else len(html)
            if tag == "textarea":
                builder.text(unescape(inside))
            elif tag == "xmp":
                builder.text(inside)


def _number(text: str | None, most: int) -> int:
    return max(1, min(most, int(text))) if text and text.isascii() and text.isdigit() and len(text) < 7 else 1


def _width(text: str) -> int:
    if text.isascii() or max(text) < "ᄀ":
        return len(text)
    return sum(2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Flow:
    """Lines of text under construction."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # 1: a new line, 2: a blank line before what comes next
        self.indent = ""
        self.marker = ""

    def text(self, text: str, keep: bool) -> None:
        if keep:
            first, *more = text.replace("\r\n", "\n").split("\n")
            self._put(first)
            for line in more:
                self.newline()
                self._put(line)
            return
        text = _SPACE.sub(" ", text)
        if text[:1] == " " and (not self.line or self.line[-1][-1:] in (" ", "\n")):
            text = text[1:]
        self._put(text)

    def _put(self, text: str) -> None:
        if not text:
            return
        if not self.line:
            if self.gap == 2 and self.lines:
                self.lines.append("")
            self.gap = 0
            self.line.append(self.indent + self.marker)
            if self.marker:
                self.indent, self.marker = self.indent + " " * len(self.marker), ""
        self.line.append(text)

    def newline(self) -> None:
        """End the line, also an empty one."""
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        elif self.lines:
            self.lines.append("")

    def apart(self, gap: int) -> None:
        if self.line:
            self.newline()
        self.gap = max(self.gap, gap)

    def whole(self, lines: list[str]) -> None:
        """Lines laid out before, as they are."""
        self.apart(1)
        for line in lines:
            if line:
                self._put(line)
            self.newline()

    def done(self) -> list[str]:
        if self.line:
            self.newline()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


class Table:
    def __init__(self):
        self.rows: list[list[tuple[int, list[str]]]] = []  # (column, lines) of each cell
        self.spans: dict[int, int] = {}  # columns that a cell from above still fills, with rows left

    def row(self) -> None:
        self.rows.append([])
        self.next = 0
        self.spans = {c: n - 1 for c, n in self.spans.items() if n > 1}

    def cell(self, lines: list[str], columns: int, rows: int) -> None:
        if not self.rows:
            self.row()
        while self.next in self.spans:
            self.next += 1
        self.rows[-1].append((self.next, lines))
        if rows > 1:
            self.spans.update(dict.fromkeys(range(self.next, self.next + columns), rows))
        self.next += columns

    def lines(self) -> list[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for column, lines in row:
                if lines:
                    widths[column] = max(widths.get(column, 0), min(COLUMN, max(map(_width, lines))))
        place, starts = 0, {}
        for column in sorted(widths):
            starts[column] = place
            place += widths[column] + 2
        out = []
        for row in self.rows:
            for i in range(max((len(lines) for _, lines in row), default=0)):
                line, at = [], 0
                for column, lines in row:
                    if i < len(lines) and lines[i]:
                        pad = max(starts[column] - at, 2 if line else 0)
                        line += [" " * pad, lines[i]]
                        at += pad + _width(lines[i])
                out.append("".join(line))
        return out


def inline_style(style: str) -> dict[str, str]:
    """The display and visibility that an inline style sets."""
    found: dict[str, tuple[bool, str]] = {}
    for name, value, important in _DECLARATION.findall(_STYLE_NOISE.sub(" ", style)):
        name, words = name.lower(), value.lower().split()
        valid = _DISPLAYS if name == "display" else _VISIBILITIES
        if words and valid.issuperset(words) and (important or not found.get(name, (False,))[0]):
            found[name] = bool(important), words[0] if len(words) == 1 else " ".join(words)
    return {name: value for name, (_, value) in found.items()}


def shown(node: Node, before: bool) -> bool | None:
    """Whether a node's own text is visible, where its parent's is as ``before`` says; None if its subtree has no boxes."""
    a = node.attributes
    if not a:
        return None if node.tag in _UNSEEN or node.tag == "dialog" else before
    style = inline_style(a["style"]) if a.get("style") else {}
    foreign = node.tag.startswith("svg ")
    display = style.get("display", a.get("display") if foreign else None)
    closed = "hidden" in a or (node.tag == "dialog" and "open" not in a)
    if node.tag in _UNSEEN or display == "none" or (closed and display in (None, "inherit", "revert", "revert-layer")):
        return None
    visibility = style.get("visibility", a.get("visibility") if foreign else None)
    if visibility in ("hidden", "collapse"):
        return False
    return True if visibility in ("visible", "initial") else before


def control_text(node: Node) -> str:
    """What an ``input`` shows as text."""
    a, kind = node.attributes, node.attributes.get("type", "").strip().lower()
    if kind in _BUTTONS:
        return a.get("value", "")
    if kind == "password":
        return "" if a.get("value") else a.get("placeholder", "")
    return "" if kind in _OTHER_INPUTS else a.get("value") or a.get("placeholder", "")


def is_block(node: Node) -> bool:
    return node.tag in _BLOCKS or (node.tag == "math math" and node.attributes.get("display") == "block")


def render(root: Node, markers: bool = True) -> str:
    """The visible text of a tree, laid out."""
    flows, tables, lists, pre, seen = [Flow()], [], [], 0, True
    # (node or text) to enter, or (node, what to restore) to leave
    todo: list = [root]
    while todo:
        x = todo.pop()
        flow = flows[-1]
        if isinstance(x, str):
            if tables and tables[-1][1] is flow and not x.strip(" \t\n\r\f"):
                continue  # white space between cells
            if seen:
                flow.text(x, pre > 0)
            continue
        if isinstance(x, Node):
            tag = x.tag
            above, now = seen, shown(x, seen)
            if now is None:
                continue
            if tag == "input" and now:
                own = control_text(x)
                if own.strip(" \t\n\r\f"):
                    flow.text(" ", False)
                    flow.text(own, False)
                    flow.text(" ", False)
            if tag == "br":
                flow.newline()
                continue
            if tag in _VOID and tag != "hr":
                continue
            seen = now
            saved = flow.indent
            if is_block(x):
                flow.apart(2 if tag in _PARAGRAPHS and not (lists and tag in ("ul", "ol")) else 1)
            if tag == "hr":
                seen = above
                continue
            if tag in ("ul", "ol", "menu", "dir"):
                start = x.attributes.get("start", "")
                lists.append([tag == "ol", int(start) - 1 if start.isascii() and start.isdigit() and len(start) < 10 else 0])
            elif tag == "li" and markers:
                own = lists[-1] if lists else [False, 0]
                own[1] += 1
                value = x.attributes.get("value", "")
                if own[0] and value.isascii() and value.isdigit() and len(value) < 10:
                    own[1] = int(value)
                marker = "" if not seen else f"{own[1]}. " if own[0] else "- "
                flow.indent, flow.marker = (flow.indent + flow.marker, marker) if not flow.marker.strip() else (flow.indent, flow.marker + marker)
                if len(flow.indent) > 4 * DEEPEST:
                    flow.indent = flow.indent[: 4 * DEEPEST]
                if len(flow.marker) > 4 * DEEPEST:
                    flow.marker = flow.marker[: 4 * DEEPEST]
            elif tag in ("dd", "blockquote") and markers and len(flow.indent) < 4 * DEEPEST:
                flow.indent += "  "
            elif tag in ("pre", "listing", "xmp", "textarea"):
                pre += 1
            elif tag == "table":
                tables.append((Table(), flow))
            elif tag == "tr" and tables:
                tables[-1][0].row()
            elif tag == "math mtd" or (tag == "svg tspan" and not x.attributes.keys().isdisjoint(("x", "y"))):
                flow.text(" ", False)  # placed apart
            elif tag in ("td", "th") and tables:
                flows.append(Flow())
                todo.append((x, saved, (pre, lists), above))
                pre, lists = 0, []
                todo.extend(reversed(x.children))
                continue
            todo.append((x, saved, None, above))
            if tag == "details" and "open" not in x.attributes:
                todo.extend([c for c in x.children if isinstance(c, Node) and c.tag == "summary"][:1])
            else:
                todo.extend(reversed(x.children))
            continue
        node, saved, outside, seen = x
        tag = node.tag
        if outside:
            pre, lists = outside
            lines = flows.pop().done()
            tables[-1][0].cell(lines, _number(node.attributes.get("colspan"), 1000), _number(node.attributes.get("rowspan"), 65534))
            continue
        if tag in ("ul", "ol", "menu", "dir") and lists:
            lists.pop()
        elif tag in ("pre", "listing", "xmp", "textarea"):
            pre = max(0, pre - 1)
        elif tag == "table" and tables:
            flow.whole(tables.pop()[0].lines())
        if is_block(node):
            flow.apart(2 if tag in _PARAGRAPHS and not (lists and tag in ("ul", "ol")) else 1)
        if tag in ("li", "dd", "blockquote"):
            flow.indent, flow.marker = saved, ""
    return "\n".join(flows[0].done())


def extract(pages: DataFrame, markers: bool = True) -> DataFrame:
    """page_id, url and the laid-out visible text of every page."""

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        texts = [render(parse(h), markers) if h else "" for h in strings(piece.column("html"))]
        return pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string()),
                                           pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
    return map_texts(rows, fn, "page_id long, url string, text string, n_chars long", text="html")
