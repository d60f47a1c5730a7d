"""Layout-aware text of web pages: a tree with implied tags, visibility rules, and a renderer that keeps the layout.

The page is cut into tags and text; a tree is built as browsers do in the common cases (a block closes an open
paragraph; items, rows, cells, terms and options close their kind; unknown end tags are ignored; everything left open
ends with the page). Elements that are never shown, and those hidden by attribute or style, are left out with all they
hold; what is only invisible (``visibility``) leaves out its own text, and descendants that are visible again show. Blocks stand on lines of their own, paragraphs and headings with a blank line between, list items with their
marker and indentation, table rows as lines with columns padded to equal width, preformatted text as it is.

Tree and rendering use explicit stacks: deep nesting cannot exhaust the interpreter's.

Edge cases: a null page gives a null text, an empty one the empty text; malformed tags are text; the time taken is linear
in the page for any page; equal rows get equal
results; other columns pass through, an output column replaces one of the same name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.frames import field, with_columns

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?", re.S)
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
# What stands in a tag behind its name: quoted values may hold ">".
INNER = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
HIDING = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
BLANKS = re.compile(r"[ \t\n\r\f]+")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript title meta link base iframe noembed noframes object svg math "
                   "audio video canvas datalist param source track area select".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table ul ol dl figure".split())
BLOCKS = PARAGRAPHS | frozenset("html body address article aside center details dialog dd dir div dt fieldset "
                                "figcaption footer form header hgroup hr legend li main menu nav optgroup option "
                                "search section summary caption thead tbody tfoot tr".split())
# A start tag closes open elements of these kinds, but not past a border.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th", "caption", "colgroup"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"), ("table",)),
    "option": (("option",), ("select", "datalist")), "optgroup": (("option", "optgroup"), ("select",)),
    "body": (("head",), ()),
}
IN_HEAD = frozenset("html head title meta link base style script noscript template".split())
COLSPAN = 1000
# Lists nested deeper than this many blanks are not indented further (their text stays).
INDENT = 200
# Tables within so many others have their cells as lines of their own: each level copies what is in it once more.
NESTED = 20
SCOPES = frozenset("table td th caption button object html".split())


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        for key, value in ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return html.unescape(value.strip("\"'"))
        return None

    def hidden(self) -> bool:
        if self.tag in UNSEEN:
            return True
        if not self.attributes:
            return False
        low = self.attributes.lower()
        if self.tag == "dialog" and self.get("open") is None:
            return True
        return ("hidden" in low and self.get("hidden") is not None) or (
            "style" in low and bool(HIDING.search(self.get("style") or "")))

    def shown(self, before: bool) -> bool:
        """Whether the element's own text is visible: visibility is inherited, and a descendant can set it again."""
        if "visibility" not in self.attributes.lower():
            return before
        found = VISIBILITY.findall(self.get("style") or "")
        return found[-1].lower() == "visible" if found else before


class Scanner:
    """Text and tags of a page from left to right, in linear time whatever the page holds.

    A tag ends at the first ">" outside quotes. Once a quote is found that never ends, quotes count no more from there on;
    "<" that begins no tag, or has no ">" behind it, is text.
    """

    def __init__(self, page: str):
        self.page, self.at, self.quotes = page, 0, True

    def __iter__(self) -> Iterator[tuple[str, str, str, str]]:
        """(text, "", "", "") or ("", slash, name, attributes)."""
        page, n = self.page, len(self.page)
        closing, text_from = page.find(">"), 0
        last_markup = max(page.rfind("<!"), page.rfind("<?"))
        while (at := page.find("<", self.at)) >= 0:
            if -1 < closing < at:
                closing = page.find(">", at)
            markup, name = MARKUP.match(page, at), NAME.match(page, at) if closing >= 0 else None
            if markup:
                yield page[text_from:at], "", "", ""
                self.at = text_from = markup.end()
                if markup[0].startswith("<![CDATA["):
                    yield "", "", "<![CDATA[", markup[0][9:].removesuffix("]]>")
                continue
            if not name:
                if closing < 0 and at > last_markup:
                    break  # nothing but text
                self.at = at + 1
                continue
            if -1 < closing < name.end():
                closing = page.find(">", name.end())
                if closing < 0:
                    self.at = at + 1
                    continue
            end = closing
            if self.quotes:
                found = INNER.match(page, name.end()).end()
                if found < n and page[found] == ">":
                    end = found
                else:
                    self.quotes = False
            yield page[text_from:at], "", "", ""
            self.at = end + 1
            yield "", name[1], name[2], page[name.end():end]
            text_from = self.at  # the reader may have gone on
        yield page[text_from:], "", "", ""

    def skip_to_end_of(self, tag: str) -> str:
        """The raw text up to the tag's end tag, behind which reading goes on."""
        found = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(self.page, self.at)
        inner = self.page[self.at:found.start() if found else len(self.page)]
        closed = self.page.find(">", found.start()) if found else -1
        self.at = closed + 1 if closed >= 0 else len(self.page)
        return inner


class Stack:
    """Open elements, and where those of each kind are, so that no look-up walks over deep nesting."""

    def __init__(self, root: Node):
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    @property
    def top(self) -> Node:
        return self.nodes[-1]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, at: int) -> None:
        while len(self.nodes) > at:
            self.places[self.nodes.pop().tag].pop()

    def last(self, tags) -> int:
        """The place of the innermost open element of these kinds, or 0."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, kinds, borders) -> None:
        at = self.last(kinds)
        if at and (at >= self.last(borders)):
            self.cut(at)


def build(page: str) -> Node:
    root = Node("#root")
    stack, scanner = Stack(root), Scanner(page)

    def put_text(text: str) -> None:
        if text:
            if stack.top.tag == "head" and text.strip():
                stack.cut(len(stack.nodes) - 1)
            stack.top.children.append(text)

    for text, slash, name, attributes in scanner:
        if not name:
            put_text(html.unescape(text))
            continue
        if name == "<![CDATA[":
            put_text(attributes)
            continue
        tag = name.lower()
        if slash:
            if tag == "br":
                stack.top.children.append(Node("br"))
            elif tag == "p" and not stack.places.get("p"):
                stack.top.children.append(Node("p"))
            else:
                stack.close((tag,), () if tag in SCOPES else ("td", "th", "caption") if tag not in (
                    "tr", "tbody", "thead", "tfoot") else ("table",))
            continue
        if stack.top.tag == "head" and tag not in IN_HEAD:
            stack.cut(len(stack.nodes) - 1)
        if tag in CLOSES:
            kinds, borders = CLOSES[tag]
            for _ in kinds:
                stack.close(kinds, borders)
        if tag in BLOCKS and tag not in ("html", "body"):
            stack.close(("p",), SCOPES)
        if tag in ("td", "th") and not stack.last(("tr",)) > stack.last(("table",)):
            row = Node("tr")
            stack.top.children.append(row)
            stack.push(row)
        node = Node(tag, attributes)
        stack.top.children.append(node)
        if tag in RAW:
            inner = scanner.skip_to_end_of(tag)
            node.children.append(html.unescape(inner) if tag in ("title", "textarea") else inner)
        elif tag not in VOID and not attributes.rstrip().endswith("/") or tag in BLOCKS and tag not in VOID:
            stack.push(node)
    return root


class Out:
    """Lines under construction: text joins the open line, breaks end it, gaps ask for a blank line before the next."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []  # of the open line; none is empty
        self.gap = False
        self.prefix = ""      # what the next line begins with (an item's marker)
        self.indent = ""

    def text(self, piece: str) -> None:
        piece = BLANKS.sub(" ", piece)
        if not self.parts or self.parts[-1].endswith(" "):
            piece = piece.lstrip(" ")
        self.add(piece)

    def add(self, piece: str) -> None:
        if piece:
            self.parts.append(piece)

    def take(self) -> str:
        """The open line, which is empty then."""
        line = "".join(self.parts)
        self.parts = []
        return line

    def end(self) -> None:
        line = self.take().rstrip(" ")
        if line:
            self.put(line)

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append((self.prefix or self.indent) + line)
        self.prefix = ""

    def block(self, paragraph: bool) -> None:
        self.end()
        if paragraph and self.lines and not self.prefix:
            self.gap = True

    def result(self) -> str:
        self.end()
        return "\n".join(self.lines)


def render(root: Node) -> str:
    """The visible text of the tree."""
    out = Out()
    pre = 0
    indents: list[str] = []                  # before each open definition
    lists: list[list] = []                   # [kind, next number, indent before]
    # Rows of cells, and outputs set aside; None for tables nested too deep.
    tables: list[tuple[list[list[str]], list[Out]] | None] = []
    todo: list[tuple[bool, bool, Node | str]] = [(True, True, root)]  # entering or leaving, visible, what
    while todo:
        entering, shown, node = todo.pop()
        if isinstance(node, str):
            if not shown:
                continue
            if pre:
                first, *more = node.split("\n")
                out.add(first)
                for line in more:
                    out.put(out.take().rstrip())
                    out.add(line)
            else:
                out.text(node)
            continue
        tag = node.tag
        if entering:
            if node.hidden() or tag == "input":
                continue
            if tag == "br":
                if any(p.strip() for p in out.parts):
                    out.end()
                else:
                    out.take()
                continue
            if tag == "hr":
                out.block(False)
                continue
            if tag == "table":
                out.block(True)
                tables.append(([], [out]) if len(tables) < NESTED else None)
            elif tag == "tr" and tables and tables[-1]:
                tables[-1][0].append([])
            elif tag in ("td", "th") and tables and not tables[-1]:
                out.block(False)
            elif tag in ("td", "th") and tables and tables[-1][0]:
                tables[-1][1].append(out)
                out = Out()
            elif tag == "caption" and tables:
                out.end()
            elif tag in BLOCKS:
                out.block(tag in PARAGRAPHS and not (tag in ("ul", "ol") and lists))
            if tag in ("ul", "ol", "menu", "dir"):
                start = node.get("start") or "1"
                lists.append([tag, int(start) if start.isdecimal() and start.isascii() else 1, out.indent])
            elif tag == "li":
                kind = lists[-1] if lists else ["ul", 1, ""]
                mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
                kind[1] += 1
                deeper = " " * len(mark) if len(kind[2]) < INDENT else ""
                out.prefix, out.indent = kind[2] + mark, kind[2] + deeper
            elif tag == "dd":
                indents.append(out.indent)
                out.indent += "  " if len(out.indent) < INDENT else ""
            elif tag == "pre":
                pre += 1
            shown = node.shown(shown)
            todo.append((False, shown, node))
            todo += [(True, shown, x) for x in reversed(node.children)]
            continue
        if tag in ("td", "th") and tables and tables[-1] and tables[-1][0] and len(tables[-1][1]) > 1:
            cell = out.result()
            out = tables[-1][1].pop()
            tables[-1][0][-1].append(cell)
            span = node.get("colspan") if node.attributes else None
            if span and span.isascii() and span.isdecimal():
                tables[-1][0][-1] += [""] * (min(int(span), COLSPAN) - 1)
        elif tag == "table":
            done = tables.pop()
            out.end()
            for line in aligned(done[0]) if done else ():
                out.put(line)
            out.gap = True
        elif tag == "pre":
            pre -= 1
            if last := out.take().rstrip():
                out.put(last)
            out.gap = True
        elif tag == "li":
            out.end()
            out.prefix, out.indent = "", lists[-1][2] if lists else ""
        elif tag in ("ul", "ol", "menu", "dir"):
            out.end()
            if lists:
                out.indent = lists.pop()[2]
            out.gap = not lists
        elif tag == "dd":
            out.end()
            out.indent = indents.pop()
        elif tag in BLOCKS:
            out.block(tag in PARAGRAPHS)
    return out.result().strip("\n")


def aligned(rows: list[list[str]]) -> list[str]:
    """Lines of a table: columns padded to their widest cell; a cell of several lines takes several lines."""
    rows = [[c.split("\n") for c in r] for r in rows if any(r)]
    widths: dict[int, int] = {}
    for row in rows:
        for k, cell in enumerate(row):
            widths[k] = max(widths.get(k, 0), *(len(x) for x in cell))
    lines = []
    for row in rows:
        for y in range(max(len(c) for c in row)):
            cells = [(c[y] if y < len(c) else "").ljust(widths[k]) for k, c in enumerate(row)]
            lines.append("  ".join(cells).rstrip())
    return lines


def extract(pages: DataFrame, source: str = "html", output: str = "text") -> DataFrame:
    """Add the visible text of each page."""
    def run(column: pa.Array) -> list:
        texts = (x.as_py() for x in column)
        return [[None if t is None else render(build(t)) for t in texts]]

    return with_columns(pages, [field(output, "string")], run, source)
