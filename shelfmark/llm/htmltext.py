"""HTML to text as a page looks: a tree builder with implied tags, visibility rules, and a renderer of blocks.

The builder takes any text. It knows void and raw-text elements, end tags that an opening tag implies (p, li, dt, dd,
option, rows and cells, headings), rows and sections that a cell implies, ends tags only within their scope, and moves
text that stands between cells in front of the table. Hidden are head, script, style and the like, fallback content
of media, the attribute hidden, inputs of type hidden, closed details but for the summary, options that are not
selected, display:none and visibility:hidden, inline or by simple selectors of the page's own style sheets. Of several
rules the one that wins in browsers counts; sheets and @-blocks for print or some screens only are not read.

All other text is emitted: white space is folded except in pre and textarea, blocks begin lines, paragraphs and their
like are parted by one blank line, br breaks, list items carry bullets or numbers and are indented by depth, and table
cells are padded so that columns line up, lines within a cell and cells that span columns or rows included. A cell wider
than PAD_WIDTH does not widen its column; what follows it in its line stands further right.

Defined cases: null is the empty text; text without tags is one paragraph; broken markup, unclosed comments and
quotes, unknown entities and deep nesting give text, never an error; equal pages give equal text; a quote that is never closed ends with its tag; an empty table gives
an empty result; other columns are kept and, if they clash with the result's, replaced.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Fixed values of HTML: elements without content, with raw text, blocks, and what is not shown.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NOT_SHOWN = frozenset("head script style template title base link meta iframe noembed noframes audio video canvas object datalist colgroup col rp".split())
#: Blocks with a blank line around them, and without.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset menu dir".split())
TIGHT = frozenset("html body div section article aside header footer nav main address form li dt dd figcaption center details summary dialog legend hgroup search caption tr thead tbody tfoot".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
BLOCKS = SPACED | TIGHT | frozenset(("td", "th", "select"))
CLOSES_P = SPACED | TIGHT - frozenset("html body li dt dd option optgroup caption tr thead tbody tfoot legend".split()) | {"li", "dt", "dd"}
SECTIONS = frozenset(("thead", "tbody", "tfoot"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
SCOPE = frozenset("html table td th caption template marquee object applet button".split())
HEAD_ONLY = frozenset("head title base link meta style script template noscript".split())
#: Opening tag -> open elements that it ends, and elements beyond which it does not look.
IMPLIED_END = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu", "dir")) | SCOPE),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",)) | SCOPE),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",)) | SCOPE),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "tr": (frozenset(("tr", "td", "th", "caption", "colgroup")), frozenset(("table", "html"))),
    "td": (frozenset(("td", "th", "caption", "colgroup")), frozenset(("tr", "table", "html"))),
    "th": (frozenset(("td", "th", "caption", "colgroup")), frozenset(("tr", "table", "html"))),
    "thead": (SECTIONS | {"tr", "td", "th", "caption", "colgroup"}, frozenset(("table", "html"))),
    "caption": (frozenset(("caption", "colgroup")), frozenset(("table", "html"))),
}
IMPLIED_END["tbody"] = IMPLIED_END["tfoot"] = IMPLIED_END["thead"]

#: Media that hold on every screen.
ALWAYS = frozenset(("all", "screen", "only all", "only screen", "not print"))

#: Open elements at a time; deeper ones become siblings, as in browsers, so that looking for an open tag stays short.
MAX_DEPTH = 512

_REST = (
    r"<!--(?:>|->|(?P<comment>.*?)(?:-->|--!>|\Z))"
    r"%s"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z/][^>]*+\Z"
)
#: A quote opens a value only behind an equals sign, as browsers read it; elsewhere it is a letter like others.
_QUOTED = r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>"
_TAG = re.compile(_REST % _QUOTED, re.S)
#: Once a tag's values took in all the rest of a page, no later one looks for the end of its quotes again.
_PLAIN_TAG = re.compile(_REST % "", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_CSS = re.compile(r"\"(?:[^\"\\\n]|\\.)*+\"?|'(?:[^'\\\n]|\\.)*+'?|[{};]|[^{};\"']++", re.S)
_AT = re.compile(r"\s*@([\w-]+)(.*)", re.S)
_SIMPLE = re.compile(r"^([a-zA-Z][\w-]*|\*)?(?:\.([\w-]+)|#([\w-]+))?$")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: str = "", parent: Node | None = None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def attributes(self) -> dict[str, str]:
        return {n.lower(): html.unescape(a or b or c or "") for n, a, b, c in _ATTR.findall(self.attrs)} if self.attrs else {}


class Builder:
    """A tree from tags and text, one pass, with a stack of open elements."""

    def __init__(self) -> None:
        self.root = Node("html")
        self.open: list[Node] = [self.root]
        self.sheets: list[str] = []

    def _pop_to(self, at: int) -> None:
        del self.open[at:]

    def _find(self, tags: frozenset[str], stop: frozenset[str]) -> int:
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                return i
            if tag in stop:
                return 0
        return 0

    def _push(self, tag: str, attrs: str) -> Node:
        if len(self.open) >= MAX_DEPTH:
            self.open.pop()
        node = Node(tag, attrs, self.open[-1])
        self.open[-1].children.append(node)
        self.open.append(node)
        return node

    def _leave_head(self, tag: str) -> None:
        if len(self.open) > 1 and self.open[1].tag == "head" and tag not in HEAD_ONLY:
            self._pop_to(1)

    def text(self, text: str) -> None:
        if not text:
            return
        blank = not text.strip(" \t\n\r\f")
        if not blank:
            self._leave_head("#text")
        top = self.open[-1]
        if not blank and (top.tag in SECTIONS or top.tag in ("table", "tr")):
            at = self._find(frozenset(("table",)), frozenset())
            if not at:  # no table is open, or it gave way to its rows at the greatest depth
                top.children.append(text)
                return
            table = self.open[at]
            before = table.parent.children
            place = len(before) - 1  # an open table is its parent's last child, or near it
            while before[place] is not table:
                place -= 1
            before.insert(place, text)
            return
        top.children.append(text)

    def start(self, tag: str, attrs: str) -> None:
        if tag == "html":
            return
        if tag == "body":
            self._leave_head(tag)
            if any(n.tag == "body" for n in self.open):
                return
        self._leave_head(tag)
        if tag in CLOSES_P and (at := self._find(frozenset(("p",)), SCOPE)):
            self._pop_to(at)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        ends = IMPLIED_END.get(tag)
        if ends:
            # All that the tag ends, the outermost within its bounds.
            at, last = len(self.open), 0
            while at > 1:
                at -= 1
                if self.open[at].tag in ends[1]:
                    break
                if self.open[at].tag in ends[0]:
                    last = at
            if last:
                self._pop_to(last)
        if tag in ("td", "th") and self.open[-1].tag in SECTIONS | {"table"}:
            self._push("tr", "")
        self._push(tag, attrs)
        if tag in VOID:
            self.open.pop()

    def end(self, tag: str) -> None:
        if tag in ("html", "body"):
            return
        if tag == "br":
            return self.start("br", "")
        stop = frozenset(("table", "html")) if tag in SECTIONS or tag in ("tr", "td", "th", "caption") else frozenset(("html",)) if tag in ("table", "head") else SCOPE - {tag}
        at = self._find(HEADINGS if tag in HEADINGS else frozenset((tag,)), stop)
        if at and tag not in BLOCKS and any(n.tag in BLOCKS for n in self.open[at + 1 :]):
            # An inline element ends although a block inside it is open: the block goes on, without it or untouched.
            if tag in FORMATTING:
                del self.open[at]
        elif at:
            self._pop_to(at)
        elif tag == "p":
            self.start("p", "")
            self.open.pop()

    def build(self, page: str) -> Node:
        at, n, pattern = 0, len(page), _TAG
        while at < n:
            m = pattern.search(page, at)
            if m is None:
                self.text(page[at:])
                break
            self.text(page[at : m.start()])
            at = m.end()
            found = m.groupdict()
            if found["name2"]:
                pattern = _PLAIN_TAG
            name = found["name2"] or found.get("name")
            if not name:
                continue
            name = name.lower()
            if found["end2"] or found.get("end"):
                self.end(name)
                continue
            attrs = (found["attrs2"] if found["name2"] else found["attrs"]) or ""
            self.start(name, attrs)
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                stop, after = (close.start(), close.end()) if close else (n, n)
                if stop > at:
                    self.open[-1].children.append(page[at:stop])
                    if name == "style" and on_screen(self.open[-1].attributes().get("media", "")):
                        self.sheets.append(page[at:stop])
                self.open.pop()
                at = after
            elif name == "plaintext":
                self.open[-1].children.append(page[at:])
                break
        return self.root


def on_screen(media: str) -> bool:
    """Whether a list of media holds on every screen, whatever its size."""
    return not media.strip() or any(" ".join(m.lower().split()) in ALWAYS for m in media.split(","))


def flat_rules(sheet: str) -> Iterator[tuple[str, str, bool]]:
    """(selectors, declarations, within a layer) of the rules that hold on every screen. Braces are balanced: blocks of
    @layer, and of @media that always hold, are entered; all other @-blocks and nested rules are left out whole."""
    entered: list[bool] = []  # the open blocks that are read: whether they are layers
    head: list[str] = []
    body: list[str] | None = None
    skipped = 0
    for part in _CSS.findall(re.sub(r"/\*.*?(?:\*/|\Z)", " ", sheet, flags=re.S)):
        if skipped:
            skipped += (part == "{") - (part == "}")
        elif body is not None and part == "}":
            yield "".join(head), "".join(body), any(entered)
            head, body = [], None
        elif body is not None:
            skipped = int(part == "{")
            body.append(";" if skipped else part)
        elif part == "{":
            at = _AT.match("".join(head))
            if at is None:
                body = []
                continue
            if at[1].lower() == "layer" or at[1].lower() == "media" and on_screen(at[2]):
                entered.append(at[1].lower() == "layer")
            else:
                skipped = 1
            head = []
        elif part in ";}":
            if part == "}" and entered:
                entered.pop()
            head = []
        else:
            head.append(part)
    if body is not None:  # the end of a sheet ends its rules
        yield "".join(head), "".join(body), any(entered)


def declared(body: str) -> dict[str, tuple[bool, bool | None]]:
    """display and visibility, as declared last: (important, hidden: True, False or as the parent)."""
    out: dict[str, tuple[bool, bool | None]] = {}
    for part in body.split(";"):
        name, _, value = part.partition(":")
        name = name.strip().lower()
        if name not in ("display", "visibility"):
            continue
        value, mark, _ = value.lower().partition("!")
        value, important = value.strip(), bool(mark)
        if name in out and out[name][0] and not important:
            continue
        if name == "display" and value and not value.startswith("-"):
            out[name] = important, value == "none"
        elif name == "visibility" and value in ("visible", "hidden", "collapse", "inherit"):
            out[name] = important, None if value == "inherit" else value != "visible"
    return out


#: By (tag, class, id), what rules say of display and visibility: the order in which they win, and hidden or not.
Rules = dict[tuple[str, str, str], dict[str, tuple[tuple, bool | None]]]


def display_rules(sheets: list[str]) -> Rules:
    """The rules of simple selectors on display and visibility, by importance, layer, selector and place, as in browsers."""
    out: Rules = {}
    count = 0
    for sheet in sheets:
        for selectors, body, layered in flat_rules(sheet):
            said = declared(body) if "display" in body.lower() or "visibility" in body.lower() else {}
            for s in selectors.split(",") if said else ():
                if (m := _SIMPLE.match(s.strip())) and any(m.groups()):
                    key = (m[1].lower() if m[1] and m[1] != "*" else "", m[2] or "", m[3] or "")
                    own = out.setdefault(key, {})
                    for name, (important, hidden) in said.items():
                        count += 1
                        rank = (important, layered == important, bool(key[2]), bool(key[1]), bool(key[0]), count)
                        if name not in own or own[name][0] < rank:
                            own[name] = rank, hidden
    return out


def _width(text: str) -> int:
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 1 + (unicodedata.east_asian_width(c) in "WF") for c in text)


class Writer:
    """Lines of one flow: the page, or a table cell."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # a space is due before the next word
        self.gap = 0  # blank lines due before the next line
        self.indent: list[str] = []
        self.marker = ""

    def put(self, text: str) -> None:
        """Text with folded white space."""
        first = text[:1] in " \t\n\r\f"
        folded = _SPACE.sub(" ", text).strip(" ")
        if not folded:
            self.space |= bool(self.line) and bool(text)
            return
        if self.line and (self.space or first):
            self.line.append(" ")
        self.line.append(folded)
        self.space = text[-1:] in " \t\n\r\f"

    def put_raw(self, text: str) -> None:
        parts = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
        for i, part in enumerate(parts):
            if i:
                self.flush(True)
            if part:
                self.line.append(part)

    def flush(self, blank: bool = False) -> None:
        """Ends the line; an empty one counts if blank."""
        if self.line or blank:
            if self.lines and self.gap:
                self.lines.extend([""] * self.gap)
            self.gap = 0
            lead = "".join(self.indent)
            if self.marker:
                lead = lead[: max(0, len(lead) - len(self.marker))] + self.marker
                self.marker = ""
            self.lines.append((lead + "".join(self.line)).rstrip(" "))
            self.line = []
        self.space = False

    def block(self, spaced: bool) -> None:
        self.flush()
        if spaced:
            self.gap = 1

    def result(self) -> list[str]:
        self.flush()
        return self.lines


#: Columns of text up to which a cell widens its column; what is wider stands out, so that padding stays in proportion.
PAD_WIDTH = 100
MOST_BLANKS = 4 * PAD_WIDTH
#: Rows that a cell reaches down at most; each row looks at the cells that reach into it.
MAX_REACH = 300
#: Fixed value of HTML: the most columns that a cell spans.
MAX_SPAN = 1000


class Table:
    """Rows of (lines, columns, rows) of cells; the caption's lines."""

    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int, int]]] = []
        self.caption: list[str] = []

    def placed(self) -> list[list[tuple[int, int, list[str]]]]:
        """Of each row (first column, columns, lines) of its cells. A cell takes the next columns that no cell of a row
        above reaches down into."""
        out = []
        reaching: list[tuple[int, int, int]] = []  # first column, end, last row that is taken
        for number, row in enumerate(self.rows):
            above = sorted(r for r in reaching if r[2] >= number)
            own = []
            cells, column, at = [], 0, 0
            for lines, columns, rows in row:
                while at < len(above) and above[at][0] <= column:
                    column = max(column, above[at][1])
                    at += 1
                cells.append((column, columns, lines))
                if rows != 1:
                    own.append((column, column + columns, number + rows - 1 if rows else len(self.rows)))
                column += columns
            reaching = above + own
            out.append(cells)
        return out

    def lines(self) -> list[str]:
        """Cells padded to their columns' widths; a cell over several columns takes their widths together."""
        placed = self.placed()
        # Columns at which no cell begins or ends lie in one segment with their neighbours, so a wide span costs no more
        # than another cell. A segment of k columns is as wide as they are, with the blanks between.
        cuts = sorted({x for row in placed for c, n, _ in row for x in (c, c + n)} | {0})
        place = {x: i for i, x in enumerate(cuts)}
        widths = [0] * (len(cuts) - 1)
        for row in placed:
            for column, columns, cell in row:
                if columns == 1:
                    widths[place[column]] = max([widths[place[column]], *(min(PAD_WIDTH, _width(x)) for x in cell)])
        for row in placed:
            for column, columns, cell in row:
                if columns > 1:
                    first, end = place[column], place[column + columns]
                    have = sum(widths[first:end]) + 2 * (columns - 1)
                    widths[end - 1] += max(0, min(PAD_WIDTH, max(map(_width, cell), default=0)) - have)
        begin, total = {0: 0}, 0
        for i, w in enumerate(widths):
            total += w + 2 * (cuts[i + 1] - cuts[i])
            begin[cuts[i + 1]] = total
        out = list(self.caption)
        for row in placed:
            for k in range(max((len(c) for _, _, c in row), default=0)):
                parts, at = [], 0
                for column, _, cell in row:
                    if k >= len(cell) or not cell[k]:
                        continue
                    lead = min(max(begin[column] - at, 2 if at else 0), MOST_BLANKS)
                    parts.append(" " * lead + cell[k])
                    at += lead + _width(cell[k])
                out.append("".join(parts))
        return out


class Renderer:
    """Walks a tree without recursion and writes what is visible."""

    def __init__(self, rules: Rules):
        self.rules = rules
        self.writers = [Writer()]
        self.tables: list[Table] = []
        self.lists: list[list] = []  # [ordered, number]
        self.pre = 0

    def _style(self, node: Node) -> tuple[bool, bool | None]:
        """(not displayed, visible: True, False or as the parent)."""
        tag = node.tag
        if tag in NOT_SHOWN:
            return True, None
        if not node.attrs and not self.rules and tag != "dialog":
            return False, None
        a = node.attributes()
        if "hidden" in a and a["hidden"] != "until-found" or tag == "input" and a.get("type", "").lower() == "hidden" or tag == "dialog" and "open" not in a:
            return True, None
        found: dict[str, tuple[tuple, bool | None]] = {}
        if self.rules:
            kinds = [(c, "") for c in ("", *a.get("class", "").split())] + [("", i) for i in (a.get("id"),) if i]
            for key in ((t, c, i) for c, i in kinds for t in ("", tag)):
                for name, what in self.rules.get(key, {}).items():
                    if name not in found or found[name][0] < what[0]:
                        found[name] = what
        for name, (important, hidden) in declared(a["style"]).items() if a.get("style") else ():
            if name not in found or important or not found[name][0][0]:
                found[name] = (important,), hidden
        if "display" in found and found["display"][1]:
            return True, None
        hidden = found["visibility"][1] if "visibility" in found else None
        return False, None if hidden is None else not hidden

    def render(self, root: Node) -> str:
        # What is left to do: (node or text, visible) to enter, or (node, None) to leave.
        todo: list[tuple[Node | str, bool | None]] = [(root, True)]
        while todo:
            item, visible = todo.pop()
            if isinstance(item, str):
                if visible:
                    text = html.unescape(item) if "&" in item else item
                    self.writers[-1].put_raw(text) if self.pre else self.writers[-1].put(text)
                continue
            if visible is None:
                self.leave(item)
                continue
            gone, own = self._style(item)
            if gone:
                continue
            visible = visible if own is None else own
            self.enter(item)
            todo.append((item, None))
            for child in reversed(self.shown(item)):
                todo.append((child, visible))
        lines = self.writers[0].result()
        return "\n".join(lines).strip("\n")

    def shown(self, node: Node) -> list[Node | str]:
        if node.tag == "details" and "open" not in node.attributes():
            return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]
        if node.tag == "select":
            options = []
            todo = list(reversed(node.children))
            while todo:
                c = todo.pop()
                if isinstance(c, Node):
                    options += [c] if c.tag == "option" else []
                    todo += reversed(c.children) if c.tag == "optgroup" else []
            chosen = [o for o in options if "selected" in o.attributes()]
            several = "multiple" in node.attributes()
            return options if several else (chosen or options)[:1]
        return node.children

    def enter(self, node: Node) -> None:
        tag, w = node.tag, self.writers[-1]
        if tag == "br":
            w.flush(True)
        elif tag == "table":
            w.block(True)
            self.tables.append(Table())
        elif tag == "tr" and self.tables:
            self.tables[-1].rows.append([])
        elif tag in ("td", "th", "caption") and self.tables:
            self.writers.append(Writer())
            self.lists.append([None, 0])
        elif tag in ("ul", "ol", "menu", "dir"):
            w.block(not any(x[0] is not None for x in self.lists))
            start = node.attributes().get("start", "") if tag == "ol" else ""
            self.lists.append([tag == "ol", int(start) - 1 if re.fullmatch(r"-?[0-9]{1,9}", start) else 0])
        elif tag == "li":
            w.block(False)
            ordered = bool(self.lists) and self.lists[-1][0]
            if ordered:
                self.lists[-1][1] += 1
            marker = f"{self.lists[-1][1]}. " if ordered else "- "
            w.indent.append(" " * len(marker))
            w.marker = marker
        elif tag in ("dd", "blockquote"):
            w.block(tag == "blockquote")
            w.indent.append("    " if tag == "dd" else "  ")
        elif tag in SPACED or tag in TIGHT:
            w.block(tag in SPACED)
        if tag in ("pre", "textarea", "xmp", "plaintext", "listing"):
            self.pre += 1
            if node.children and isinstance(node.children[0], str) and tag != "xmp":
                node.children[0] = node.children[0].removeprefix("\r").removeprefix("\n")

    def leave(self, node: Node) -> None:
        tag, w = node.tag, self.writers[-1]
        if tag in ("pre", "textarea", "xmp", "plaintext", "listing"):
            self.pre -= 1
        if tag == "table":
            table = self.tables.pop()
            for line in table.lines():
                w.line.append(line)
                w.flush(True)
            w.block(True)
        elif tag in ("td", "th", "caption") and self.tables:
            lines = self.writers.pop().result()
            self.lists.pop()
            if tag == "caption":
                self.tables[-1].caption += lines
            else:
                if not self.tables[-1].rows:
                    self.tables[-1].rows.append([])
                a = node.attributes() if node.attrs else {}
                columns, rows = (int(x) if re.fullmatch("[0-9]{1,6}", x) else 1 for x in (a.get("colspan", "1"), a.get("rowspan", "1")))
                self.tables[-1].rows[-1].append((lines, min(MAX_SPAN, max(1, columns)), min(MAX_REACH, rows)))
        elif tag in ("ul", "ol", "menu", "dir"):
            self.lists.pop()
            w.block(not any(x[0] is not None for x in self.lists))
        elif tag in ("li", "dd", "blockquote"):
            w.flush()
            if w.marker:  # an item without text
                w.flush(True)
            w.indent.pop()
            w.block(tag == "blockquote")
        elif tag in SPACED or tag in TIGHT:
            w.block(tag in SPACED)


def render(page: str) -> str:
    """The page's visible text."""
    builder = Builder()
    root = builder.build(page.replace("\0", "�"))
    return Renderer(display_rules(builder.sheets)).render(root)


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """All columns but the page's source, then text, n_chars and n_lines; one page in memory at a time."""
    new = ("text", "n_chars", "n_lines")
    kept = pages.select(*[c for c in pages.columns if c not in new or c == html_col])
    names = kept.columns
    at = names.index(html_col)
    others = [n for n in names if n != html_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(v.as_py() or "") for v in batch.column(at)]
            kept_columns = [batch.column(i) for i, n in enumerate(names) if n != html_col]
            made = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*kept_columns, *made], names=[*others, *new])

    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields if f.name != html_col)
    return kept.mapInArrow(run, f"{schema}text string, n_chars long, n_lines long")
