"""HTML extraction by layout: a tree with implied tags, visibility rules, and rendering as text.

The result is what a reader sees: every visible word, paragraphs apart, list items marked and
indented, table cells in aligned columns, preformatted text as it stands.  Text in drawings (svg) and all
options of a list box are shown; a closed menu shows its choice.

A null page gives null, an empty one an empty text; each row is read by itself, so ties and repeated rows
give the same text, and other columns are kept.  Broken pages are read as browsers do: what is left open is closed by
the end, what is closed without being open is passed over.  Depth has no limit and the time is in
proportion to the page: trees, sheets and rendering keep their own stacks and read each letter a
bounded number of times.
"""

from __future__ import annotations

import re
from functools import partial
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import col, table

#: Lists, quotes and tables that lie deeper in one another than this are set as plain blocks; no text is lost.
MAX_NEST = 40
#: Cells are padded to the longest of their column, this wide at most; longer ones run over.
MAX_COLUMN = 80

# Sets of element names from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript title meta link base iframe noembed noframes audio video canvas object datalist rp param source track area col colgroup".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure fieldset hr menu details".split())
BLOCKS = PARAGRAPHS | frozenset(
    "address article aside body center dd dialog dir div dt figcaption footer form header hgroup html legend li listing main nav option optgroup search section summary tr thead tbody tfoot caption".split()
)
#: Parts of a drawing that are not drawn where they stand.
UNDRAWN = frozenset("defs symbol clippath mask marker pattern lineargradient radialgradient filter metadata desc".split())
#: HTML elements that end a drawing they stand in.
ENDS_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
HEAD_ONLY = frozenset("base basefont bgsound link meta noframes script style template title noscript".split())
CLOSES_P = (BLOCKS | frozenset(["xmp"])) - frozenset("option optgroup tr thead tbody tfoot caption html body legend".split())
#: A start tag ends the open elements on the left, searched up to those on the right.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist", "optgroup"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
}
P_SCOPE = frozenset("table td th caption button body html template li".split())
END_SCOPE = frozenset("table td th caption".split())
_TABLE = frozenset(["table"])
_SVG = frozenset(["svg"])
_HTML_IN_SVG = frozenset(["foreignobject"])
TABLE_PARTS = frozenset("table tr td th tbody thead tfoot caption colgroup".split())

_VALUE = r""""[^"<>]*+"|"[^"]{0,65536}+"|'[^'<>]*+'|'[^']{0,65536}+'"""
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|{_VALUE})*+)>|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>", re.S
)
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_SPACE = re.compile(r"[ \t\n\r\f]+")
#: Comments and strings of a sheet; those left open end with the sheet or the line.
_QUIET = re.compile(r"""/\*.*?(?:\*/|\Z)|"(?:[^"\\\n]|\\.)*+"?|'(?:[^'\\\n]|\\.)*+'?""", re.S)
_PIECE = re.compile(r"([^{};]*+)([{};]|\Z)")
#: Media blocks that may hold on a screen.
_SHOWING_BLOCK = re.compile(r"@(?:media(?!\s+(?:only\s+)?print\b)|supports|layer|container)", re.I)
#: Tag, names and the conditions that are not looked at of an element's own selector.
_COMPOUND = re.compile(r"^([a-z][\w-]*+|\*)?+((?:[.#][\w-]++)*+)((?:\[\]|:[\w-]++(?:\([^()]*+\))?+|[.#][\w-]++)*+)$", re.I)
#: States that a page is not in when it is opened, and parts that are no elements.
_UNSEEN = re.compile(r"::|:(?:hover|focus|active|target|before|after|first-line|first-letter)", re.I)
_RELEVANT = re.compile(r"display|visibility", re.I)
_DECLARED = re.compile(r"(?<![\w-])(display|visibility)\s*:\s*([a-z-]+)[^;!]*(!\s*important)?", re.I)
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(source):
        if value[:1] in "\"'":
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


# -- the tree -----------------------------------------------------------------------------------------


class Open:
    """The open elements, outermost first, and where each kind of them stands."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def cut(self, size: int) -> None:
        while len(self.nodes) > size:
            self.places[self.nodes.pop().tag].pop()

    def innermost(self, tags: frozenset) -> int:
        """Place of the innermost open element of these kinds, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def close(self, tags: frozenset, scope: frozenset) -> bool:
        """End the innermost element of ``tags`` with all in it, unless one of ``scope`` is further in."""
        at = self.innermost(tags)
        if not at or at < self.innermost(scope):
            return False
        self.cut(at)
        return True


def parse(source: str) -> tuple[Node, list[str]]:
    """Tree of a page and the texts of its style sheets."""
    root = Node("html", {})
    opened, styles, at = Open(root), [], 0
    size, last = len(source), source.rfind(">")
    while at < size:
        start = source.find("<", at)
        if start < 0 or start > last:
            start = size
        if start > at:
            _add_text(opened, source[at:start])
        if start == size:
            break
        token = _TOKEN.match(source, start)
        if token is None:
            _add_text(opened, "<")
            at = start + 1
            continue
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            continue
        tag, rest = name.lower(), token[3] or token[6] or ""
        if token[1] or token[4]:
            _end(opened, tag)
            continue
        node = _start(opened, tag, _attributes(rest) if rest.strip(" /") else {}, rest.endswith("/"))
        if tag in RAW:
            close = _ENDS[tag].search(source, at)
            stop = close.start() if close else size
            body = source[at:stop]
            if tag == "style":
                styles.append(body)
            elif body and tag not in HIDDEN:
                node.children.append(unescape(body) if tag == "textarea" else body)
            at = stop
    return root, styles


def _add_text(opened: Open, text: str) -> None:
    if opened.nodes[-1].tag == "head":
        if not text.strip():
            return
        opened.cut(len(opened.nodes) - 1)
    opened.nodes[-1].children.append(unescape(text) if "&" in text else text)


def _start(opened: Open, tag: str, attrs: dict[str, str], ended: bool) -> Node:
    top = opened.nodes[-1]
    if tag == "html":
        opened.nodes[0].attrs.update(attrs)
        return top
    if tag == "body" and opened.places.get("body"):
        return top
    drawing = opened.innermost(_SVG) > opened.innermost(_HTML_IN_SVG)
    if drawing and tag in ENDS_SVG:
        opened.cut(opened.innermost(_SVG))
        drawing = False
    if not drawing:
        if tag == "body" or (opened.nodes[-1].tag == "head" and tag not in HEAD_ONLY):
            opened.close(frozenset(["head"]), frozenset())
        if tag in CLOSES_P:
            opened.close(frozenset(["p"]), P_SCOPE)
        top = opened.nodes[-1]
        if tag in IMPLIED:
            opened.close(*IMPLIED[tag])
        elif tag[0] == "h" and tag in PARAGRAPHS and tag != "hr" and top.tag in PARAGRAPHS and top.tag[0] == "h":
            opened.cut(len(opened.nodes) - 1)
    node = Node(tag, attrs)
    opened.nodes[-1].children.append(node)
    if tag not in VOID and tag not in RAW and not (ended and (drawing or tag == "svg")):
        opened.push(node)
    return node


def _end(opened: Open, tag: str) -> None:
    if tag in ("html", "body"):
        return  # what follows still belongs to the body
    if tag == "br":
        opened.nodes[-1].children.append(Node("br", {}))
        return
    scope = frozenset() if tag == "table" else _TABLE if tag in TABLE_PARTS else END_SCOPE
    if not opened.close(frozenset([tag]), scope) and tag == "p":
        opened.nodes[-1].children.append(Node("p", {}))


# -- visibility ---------------------------------------------------------------------------------------


class Sheet:
    """Rules that hide or show, by the last part of their selector, with importance, specificity and order.

    Rules for a tag, its classes and ids apply as in browsers.  Of those whose selector also asks for
    other elements, attributes or states, or that stand in a media block, only the ones that show
    are taken, as if the rest held: no text is lost to a rule that may be overridden.
    """

    def __init__(self, styles: list[str]):
        self.rules: dict[str, list[tuple]] = {}
        count = 0
        for text in styles:
            if not _RELEVANT.search(text):
                continue
            for selectors, body, sure in _style_rules(text):
                effects = _effects(body)
                for selector in selectors.split(",") if effects else ():
                    count += 1
                    self._add(selector.strip(), effects, sure, count)

    def _add(self, selector: str, effects: dict[str, tuple[bool, str]], sure: bool, place: int) -> None:
        parts = re.split(r"\s*[\s>+~]\s*", re.sub(r"\[[^\[\]]*+\]", "[]", selector))
        last = _COMPOUND.match(parts[-1])
        if not last or not parts[-1] or _UNSEEN.search(selector):
            return
        if len(parts) > 1 or last[3]:
            sure = False
        if not sure:
            effects = {k: x for k, x in effects.items() if x[1] in ("shown", "visible")}
        tag, names = (last[1] or "*").lower(), frozenset(re.findall(r"[.#][\w-]+", last[2]))
        weight = (selector.count("#"), len(re.findall(r"[.:\[]", selector)), len(re.findall(r"(?:^|[\s>+~])[a-z]", selector, re.I)))
        if effects:
            self.rules.setdefault(min(names, default=tag), []).append((tag, names, effects, weight, place))

    def effect(self, node: Node) -> str | None:
        """``none``, ``hidden``, ``visible`` or no effect."""
        attrs = node.attrs
        if not attrs and not self.rules:
            return None
        best: dict[str, tuple] = {}
        if "hidden" in attrs and attrs["hidden"].lower() != "until-found":
            best["display"] = (False, -1, (), 0, "none")
        names = {f".{c}" for c in attrs.get("class", "").split()} | ({f"#{attrs['id']}"} if attrs.get("id") else set())
        for name in (*names, node.tag, "*") if self.rules else ():
            for tag, wanted, effects, weight, place in self.rules.get(name, ()):
                if tag in ("*", node.tag) and wanted <= names:
                    for kind, (important, value) in effects.items():
                        best[kind] = max(best.get(kind, (False, -2)), (important, 0, weight, place, value))
        for kind, (important, value) in _effects(attrs["style"]).items() if "style" in attrs else ():
            best[kind] = max(best.get(kind, (False, -2)), (important, 1, (), 0, value))
        if "display" in best and best["display"][-1] == "none":
            return "none"
        return best["visibility"][-1] if "visibility" in best else None


def _style_rules(css: str) -> list[tuple[str, str, bool]]:
    """(selectors, declarations, sure) of a sheet, in one pass; unsure are those in a block or in another rule."""
    rules: list[tuple[str, str, bool]] = []
    within: list[tuple[str, list[str], bool]] = []  # open blocks: selectors or "", declarations, sure
    unread = 0  # depth within a block that is passed over
    for text, mark in _PIECE.findall(_QUIET.sub(lambda m: " " if m[0][0] == "/" else '""', css)):
        if unread:
            unread += (mark == "{") - (mark == "}")
            continue
        head = text.strip()
        if mark == "{":
            if head[:1] != "@":
                within.append((head.replace("&", "").strip() or "&", [], not within))
            elif _SHOWING_BLOCK.match(head):
                within.append(("", [], False))
            else:
                unread = 1
            continue
        if within:
            within[-1][1].append(text)
        if mark == "}" and within:
            selectors, body, sure = within.pop()
            rules.append((selectors, ";".join(body), sure))
    rules += [(selectors, ";".join(body), sure) for selectors, body, sure in reversed(within)]
    return [r for r in rules if r[0]]


def _effects(css: str) -> dict[str, tuple[bool, str]]:
    """{display: (important, none or shown), visibility: (important, hidden or visible)} of declarations."""
    out: dict[str, tuple[bool, str]] = {}
    for kind, value, important in _DECLARED.findall(css):
        kind, value = kind.lower(), value.lower()
        if kind == "display":
            value = "none" if value == "none" else "shown"
        elif value in ("hidden", "collapse", "visible"):
            value = "visible" if value == "visible" else "hidden"
        else:
            continue
        if kind not in out or bool(important) >= out[kind][0]:
            out[kind] = (bool(important), value)
    return out


# -- rendering ----------------------------------------------------------------------------------------


class Flow:
    """Lines of text; ``gap`` is the break owed before the next text: 0 none, 1 line, 2 blank line."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.current: list[str] = []
        self.gap = 0
        self.spaced = True  # at a line's start, or after a space

    def text(self, text: str, pre: bool) -> None:
        if pre:
            for k, part in enumerate(text.replace("\r\n", "\n").split("\n")):
                if k:
                    self.newline()
                if part:
                    self._put(part)
            return
        text = _SPACE.sub(" ", text)
        if self.spaced and text[:1] == " ":
            text = text[1:]
        if text:
            self._put(text)

    def _put(self, text: str) -> None:
        if self.gap:
            self.flush()
        self.current.append(text)
        self.spaced = text[-1] == " "

    def flush(self) -> None:
        if self.current:
            self.lines.append("".join(self.current).rstrip(" "))
            self.current = []
        if self.gap == 2 and self.lines and self.lines[-1]:
            self.lines.append("")
        self.gap, self.spaced = 0, True

    def newline(self) -> None:
        if self.gap:
            self.flush()
        else:
            self.lines.append("".join(self.current).rstrip(" "))
            self.current, self.spaced = [], True

    def block(self, gap: int) -> None:
        if self.current or self.lines:
            self.gap = max(self.gap, gap)
        self.spaced = True

    def add(self, lines: list[str]) -> None:
        if lines:
            self.gap = max(self.gap, 1)
            self.flush()
            self.lines.extend(lines)
            self.gap = 1

    def done(self) -> list[str]:
        self.gap = 0
        self.flush()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        start = 0
        while start < len(lines) and not lines[start]:
            start += 1
        return lines[start:]


def _render(node: Node, flow: Flow, sheet: Sheet, shown: bool, pre: bool, nest: int) -> None:
    """The children of ``node`` into ``flow``.

    Plain nesting is followed with a stack of its own; only layouts in layouts, ``MAX_NEST`` at most,
    are calls within calls.
    """
    todo = [(iter(node.children), shown, pre, node.tag == "svg", None)]

    def enter(element: Node, seen: bool, pre: bool, after=None, svg: bool = False) -> None:
        todo.append((iter(element.children), seen, pre, svg, after))

    while todo:
        children, shown, pre, drawing, after = todo[-1]
        child = next(children, None)
        if child is None:
            todo.pop()
            if after:
                after()
            continue
        if isinstance(child, str):
            if shown and not drawing:
                flow.text(child, pre)
            continue
        tag = child.tag
        if tag in HIDDEN or (drawing and tag in UNDRAWN):
            continue
        effect = sheet.effect(child)
        if effect == "none" or (tag == "dialog" and "open" not in child.attrs):
            continue
        seen = shown if effect is None else effect == "visible"
        layout = nest < MAX_NEST
        if tag == "svg" or drawing:
            label = tag in ("text", "foreignobject") and drawing
            if label:
                flow.block(1)
            enter(child, seen, pre, partial(flow.block, 1) if label else None, not label)
        elif tag == "br":
            flow.newline()
        elif tag == "input":
            if seen and child.attrs.get("type", "").lower() in ("submit", "button", "reset") and child.attrs.get("value"):
                flow.text(child.attrs["value"], False)
        elif tag == "select":
            _render_select(child, flow, sheet, seen, nest)
        elif tag in ("ul", "ol", "menu", "dir") and layout:
            _render_list(child, flow, sheet, seen, pre, nest)
        elif tag == "table" and layout:
            flow.block(2)
            flow.add(_table_lines(child, sheet, seen, pre, nest))
            flow.block(2)
        elif tag in ("dd", "blockquote") and layout:
            flow.block(2 if tag == "blockquote" else 1)
            flow.add(_indented(_lines(child, sheet, seen, pre, nest), "  ", "  "))
            flow.block(2 if tag == "blockquote" else 1)
        elif tag == "details" and "open" not in child.attrs:
            closed = Node("details", {})
            closed.children = [c for c in child.children if not isinstance(c, str) and c.tag == "summary"][:1]
            flow.block(2)
            enter(closed, seen, pre, partial(flow.block, 2))
        elif tag in BLOCKS:
            gap = 2 if tag in PARAGRAPHS else 1
            flow.block(gap)
            enter(child, seen, pre or tag in ("pre", "listing", "xmp"), partial(flow.block, gap))
        elif tag in ("td", "th"):  # outside of a table, or deeper than tables are laid out
            flow.text(" ", False)
            enter(child, seen, pre, partial(flow.text, " ", False))
        elif tag == "q" and seen:
            flow.text("“", False)
            enter(child, seen, pre, partial(flow.text, "”", False))
        else:
            enter(child, seen, pre or tag in ("textarea", "xmp"))


def _lines(node: Node, sheet: Sheet, shown: bool, pre: bool, nest: int) -> list[str]:
    flow = Flow()
    _render(node, flow, sheet, shown, pre, nest + 1)
    return flow.done()


def _indented(lines: list[str], first: str, rest: str) -> list[str]:
    return [(rest if k else first) + line if line else line for k, line in enumerate(lines)]


def _render_list(node: Node, flow: Flow, sheet: Sheet, shown: bool, pre: bool, nest: int) -> None:
    start = node.attrs.get("start", "")
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    flow.block(2)
    for child in node.children:
        if isinstance(child, str) or child.tag != "li":
            loose = Node("div", {})
            loose.children = [child]
            flow.add(_lines(loose, sheet, shown, pre, nest))
            continue
        effect = sheet.effect(child)
        if effect == "none":
            continue
        value = child.attrs.get("value", "")
        if re.fullmatch(r"-?\d{1,9}", value):
            number = int(value)
        marker = f"{number}. " if node.tag == "ol" else "- "
        flow.add(_indented(_lines(child, sheet, shown if effect is None else effect == "visible", pre, nest), marker, " " * len(marker)))
        number += 1
    flow.block(2)


def _render_select(node: Node, flow: Flow, sheet: Sheet, shown: bool, nest: int) -> None:
    """A closed menu shows its chosen options, or the first; a list box shows all, with their groups."""
    size = node.attrs.get("size", "")
    box = "multiple" in node.attrs or (size.isdecimal() and len(size) < 9 and int(size) > 1)
    found: list[tuple[Node, bool]] = []
    todo = [(child, shown) for child in reversed(node.children)]
    while todo:
        item, seen = todo.pop()
        if isinstance(item, str) or item.tag in HIDDEN:
            continue
        effect = sheet.effect(item)
        if effect == "none":
            continue
        seen = seen if effect is None else effect == "visible"
        if item.tag in ("option", "optgroup"):
            found.append((item, seen))
        if item.tag != "option":
            todo += [(child, seen) for child in reversed(item.children)]
    if box:
        flow.block(1)
        for item, seen in found:
            label = [item.attrs.get("label", "")] if item.tag == "optgroup" and seen else []
            flow.add(label if item.tag == "optgroup" else _lines(item, sheet, seen, False, nest))
        flow.block(1)
        return
    options = [x for x in found if x[0].tag == "option"]
    for option, seen in [x for x in options if "selected" in x[0].attrs] or options[:1]:
        flow.text(" " + " ".join(_lines(option, sheet, seen, False, nest)) + " ", False)


def _table_lines(node: Node, sheet: Sheet, shown: bool, pre: bool, nest: int) -> list[str]:
    """Rows as lines; the columns of rows with several cells begin at the same place."""
    rows: list[list[tuple[int, int, list[str]]]] = []  # (column, span, lines)
    outside: list[str] = []
    held: dict[int, int] = {}  # column -> rows for which a cell from above still holds it

    def add_row(row: Node, seen: bool) -> None:
        cells, at = [], 0
        for cell in row.children:
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                if isinstance(cell, Node) or cell.strip():
                    loose = Node("div", {})
                    loose.children = [cell]
                    outside.extend(_lines(loose, sheet, seen, pre, nest))
                continue
            effect = sheet.effect(cell)
            if effect == "none":
                continue
            while held.get(at):
                at += 1
            span, down = _span(cell, "colspan", 1000), _span(cell, "rowspan", 65534)
            cells.append((at, span, _lines(cell, sheet, seen if effect is None else effect == "visible", pre, nest)))
            for k in range(at, at + span):
                if down > 1:
                    held[k] = max(held.get(k, 0), down)
            at += span
        for k in [k for k in held]:
            held[k] -= 1
            if not held[k]:
                del held[k]
        if any(lines for *_, lines in cells):
            rows.append(cells)

    def walk(part: Node, seen: bool) -> None:
        for child in part.children:
            if isinstance(child, str):
                if child.strip() and seen:
                    outside.extend(_lines_of_text(child))
                continue
            effect = sheet.effect(child) if child.tag not in HIDDEN else "none"
            if effect == "none":
                continue
            now = seen if effect is None else effect == "visible"
            if child.tag in ("thead", "tbody", "tfoot"):
                walk(child, now)
            elif child.tag == "tr":
                add_row(child, now)
            elif child.tag in ("td", "th"):
                row = Node("tr", {})
                row.children = [child]
                add_row(row, now)
            else:
                loose = Node("div", {})
                loose.children = [child]
                outside.extend(_lines(loose, sheet, now, pre, nest))

    walk(node, shown)
    widths: dict[int, int] = {}
    for cells in rows:
        for at, span, lines in cells:
            if span == 1:
                widths[at] = max([widths.get(at, 0), *map(len, lines)])
    widths = {at: min(width, MAX_COLUMN) for at, width in widths.items()}
    starts, place = {}, 0
    for at in range(max(widths, default=-1) + 2):
        starts[at] = place
        place += widths.get(at, 0) + 2 if at in widths else 0
    out = outside
    for cells in rows:
        for k in range(max(len(lines) for *_, lines in cells)):
            line = ""
            for at, _, lines in cells:
                if k < len(lines) and lines[k]:
                    begin = starts.get(at, place)
                    line = line.ljust(begin) if len(line) < begin else line + "  " if line else line
                    line += lines[k]
            out.append(line.rstrip(" "))
    return out


def _lines_of_text(text: str) -> list[str]:
    flow = Flow()
    flow.text(text, False)
    return flow.done()


def _span(cell: Node, name: str, most: int) -> int:
    value = cell.attrs.get(name, "")
    return min(max(int(value), 1), most) if value.isdecimal() and len(value) < 9 else 1


def extract(source: str | None) -> str | None:
    """Visible text of one whole page; null for null, empty for a page without any."""
    if source is None:
        return None
    root, styles = parse(source)
    sheet = Sheet(styles)
    return "\n".join(_lines(root, sheet, sheet.effect(root) != "hidden", False, -1)).replace("\xa0", " ")


def visible_text(html: Column) -> Column:
    @F.pandas_udf("string")
    def render(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(p) for p in pages], dtype=object)

    return render(html)


def extract_pages(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``html`` in ``out`` (replaced if there is such a column)."""
    return pages.withColumn(out, visible_text(col(html)))


def query(spark, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")
