"""Layout-aware text of HTML pages.

A tree is built as browsers do: start and end tags that HTML lets authors leave out are implied (also the head's end and table rows), void
elements have no content, raw-text elements run to their own end tag, and stray end tags are passed over. All visible text is then
rendered: blocks on lines of their own with a blank line around paragraphs, headings and the like, list items with markers and indentation,
table rows with their cells padded to columns, spans of columns and rows kept free, preformatted text as it is. What a page does not show
is left out: scripts, styles, templates, hidden elements, comments, the head. Neither step uses Python's own stack, so pages may nest at
any depth.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import chunks, ship_code

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("script style template head title noscript iframe noembed noframes object audio video canvas datalist defs desc metadata annotation annotation-xml area base col colgroup link meta param source track rp".split())
#: What may stand in the head; any other text or element ends it.
IN_HEAD = frozenset("base link meta title style script noscript template noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p plaintext pre search section select summary table tbody td tfoot th thead tr ul caption".split()
)
#: Values of a style's display that make a block of any element.
DISPLAYS = frozenset("block flex grid list-item table flow-root".split())
#: Blocks with a blank line around them.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote plaintext pre ul ol dl table figure hr article section fieldset".split())
#: Inline elements whose end tag ends them alone, with blocks that were begun inside left open.
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
LISTS = frozenset("ul ol menu dir".split())
GROUPS = frozenset("tbody thead tfoot".split())
CELLS = frozenset({"td", "th"})
#: A start tag ends these open elements, if none of the second set is in between.
ROWS = {"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}
IMPLIED = {
    "li": ({"li"}, LISTS | CELLS | {"caption"}), "dt": ({"dt", "dd"}, CELLS | {"dl", "caption"}), "dd": ({"dt", "dd"}, CELLS | {"dl", "caption"}),
    "option": ({"option"}, {"select", "datalist"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th", "caption"}, {"tr", "table"}),
    "th": ({"td", "th", "caption"}, {"tr", "table"}), "tbody": (ROWS, {"table"}), "thead": (ROWS, {"table"}), "tfoot": (ROWS, {"table"}), "caption": (ROWS, {"table"}),
}
ENDS_P = BLOCK - ROWS - {"body", "html", "option", "legend"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Bounds of the HTML standard for spans.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
#: Columns that indentation takes at most; text nested deeper stands there.
INDENT = 80

_token = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"""
    r"""|</?[a-zA-Z][^\s/>]*+(?:[\s/]++|=*+[^\s/>=]++(?:\s*+=\s*+(?>"[^"]*+"|'[^']*+'|[^\s>]*+))?+|=++)*+(?:>|\Z)""",
    re.DOTALL,
)
_attribute = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?>"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?+""")
_name = re.compile(r"[^\s/>]*")
_space = re.compile(r"[ \t\n\f\r]+")
_blank = " \t\n\f\r"


class Element:
    """gone: not rendered at all; seen: False or True where the element says so itself (visibility), else None; block: a block by its style."""

    __slots__ = ("name", "children", "attributes", "gone", "seen", "block")

    def __init__(self, name: str, attributes: dict[str, str] | None = None):
        self.name, self.children, self.attributes, self.seen, self.block = name, [], attributes or {}, None, False
        a = self.attributes
        self.gone = name in HIDDEN or "hidden" in a or (name == "input" and a.get("type", "").lower() == "hidden") or (name == "dialog" and "open" not in a)
        if "style" in a:
            style = {}
            for part in a["style"].split(";"):
                key, _, value = part.partition(":")
                style[key.strip().lower()] = value.replace("!important", "").strip().lower()
            self.gone |= style.get("display") == "none"
            self.block = style.get("display") in DISPLAYS
            if style.get("visibility") in ("hidden", "collapse", "visible"):
                self.seen = style["visibility"] == "visible"


class Open:
    """The stack of open elements, with a count of each name."""

    def __init__(self, root: Element):
        self.stack, self.count = [root], Counter()

    def push(self, element: Element) -> None:
        self.stack[-1].children.append(element)
        self.stack.append(element)
        self.count[element.name] += 1

    def cut(self, at: int) -> None:
        for x in self.stack[at:]:
            self.count[x.name] -= 1
        del self.stack[at:]

    def start(self, name: str) -> None:
        """Ends the open elements that a start tag of this name ends, and begins those that it implies."""
        stack = self.stack
        if stack[-1].name == "head" and name not in IN_HEAD:
            self.cut(len(stack) - 1)
        if name in ENDS_P and self.count["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    self.cut(k)
                    break
                if stack[k].name in BLOCK:
                    break
        if name in IMPLIED:
            ends, until = IMPLIED[name]
            cut = None
            if any(self.count[x] for x in ends):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name in until:
                        break
                    if stack[k].name in ends:
                        cut = k
            if cut is not None:
                self.cut(cut)
            if name in CELLS and self.count["table"] and stack[-1].name in GROUPS | {"table"}:
                self.push(Element("tr"))
        elif name in HEADINGS and stack[-1].name in HEADINGS:
            self.cut(len(stack) - 1)

    def end(self, name: str) -> None:
        """An end tag; it reaches beyond no table cell, a list item's beyond no list, and an inline element's ends no block."""
        if not self.count[name]:
            if name in ("p", "br"):
                self.stack[-1].children.append(Element(name))
            return
        of_table = name in ROWS or name == "table"
        inside = False
        for k in range(len(self.stack) - 1, 0, -1):
            x = self.stack[k].name
            if x == name:
                if inside:
                    self.count[x] -= 1
                    del self.stack[k]
                else:
                    self.cut(k)
                return
            if not of_table and x in CELLS | {"table"} or name == "li" and x in LISTS:
                break
            if x in BLOCK and name not in BLOCK:
                if name not in FORMATTING:
                    break
                inside = True
        if name == "p":
            self.stack[-1].children.append(Element(name))


def tree(page: str) -> Element:
    """The elements of a page below one root; text is in strings."""
    root = Element("html")
    open_ = Open(root)
    at, n, body = 0, len(page), False

    def text(value: str) -> None:
        if value:
            if open_.stack[-1].name == "head" and value.strip(_blank):
                open_.cut(len(open_.stack) - 1)
            open_.stack[-1].children.append(html.unescape(value) if "&" in value else value)

    while at < n:
        m = _token.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at, tag = m.end(), m.group()
        if tag[1] in "!?":
            continue
        if tag[1] == "/":
            open_.end(_name.match(tag, 2).group().lower())
            continue
        name = _name.match(tag, 1).group().lower()
        if name == "html" or name == "head" and (body or open_.count["head"]) or name == "body" and open_.count["body"]:
            continue
        if name in ROWS and not open_.count["table"]:  # parts of a table mean nothing elsewhere
            continue
        body |= name == "body"
        rest = tag[1 + len(name) :].removesuffix(">")
        attributes = {}
        if rest.strip(" /\n\t"):
            for k, *v in _attribute.findall(rest):
                attributes.setdefault(k.lower(), html.unescape(v[0] or v[1] or v[2]))
        open_.start(name)
        element = Element(name, attributes)
        if name in VOID:
            open_.stack[-1].children.append(element)
        elif name in RAW:
            open_.stack[-1].children.append(element)
            end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            inner = page[at : end.start() if end else n]
            element.children.append(html.unescape(inner) if name in ("textarea", "title") else inner)
            at = end.end() if end else n
        else:
            open_.push(element)
            if name == "plaintext":  # has no end
                element.children.append(page[at:])
                break
    return root


def width(text: str) -> int:
    """Columns of a text: wide characters take two, combining ones none."""
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Lines:
    """Output lines. A blank line stands between blocks if either asks for it. Open levels put their marker before their first line and
    as many blanks before the further ones."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.blank = False
        self.levels: list[int] = []  # widths of levels that have a line
        self.shift = 0
        self.fresh: list[str] = []  # markers of levels that have none yet

    def open(self, marker: str) -> None:
        self.fresh.append(marker)

    def close(self) -> None:
        if self.fresh:
            self.fresh.pop()
        else:
            self.shift -= self.levels.pop()
            self.blank = False

    def add(self, text: str) -> None:
        flat = _space.sub(" ", text)
        if not self.now or self.now[-1].endswith(" "):
            flat = flat.lstrip(" ")
        if flat:
            self.now.append(flat)

    def end(self, spaced: bool = False) -> None:
        line = "".join(self.now).rstrip(" ")
        self.now = []
        if line:
            self.put(line)
        self.blank |= spaced and not self.fresh  # no space between a marker and its line

    def put(self, line: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        before = " " * min(self.shift, INDENT)
        if self.fresh:
            before += "".join(self.fresh)
            for marker in self.fresh:
                self.levels.append(len(marker))
                self.shift += len(marker)
            self.fresh = []
        self.lines.append((before + line).rstrip(" ") if line else "")


class Table:
    """Rows of cells (lines, columns, rows) as they are met, and lines of captions and strays before them."""

    def __init__(self, outer: Lines):
        self.outer, self.before, self.rows = outer, Lines(), []

    def lines(self) -> list[str]:
        self.before.end()
        before, rows = self.before.lines, self.rows
        if all(len(r) <= 1 for r in rows):  # a table of one column is layout
            return before + [line for r in rows for cell, _, _ in r for line in cell]
        placed: list[list[tuple[int, list[str], int]]] = []
        taken: dict[int, int] = {}  # column: rows below that a cell above still takes
        columns: dict[int, int] = {}
        for row in rows:
            at, line, down = 0, [], {c: n - 1 for c, n in taken.items() if n > 1}
            for cell, across, below in row:
                while at in taken:
                    at += 1
                line.append((at, cell, across))
                for c in range(at, at + across):
                    columns.setdefault(c, 0)
                    if below > 1:
                        down[c] = below - 1
                if across == 1:
                    columns[at] = max(columns[at], max(map(width, cell), default=0))
                at += across
            placed.append(line)
            taken = down
        starts = [0]
        for c in range(max(columns, default=-1) + 1):
            starts.append(starts[-1] + columns.get(c, 0) + 3)
        out = before
        for line in placed:
            for k in range(max((len(cell) for _, cell, _ in line), default=0)):
                made, done = "", 0
                for at, cell, across in line:
                    if at > done:
                        made += "".join(" " * columns.get(c, 0) + " | " for c in range(done, at))
                    text = cell[k] if k < len(cell) else ""
                    made += text + " " * max(0, starts[at + across] - starts[at] - 3 - width(text)) + " | "
                    done = at + across
                out.append("" if not made.strip(" |") else made[:-3].rstrip(" "))
        return out


def spanned(element: Element, name: str, most: int) -> int:
    value = element.attributes.get(name, "1").strip(_blank)
    n = min(int(value), most) if re.fullmatch(r"\d{1,18}", value) else 1
    return n if n or name == "rowspan" else 1


def numbered(element: Element, name: str, otherwise: int) -> int:
    value = element.attributes.get(name, "")
    return int(value) if re.fullmatch(r"-?\d{1,9}", value) else otherwise


#: Roman numerals.
ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


def marker(value: int, kind: str) -> str:
    """A list item's number, as figures, letters or a Roman numeral; figures where the others have no such number."""
    out, left = "", value
    if kind in ("a", "A"):
        while left > 0:
            left, k = divmod(left - 1, 26)
            out = chr(97 + k) + out
    elif kind in ("i", "I") and value < 4000:
        for n, sign in ROMAN:
            while left >= n:
                out, left = out + sign, left - n
    return (out.upper() if kind.isupper() else out) or str(value)


def plain(element: Element, seen: bool) -> str:
    """Text of an element with its white space."""
    parts, work = [], [(x, seen) for x in reversed(element.children)]
    while work:
        x, seen = work.pop()
        if isinstance(x, str):
            parts.append(x if seen else "")
        elif x.name == "br":
            parts.append("\n")
        elif not x.gone:
            here = seen if x.seen is None else x.seen
            work += [(y, here) for y in reversed(x.children)]
    return "".join(parts)


def rendered(root: Element) -> list[str]:
    """The lines of a tree. Open elements wait on a stack: (element, children left, visible, what to do at the end, table, numbers)."""
    out = Lines()
    work: list[tuple] = [(root, iter(root.children), root.seen is not False, None, None, None)]
    while work:
        parent, children, seen, finish, table, numbers = work[-1]
        child = next(children, None)
        if child is None:
            work.pop()
            if finish == "cell":
                out.end()
                table.rows[-1].append((out.lines, spanned(parent, "colspan", MOST_COLUMNS), spanned(parent, "rowspan", MOST_ROWS) or MOST_ROWS))
                out = table.before
            elif finish == "table":
                out = table.outer
                for line in table.lines():
                    out.put(line)
                out.end(True)
            elif finish == "level":
                out.end()
                out.close()
            elif finish == "list":
                out.end(not numbers["inner"])
            elif finish == "block":
                out.end(parent.name in SPACED)
            elif finish == "quote" and seen:
                out.add('"')
            continue
        if isinstance(child, str):
            if seen:
                out.add(child)
            continue
        name = child.name
        if child.gone:
            continue
        here = seen if child.seen is None else child.seen
        finish, inner, count = None, None, None
        if name == "br":
            line = "".join(out.now).rstrip(" ")
            out.now = []
            out.put(line)
        elif name == "hr":
            out.end(True)
            if here:
                out.put("---")
            out.end(True)
        elif name == "img":
            if here:
                out.add(child.attributes.get("alt", ""))
        elif name == "input":
            if here and child.attributes.get("type", "text").lower() in ("submit", "button", "reset"):
                out.add(child.attributes.get("value", ""))
        elif name in ("pre", "plaintext"):
            out.end(True)
            text = plain(child, here).removeprefix("\n").rstrip("\n")
            for line in text.split("\n") if text.strip(_blank) else ():
                out.put(line.rstrip())
            out.end(True)
        elif name == "table":
            out.end(True)
            inner, finish = Table(out), "table"
            out = inner.before
        elif table and name in GROUPS and parent.name == "table":
            inner = table
        elif table and name == "tr" and parent.name in GROUPS | {"table"}:
            table.rows.append([])
            inner = table
        elif table and name in CELLS and parent.name == "tr":
            out.end()
            inner, finish = table, "cell"
            out = Lines()
        elif name in LISTS:
            back = name == "ol" and "reversed" in child.attributes
            first = sum(not isinstance(x, str) and x.name == "li" for x in child.children) if back else 1
            count = {"ordered": name == "ol", "next": numbered(child, "start", first), "step": -1 if back else 1, "type": child.attributes.get("type", ""), "inner": parent.name == "li"}
            out.end(not count["inner"])
            finish = "list"
        elif name == "li" and numbers:
            out.end()
            value = numbered(child, "value", numbers["next"])
            numbers["next"] = value + numbers["step"]
            out.open(f"{marker(value, child.attributes.get('type', numbers['type']))}. " if numbers["ordered"] else "- ")
            finish = "level"
        elif name == "dd":
            out.end()
            out.open("    ")
            finish = "level"
        elif name in BLOCK or child.block:
            out.end(name in SPACED)
            finish = "block"
        elif name == "q":
            if here:
                out.add('"')
            finish = "quote"
        if name not in VOID and name not in ("pre", "plaintext"):
            work.append((child, iter(child.children), here, finish, inner, count))
    out.end()
    return out.lines


def visible_text(page: str) -> str:
    return "\n".join(rendered(tree(page))).strip("\n")


def extract_text(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """For every row of df: page_id, text, n_chars and n_lines of the visible text.

    A null page gives null text and zeros; an empty one an empty text. An attribute's quote that is never closed is part of its value, so
    the tag ends at the next `>`. aria-hidden hides nothing, visibility does, and a visible part of a hidden one is shown. Indentation
    takes INDENT columns at most. Rows that repeat give equal rows; other columns are not read; an empty table gives an empty result. Pages
    are parsed whole, in one pass without a shuffle.
    """
    ship_code(df.sparkSession)

    def scan(batches):
        for batch in chunks(batches, "t"):
            texts = [None if x is None else visible_text(x) for x in batch.column("t").to_pylist()]
            n_chars, n_lines = [len(t or "") for t in texts], [t.count("\n") + 1 if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(texts, pa.string()), pa.array(n_chars, pa.int64()), pa.array(n_lines, pa.int64())], ["page_id", "text", "n_chars", "n_lines"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col].alias("d"), df[html_col].alias("t")).mapInArrow(scan, f"page_id {kind}, text string, n_chars long, n_lines long")
