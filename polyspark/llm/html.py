"""HTML to text as a page shows it: a tree builder with implied tags, visibility rules, and a layout of blocks, lists and tables.

All visible text comes out, navigation and footers included; nothing is judged to be boilerplate.
The parser is a small helper of one pass per page; Spark deals the pages out.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDEST = 60  # columns with longer cells are not padded
RULE = "-" * 8
MOST_COLUMNS, MOST_ROWS = 1000, 65534  # spans, as the HTML standard bounds them

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style title template noscript iframe noembed noframes object svg math audio video canvas datalist area base link meta param source track".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr "
    "html legend li main menu nav ol optgroup option p pre search section summary table ul caption xmp".split()
)
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul menu fieldset xmp".split())
CLOSES_P = BLOCK - frozenset("body html dd dt li option optgroup legend caption summary".split()) | {"summary"}
# start tag -> open elements it ends, and the elements that this search does not pass
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
LIST_MARKS = ("-", "*", "+")

_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)", re.S)
_ATTRIBUTE = re.compile(r"""\s*/?\s*([^\s"'>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]*)))?|\s*["'=/]""")
_STYLE = re.compile(r"(?:^|[;\s])(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?", re.I)
_COMPOUND = re.compile(r"([a-zA-Z][\w-]*|\*)?((?:[.#][\w-]+)*)\Z")
_SCREEN = frozenset(["", "all", "screen", "only screen", "only all", "not print", "not speech"])
_SPACE = re.compile(r"[ \t\n\r\f]+")


@dataclass(slots=True)
class Element:
    """An element with its attributes; children are elements and strings.

    ``gone`` elements are left out with all they hold; where ``shown`` is false, the element's own
    text is left out, but not that of elements inside that are shown again.
    """

    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)
    gone: bool = False
    shown: bool = True


def _attributes(html: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes from a position inside a start tag on, and the position after the tag."""
    out: dict[str, str] = {}
    while at < len(html) and html[at] != ">":
        m = _ATTRIBUTE.match(html, at)
        if not m or m.end() == at:
            at += 1
            continue
        at = m.end()
        if m[1]:
            value = next((v for v in m.groups()[1:] if v is not None), "")
            out.setdefault(m[1].lower(), unescape(value))
    return out, min(at + 1, len(html))


def parse(html: str) -> Element:
    """The tree of a page. End tags without a start are dropped; missing ends are implied."""
    root = Element("#root")
    open_ = [root]
    held = Counter()  # open elements of each tag, so that a search for none is not made
    at = 0

    def close(i: int) -> None:
        held.subtract(e.tag for e in open_[i:])
        del open_[i:]

    def end(tags: set[str] | frozenset[str], walls: set[str] | frozenset[str]) -> None:
        # an ended element may itself sit in another one that has to end
        while any(held[t] > 0 for t in tags):
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag in tags:
                    close(i)
                    break
                if open_[i].tag in walls:
                    return
            else:
                return

    while at < len(html):
        m = _TAG.search(html, at)
        if not m:
            open_[-1].children.append(unescape(html[at:]))
            break
        if m.start() > at:
            open_[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                open_[-1].children.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        attributes, at = _attributes(html, at)
        if m[1]:
            if tag == "p" and held["p"] <= 0:
                open_[-1].children.append(Element("p"))  # as browsers do
                continue
            if tag == "br":
                open_[-1].children.append(Element("br"))
                continue
            wall = {"table"} if tag not in ("table", "body", "html") else set()
            for i in range(len(open_) - 1 if held[tag] > 0 else 0, 0, -1):
                if open_[i].tag == tag:
                    close(i)
                    break
                if open_[i].tag in wall:
                    break
            continue
        if tag in CLOSES_P:
            end({"p"}, {"table", "td", "th", "button", "caption", "object"})
        if tag in ENDS:
            end(*ENDS[tag])
        if re.fullmatch("h[1-6]", tag) and re.fullmatch("h[1-6]", open_[-1].tag):
            close(len(open_) - 1)
        element = Element(tag, attributes)
        open_[-1].children.append(element)
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            text = html[at : stop.start() if stop else len(html)]
            element.children.append(unescape(text) if tag in ("textarea", "title") else text)
            at = stop.end() if stop else len(html)
            continue
        if tag in ("head", "body", "html") and held[tag] > 0:
            continue
        if tag == "body" and held["head"] > 0:
            open_[:] = [e for e in open_ if e.tag != "head"]
            held["head"] = 0
        open_.append(element)
        held[tag] += 1
    return root


@dataclass
class Rule:
    """One selector of a style rule, as compounds from the outermost on, and the properties it sets.

    A compound is (whether it must be the parent's child, tag, ids and classes); ``rank`` orders
    rules by specificity and place.
    """

    compounds: list[tuple[bool, str, frozenset[str]]]
    values: dict[str, tuple[bool, str]]  # property -> (important, value)
    rank: tuple[int, int, int, int]


def _values(body: str) -> dict[str, tuple[bool, str]]:
    """The last display and visibility of a block of declarations; an important one stands against later others."""
    out: dict[str, tuple[bool, str]] = {}
    for name, value, important in _STYLE.findall(body):
        now = (bool(important), value.lower())
        if now[0] >= out.get(name.lower(), (False, ""))[0]:
            out[name.lower()] = now
    return out


def _compounds(selector: str) -> list[tuple[bool, str, frozenset[str]]] | None:
    """None for a selector with attributes, states or siblings, which says nothing here."""
    out, child = [], False
    for part in selector.replace(">", " > ").split():
        if part == ">":
            child = True
            continue
        m = _COMPOUND.match(part)
        if not m:
            return None
        out.append((child, "" if m[1] in (None, "*") else m[1].lower(), frozenset(re.findall(r"[.#][\w-]+", m[2]))))
        child = False
    return out or None


def _blocks(css: str) -> Iterator[tuple[str, str]]:
    """(selectors, declarations) of the rules that hold on a screen; other at-rules are passed over."""
    waiting = [re.sub(r"/\*.*?(?:\*/|\Z)", "", css, flags=re.S)]
    while waiting:
        text, at = waiting.pop(), 0
        while m := re.compile(r"[{};]").search(text, at):
            head, at = text[at : m.start()].strip(), m.end()
            if m[0] != "{":
                continue
            depth, stop = 1, at
            while depth and (edge := re.compile(r"[{}]").search(text, stop)):
                depth += 1 if edge[0] == "{" else -1
                stop = edge.end()
            body, at = text[at : stop - 1] if not depth else text[at:], stop if not depth else len(text)
            if not head.startswith("@"):
                yield head, body
            elif re.match(r"@(?:layer|supports)\b", head, re.I) or (
                (query := re.match(r"@media\b(.*)", head, re.I | re.S)) and any(" ".join(q.split()).lower() in _SCREEN for q in query[1].split(","))
            ):
                waiting.append(body)


def rules_of(root: Element) -> list[Rule]:
    """Rules of the style elements that set display or visibility, those that win last."""
    sheets, stack = [], [root]
    while stack:
        e = stack.pop()
        if e.tag == "style" and " ".join(e.attributes.get("media", "").split()).lower() in _SCREEN:
            sheets.append("".join(c for c in e.children if isinstance(c, str)))
        stack += [c for c in reversed(e.children) if isinstance(c, Element)]
    found: list[Rule] = []
    for selectors, body in (block for css in sheets for block in _blocks(css)):
        values = _values(body)
        for selector in selectors.split(",") if values else ():
            compounds = _compounds(selector)
            if compounds:
                marks = [m for _, _, own in compounds for m in own]
                ids = sum(m[0] == "#" for m in marks)
                found.append(Rule(compounds, values, (ids, len(marks) - ids, sum(bool(tag) for _, tag, _ in compounds), len(found))))
    return sorted(found, key=lambda rule: rule.rank)


Chain = tuple[str, frozenset[str], "Chain | None"]  # tag and marks of an element, and its parent's


def _fits(chain: Chain | None, compounds: list[tuple[bool, str, frozenset[str]]], k: int) -> bool:
    """Whether an element, given with its ancestors, meets the first k + 1 compounds."""
    child, tag, marks = compounds[k]
    if chain is None or (tag and tag != chain[0]) or not marks <= chain[1]:
        return False
    if k == 0:
        return True
    above = chain[2]
    while above is not None and not _fits(above, compounds, k - 1):
        if child:
            return False
        above = above[2]
    return above is not None


def mark(root: Element, rules: list[Rule]) -> int:
    """Sets ``gone`` and ``shown`` of all elements; the depth of the tree."""
    deepest = 0
    stack: list[tuple[Element, Chain | None, bool, int]] = [(root, None, True, 0)]
    while stack:
        e, above, shown, depth = stack.pop()
        deepest = max(deepest, depth)
        a = e.attributes
        own = frozenset([*(f".{c}" for c in a.get("class", "").split()), *([f"#{a['id']}"] if "id" in a else [])]) if rules else frozenset()
        chain = (e.tag, own, above)
        values: dict[str, tuple[bool, str]] = {}
        for rule in [r.values for r in rules if _fits(chain, r.compounds, len(r.compounds) - 1)] + ([_values(a["style"])] if "style" in a else []):
            values |= {name: value for name, value in rule.items() if value[0] >= values.get(name, (False, ""))[0]}
        display = values.get("display", (False, "none" if "hidden" in a else ""))[1]
        visibility = values.get("visibility", (False, ""))[1]
        e.gone = e.tag in HIDDEN or display == "none" or (e.tag == "input" and a.get("type", "").lower() == "hidden")
        e.shown = visibility not in ("hidden", "collapse") if visibility in ("visible", "hidden", "collapse") else shown
        if not e.gone:
            stack += [(c, chain, e.shown, depth + 1) for c in e.children if isinstance(c, Element)]
    return deepest


class Layout:
    """Lines of a block, built up from inline text; runs of white space are one space."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False  # a blank line is due before the next text

    def text(self, text: str) -> None:
        self.line.append(text)

    def end(self) -> None:
        """Ends the line, if it has text."""
        line = _SPACE.sub(" ", "".join(self.line)).strip(" ")
        self.line = []
        if line:
            self.add([line])

    def gap(self) -> None:
        self.end()
        self.space = True

    def add(self, lines: list[str]) -> None:
        if not lines:
            return
        if self.space and self.lines:
            self.lines.append("")
        self.space = False
        self.lines += lines


def _visible(e: Element) -> list:
    if e.tag == "details" and "open" not in e.attributes:
        return [c for c in e.children if isinstance(c, Element) and c.tag == "summary"]
    return e.children


def lines_of(e: Element, depth: int = 0) -> list[str]:
    """The text lines of an element's contents."""
    out = Layout()
    _inline(e, out, depth)
    out.end()
    return out.lines


def _inline(e: Element, out: Layout, depth: int) -> None:
    number = int(e.attributes["start"]) if e.tag == "ol" and re.fullmatch(r"-?\d{1,9}", e.attributes.get("start", "")) else 1
    for child in _visible(e):
        if isinstance(child, str):
            if e.shown:
                out.text(child)
            continue
        tag = child.tag
        if child.gone:
            continue
        if tag == "br":
            if "".join(out.line).strip():
                out.end()
            else:
                out.add([""] if out.lines and out.lines[-1] and not out.space else [])
        elif tag == "wbr":
            continue
        elif tag == "hr":
            out.gap()
            out.add([RULE] if child.shown else [])
            out.gap()
        elif tag in ("pre", "xmp", "textarea"):
            out.gap()
            text = _plain(child).replace("\r\n", "\n").replace("\r", "\n").removeprefix("\n").rstrip()
            out.add(text.split("\n") if text else [])
            out.gap()
        elif tag == "table":
            out.gap()
            out.add(_table(child, depth))
            out.gap()
        elif tag in ("ul", "ol", "menu", "dir"):
            nested = depth > 0
            out.end() if nested else out.gap()
            out.add(lines_of(child, depth + 1))
            out.end() if nested else out.gap()
        elif tag == "li":
            out.end()
            lines = lines_of(child, depth)
            if e.tag == "ol":
                value = child.attributes.get("value", "")
                number = int(value) if re.fullmatch(r"-?\d{1,9}", value) else number
                mark = f"{number}."
                number += 1
            else:
                mark = LIST_MARKS[max(depth - 1, 0) % len(LIST_MARKS)]
            pad = " " * (len(mark) + 1)
            out.add([(f"{mark} " if i == 0 else pad if line else "") + line for i, line in enumerate(lines)])
        elif tag in ("dd", "blockquote"):
            out.gap() if tag in SPACED else out.end()
            out.add([f"  {line}" if line else "" for line in lines_of(child, depth)])
            out.gap() if tag in SPACED else out.end()
        elif tag in BLOCK or tag in ("tr", "thead", "tbody", "tfoot"):
            out.gap() if tag in SPACED else out.end()
            _inline(child, out, depth)
            out.gap() if tag in SPACED else out.end()
        elif tag in ("td", "th"):  # outside a table
            out.text(" ")
            _inline(child, out, depth)
            out.text(" ")
        elif tag == "input":
            if child.shown and child.attributes.get("type", "text").lower() in ("submit", "button", "reset", "text"):
                out.text(f" {child.attributes.get('value', '')} ")
        else:
            _inline(child, out, depth)


def _plain(e: Element) -> str:
    parts = []
    for child in _visible(e):
        if isinstance(child, str):
            parts.append(child if e.shown else "")
        elif child.tag == "br":
            parts.append("\n")
        elif not child.gone:
            parts.append(_plain(child))
    return "".join(parts)


def _span(e: Element, name: str, most: int) -> int:
    value = re.match(r"\s*\+?(\d+)", e.attributes.get(name, "1"))
    n = int(value[1][:9]) if value else 1
    return min(n, most) if n else most if name == "rowspan" else 1  # a rowspan of 0 goes on to the end


def _table(table: Element, depth: int) -> list[str]:
    """Rows with cells side by side, columns padded to one width; a caption above."""
    captions: list[str] = []
    sections: dict[str, list[Element]] = {"thead": [], "tbody": [], "tfoot": []}

    def walk(e: Element, section: str) -> None:
        loose: list = []
        for child in e.children:
            if isinstance(child, str):
                if child.strip() and e.shown:
                    loose.append(child)
            elif child.gone:
                continue
            elif child.tag == "caption":
                captions.extend(lines_of(child, depth))
            elif child.tag in ("thead", "tbody", "tfoot"):
                walk(child, child.tag)
            elif child.tag == "tr":
                sections[section].append(child)
            elif child.tag in ("td", "th"):  # an implied row
                if not sections[section] or sections[section][-1].tag != "#row":
                    sections[section].append(Element("#row"))
                sections[section][-1].children.append(child)
            elif child.tag not in ("col", "colgroup"):
                loose.append(child)
        captions.extend(lines_of(Element("#loose", {}, loose), depth) if loose else [])

    walk(table, "tbody")
    grid: list[list[list[str]]] = []
    below: dict[int, int] = {}  # column -> rows that a cell above still covers
    for row in (*sections["thead"], *sections["tbody"], *sections["tfoot"]):
        cells: list[list[str]] = []
        taken = {c for c, left in below.items() if left > 0}
        for c in list(below):
            below[c] -= 1

        def skip() -> None:
            while len(cells) in taken:
                cells.append([])

        for child in row.children:
            if not isinstance(child, Element) or child.gone:
                continue
            skip()
            width, height = (_span(child, "colspan", MOST_COLUMNS), _span(child, "rowspan", MOST_ROWS)) if child.tag in ("td", "th") else (1, 1)
            content = lines_of(child, depth) if child.tag in ("td", "th") else lines_of(Element("#cell", {}, [child]), depth)
            for k in range(width):
                if height > 1:
                    below[len(cells)] = height - 1
                cells.append(content if k == 0 else [])
        text = " ".join(c for c in row.children if isinstance(c, str) and row.shown).strip()
        if text:
            cells.append([_SPACE.sub(" ", text)])
        skip()
        if any(cells):
            grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for c, lines in enumerate(cells):
            widths[c] = max(widths.get(c, 0), *(len(x) for x in lines), 0) if lines else widths.get(c, 0)
    used = [c for c in sorted(widths) if widths[c]]
    out = list(captions)
    for cells in grid:
        for i in range(max(len(lines) for lines in cells)):
            parts = [cells[c][i] if c < len(cells) and i < len(cells[c]) else "" for c in used]
            padded = [p.ljust(widths[c]) if widths[c] <= WIDEST else p for p, c in zip(parts, used, strict=True)]
            out.append(" | ".join(padded).rstrip(" |") if len(used) > 1 else padded[0].rstrip())
    return out


def render(html: str | None) -> str:
    """The visible text of a page; null, empty and markup without visible text give ''."""
    if not html:
        return ""
    root = parse(html)
    deepest = mark(root, rules_of(root))
    # a level of the tree takes a few calls, none of which is on the C stack
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 6 * deepest + 1000))
    lines = lines_of(root)
    while lines and not lines[-1]:
        lines.pop()
    return "\n".join(line.rstrip(" ") for line in lines)


def extract(pages: DataFrame) -> DataFrame:
    """Text of every page: page_id, text, n_lines.

    Reads page_id and html. A null or empty page has text '' and 0 lines; a page that is not HTML is its own
    text with white space folded. Repeated rows come out repeated. Empty in, empty out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [render(html.as_py()) for html in batch.column("html")]
            lines = [len(t.split("\n")) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], ["page_id", "text", "n_lines"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", F.col("html").cast("string")).mapInArrow(run, f"page_id {kind}, text string, n_lines long")
