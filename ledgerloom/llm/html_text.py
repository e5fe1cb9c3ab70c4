"""HTML extraction (3): a tree built with implied tags, rendered as a reader would see it.

parse() builds the tree of a whole page: end tags that HTML lets authors leave out are implied (paragraphs, list items,
table parts, options), rows and bodies that a cell or row needs are added, what stands in a table outside its cells
moves before the table, raw text elements end at their own end tag, and a tag cut off by the end of the page goes.
render() walks the tree without recursion and writes the text that is visible: elements that are never shown go, and
those that `display` or `visibility` hides. These come from the `hidden` attribute, the page's own style sheets (rules of
tags, classes, ids and attributes, as descendants or children too; the most specific wins, then the last, `!important`
before all; of @media only what holds on a screen) and inline style. Rules with other selectors, as :hover, don't count.
White space collapses outside preformatted text. Paragraphs, headings, lists, quotes and tables are parted by a blank
line, other blocks by a line break. List items carry their bullet or number, indented by depth. Cells of a table stand
in columns as wide as their longest line, lines of more than `WIDEST` characters aside, which push what follows them to
the right; a cell that spans columns takes their width, one that spans rows leaves its column blank below.

A tag costs no more the deeper it stands: open elements are looked up by name. Text of math and of SVG is shown.

Null and empty pages give an empty text. Repeated rows fare alike. Other columns stay behind.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom.llm.shared import map_batches

_words = str.split
#: Classes of elements.
VOID = frozenset(_words("area base br col embed hr img input link meta param source track wbr"))
RAW = frozenset(_words("script style textarea title noscript iframe noembed noframes xmp"))
UNSEEN = frozenset(_words("head script style title noscript iframe noembed noframes template datalist audio video canvas object meta link base area param source track desc defs metadata symbol clippath mask marker pattern annotation annotation-xml"))
SPACED = frozenset(_words("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr menu"))
BLOCK = SPACED | frozenset(_words("address article aside body center dd details dialog dir div dt figcaption footer form header hgroup html legend li main nav section summary optgroup option search"))
LISTS = frozenset(("ul", "ol", "menu", "dir"))
_CELLS = frozenset(("td", "th"))
_BODIES = frozenset(("thead", "tbody", "tfoot"))
_TABLE_PARTS = _CELLS | _BODIES | frozenset(("tr", "caption", "colgroup", "col"))
#: A start tag of the first closes open elements of the second, up to a scope of the third.
_IMPLIED = {t: (frozenset("p"), frozenset(_words("table td th caption button object html"))) for t in BLOCK - frozenset(_words("body html li dd dt option optgroup"))}
_IMPLIED["p"] = _IMPLIED["div"]
_IMPLIED |= {
    "li": (frozenset(("li", "p")), LISTS | frozenset(_words("table td th html"))),
    "dt": (frozenset(("dt", "dd", "p")), frozenset(_words("dl table td th html"))),
    "option": (frozenset(("option",)), frozenset(_words("select optgroup html"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(_words("select html"))),
    "tr": (frozenset(_words("tr td th caption colgroup")), frozenset(("table", "html"))),
    "td": (frozenset(_words("td th")), frozenset(_words("tr table html"))),
    "tbody": (frozenset(_words("thead tbody tfoot tr td th caption colgroup")), frozenset(("table", "html"))),
    "caption": (frozenset(_words("caption")), frozenset(("table", "html"))),
}
#: What stands in a template closes nothing outside.
_IMPLIED = {t: (tags, scope | {"template"}) for t, (tags, scope) in _IMPLIED.items()}
_IMPLIED |= {"dd": _IMPLIED["dt"], "th": _IMPLIED["td"], "thead": _IMPLIED["tbody"], "tfoot": _IMPLIED["tbody"]}

#: Longest line of a cell that widens its column.
WIDEST = 200

_OPEN = re.compile(r"<(?:!--|([a-zA-Z][^\s/>]*)|/([a-zA-Z][^\s/>]*)|[!?/])")
_ATTRIBUTE = re.compile(r"""[\s/]*(?:(>)|([^\s/>=][^\s/>=]*|=[^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)|(?=>)))?)""")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("attributes", "children", "parent", "tag")

    def __init__(self, tag: str, attributes: dict[str, str], parent: "Node | None") -> None:
        self.tag, self.attributes, self.parent = tag, attributes, parent
        self.children: list[Node | str] = []


def _attributes(page: str, at: int) -> tuple[dict[str, str], int]:
    """Attributes from `at` on and the place after the tag; -1 if the page ends first."""
    out: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(page, at)
        if not m:
            return out, -1 if page.find(">", at) < 0 else page.find(">", at) + 1
        at = m.end()
        if m[1]:
            return out, at
        value = m[3] if m[3] is not None else m[4] if m[4] is not None else m[5]
        out.setdefault(m[2].lower(), html.unescape(value) if value else "")


class Open:
    """The open elements, and their places by tag."""

    def __init__(self, root: Node) -> None:
        self.stack = [root]
        self.places: dict[str, list[int]] = {}

    @property
    def here(self) -> Node:
        return self.stack[-1]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, place: int) -> None:
        """Closes the element at a place and all in it."""
        while len(self.stack) > place:
            self.places[self.stack.pop().tag].pop()

    def last(self, tags) -> int:
        """The place of the innermost open element of these tags; 0 if there is none."""
        return max((own[-1] for t in tags if (own := self.places.get(t))), default=0)

    def close(self, tags, scope) -> None:
        """Closes the outermost element of `tags` inside the innermost of `scope`."""
        top = self.last(scope)
        first = [own[k] for t in tags if (own := self.places.get(t)) and (k := bisect_right(own, top)) < len(own)]
        if first:
            self.cut(min(first))


_ROW_OR_ABOVE = _BODIES | {"table", "tr"}
_LOOSE = _ROW_OR_ABOVE
_WALLS = _CELLS | {"template"}


def parse(page: str) -> Node:
    root = Node("html", {}, None)
    open_ = Open(root)
    at, end = 0, len(page)

    def add(tag: str, attributes: dict[str, str]) -> Node:
        node = Node(tag, attributes, open_.here)
        open_.here.children.append(node)
        return node

    def beside(child: "Node | str") -> None:
        """In a table outside its cells: before the table, or in what has been put there last and is still open."""
        table = open_.stack[open_.last(("table",))]
        where = table.parent.children
        k = len(where) - 1  # an open table is its parent's last child
        while where[k] is not table:
            k -= 1
        where.insert(k, child)
        if isinstance(child, Node):
            child.parent = table.parent

    def text(data: str) -> None:
        if not data:
            return
        data = html.unescape(data) if "&" in data else data
        if open_.here.tag in _LOOSE:
            if data.strip():
                beside(data)
        else:
            open_.here.children.append(data)

    while at < end:
        m = _OPEN.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        if m[1]:
            tag = m[1].lower()
            attributes, at = _attributes(page, at)
            if at < 0:
                break
            if tag in ("html", "body"):
                root.attributes |= {k: v for k, v in attributes.items() if k not in root.attributes}
                if tag == "body":
                    open_.close(("head",), ())
                continue
            if open_.here.tag == "head" and tag not in UNSEEN:
                open_.close(("head",), ())  # the head ends where something to show begins
            if tag in _IMPLIED:
                open_.close(*_IMPLIED[tag])
            if tag in _TABLE_PARTS:
                table = open_.last(("table",))
                if not table:
                    continue  # a part without a table is no element
                if tag == "tr" or tag in _CELLS:
                    open_.cut(open_.last(_ROW_OR_ABOVE) + 1)
                    if open_.here.tag == "table":
                        open_.push(add("tbody", {}))
                    if tag in _CELLS and open_.here.tag != "tr":
                        open_.push(add("tr", {}))
                else:
                    open_.cut(table + 1)
                node = add(tag, attributes)
            elif open_.here.tag in _LOOSE and tag not in ("script", "style", "template"):
                node = Node(tag, attributes, open_.here)
                beside(node)
            else:
                node = add(tag, attributes)
            if tag in VOID:
                continue
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                data = page[at : stop.start()] if stop else page[at:]
                node.children.append(html.unescape(data) if tag in ("textarea", "title") else data)
                if not stop:
                    break
                gone = page.find(">", stop.end())
                at = gone + 1 if gone >= 0 else end
                continue
            open_.push(node)
        elif m[2]:
            tag = m[2].lower()
            gone = page.find(">", at)
            if gone < 0:
                break
            at = gone + 1
            if tag == "br":
                add("br", {})
                continue
            # an end tag inside a cell doesn't close what the cell stands in, unless it is a table's
            wall = open_.last(("template",) if tag in _TABLE_PARTS or tag == "table" else _WALLS) if tag != "template" else 0
            place = open_.last((tag,))
            if place > wall:
                open_.cut(place)
            elif tag == "p":
                add("p", {})
        elif page.startswith("<!--", m.start()):
            gone = page.find("-->", at)
            at = gone + 3 if gone >= 0 else end
        else:
            gone = page.find(">", at)
            at = gone + 1 if gone >= 0 else end
    return root


_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.DOTALL)
_DECLARATION = re.compile(r"(?:^|[;\s])(display|visibility)\s*:\s*([a-z-]+)[^;!]*(!\s*important)?", re.IGNORECASE)
_SIMPLE = re.compile(r"""([.#]?)((?:[\w-]|[^\x00-\x7f])+)|\[\s*([\w-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([\w-]+))\s*)?\]|(\*)""")
_SCREEN = re.compile(r"\b(?:screen|all)\b")
_MEDIUM = re.compile(r"\b(?:print|speech|tty|tv|projection|handheld|braille|embossed|aural)\b")

#: What a compound selector asks for: (kind, name, value) of a tag, class, id or attribute.
Compound = tuple[tuple[str, str, str | None], ...]


def _declared(body: str) -> list[tuple[str, str, bool]]:
    """property, value, important."""
    return [(m[1].lower(), m[2].lower(), bool(m[3])) for m in _DECLARATION.finditer(body)]


def _on_screen(query: str) -> bool:
    """Whether one of the media is a screen's. Conditions on sizes are taken to hold."""
    media = [q.strip().lower() for q in query.split(",")]
    return any((q.startswith("not ") and bool(_MEDIUM.search(q))) or (not q.startswith("not ") and (bool(_SCREEN.search(q)) or not _MEDIUM.search(q))) for q in media)


def _compound(text: str) -> Compound | None:
    out, at = [], 0
    while at < len(text):
        m = _SIMPLE.match(text, at)
        if not m:
            return None
        if m[2]:
            kind = {".": "class", "#": "id", "": "tag"}[m[1]]
            if kind == "tag" and at:
                return None
            out.append((kind, m[2].lower() if kind == "tag" else m[2], None))
        elif m[3]:
            value = next((v for v in (m[4], m[5], m[6]) if v is not None), None)
            out.append(("attribute", m[3].lower(), value))
        at = m.end()
    return tuple(out)


def _selector(text: str) -> list[tuple[str, Compound]] | None:
    """Compounds from the last to the first, each with how it stands to the one before (" " or ">")."""
    out: list[tuple[str, Compound]] = []
    how = ""
    for word in reversed(re.sub(r"\s*>\s*", " > ", text.strip()).split()):
        if word == ">":
            how = ">"
            continue
        one = _compound(word)
        if one is None:
            return None
        out.append((how or " ", one))
        how = ""
    return out or None


class Styles:
    """The rules of a page that set display or visibility, by what their last compound asks for."""

    def __init__(self, root: Node) -> None:
        self.rules: dict[tuple, list] = {}
        self.order = 0
        todo: list[Node] = [root]
        while todo:
            node = todo.pop()
            if node.tag == "style":
                if _on_screen(node.attributes.get("media", "")):
                    self._read(_COMMENT.sub(" ", "".join(map(str, node.children))))
            else:
                todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def _read(self, css: str) -> None:
        at, depth, start = 0, [], 0  # depth: whether what stands inside each open at-rule counts
        for m in re.finditer(r"[{};]", css):
            if m.start() < at:
                continue
            head = css[start : m.start()].strip()
            if m[0] == "}":
                depth = depth[:-1]
            elif m[0] == "{" and head.startswith("@"):
                name, _, query = head[1:].partition(" ")
                depth.append((not depth or depth[-1]) and (name.lower() in ("supports", "layer", "container") or name.lower().startswith("media") and _on_screen(head[6:])))
            elif m[0] == "{":
                at = css.find("}", m.end())
                at = len(css) if at < 0 else at + 1
                if not depth or depth[-1]:
                    self._add(head, css[m.end() : at - 1 if css[at - 1 : at] == "}" else at])
                start = at
                continue
            start = m.end()

    def _add(self, selectors: str, body: str) -> None:
        found = _declared(body)
        for text in selectors.split(",") if found else ():
            if not (path := _selector(text)):
                continue
            kinds = [kind for _, one in path for kind, _, _ in one]
            weight = (kinds.count("id"), kinds.count("class") + kinds.count("attribute"), kinds.count("tag"))
            last = path[0][1]
            key = next((x for kind in ("id", "class", "tag") for x in last if x[0] == kind), ("any", "", None))
            for name, value, important in found:
                self.order += 1
                self.rules.setdefault(key, []).append((name, value, (important, 0, *weight, self.order), path))

    def of(self, node: Node) -> dict[str, str]:
        """display and visibility as declared for a node."""
        a, best = node.attributes, {}
        if self.rules:
            keys = [("any", "", None), ("tag", node.tag, None), ("id", a.get("id", ""), None)]
            keys += [("class", c, None) for c in set(a.get("class", "").split())]
            for key in keys:
                for name, value, weight, path in self.rules.get(key, ()):
                    if (name not in best or weight > best[name][0]) and _matches(node, path):
                        best[name] = (weight, value)
        for name, value, important in _declared(a["style"]) if a.get("style") else ():
            weight = (important, 1, 0, 0, 0, 0)
            if name not in best or weight >= best[name][0]:
                best[name] = (weight, value)
        return {name: value for name, (_, value) in best.items()}


def _is(node: Node, one: Compound) -> bool:
    a = node.attributes
    for kind, name, value in one:
        if kind == "tag":
            fits = node.tag == name
        elif kind == "class":
            fits = name in a.get("class", "").split()
        elif kind == "id":
            fits = a.get("id") == name
        else:
            fits = name in a and (value is None or a[name] == value)
        if not fits:
            return False
    return True


def _matches(node: Node, path: list[tuple[str, Compound]]) -> bool:
    """The ancestors that may stand for the compounds so far are kept as one set a compound, so nothing is tried twice."""
    if not _is(node, path[0][1]):
        return False
    at: set[int] = {0}
    line = [node]
    while line[-1].parent and len(path) > 1:
        line.append(line[-1].parent)
    for how, one in path[1:]:
        places = {k + 1 for k in at} if how == ">" else range(min(at) + 1, len(line))
        at = {k for k in places if k < len(line) and _is(line[k], one)}
        if not at:
            return False
    return True


def _shown(node: Node, styles: Styles, seen: bool) -> bool | None:
    """None: not there at all. Else whether text in it is visible, given what holds around it."""
    a, tag = node.attributes, node.tag
    if tag in UNSEEN:
        return None
    own = styles.of(node)
    display = own.get("display", "none" if "hidden" in a or tag == "dialog" and "open" not in a else "")
    if display == "none":
        return None
    seen = {"visible": True, "hidden": False, "collapse": False}.get(own.get("visibility", ""), seen)
    parent = node.parent
    if parent and parent.tag == "details" and "open" not in parent.attributes and tag != "summary":
        return None
    return seen


class Sink:
    """Lines of text under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = False  # a collapsed space is due
        self.blank = False  # a blank line is due
        self.lead = ""  # what the next line begins with: a bullet
        self.indent = ""

    def write(self, text: str, keep: bool) -> None:
        if keep:
            first, *more = text.split("\n")
            self._add(first)
            for line in more:
                self.end(force=True)
                self._add(line)
            return
        for k, part in enumerate(_SPACE.split(text)):
            if k:
                self.space = bool(self.now)
            if part:
                self._add(part)

    def _add(self, part: str) -> None:
        if not part:
            return
        if not self.now:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.now.append(self.indent + self.lead)
            self.indent += " " * len(self.lead)
            self.lead = ""
        elif self.space:
            self.now.append(" ")
        self.space = False
        self.now.append(part)

    def end(self, force: bool = False) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip())
            self.now = []
        elif force and self.lines:
            self.lines.append("")
        self.space = False

    def part(self, spaced: bool) -> None:
        self.end()
        self.blank |= spaced


def _columns(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Aligned lines of a table: cells are (lines, columns, rows) spanned."""
    grid: list[dict[int, tuple[list[str], int]]] = []
    taken: dict[int, int] = {}  # column -> rows that a cell above still covers
    for row in rows:
        at, placed = 0, {}
        fresh: dict[int, int] = {}
        for lines, wide, high in row:
            while taken.get(at, 0):
                at += 1
            placed[at] = (lines, wide)
            for c in range(at, at + wide):
                fresh[c] = high
            at += wide
        taken = {c: n - 1 for c, n in (taken | fresh).items() if n > 1}
        grid.append(placed)
    width: dict[int, int] = {}
    for placed in grid:
        for at, (lines, wide) in placed.items():
            if wide == 1:
                width[at] = max([width.get(at, 0), *(len(x) for x in lines if len(x) <= WIDEST)])
    for placed in grid:
        for at, (lines, wide) in placed.items():
            if wide > 1:
                have = sum(width.get(c, 0) for c in range(at, at + wide)) + 2 * (wide - 1)
                width[at + wide - 1] = width.get(at + wide - 1, 0) + max(0, max((len(x) for x in lines if len(x) <= WIDEST), default=0) - have)
    start, x = {}, 0
    for c in range(max(width, default=-1) + 1):
        start[c] = x
        x += width[c] + 2 if width.get(c) else 0
    out = []
    for placed in grid:
        for k in range(max((len(lines) for lines, _ in placed.values()), default=0)):
            line = ""
            for at, (lines, _) in sorted(placed.items()):
                if k < len(lines) and lines[k]:
                    line = (line.ljust(start[at]) if len(line) <= start[at] else line + "  ") + lines[k]
            out.append(line.rstrip())
    return out


def _number(text: str | None, default: int, least: int, most: int) -> int:
    m = re.match(r"\s*(-?\d{1,9})", text or "")
    return min(most, max(least, int(m[1]))) if m else default


def render(root: Node) -> str:
    rules = Styles(root)
    sinks = [Sink()]
    tables: list[list] = []  # rows of each open table
    lists: list[list] = []  # [kind, next number, step] of each open list
    todo: list = [(root, True, False)]
    while todo:
        node, seen, keep = todo.pop()
        sink = sinks[-1]
        if isinstance(node, str):
            if seen:
                sink.write(node, keep)
            continue
        if callable(node):
            node()
            continue
        state = _shown(node, rules, seen)
        if state is None:
            continue
        tag, a = node.tag, node.attributes
        if tag == "br":
            sink.end(force=not sink.now)
            continue
        if tag == "input":
            kind = a.get("type", "text").lower()
            if state and a.get("value") and kind in ("text", "search", "email", "url", "tel", "number", "submit", "reset", "button", "date"):
                sink.write(f" {a['value']} ", False)
            continue
        keep = keep or tag in ("pre", "textarea", "xmp", "listing")
        after = None
        if tag == "table":
            sink.part(True)
            tables.append([])
            after = _table_end(sinks, tables)
        elif tag == "tr" and tables:
            tables[-1].append([])
        elif tag in _CELLS and tables and tables[-1]:
            sinks.append(Sink())
            after = _cell_end(sinks, tables, _number(a.get("colspan"), 1, 1, 1000), _number(a.get("rowspan"), 1, 1, 65534))
        elif tag in LISTS:
            sink.part(not lists)
            lists.append([tag, _number(a.get("start"), 1, -(10**9), 10**9), 1])
            after = _list_end(sink, lists)
        elif tag == "li":
            sink.end()
            around, lead = sink.indent, sink.lead
            if lead:  # the item around it has no text of its own before this list
                sink._add("​")
                sink.now = [sink.now[0].rstrip()]
                sink.end()
            if lists and lists[-1][0] == "ol":
                n = _number(a.get("value"), lists[-1][1], -(10**9), 10**9)
                sink.lead = f"{n}. "
                lists[-1][1] = n + lists[-1][2]
            else:
                sink.lead = "- "
            after = _item_end(sink, around)
        elif tag in ("blockquote", "dd"):
            sink.part(tag == "blockquote")
            around, sink.indent = sink.indent, sink.indent + "  "
            after = _indent_end(sink, around, tag == "blockquote")
        elif tag in BLOCK or tag == "caption":
            spaced = tag in SPACED
            sink.part(spaced)
            after = _block_end(sink, spaced)
        if after:
            todo.append((after, True, False))
        if tag in ("pre", "textarea") and node.children and isinstance(node.children[0], str) and node.children[0].startswith("\n"):
            node.children[0] = node.children[0][1:]
        todo += [(c, state, keep) for c in reversed(node.children)]
    sinks[0].end()
    while sinks[0].lines and not sinks[0].lines[-1]:
        sinks[0].lines.pop()
    return "\n".join(sinks[0].lines)


def _table_end(sinks: list[Sink], tables: list[list]):
    def end() -> None:
        sink = sinks[-1]
        sink.end()
        sink.blank |= bool(sink.lines)
        for line in _columns(tables.pop()):
            if line:
                sink._add(line)
                sink.end()
        sink.part(True)

    return end


def _cell_end(sinks: list[Sink], tables: list[list], wide: int, high: int):
    def end() -> None:
        cell = sinks.pop()
        cell.end()
        tables[-1][-1].append((cell.lines, wide, high))

    return end


def _list_end(sink: Sink, lists: list[list]):
    def end() -> None:
        lists.pop()
        sink.part(not lists)

    return end


def _item_end(sink: Sink, around: str):
    def end() -> None:
        sink.end()
        sink.indent, sink.lead = around, ""

    return end


def _indent_end(sink: Sink, around: str, spaced: bool):
    def end() -> None:
        sink.part(spaced)
        sink.indent = around

    return end


def _block_end(sink: Sink, spaced: bool):
    return lambda: sink.part(spaced)


def extract(page: str | None) -> str:
    return render(parse(page)) if page else ""


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, text for each row of pages."""

    def make():
        return lambda batch: {"page_id": batch.column(0), "text": pa.array([extract(p) for p in batch.column(1).to_pylist()], pa.string())}

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return map_batches(rows, make, "page_id long, text string")


def visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the visible text of each page, with its lines and words."""
    found = extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    lines = F.size(F.filter(F.split("text", "\n"), lambda x: x != "")).cast("long")
    return found.select("page_id", "text", lines.alias("n_lines"), F.size(F.filter(F.split("text", "\\s+"), lambda x: x != "")).cast("long").alias("n_words"))
