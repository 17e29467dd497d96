"""HTML extraction by layout-aware rendering.

``events`` builds the tree of a page as a stream of open, close and text events:
it supplies end tags that HTML lets authors leave out, ignores end tags that
match nothing, and reads raw-text elements to their own end tag. ``render``
walks the stream, leaves out what a browser doesn't show, and lays out the
rest: blocks on lines of their own with blank lines where browsers have
margins, lists with markers and indents, tables with aligned columns,
preformatted text as it is. Neither recurses, so nesting has no depth limit.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from voltframe.llm.common import by_value, table

# Element names of the HTML standard, by what they do.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes textarea title".split())
IN_HEAD = set("base link meta title style script noscript template head html".split())
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
               "form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre section summary table ul".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LISTS = set("ul ol menu dir".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol menu dir dl blockquote pre figure table hr fieldset".split())
BLOCKS = SPACED | set("address article aside body center details dialog div dd dt figcaption footer form header hgroup "
                      "html legend li main nav optgroup option section summary tr caption".split())
HIDDEN = set("head script style template noscript iframe noembed noframes object audio video canvas datalist title "
             "meta link rp".split())
#: Buttons that an input makes, with the label of one that has no value.
BUTTONS = {"submit": "Submit", "reset": "Reset", "button": ""}
#: Parts of a formula that give it again in another form.
MATH_HIDDEN = set("annotation annotation-xml".split())
#: Parts of an svg that aren't drawn where they stand; of the others, only what ``SVG_TEXT`` holds is text.
SVG_HIDDEN = set("defs metadata desc symbol clippath mask pattern marker filter lineargradient radialgradient".split())
SVG_TEXT = set("text foreignobject".split())
SCOPE = set("table td th caption html template".split())

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(?:[!?]|/[^a-zA-Z])[^>]*(?:>|\Z)"""
                    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]+|=\s*(?:"[^"]*"|'[^']*')?)*)(>?)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_SPACE = re.compile(r"[ \t\n\f\r]+")
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_RULE = re.compile(r"([^{}]*)\{([^{}]*)\}")
#: A selector of an element's own name, id and classes.
_SIMPLE = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)\Z")
_UNQUOTED = re.compile(r"""=\s*[^\s"']+\Z""")


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)} if text else {}


class _Tree:
    """Stack of open elements that turns tags into balanced events."""

    def __init__(self):
        self.stack: list[str] = []
        self.open = Counter()
        self.events: list[tuple] = []

    def push(self, tag: str, attributes: str) -> None:
        self.stack.append(tag)
        self.open[tag] += 1
        self.events.append(("open", tag, attributes))

    def pop(self) -> None:
        tag = self.stack.pop()
        self.open[tag] -= 1
        self.events.append(("close", tag))

    def close(self, tags: set[str], barrier: set[str]) -> None:
        """Close the innermost of ``tags`` and all in it, if no ``barrier`` is nearer."""
        if not any(self.open[t] for t in tags):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at] in tags:
                while len(self.stack) > at:
                    self.pop()
                return
            if self.stack[at] in barrier:
                return

    def start(self, tag: str, attributes: str) -> None:
        if self.open["head"] and tag not in IN_HEAD:
            self.close({"head"}, set())
        if tag in ("html", "head", "body") and self.open[tag]:
            return
        if tag in CLOSES_P:
            self.close({"p"}, SCOPE)
        if tag in HEADINGS and self.stack and self.stack[-1] in HEADINGS:
            self.pop()
        if tag == "li":
            self.close({"li"}, SCOPE | LISTS)
        elif tag in ("dd", "dt"):
            self.close({"dd", "dt"}, SCOPE | {"dl"})
        elif tag in ("option", "optgroup"):
            self.close({"option"}, SCOPE | {"select", "datalist"})
            if tag == "optgroup":
                self.close({"optgroup"}, SCOPE | {"select"})
        elif tag in ("td", "th"):
            self.close({"td", "th"}, {"tr", "table"})
            if self.open["table"] and not self._inside("tr"):
                self.push("tr", "")
        elif tag == "tr":
            self.close({"tr"}, {"table"})
        elif tag in ("thead", "tbody", "tfoot", "caption", "colgroup"):
            self.close({"thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"})
            self.close({"tr"}, {"table"})
        if tag in VOID or self.empty(attributes):
            self.events += [("open", tag, attributes), ("close", tag)]
        else:
            self.push(tag, attributes)

    def empty(self, attributes: str) -> bool:
        """Whether ``/>`` ends the element, as it does in svg and math only."""
        return (attributes.endswith("/") and bool(self.open["svg"] or self.open["math"])
                and not _UNQUOTED.search(attributes))

    def _inside(self, tag: str) -> bool:
        for t in reversed(self.stack):
            if t == tag or t == "table":
                return t == tag
        return False

    def end(self, tag: str) -> None:
        if tag == "br":
            self.events += [("open", "br", ""), ("close", "br")]
        elif tag in ("table", "html", "body", "head"):
            if tag not in ("html", "body"):  # what follows them still belongs to the page
                self.close({tag}, set())
        elif tag in ("td", "th", "tr", "thead", "tbody", "tfoot", "caption"):
            self.close({tag}, {"table"})
        elif tag in HEADINGS:
            self.close(HEADINGS, SCOPE)
        elif tag == "li":
            self.close({"li"}, SCOPE | LISTS)
        else:
            self.close({tag}, SCOPE - {tag})


def events(page: str) -> list[tuple]:
    """Balanced ``("open", tag, attributes)``, ``("close", tag)``, ``("text", str)``."""
    tree, at = _Tree(), 0
    while at < len(page):
        mark = page.find("<", at)
        token = _TOKEN.match(page, mark) if mark >= 0 else None
        while mark >= 0 and token is None:  # a "<" that starts no tag is text
            mark = page.find("<", mark + 1)
            token = _TOKEN.match(page, mark) if mark >= 0 else None
        text = page[at:mark] if mark >= 0 else page[at:]
        if text:
            if tree.open["head"] and tree.stack[-1] == "head" and text.strip():
                tree.close({"head"}, set())
            tree.events.append(("text", unescape(text)))
        if token is None:
            break
        at = token.end()
        if not token[2]:
            continue
        if not token[4]:
            break  # the page ends inside a tag
        tag = token[2].lower()
        if token[1]:
            tree.end(tag)
            continue
        tree.start(tag, token[3])
        if tag in RAW and not tree.empty(token[3]):
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = end.start() if end else len(page)
            tree.events.append(("text", unescape(page[at:stop]) if tag in ("textarea", "title") else page[at:stop]))
            at = stop
            if not end:
                break
    while tree.stack:
        tree.pop()
    return tree.events


class _Flow:
    """Lines of one column of text, with pending breaks and spaces."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0
        self.space = False
        self.indent: list[str] = []
        self.marker = ""

    def text(self, s: str, keep_space: bool) -> None:
        if keep_space:
            for i, part in enumerate(s.split("\n")):
                if i:
                    self.newline()
                if part:
                    self.put(part)
            return
        s = _SPACE.sub(" ", s)
        if s.startswith(" "):
            self.space, s = True, s[1:]
        if s:
            body = s[:-1] if s.endswith(" ") else s
            self.put((" " if self.space and self.line else "") + body)
            self.space = s.endswith(" ")

    def put(self, s: str) -> None:
        if not self.line:
            if self.lines and self.gap > 1:
                self.lines.append("")
            lead = "".join(self.indent)
            if self.marker:
                lead, self.marker = lead[:len(lead) - len(self.marker)] + self.marker, ""
            self.line.append(lead)
            self.gap = 0
        self.line.append(s)

    def newline(self) -> None:
        """End of line, also of an empty one."""
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
            self.line = []
        elif self.lines:
            self.lines.append("")
        self.gap, self.space = 0, False

    def block(self, gap: int) -> None:
        """A block begins or ends: 1 for a new line, 2 for a blank line."""
        if self.line:
            self.newline()
        self.gap, self.space = max(self.gap, gap), False

    def result(self) -> list[str]:
        self.block(1)
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        return lines


#: A column is as wide as its widest cell, unless that takes more blanks than so many
#: times the table's characters; then as wide as the widest cell that doesn't.
MOST_BLANKS = 4


class _Table:
    """Cells by row and column; ``below`` holds the columns that cells of
    earlier rows still fill, with the number of rows left."""

    def __init__(self):
        self.rows: list[dict[int, tuple[list[str], int]]] = []
        self.below: dict[int, int] = {}
        self.fresh: dict[int, int] = {}

    def row(self) -> None:
        self.below = {c: n - 1 for c, n in (self.below | self.fresh).items() if n > 1}
        self.fresh = {}
        self.rows.append({})

    def cell(self, lines: list[str], across: int, down: int) -> None:
        if not self.rows:
            self.row()
        row = self.rows[-1]
        last = next(reversed(row), None)
        at = 0 if last is None else last + row[last][1]
        while at in self.below:
            at += 1
        row[at] = (lines if len(lines) > 1 else [x.strip() for x in lines], across)
        self.fresh.update({at + i: down for i in range(across) if down > 1})

    def lines(self) -> list[str]:
        """Rows are as high as their highest cell, columns as wide as their widest."""
        sizes: dict[int, list[int]] = {}
        total = 0
        for row in self.rows:
            for at, (lines, across) in row.items():
                total += sum(map(len, lines))
                if across == 1:
                    sizes.setdefault(at, []).extend(map(len, lines))
        widths: Counter = Counter()
        for at, column in sizes.items():
            column.sort()
            taken = 0
            for n, size in enumerate(column):
                taken += size
                if (n + 1) * size - taken <= MOST_BLANKS * total:
                    widths[at] = size
        out = []
        for row in self.rows:
            for i in range(max((len(lines) for lines, _ in row.values()), default=0)):
                line, col = [], 0
                for at, (lines, across) in sorted(row.items()):
                    line += [" " * (widths[c] + 2) for c in range(col, at)]
                    text = lines[i] if i < len(lines) else ""
                    line.append(text.ljust(sum(widths[c] + 2 for c in range(at, at + across)) - 2) + "  ")
                    col = at + across
                out.append("".join(line).rstrip())
        return out


def _number(attributes: dict[str, str], name: str, default: int, most: int) -> int:
    found = re.match(r"\s*(\d{1,9})", attributes.get(name, ""))
    return min(max(int(found[1]), 1), most) if found else default


def _integer(attributes: dict[str, str], name: str) -> int | None:
    found = re.match(r"\s*([+-]?\d{1,9})", attributes.get(name, ""))
    return int(found[1]) if found else None


class _Styles:
    """``display`` and ``visibility`` by the rules of a page's style elements whose
    selectors are an element's own name, id and classes, and by style attributes.
    Rules for other media than screens, and other selectors, don't count."""

    def __init__(self, found: list[tuple]):
        #: by one of its parts: (specificity, order, name, parts, property, value, important)
        self.rules: dict[str, list[tuple]] = {}
        order = 0
        for at, event in enumerate(found):
            if event[0] == "open" and event[1] == "style" and at + 1 < len(found) and found[at + 1][0] == "text":
                media = _attributes(event[2]).get("media", "").lower()
                if not media or "screen" in media or "all" in media:
                    order = self._read(_COMMENT.sub("", found[at + 1][1]), order)

    def _read(self, sheet: str, order: int) -> int:
        for media, body in self._parts(sheet):
            if media and not ("screen" in media or "all" in media):
                continue
            for selectors, declared in _RULE.findall(body):
                said = _DECLARED.findall(declared)
                for selector in selectors.split(",") if said else ():
                    m = _SIMPLE.match(selector.strip())
                    if not m or not m[0]:
                        continue
                    name = (m[1] or "*").lower()
                    parts = re.findall(r"[.#][\w-]+", m[2])
                    rank = (sum(p[0] == "#" for p in parts), sum(p[0] == "." for p in parts), name != "*")
                    for prop, value, important in said:
                        order += 1
                        self.rules.setdefault(parts[0] if parts else name, []).append(
                            (rank, order, name, parts, prop.lower(), value.lower(), bool(important)))
        return order

    @staticmethod
    def _parts(sheet: str) -> list[tuple[str, str]]:
        """The sheet outside of at-rules, and the body of each with its medium
        (other at-rules as of a medium of their own)."""
        out, plain, at = [], [], 0
        while (mark := sheet.find("@", at)) >= 0:
            plain.append(sheet[at:mark])
            brace, stop = sheet.find("{", mark), sheet.find(";", mark)
            if stop >= 0 and (brace < 0 or stop < brace):  # @import, @charset
                at = stop + 1
                continue
            if brace < 0:
                at = len(sheet)
                break
            depth, end = 1, brace + 1
            while depth and (m := re.compile("[{}]").search(sheet, end)):
                depth += 1 if m[0] == "{" else -1
                end = m.end()
            end = end if not depth else len(sheet)
            head = sheet[mark:brace].strip().lower()
            out.append((head if head.startswith("@media") else "@other", sheet[brace + 1:end - 1]))
            at = end
        return [("", "".join(plain) + sheet[at:]), *out]

    def of(self, tag: str, attributes: dict[str, str]) -> dict[str, str]:
        best: dict[str, tuple] = {}
        if self.rules:
            own = {"." + c for c in attributes.get("class", "").split()}
            if attributes.get("id"):
                own.add("#" + attributes["id"])
            for key in ("*", tag, *own):
                for rank, order, name, parts, prop, value, important in self.rules.get(key, ()):
                    if name in ("*", tag) and own.issuperset(parts):
                        best[prop] = max(best.get(prop, ()), (important, False, rank, order, value))
        for prop, value, important in _DECLARED.findall(attributes.get("style", "")):
            best[prop.lower()] = max(best.get(prop.lower(), ()), (bool(important), True, (), 0, value.lower()),
                                     key=lambda b: b[:2])
        return {prop: b[-1] for prop, b in best.items()}


def _items(found: list[tuple]) -> dict[int, int]:
    """Number of items of each list, by the place of its opening."""
    items: dict[int, int] = {}
    path: list[tuple[int, str]] = []
    for at, event in enumerate(found):
        if event[0] == "open":
            if event[1] == "li" and path and path[-1][1] in LISTS:
                items[path[-1][0]] = items.get(path[-1][0], 0) + 1
            path.append((at, event[1]))
        elif event[0] == "close":
            path.pop()
    return items


def render(page: str | None) -> str:
    """Visible text of a page; empty for null."""
    flows, tables, cells, counters = [_Flow()], [], [], []
    hidden = pre = svg = svg_text = math = 0
    visible = [True]
    # of each open element: 0, or for a closed ``details`` 1, then 2 once its summary has come
    folded = [0]
    found = events(page or "")
    styles = _Styles(found)
    items = _items(found) if "reversed" in (page or "").lower() else {}
    for place, event in enumerate(found):
        kind, what = event[0], event[1]
        if kind == "text":
            if not hidden and visible[-1] and not folded[-1] and (svg_text or not svg):
                flows[-1].text(what, bool(pre))
            continue
        if kind == "open":
            if hidden:
                hidden += 1
                continue
            attributes = _attributes(event[2])
            style = styles.of(what, attributes)
            summary = what == "summary" and folded[-1] == 1
            if summary:
                folded[-1] = 2
            shown = style.get("display")
            unseen = (what in HIDDEN or (shown == "none" if shown else "hidden" in attributes
                                         or what == "dialog" and "open" not in attributes)
                      or svg and what in SVG_HIDDEN or math and what in MATH_HIDDEN or folded[-1] and not summary)
            if unseen:
                hidden = 1
                continue
            flow = flows[-1]
            said = style.get("visibility")
            visible.append(said in ("visible", "initial") if said in ("hidden", "collapse", "visible", "initial")
                           else visible[-1])
            folded.append(1 if what == "details" and "open" not in attributes else 0)
            if what == "input":
                kind_of = attributes.get("type", "").lower()
                if kind_of in BUTTONS and visible[-1]:
                    flow.text(attributes.get("value", BUTTONS[kind_of]), False)
                continue
            if what == "br":
                if visible[-1]:
                    flow.newline()
                continue
            if what == "svg":
                svg += 1
            elif svg and what in SVG_TEXT:
                svg_text += 1
                flow.block(1)
            elif what == "math":
                math += 1
                if attributes.get("display", "").lower() == "block":
                    flow.block(1)
            elif what == "mtr":
                flow.block(1)
            elif what == "mtd":
                flow.space = True
            if what in BLOCKS:
                nested = what in LISTS and bool(counters)
                flow.block(2 if what in SPACED and not nested else 1)
            if what in LISTS:
                back = "reversed" in attributes
                first = _integer(attributes, "start")
                first = first if first is not None else items.get(place, 0) if back else 1
                counters.append([first, -1 if back else 1] if what == "ol" else None)
                flow.indent.append("  ")
            elif what == "li":
                mark = "- "
                if counters and counters[-1] is not None:
                    value = _integer(attributes, "value")
                    if value is not None:
                        counters[-1][0] = value
                    mark = f"{counters[-1][0]}. "
                    counters[-1][0] += counters[-1][1]
                flow.indent.append(" " * len(mark))
                flow.marker = mark
            elif what in ("dd", "blockquote"):
                flow.indent.append("  ")
            elif what in ("pre", "textarea"):
                pre += 1
            elif what == "table":
                tables.append(_Table())
            elif what == "tr" and tables:
                tables[-1].row()
            elif what in ("td", "th") and tables:
                span = _number(attributes, "colspan", 1, 100), _number(attributes, "rowspan", 1, 1000)
                flows.append(_Flow())
                cells.append((*span, counters, pre))
                counters, pre = [], 0
            continue
        if hidden:
            hidden -= 1
            continue
        visible.pop()
        folded.pop()
        flow = flows[-1]
        if what == "svg":
            svg -= 1
        elif what == "math":
            math -= 1
        elif svg and what in SVG_TEXT:
            svg_text -= 1
            flow.block(1)
        if what in ("td", "th") and tables:
            across, down, counters, pre = cells.pop()
            tables[-1].cell(flows.pop().result(), across, down)
            continue
        if what in BLOCKS:
            nested = what in LISTS and len(counters) > 1
            flow.block(2 if what in SPACED and not nested else 1)
        if what in LISTS:
            counters.pop()
            flow.indent.pop()
        elif what in ("li", "dd", "blockquote"):
            flow.indent.pop()
            flow.marker = ""
        elif what in ("pre", "textarea"):
            pre -= 1
        elif what == "table":
            for line in tables.pop().lines():
                flow.block(1)
                if line:
                    flow.put(line)
                else:
                    flow.newline()
            flow.block(2)
    return "\n".join(flows[0].result())


_render_all = by_value(lambda pages: pa.array([render(p) for p in pages], pa.string()))


def extract_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``html_col`` in ``out_col`` (an existing
    column of that name is replaced). One narrow pass. A null or empty page gives
    an empty text; repeated rows each get theirs; an empty table stays empty."""
    return pages.withColumn(out_col, F.arrow_udf(_render_all, StringType())(F.col(html_col)))


def op4_html_text(spark, sf_dir: str) -> DataFrame:
    got = extract_text(table(spark, sf_dir, "pages"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
