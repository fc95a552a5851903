"""Visible text of HTML pages: a tree builder with implied tags, visibility rules and a text layout."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stackweave.llm.batches import add_columns

# Element kinds as HTML defines them.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEAD_ONLY = frozenset("title style script meta link base noscript template".split())
HIDDEN = frozenset("head title style script template noscript iframe object video audio canvas datalist".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SPACED = HEADINGS | frozenset("p ul ol dl blockquote pre table figure fieldset hr".split())
LINED = frozenset(
    "address article aside body center details dialog dd dir div dt figcaption footer form header hgroup html legend li main menu nav option "
    "optgroup search section summary".split())
BLOCKS = SPACED | LINED | HIDDEN | frozenset("select textarea table tr td th caption button".split())
CLOSES_P = (SPACED | LINED) - frozenset("body html legend option optgroup".split())
CELLS, SECTIONS = frozenset(("td", "th")), frozenset(("thead", "tbody", "tfoot"))
WALLS = frozenset(("table", "td", "th", "caption", "template", "button"))
COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
IMPORTANT = re.compile(r"\s*!\s*important$")
SPACES = re.compile(r"[ \t\n\r\f]+")
COLUMN_GAP = "  "


class Layout:
    """Lines of text under construction: collapsed runs, pending margins, prefixes of lists and quotes."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.run: list[str] = []
        self.blank_wanted = False
        self.space = False
        self.prefixes: list[str] = []
        self.marker = ""

    def text(self, data: str, keep: bool) -> None:
        if keep:
            first, *more = data.replace("\r\n", "\n").split("\n")
            self.run.append(first)
            for line in more:
                self.end_line(always=True)
                self.run.append(line)
            self.space = False
            return
        words = SPACES.sub(" ", data)
        if words.startswith(" ") and (self.run and not self.space):
            self.space = True
        body = words.strip(" ")
        if body:
            if self.space and self.run:
                self.run.append(" ")
            self.run.append(body)
            self.space = words.endswith(" ")

    def end_line(self, always: bool = False) -> None:
        """Close the current line; an empty one counts only after a forced break."""
        line = "".join(self.run)
        self.run, self.space = [], False
        if line.strip(" ") or always:
            if self.blank_wanted and self.lines:
                self.lines.append("")
            self.blank_wanted = False
            indent = "".join(self.prefixes)
            if self.marker:
                indent, self.marker = indent[: len(indent) - len(self.marker)] + self.marker, ""
            self.lines.append((indent + line).rstrip(" "))

    def margin(self, blank: bool) -> None:
        self.end_line()
        self.blank_wanted = self.blank_wanted or blank

    def result(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


def declared(style: str | None, wanted: tuple[str, ...] = ("display", "visibility")) -> dict[str, str]:
    """Values of the wanted properties in a style attribute: the last declaration counts, an important one more."""
    found: dict[str, tuple[bool, str]] = {}
    for declaration in COMMENT.sub(" ", style or "").split(";"):
        name, colon, value = declaration.partition(":")
        name, value = name.strip().lower(), value.strip().lower()
        if colon and value and name in wanted:
            plain, marks = IMPORTANT.subn("", value)
            if marks or not found.get(name, (False, ""))[0]:
                found[name] = (bool(marks), plain)
    return {name: value for name, (_, value) in found.items()}


class Table:
    """Cells by row; a cell that spans several rows keeps its columns taken in them.

    Taken columns are intervals ``(first, end, rows left)``, one per such cell, however many columns it spans.
    """

    def __init__(self, outer: Layout):
        self.outer, self.rows, self.taken, self.caption = outer, [], [], ""

    def row(self) -> None:
        self.taken = [(first, end, left - 1) for first, end, left in self.taken if left > 1]
        self.taken.sort()
        self.rows.append([])
        self.next, self.free = 0, 0

    def cell(self, text: str, columns: int, rows: int) -> None:
        if not self.rows:
            self.row()
        # Cells of a row come from left to right, so the intervals are passed once.
        while self.free < len(self.taken) and self.taken[self.free][0] <= self.next:
            self.next = max(self.next, self.taken[self.free][1])
            self.free += 1
        self.rows[-1].append((self.next, columns, rows, text.split("\n")))
        self.next += columns

    def end_row(self) -> None:
        """The cells of a finished row that go on below it."""
        self.taken += [(at, at + columns, rows) for at, columns, rows, _ in self.rows[-1] if rows > 1] if self.rows else []

    def lines(self) -> list[str]:
        """Rows with their cells in columns: each as wide as its widest cell, the last of a spanning cell's as it needs.

        A cell of several lines keeps them; the cells of a row stand side by side from its first line on.
        """
        starts = sorted({at for row in self.rows for at, *_ in row})
        width = [0] * len(starts)
        wide = []
        for row in self.rows:
            for at, columns, _, lines in row:
                first, end = bisect_left(starts, at), bisect_left(starts, at + columns)
                longest = max(map(len, lines))
                if end - first == 1:
                    width[first] = max(width[first], longest)
                else:
                    wide.append((end - first, first, end, longest))
        for _, first, end, longest in sorted(wide):
            held = sum(width[first:end]) + len(COLUMN_GAP) * (end - first - 1)
            width[end - 1] += max(0, longest - held)
        places, at = {}, 0
        for start, columns in zip(starts, width):
            places[start], at = at, at + columns + len(COLUMN_GAP)
        out = [self.caption] if self.caption else []
        for row in self.rows:
            for k in range(max((len(lines) for *_, lines in row), default=0)):
                line = ""
                for start, _, _, lines in row:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(places[start]) + lines[k]
                if line.strip():
                    out.append(line.rstrip())
        return out


def number(text: str | None, fallback: int, most: int = 1000) -> int:
    text = (text or "").strip()
    return min(most, int(text)) if re.fullmatch(r"\d{1,6}", text) and int(text) else fallback


class Page(HTMLParser):
    """Turns tags into a well-nested tree, element by element, and lays out what is visible."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.shown: list[bool] = []  # visibility of each open element, which its children may change
        self.count: Counter = Counter()
        self.hidden_from: int | None = None
        self.layouts = [Layout()]
        self.tables: list[Table] = []
        self.lists: list[list] = []
        self.kept = 0
        self.spans: list[tuple[int, int]] = []
        self.folded = False  # whether the innermost visible details element is closed

    # The tree

    def scope(self, names: frozenset | set, walls: frozenset) -> int | None:
        """Place of the innermost open element of ``names`` with none of ``walls`` inside it."""
        if not any(self.count[n] for n in names):
            return None
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k] in names:
                return k
            if self.open[k] in walls:
                return None
        return None

    def close_to(self, place: int | None) -> None:
        if place is not None:
            while len(self.open) > place:
                self.pop()

    def push(self, tag: str, attrs: dict) -> None:
        self.open.append(tag)
        self.shown.append(self.visible(attrs))
        self.count[tag] += 1
        if self.hidden_from is None:
            if self.unseen(tag, attrs):
                self.hidden_from = len(self.open) - 1
            else:
                self.enter(tag, attrs)

    def pop(self) -> None:
        tag = self.open.pop()
        self.shown.pop()
        self.count[tag] -= 1
        if self.hidden_from is None:
            self.leave(tag)
        elif self.hidden_from == len(self.open):
            self.hidden_from = None

    def unseen(self, tag: str, attrs: dict) -> bool:
        """Whether an element and all in it take no part in the layout."""
        display = declared(attrs.get("style")).get("display")
        if tag in HIDDEN or display == "none":
            return True
        if display is None and ("hidden" in attrs or (tag == "dialog" and "open" not in attrs)):
            return True
        return self.open[-2:-1] == ["details"] and tag != "summary" and self.folded

    def visible(self, attrs: dict) -> bool:
        """Whether the text of an element is seen; it takes its place in the layout in any case."""
        told = declared(attrs.get("style")).get("visibility")
        return told == "visible" if told in ("visible", "hidden", "collapse") else not self.shown or self.shown[-1]

    def handle_starttag(self, tag: str, pairs: list) -> None:
        attrs = dict(reversed(pairs))
        if tag in ("html", "body"):
            self.close_to(self.scope({"head"}, frozenset()))
            if tag == "html" or self.count["body"]:
                return
        elif tag == "head":
            if self.open:
                return
        elif self.open and self.open[-1] == "head" and tag not in HEAD_ONLY:
            self.pop()
        if tag in CLOSES_P:
            self.close_to(self.scope({"p"}, WALLS))
        if tag in HEADINGS and self.open and self.open[-1] in HEADINGS:
            self.pop()
        elif tag == "li":
            self.close_to(self.scope({"li"}, WALLS | {"ul", "ol", "menu", "dir"}))
        elif tag in ("dt", "dd"):
            self.close_to(self.scope({"dt", "dd"}, WALLS | {"dl"}))
        elif tag in ("option", "optgroup"):
            self.close_to(self.scope({"option"}, WALLS | {"select"}))
            if tag == "optgroup":
                self.close_to(self.scope({"optgroup"}, WALLS | {"select"}))
        elif tag in ("a", "button"):
            self.close_to(self.scope({tag}, frozenset(("table", "td", "th", "caption"))))
        elif tag in SECTIONS or tag in ("tr", "caption", "col", "colgroup") or tag in CELLS:
            table = self.scope({"table"}, frozenset())
            if table is None:
                return  # no table is open: the tag means nothing
            inside = self.open[table + 1 :]
            keep = 0
            if tag == "tr":
                keep = 1 if inside and inside[0] in SECTIONS else 0
            elif tag in CELLS:
                keep = next((k + 1 for k, t in enumerate(inside) if t == "tr"), 1 if inside and inside[0] in SECTIONS else 0)
            self.close_to(table + 1 + keep)
            if tag in CELLS and self.open[-1] != "tr":
                self.push("tr", {})
        if tag in VOID:
            if self.hidden_from is None and not self.unseen(tag, attrs) and self.visible(attrs):
                self.void(tag)
            return
        self.push(tag, attrs)

    def handle_startendtag(self, tag: str, pairs: list) -> None:
        self.handle_starttag(tag, pairs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.handle_starttag("br", [])
        elif tag in HEADINGS:
            self.close_to(self.scope(HEADINGS, WALLS))
        elif tag in CELLS or tag in SECTIONS or tag in ("tr", "caption"):
            self.close_to(self.scope({tag}, frozenset(("table",))))
        elif tag not in ("html", "body"):
            place = self.scope({tag}, WALLS - {tag} if tag != "table" else frozenset())
            if place is not None and place != self.hidden_from and tag not in BLOCKS and BLOCKS.intersection(self.open[place + 1 :]):
                # An inline element ends inside a block that it began before: the block stays open.
                del self.open[place], self.shown[place]
                self.count[tag] -= 1
                if self.hidden_from is not None and self.hidden_from > place:
                    self.hidden_from -= 1
            else:
                self.close_to(place)

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1] == "head" and data.strip():
            self.pop()
        if self.hidden_from is None and not (self.shown and not self.shown[-1]) and not (self.open and self.open[-1] == "details" and self.folded):
            outside = self.tables and (not self.open or self.open[-1] in ("table", "tr") or self.open[-1] in SECTIONS)
            if not outside:
                self.layouts[-1].text(data, self.kept > 0)
            elif data.strip():
                self.tables[-1].outer.text(data, False)  # text between cells stands before the table

    # The layout

    def void(self, tag: str) -> None:
        if tag == "br":
            self.layouts[-1].end_line(always=True)
        elif tag == "hr":
            self.layouts[-1].margin(True)

    def enter(self, tag: str, attrs: dict) -> None:
        lay = self.layouts[-1]
        if tag in SPACED:
            lay.margin(not (tag in ("ul", "ol") and self.lists))
        elif tag in LINED:
            lay.margin(False)
        if tag in ("ul", "ol", "menu", "dir"):
            self.lists.append([tag, number(attrs.get("start"), 1, 10**6)])
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 1]
            marker = "- "
            if kind[0] == "ol":
                kind[1] = number(attrs.get("value"), kind[1], 10**6)
                marker = f"{kind[1]}. "
                kind[1] += 1
            lay.prefixes.append(" " * len(marker))
            lay.marker = marker if self.shown[-1] else ""
        elif tag == "blockquote":
            lay.prefixes.append("> ")
        elif tag == "dd":
            lay.prefixes.append("  ")
        elif tag in ("pre", "textarea"):
            self.kept += 1
        elif tag == "details":
            self.folded = "open" not in attrs
        elif tag == "table":
            self.tables.append(Table(lay))
        elif tag == "tr":
            self.tables[-1].row()
        elif tag in CELLS or tag == "caption":
            self.spans.append((number(attrs.get("colspan"), 1), number(attrs.get("rowspan"), 1)))
            self.layouts.append(Layout())

    def leave(self, tag: str) -> None:
        if tag in CELLS or tag == "caption":
            text, span = self.layouts.pop().result(), self.spans.pop()
            if tag == "caption":
                self.tables[-1].caption = " ".join(text.split())
            else:
                self.tables[-1].cell(text, *span)
            return
        if tag == "tr":
            self.tables[-1].end_row()
            return
        lay = self.layouts[-1]
        if tag == "table":
            lay.end_line()
            for line in self.tables.pop().lines():
                lay.run.append(line)
                lay.end_line()
        elif tag in ("ul", "ol", "menu", "dir"):
            self.lists.pop()
        if tag in SPACED:
            lay.margin(not (tag in ("ul", "ol") and self.lists))
        elif tag in LINED:
            lay.margin(False)
        if tag == "li":
            lay.prefixes.pop()
            lay.marker = ""
        elif tag in ("blockquote", "dd"):
            lay.prefixes.pop()
        elif tag in ("pre", "textarea"):
            self.kept -= 1
        elif tag == "details":
            self.folded = False

    def finish(self) -> str:
        self.close()
        self.close_to(0)
        return self.layouts[0].result()


def visible_text(html: str | None) -> str:
    """The text a reader sees, laid out in lines; empty for null and empty pages."""
    if not html:
        return ""
    page = Page()
    page.feed(html.replace("\x00", "�"))
    return page.finish()


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` with ``text``, the visible text of ``html``, which is left out.

    A narrow map, one page at a time; a page of any length must fit its task, and the work grows with it (with the
    number of cells times those that reach into their row, in tables). Visibility follows the tags, the attributes ``hidden``, ``open`` and
    ``style``; rules of style sheets are not applied. Null and empty pages give empty texts, repeated rows repeated
    results, an empty table an empty one; a column ``text`` of the table gives way. Of several cells that need a
    column wider, the widest counts; a cell over several columns widens its last one.
    """

    def work(batch: pa.RecordBatch) -> dict[str, object]:
        return {"text": [visible_text(h) for h in batch.column("html").to_pylist()]}

    return add_columns(pages, [("text", T.StringType())], work, column="html", drop=("html",))
