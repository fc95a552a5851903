"""Pages against a second, plain renderer that walks a given tree, and the cost of odd tables."""

import random
import time

import pytest

from stackweave.llm.html import COLUMN_GAP, declared, visible_text

BLOCK = {"div": False, "p": True, "ul": True, "li": False, "table": True, "section": False}


def tree(rng, depth, inside="div"):
    """A random element: (tag, style, children); children are words or elements."""
    style = rng.choice(["", "", "", "", "visibility:hidden", "visibility: visible", "display:none", "display:none;display:block", "visibility:hidden!important;visibility:visible"])
    if inside == "ul":
        return "li", style, [word(rng)] + ([tree(rng, depth - 1)] if depth > 0 and rng.random() < 0.3 else [])
    kinds = ["span", "b", "div", "section", "p", "ul", "table"] if depth > 0 else ["span", "b"]
    tag = rng.choice(kinds if inside not in ("p", "span", "b") else ["span", "b"])
    if tag == "ul":
        return tag, style, [tree(rng, depth - 1, "ul") for _ in range(rng.randint(1, 3))]
    if tag == "table":
        return tag, "", [[(word(rng, 3), rng.choice([1, 1, 1, 2]), rng.choice(["", "", "visibility:hidden"])) for _ in range(rng.randint(1, 3))] for _ in range(rng.randint(1, 3))]
    return tag, style, [word(rng) if rng.random() < 0.6 else tree(rng, depth - 1, tag) for _ in range(rng.randint(1, 4))]


def word(rng, most=1):
    return " ".join(rng.choice("alpha be gamma d epsilon zeta".split()) for _ in range(rng.randint(1, most)))


def written(node):
    if isinstance(node, str):
        return f" {node} "
    tag, style, children = node
    if tag == "table":
        rows = "".join("<tr>" + "".join(f"<td colspan={n}" + (f' style="{s}"' if s else "") + f">{t}" for t, n, s in row) for row in children)
        return f"<table>{rows}</table>"
    return f'<{tag} style="{style}">' + "".join(map(written, children)) + f"</{tag}>"


class Plain:
    def __init__(self):
        self.lines, self.words, self.gap, self.lead = [], [], False, False

    def flush(self, gap=False):
        if self.words:
            if not self.lines:
                self.lead = self.gap
            elif self.gap:
                self.lines.append("")
            self.gap = False
            self.lines.append(" ".join(self.words))
        self.words = []
        self.gap |= gap

    def walk(self, node, seen=True, lists=0, indent=""):
        if isinstance(node, str):
            if seen:
                self.words += node.split()
            return
        tag, style, children = node
        if style == "display:none":
            return
        seen = {"visibility:hidden": False, "visibility: visible": True, "visibility:hidden!important;visibility:visible": False}.get(style, seen)
        block = tag in BLOCK
        if block:
            self.flush(BLOCK[tag] and not (tag == "ul" and lists))
        if tag == "table":
            self.table(children, seen)
        elif tag == "li":
            inner = Plain()
            for child in children:
                inner.walk(child, seen, lists)
            inner.flush()
            self.gap |= inner.lead and bool(inner.lines)
            for k, line in enumerate(inner.lines):
                if self.gap and self.lines:
                    self.lines.append("")
                self.gap = False
                self.lines.append(((("- " if seen else "  ") if k == 0 else "  ") + line).rstrip() if line else "")
            self.gap = self.gap or (inner.gap and bool(inner.lines))
        else:
            for child in children:
                self.walk(child, seen, lists + (tag == "ul"))
        if block:
            self.flush(BLOCK[tag] and not (tag == "ul" and lists))

    def table(self, rows, seen):
        placed = []
        for row in rows:
            at, cells = 0, []
            for text, n, style in row:
                cells.append((at, n, "" if style or not seen else text))
                at += n
            placed.append(cells)
        starts = sorted({at for row in placed for at, *_ in row})
        width = dict.fromkeys(starts, 0)
        spans = {(at, n): [s for s in starts if at <= s < at + n] for row in placed for at, n, _ in row}
        for (at, n), covered in sorted(spans.items(), key=lambda x: (len(x[1]), x[0][0])):
            longest = max(len(t) for row in placed for a, m, t in row if (a, m) == (at, n))
            width[covered[-1]] += max(0, longest - sum(width[c] for c in covered) - len(COLUMN_GAP) * (len(covered) - 1))
        for row in placed:
            line = ""
            for at, _, text in row:
                line = (line.ljust(sum(width[s] + len(COLUMN_GAP) for s in starts if s < at)) + text) if text else line
            self.words = [line.rstrip()] if line.strip() else []
            self.flush()


@pytest.mark.parametrize("seed", range(150))
def test_random_pages(seed):
    rng = random.Random(seed)
    parts = [tree(rng, 3) for _ in range(rng.randint(1, 5))]
    page = "<body>" + "".join(map(written, parts))
    told = Plain()
    for part in parts:
        told.walk(part)
    told.flush()
    assert visible_text(page) == "\n".join(told.lines), page


@pytest.mark.parametrize("html,text", [
    ("<div style='visibility:hidden'>a<b style='visibility:visible'>SEEN</b>c</div>b", "SEEN\nb"),
    ("<p style='display:none;display:block'>x", "x"), ("<p style='display:none!important;display:block'>x", ""),
    ("<p style='/* display:none */color:red'>x", "x"), ("<p hidden style='display:block'>x", "x"), ("<p style='DISPLAY : None'>x", ""),
    ("<table><tr><td colspan=2>a very long heading over two<td>c<tr><td>1<td>2<td>3", "a very long heading over two  c\n" + "1  2".ljust(30) + "3"),
    ("<table><tr><td><ul><li>x<li>y</ul><td>z", "- x  z\n- y"),
    ("<table><tr><td rowspan=2>a<td>b<tr><td>c<tr><td>d<td>e", "a  b\n   c\nd  e"),
    ("<table><tr><td rowspan=3>a<td rowspan=2>b<td>c<tr><td>d<tr><td>e", "a  b  c\n      d\n   e"),
])
def test_cases(html, text):
    assert visible_text(html) == text


def test_declarations():
    assert declared(None) == {} and declared("display") == {} and declared("display:;x:y;visibility:HIDDEN ! important") == {"visibility": "hidden"}


@pytest.mark.parametrize("page", [
    "<table>" + "<tr><td colspan=1000 rowspan=1000>x" * 400, "<table><tr>" + "<td colspan=1000 rowspan=1000>x" * 400 + "<tr><td>y" * 50,
    "<table><tr>" + "<td>x" * 3000, "<div>" * 3000 + "x",
])
def test_odd_tables_are_quick(page):
    start = time.perf_counter()
    assert "x" in visible_text(page)
    assert time.perf_counter() - start < 2
