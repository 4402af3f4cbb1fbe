"""Main text of web pages: flat blocks, their own and their neighbours' density, and a decision tree.

A page becomes a flat list of text blocks. Each has its number of words, its
link density, those of the blocks before and after it, and whether its markup
names a part that is never article text or the article itself. A decision tree,
grown from the small labelled table below, says which blocks are article text.
"""

from __future__ import annotations

import html as references
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from florametrics.llm.common import ship_modules

#: Elements of HTML by what they do to the text.
DROPPED = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "select", "textarea", "button", "title",
           "canvas", "audio", "video"}
BOILER = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"}
MAIN = {"article", "main"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "li", "main",
         "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Words of class, id and role that name such parts.
NAMED = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
         "comments", "cookie", "cookies", "consent", "copyright", "disqus", "footer", "gdpr", "header", "masthead", "menu", "nav",
         "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo", "promoted", "recommended",
         "related", "reply", "replies", "share", "sharing", "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar",
         "widget", "alert", "modal", "complementary", "contentinfo", "search"}
NAMED_MAIN = {"article", "content", "post", "entry", "story", "main"}

PIECE = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)

#: Labelled blocks (fixed values): words, words before, words after, link density, density before, density after,
#: inside a part that is never text, inside the article, the page marks its article; 1: article text.
LABELLED = [
    (42, 0, 38, 0.0, 0.0, 0.0, 0, 1, 1, 1), (65, 12, 80, 0.0, 0.0, 0.0, 0, 1, 1, 1), (1, 40, 30, 0.0, 0.0, 0.0, 0, 1, 1, 1),
    (3, 0, 55, 0.0, 1.0, 0.0, 0, 1, 1, 1), (9, 6, 70, 0.0, 1.0, 0.0, 0, 1, 1, 1), (8, 90, 4, 0.1, 0.0, 1.0, 0, 1, 1, 1),
    (30, 5, 5, 0.5, 0.0, 0.0, 0, 1, 1, 1), (2, 2, 2, 1.0, 0.0, 0.0, 0, 1, 1, 1), (120, 30, 0, 0.05, 0.0, 0.0, 0, 1, 1, 1),
    (1, 0, 0, 0.0, 0.0, 0.0, 0, 1, 1, 1), (14, 1, 1, 1.0, 1.0, 1.0, 0, 1, 1, 1), (5, 0, 14, 0.0, 0.0, 0.0, 0, 1, 1, 1),
    (1, 1, 1, 1.0, 1.0, 1.0, 1, 0, 1, 0), (2, 1, 15, 1.0, 1.0, 0.0, 1, 0, 1, 0), (16, 2, 9, 0.0, 1.0, 0.0, 1, 0, 1, 0),
    (12, 80, 0, 0.0, 0.0, 0.0, 1, 0, 1, 0), (40, 60, 3, 0.0, 0.0, 0.0, 1, 0, 1, 0), (85, 40, 12, 0.0, 0.0, 0.0, 1, 0, 1, 0),
    (25, 50, 50, 0.0, 0.0, 0.0, 1, 1, 1, 0), (6, 50, 45, 0.9, 0.0, 0.0, 1, 1, 1, 0), (70, 70, 70, 0.0, 0.0, 0.0, 1, 1, 1, 0),
    (3, 60, 60, 1.0, 0.0, 0.0, 1, 1, 1, 0), (1, 9, 0, 0.0, 0.0, 0.0, 1, 1, 1, 0), (15, 0, 0, 0.0, 0.0, 0.0, 1, 0, 0, 0),
    (60, 0, 0, 0.0, 0.0, 0.0, 1, 0, 0, 0), (4, 30, 30, 0.0, 0.0, 0.0, 1, 0, 0, 0), (2, 2, 2, 1.0, 1.0, 1.0, 1, 0, 0, 0),
    (12, 3, 20, 0.0, 1.0, 0.0, 0, 0, 1, 0), (30, 5, 9, 0.0, 0.0, 0.0, 0, 0, 1, 0), (60, 2, 0, 0.0, 1.0, 0.0, 0, 0, 1, 0),
    (3, 0, 4, 1.0, 0.0, 1.0, 0, 0, 1, 0), (7, 90, 0, 0.2, 0.0, 0.0, 0, 0, 1, 0), (1, 0, 60, 0.0, 0.0, 0.0, 0, 0, 1, 0),
    (45, 40, 50, 0.0, 0.0, 0.0, 0, 0, 0, 1), (80, 10, 60, 0.05, 0.0, 0.0, 0, 0, 0, 1), (22, 60, 55, 0.1, 0.0, 0.0, 0, 0, 0, 1),
    (18, 2, 40, 0.0, 1.0, 0.0, 0, 0, 0, 1), (4, 50, 60, 0.0, 0.0, 0.0, 0, 0, 0, 1), (1, 45, 40, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (6, 1, 70, 0.0, 1.0, 0.0, 0, 0, 0, 1), (12, 70, 2, 0.0, 0.0, 1.0, 0, 0, 0, 1), (10, 0, 0, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (35, 0, 0, 0.3, 0.0, 0.0, 0, 0, 0, 1), (3, 0, 0, 0.0, 0.0, 0.0, 0, 0, 0, 1), (9, 8, 9, 0.0, 0.0, 0.0, 0, 0, 0, 1),
    (2, 2, 3, 1.0, 1.0, 1.0, 0, 0, 0, 0), (1, 1, 1, 1.0, 1.0, 1.0, 0, 0, 0, 0), (5, 3, 4, 0.9, 1.0, 1.0, 0, 0, 0, 0),
    (8, 60, 2, 1.0, 0.0, 1.0, 0, 0, 0, 0), (20, 5, 3, 0.8, 1.0, 1.0, 0, 0, 0, 0), (3, 0, 2, 1.0, 0.0, 1.0, 0, 0, 0, 0),
    (14, 2, 2, 0.7, 1.0, 1.0, 0, 0, 0, 0), (6, 50, 50, 1.0, 0.0, 0.0, 0, 0, 0, 0), (30, 20, 25, 0.9, 0.0, 0.0, 0, 0, 0, 0),
]


@lru_cache(maxsize=1)
def tree():
    """Decision tree grown on the labelled table: splits of least Gini impurity until the leaves are pure."""
    def grow(rows):
        ones = sum(r[-1] for r in rows)
        if ones in (0, len(rows)):
            return int(ones > 0)
        best = None
        for at in range(len(rows[0]) - 1):
            values = sorted({r[at] for r in rows})
            for low, high in zip(values, values[1:]):
                cut = (low + high) / 2
                sides = [r for r in rows if r[at] <= cut], [r for r in rows if r[at] > cut]
                cost = sum(2 * sum(r[-1] for r in s) * (1 - sum(r[-1] for r in s) / len(s)) for s in sides)
                # Of equal splits the one nearest the middle of its sides, then the first column.
                key = (round(cost, 9), at, abs(len(sides[0]) - len(sides[1])))
                if best is None or key < best[0]:
                    best = key, at, cut, sides
        if best is None:
            return int(2 * ones >= len(rows))
        return best[1], best[2], grow(best[3][0]), grow(best[3][1])
    return grow(LABELLED)


def _says(node, row) -> bool:
    while not isinstance(node, int):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return bool(node)


def _names(attrs: str) -> set[str]:
    return {w for m in ATTRIBUTE.finditer(attrs) for w in re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower())}


def blocks(page: str) -> list[tuple[str, int, int, bool, bool]]:
    """(text, words, words in links, in a part that is never text, in the article) in page order; blocks without text left out."""
    out, held, linked = [], [], 0
    stack: list[tuple[str, bool, bool]] = []
    boiler = main = False
    link = at = 0

    def close_block():
        nonlocal linked
        words = references.unescape("".join(held)).split()
        held.clear()
        if words:
            out.append((" ".join(words), len(words), min(linked, len(words)), boiler, main))
        linked = 0

    def add(text: str):
        nonlocal linked
        if text:
            held.append(text)
            if link:
                linked += len(references.unescape(text).split())

    while at < len(page):
        m = PIECE.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            if m[0].startswith("<![CDATA["):
                add(references.unescape(m[0][9:-3]).replace("&", "&amp;"))
            continue
        if name in DROPPED and not m["close"]:
            if not m["attrs"].endswith("/"):
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                # Without an end, script-like elements run to the end of the page and others are ignored.
                at = end.end() if end else len(page) if name in ("script", "style", "title", "textarea") else at
            continue
        if name == "br":
            held.append(" ")
            continue
        if name == "a":
            link = 0 if m["close"] else 1
            continue
        if name in BLOCK:
            close_block()
        if name in VOID or m["attrs"].endswith("/") and name not in BLOCK:
            continue
        if m["close"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None:
                if name not in BLOCK and (boiler, main) != stack[depth][1:]:
                    close_block()
                boiler, main = stack[depth][1:]
                del stack[depth:]
        else:
            if name in ("p", "li", "td", "tr", "dd", "dt", "option"):  # these end an open one of their kind in the same list or table
                floor = max((i for i, s in enumerate(stack) if s[0] in ("ul", "ol", "table", "dl", "div", "article", "section", "body", "nav", "aside", "footer", "header", "main", "form", "blockquote")), default=-1)
                if stack and len(stack) - 1 > floor and any(s[0] == name for s in stack[floor + 1:]):
                    depth = next(i for i in range(floor + 1, len(stack)) if stack[i][0] == name)
                    boiler, main = stack[depth][1:]
                    del stack[depth:]
            was = boiler, main
            named = _names(m["attrs"]) if m["attrs"] else set()
            if name in MAIN or name not in ("html", "body") and named & NAMED_MAIN and not named & NAMED:
                now = boiler, True
            else:
                now = boiler, main
            if name not in ("html", "body", "article", "main") and (name in BOILER or named & NAMED or m["attrs"] and HIDDEN.search(m["attrs"])):
                now = True, now[1]
            if now != was and name not in BLOCK:
                close_block()
            stack.append((name, *was))
            boiler, main = now
    close_block()
    return out


def main_text(page: str | None) -> str:
    """Article blocks joined by newlines; empty if there are none."""
    found = blocks(page or "")
    density = [b[2] / b[1] for b in found]
    marked = any(b[4] for b in found)
    kept = []
    for i, (text, words, _, boiler, main) in enumerate(found):
        before, after = (found[i - 1][1], density[i - 1]) if i else (0, 0.0), (found[i + 1][1], density[i + 1]) if i + 1 < len(found) else (0, 0.0)
        row = (words, before[0], after[0], density[i], before[1], after[1], int(boiler), int(main), int(marked))
        if _says(tree(), row):
            kept.append(text)
    return "\n".join(kept)


def extract(pages: DataFrame, out: str = "text") -> DataFrame:
    """All columns but ``html``, then ``out`` (article text) and ``n_chars`` (its code points); columns of these names are replaced.

    A null or empty page gives an empty text; broken markup never fails; an
    empty table gives no rows; a repeated page gives its text per row.
    """
    ship_modules()
    rest = [c for c in pages.columns if c not in ("html", out, "n_chars")]
    rows = pages.select(*rest, "html")
    kinds = T.StructType([*(rows.schema[c] for c in rest), T.StructField(out, T.StringType()), T.StructField("n_chars", T.LongType())])

    def task(batches):
        for batch in batches:
            found = [main_text(h) for h in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=kinds.names)

    return rows.mapInArrow(task, kinds)
