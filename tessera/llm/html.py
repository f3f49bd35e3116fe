"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block; no names of classes or ids are read.
A line's weight is the length of its text; lines of the elements that HTML itself has for menus, headers,
footers, sidebars and forms (but for a form around an article), of articles inside an article (which are comments on it), and lines made of links weigh
nothing. Where the page marks articles, a line of one weighs ``MARK`` more and a
line outside a ``WINDOW``-th. Sums of weights over a sliding window of ``WINDOW``
lines surge where a block of text begins and dive to nothing where it ends; no sum reaches over the edge of an
article, and an article in which a sum surges is one block, edge to edge. Blocks of
less than a ``SHARE``-th of the heaviest one are boilerplate: adverts, notices, comments. The weighted lines of the others are the main text.

Defined results: null or empty html, or a page without text: empty text, 0 chars;
a page whose sums never surge keeps the weighted lines of its articles, or all if
it has none; unclosed elements end with the page, but an unclosed boilerplate
element hides only its own line; equal blocks are all kept; very long pages are read whole, in linear time; an empty table gives no rows;
columns of ``keep`` that are named like a new one are replaced by it, other columns never matter.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.llm.scratch import kept_schema, table

WINDOW, SURGE, SHARE = 3, 80, 4
#: ``WINDOW`` lines of an article are a surge, however short.
MARK = SURGE // WINDOW + 1
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(script|style|noscript|template|svg|math|iframe|object|select|textarea|canvas|audio|video|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"<]*\"|'[^'<]*'|[^'\"<>])*|[^<>]*)>|<[!?][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr img".split())
BOILERPLATE = frozenset("nav footer aside form head button menu dialog".split())

Line = tuple[str, int, int]


def lines(page: str) -> list[Line]:
    """The blocks of a page in order: text, weight, and the number of the article, 0 outside."""
    low = page.lower()
    out: list[Line] = []
    parts: list[str] = []
    linked = link = 0
    hides, hidden = "", 0  # a boilerplate element that is open, and how often its tag is
    marks, articles, depth = "article" if "<article" in low else "main", 0, 0
    mark_starts = [m.start() for m in re.finditer(f"<{marks}\\b", low)]
    closed: dict[str, int] = {}

    def ends_after(tag: str, at: int) -> bool:
        """Whether an end tag of this name follows."""
        if tag not in closed:
            closed[tag] = low.rfind(f"</{tag}")
        return closed[tag] >= at

    def holds_mark(at: int) -> bool:
        """Whether an article begins before the next form ends: such a form is a layout around the page."""
        begin = bisect_left(mark_starts, at)
        return begin < len(mark_starts) and mark_starts[begin] < low.find("</form", at)

    def end() -> None:
        nonlocal linked
        text = " ".join(entities.unescape("".join(parts)).split())
        parts.clear()
        weight = 0 if hides or 2 * linked > len(text) else len(text)
        linked = 0
        if text or (hides and out and out[-1][1]):
            out.append((text, weight, articles if depth else 0))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at and not hides:
            parts.append(page[at : m.start()])
            if link:
                linked += m.start() - at
        at = m.end()
        if m[3] is None:
            continue
        tag, closing = m[3].lower(), bool(m[2])
        if hides:
            if tag == hides:
                hidden += -1 if closing else 0 if m[4].endswith("/") else 1
                if not hidden:
                    end()
                    hides = ""
            continue
        if tag in INLINE:
            if tag == "a":
                link = 0 if closing else 1
            continue
        end()
        link = 0
        if closing:
            depth -= tag == marks and depth > 0
        elif (tag in BOILERPLATE or (tag == "header" and not depth) or (tag == marks and depth)) and ends_after(tag, at) and not (tag == "form" and holds_mark(at)):
            hides, hidden = tag, 1
        elif tag == marks:
            depth += 1
            articles += depth == 1
    if at < len(page) and not hides:
        parts.append(page[at:])
    end()
    if any(w and a for _, w, a in out):
        return [(t, w and (w + MARK if a else max(1, w // WINDOW)), a) for t, w, a in out]
    return out


def blocks(found: list[Line]) -> list[tuple[int, int]]:
    """Of lines (text, weight, article), the ranges between a surge and the dive after it.

    At a surge a sum over ``WINDOW`` lines from a line with weight exceeds ``SURGE``; at a dive it is nothing. An article
    in which a sum surges is one range.
    """
    out: list[tuple[int, int]] = []
    for article, own in groupby(range(len(found)), key=lambda i: found[i][2]):
        at = list(own)
        weights = [found[i][1] for i in at]
        begin, ranges = -1, []
        for k, weight in enumerate(weights):
            total = sum(weights[k : k + WINDOW])
            if begin < 0 and weight and total > SURGE:
                begin = k
            elif begin >= 0 and not total:
                ranges.append((at[begin], at[k]))
                begin = -1
        if begin >= 0:
            ranges.append((at[begin], at[-1] + 1))
        out += [(at[0], at[-1] + 1)] if article and ranges else ranges
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = lines(page)
    total = {r: sum(w for _, w, _ in found[slice(*r)]) for r in blocks(found)}
    heaviest = max(total.values(), default=0)
    kept = {i for r, n in total.items() if SHARE * n >= heaviest for i in range(*r)}
    if not kept:
        marked = {i for i, (_, w, a) in enumerate(found) if a and w}
        kept = marked or set(range(len(found)))
    return " ".join(t for i, (t, w, _) in enumerate(found) if w and i in kept)


NEW = {"text": "string", "n_chars": "long"}


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with ``text`` and ``n_chars``; ``pages`` needs ``html``. Columns of ``keep`` that are named like a new one are replaced by it."""
    keep = [c for c in keep if c not in NEW]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [main_text(x) for x in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], [*keep, *NEW])

    return pages.select(*dict.fromkeys([*keep, "html"])).mapInArrow(run, kept_schema(pages, keep, NEW))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"), ["page_id", "url"])
