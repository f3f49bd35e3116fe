"""Spans of pattern matches as arrays, without a UDF.

Spark extracts all matches but not their places. One pass puts a mark before and behind
each match; the pieces between marks are gap, match, gap and so on, and running sums of their lengths
give every start and end, in characters. Patterns must not match the empty string; a mark
in the text itself (U+0000) reads as U+0001.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import overlaps

MARK = "\x00"
SPAN = "array<struct<start:int,end:int,text:string>>"


def once(build: Callable[..., Column]) -> Callable[..., Column]:
    """The expression of columns given by their names, built once for each JVM: building one takes seconds of round trips."""
    held: dict[tuple, Column] = {}

    @functools.wraps(build)
    def expression(*columns: Column | str) -> Column:
        if not all(isinstance(c, str) for c in columns):
            return build(*(F.col(c) if isinstance(c, str) else c for c in columns))
        key = (*columns, id(SparkContext._gateway))
        if key not in held:
            held[key] = build(*map(F.col, columns))
        return held[key]

    return expression


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), lambda x: body(x)), 1)


def find_spans(text: Column, pattern: str, long: bool = False) -> Column:
    """All matches in order: struct(start, end, text), 0-based, end exclusive. ``long`` is for texts with many matches."""

    def placed(pieces: Column) -> Column:
        places = F.sequence(F.lit(1), F.floor(F.size(pieces) / 2).cast("int"))
        match = lambda i: F.element_at(pieces, 2 * i)
        gap = lambda i: F.length(F.element_at(pieces, 2 * i - 1))
        if long:
            spans = let(F.transform(places, lambda i: F.struct(match(i).alias("m"), gap(i).alias("g"))), by_blocks)
        else:
            spans = running(places, F.lit(0), gap, match)
        return F.when(F.size(pieces) > 1, spans).otherwise(F.array().cast(SPAN))

    return let(F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit("\x01")), pattern, f"{MARK}$0{MARK}"), MARK, -1), placed)


def running(items: Column, at: Column, gap: Callable[[Column], Column], match: Callable[[Column], Column]) -> Column:
    """Spans of the items' matches behind their gaps, the first gap beginning at ``at``: one fold, which copies what it has at each step."""

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + gap(x)
        end = begin + F.length(match(x))
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(begin.alias("start"), end.alias("end"), match(x).alias("text"))).alias("out"))

    return F.aggregate(items, F.struct(at.alias("at"), F.array().cast(SPAN).alias("out")), step, lambda acc: acc["out"])


def by_blocks(pairs: Column) -> Column:
    """``running`` over blocks of the square root of their number, each from the sum of those before it, so that n matches cost the power 1.5 of n and not its square."""
    size = F.ceil(F.sqrt(F.size(pairs))).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / size).cast("int")), lambda k: F.slice(pairs, k * size + 1, size))

    def begun(cut: Column) -> Column:
        width = F.transform(cut, lambda b: F.aggregate(b, F.lit(0), lambda n, p: n + p["g"] + F.length(p["m"])))
        return F.aggregate(width, F.array(F.lit(0)), lambda acc, w: F.array_append(acc, F.element_at(acc, -1) + w))

    return let(blocks, lambda cut: F.flatten(F.zip_with(cut, let(begun(cut), lambda at: F.slice(at, F.lit(1), F.size(cut))), lambda block, at: running(block, at, lambda p: p["g"], lambda p: p["m"]))))


def first_span(text: Column, pattern: str) -> Column:
    return F.try_element_at(find_spans(text, pattern), F.lit(1))


def shifted(spans: Column, by: Column) -> Column:
    return F.transform(spans, lambda s: F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["text"].alias("text")))


def hits_any(span: Column, others: Column) -> Column:
    """Whether a span overlaps any of the others."""
    return F.exists(others, lambda o: overlaps(span["start"], span["end"], o["start"], o["end"]))


def greedy(items: Column, kind: str, clash: Callable[[Column, Column], Column]) -> Column:
    """Items in the order given, each kept unless it clashes with one kept before."""
    return F.aggregate(items, F.array().cast(f"array<{kind}>"), lambda kept, x: F.when(F.exists(kept, lambda k: clash(k, x)), kept).otherwise(F.array_append(kept, x)))


def stable_unique(c: Column) -> Column:
    return F.array_distinct(c)


def only(c: Column) -> Column:
    """The item of an array that holds one distinct item, else null."""
    return let(F.array_distinct(c), lambda x: F.when(F.size(x) == 1, F.element_at(x, 1)))
