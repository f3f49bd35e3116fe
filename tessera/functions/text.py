"""Text normalisation as column expressions.

Every function takes and returns columns, keeps null as stated, and stays inside
Spark's own expressions. Patterns carry ``(?U)`` so that white space and word
boundaries follow Unicode.
"""

from __future__ import annotations

import unicodedata
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that are no part of a name.
PARTICLES = ["DE", "DA", "DO", "DAS", "DOS", "E", "MIN", "MINISTRO", "MINISTRA"]


def _accents() -> tuple[str, str]:
    """Letters whose decomposition is one base letter and marks, and those base letters, by rule."""
    pairs = []
    for code in range(0xC0, 0x250):
        bare = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if bare != chr(code) and len(bare) == 1:
            pairs.append((chr(code), bare))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, BARE = _accents()


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unaccented(c: Column | str) -> Column:
    return F.regexp_replace(F.translate(column(c), ACCENTED, BARE), r"\p{Mn}", "")


def normalize_value(c: Column | str) -> Column:
    """Upper case without accents; each white-space character becomes one space."""
    return F.upper(F.regexp_replace(unaccented(c), r"(?U)[\s\x1c-\x1f]", " "))


def normalize_for_matching(c: Column | str) -> Column:
    """Struct of the original, its folded text, and for each folded character the position it comes from."""
    c = column(c)
    length = lambda i: F.length(normalize_value(F.substr(c, i, F.lit(1))))
    sources = F.flatten(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.array_repeat(i - 1, length(i))))
    plain = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: i - 1)
    text = normalize_value(c)
    indices = F.when(F.length(c) == 0, F.array().cast("array<int>")).when((F.length(text) == F.length(c)) & ~c.rlike(r"[ß\p{Mn}\x{FB00}-\x{FB06}]"), plain).otherwise(sources)
    return F.struct(c.alias("original"), text.alias("text"), indices.alias("source_indices"))


def original_slice(norm: Column, start: Column, end: Column) -> Column:
    """The original text behind folded positions start:end, both clamped."""
    n = F.size(norm["source_indices"])
    start, end = F.greatest(F.lit(0), F.least(start, n)), F.greatest(F.lit(0), F.least(end, n))
    first, last = F.try_element_at(norm["source_indices"], start + 1), F.try_element_at(norm["source_indices"], end)
    return F.when(start < end, F.substr(norm["original"], first + 1, last - first + 1)).otherwise("")


def compact_space(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(column(c), r"(?U)[\s\x1c-\x1f]+", " "))


def fold(c: Column | str) -> Column:
    """Upper case without accents, single spaces, trimmed; null becomes empty."""
    return F.coalesce(F.upper(compact_space(unaccented(c))), F.lit(""))


def digits(c: Column | str) -> Column:
    """The ASCII digits; null becomes empty."""
    return F.coalesce(F.regexp_replace(column(c).cast("string"), "[^0-9]", ""), F.lit(""))


def class_key(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(fold(c), "[^A-Z0-9]+", " "))


def name_tokens(c: Column | str) -> Column:
    words = F.filter(F.split(class_key(c), " "), lambda x: x != "")
    return F.filter(words, lambda x: ~x.isin(PARTICLES))


def is_subsequence(expected: Column, available: Column) -> Column:
    """Whether the expected items occur in the available ones in order; false if none are expected."""
    matched = F.aggregate(available, F.lit(0), lambda p, t: F.when(F.try_element_at(expected, p + 1) == t, p + 1).otherwise(p))
    return (F.size(expected) > 0) & (matched == F.size(expected))


def name_matches(candidate: Column | str, expected: Column | str) -> Column:
    return is_subsequence(name_tokens(expected), name_tokens(candidate))


def normalize_uf(c: Column | str) -> Column:
    return F.when(fold(c).rlike("^[A-Z]{2}$"), fold(c))


def ocr_digits(c: Column | str) -> Column:
    return F.translate(F.upper(column(c)), "OIL", "011")


def ocr_digits_wide(c: Column | str) -> Column:
    return F.translate(column(c), "OoIlLSsGg", "001115599")


def compact_number(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(ocr_digits(c), r"(?U)\s*([.\-/])\s*", "$1"), r"(?U)\s+", "")


def output_form(c: Column | str) -> Column:
    return compact_space(F.regexp_replace(normalize_value(c), "[-–—_/.,;:()'\"º°]", " "))


def four_digit_year(c: Column | str) -> Column:
    """Two digits up to 30 are of this century, others of the last."""
    value = ocr_digits(c)
    short = value.try_cast("int")
    return F.when(F.length(value) == 2, F.when(short <= 30, 2000 + short).otherwise(1900 + short).cast("string")).otherwise(value)


def clean_article(c: Column | str) -> Column:
    value = F.regexp_replace(column(c), r"(?iU)\s*(?:º|°|O)\s*$", "")
    value = F.regexp_replace(value, r"(?U)\s*[-–]\s*", "-")
    return F.upper(F.trim(F.regexp_replace(value, r"(?U)\s*\.\s*", ".")))


def roman_values(c: Column | str) -> Column:
    return F.regexp_extract_all(F.upper(column(c)), F.lit(r"(?U)\b[IVXLCDM]+\b"), F.lit(0))


def norm_id(c: Column | str) -> Column:
    """Trimmed; digits lose leading zeros."""
    value = F.trim(column(c).cast("string"))
    return F.when(value.rlike("^[0-9]+$"), F.coalesce(F.nullif(F.regexp_replace(value, "^0+", ""), F.lit("")), F.lit("0"))).otherwise(value)


def level_of(c: Column | str) -> Column:
    """The level in a document name such as ``x_n1_7``, in either case, or null."""
    return F.nullif(F.regexp_extract(column(c), r"(?i)(?:^|_)n([12])(?:_|$)", 1), F.lit("")).cast("int")


def contains_word(text: Column, word: Column) -> Column:
    """Whether ``word`` stands in ``text`` with no A-Z beside it."""
    return F.regexp_like(text, F.concat(F.lit(r"(?<![A-Z])\Q"), word, F.lit(r"\E(?![A-Z])")))


def overlaps(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return (s1 < e2) & (s2 < e1)


def distance(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    return F.greatest(s2 - e1, s1 - e2, F.lit(0))


def exact_round(c: Column, places: int) -> Column:
    """Rounding of a double in [0, 1] by its binary value, exact ties to even.

    The double times 2**60 is a whole number, so what is beyond the last place is
    compared with one half in whole decimals.
    """
    unit = F.lit(Decimal(2**60)).cast("decimal(20,0)")
    whole = (c * F.lit(float(2**60))).cast("long").cast("decimal(20,0)") * F.lit(Decimal(10**places)).cast("decimal(10,0)")
    rest = whole % unit
    low = F.floor((whole - rest) / unit).cast("long")
    up = (2 * rest > unit) | ((2 * rest == unit) & (low % 2 == 1))
    return F.when(up, low + 1).otherwise(low).cast("double") / F.lit(float(10**places))
