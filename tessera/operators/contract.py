"""Contract checks as violation rows, and completeness of outputs.

A duplicate span is a row of its document here; it never stops other documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.evaluate import CLASSES, iou

#: Kinds and natures of a citation.
KINDS, NATURES = ["lei", "jurisprudencia"], ["dispositivo", "sumula", "acordao"]


def violations(citations: DataFrame, doc: str) -> DataFrame:
    """(doc, citation, rule) for every rule that a citation breaks.

    citations: doc, citation, inicio, fim, classificacao, id_canonico, confianca (which may be null),
    and length of the text; trecho and text if the slice is to be compared, tipo and natureza if they are to be checked.
    """
    span = (F.col("inicio") < 0) | (F.col("fim") > F.col("length")) | (F.col("fim") <= F.col("inicio")) | F.col("inicio").isNull() | F.col("fim").isNull()
    real = F.col("classificacao") == "real"
    known = lambda c, values: F.coalesce(F.col(c).isin(values), F.lit(False))
    rules = {
        "no_document": F.coalesce(F.col(doc).cast("string"), F.lit("")) == "",
        "span_out_of_bounds": span,
        "unknown_class": ~known("classificacao", CLASSES),
        "real_without_id": real & F.col("id_canonico").isNull(),
        "id_without_real": ~F.coalesce(real, F.lit(False)) & F.col("id_canonico").isNotNull(),
        "confidence_out_of_range": F.col("confianca").isNotNull() & (F.isnan("confianca") | ~F.col("confianca").between(0, 1)),
    }
    if {"text", "trecho"} <= set(citations.columns):
        rules["slice_differs"] = ~F.substr("text", F.col("inicio") + 1, F.col("fim") - F.col("inicio")).eqNullSafe(F.col("trecho"))
    if {"tipo", "natureza"} <= set(citations.columns):
        rules["unknown_kind"] = ~(known("tipo", KINDS) & known("natureza", NATURES))
    broken = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(rule)) for rule, bad in rules.items())))
    single = citations.select(doc, "citation", F.explode(broken).alias("rule"))
    return single.unionByName(duplicates(citations, doc).select(doc, "citation", F.lit("duplicate_span").alias("rule")))


def duplicates(citations: DataFrame, doc: str) -> DataFrame:
    """(doc, citation, _citation) of two spans of a document whose IoU is one half or more, the greater citation first.

    Such spans differ by a factor of two at most in width. The narrower starts a third of the wider's width before it at most and half
    of it behind; seen from the narrower, the wider starts at most the narrower's width before it. So a span is held at its power
    of two and its start in units of twice that, and asks at its own power and the one below in the few units of those starts: an
    equi-join whose rows follow the overlaps and not the square of a document's citations.
    """
    power = F.length(F.bin(F.col("fim") - F.col("inicio"))) - 1
    side = citations.where("fim > inicio").select(doc, "citation", F.struct("inicio", "fim").alias("s"), power.alias("k"))
    held = side.select(F.col(doc).alias("_doc"), F.col("citation").alias("_citation"), F.col("s").alias("_s"), F.col("k").alias("_k"), unit(F.col("s.inicio"), F.col("k")).alias("_at"))
    asked = asking(side)
    met = (F.col(doc) == F.col("_doc")) & (F.col("ask") == F.col("_k")) & (F.col("at") == F.col("_at"))
    once = (F.col("k") > F.col("_k")) | (F.col("citation") > F.col("_citation"))
    pairs = asked.join(held, met & once & (iou(F.col("s"), F.col("_s")) >= 0.5))
    return pairs.select(doc, F.greatest("citation", "_citation").alias("citation"), F.least("citation", "_citation").alias("_citation"))


def unit(place: Column, power: Column) -> Column:
    return F.floor(place / F.pow(F.lit(2.0), power + 1)).cast("long")


def asking(side: DataFrame) -> DataFrame:
    """A row for each power ``ask`` and unit ``at`` in which a span (``s``, of power ``k``) can have a duplicate."""
    width, start, ask = F.col("s.fim") - F.col("s.inicio"), F.col("s.inicio"), F.col("ask")
    rows = side.withColumn("ask", F.explode(F.filter(F.array(F.col("k"), F.col("k") - 1), lambda k: k >= 0)))
    first = start - F.when(ask == F.col("k"), width).otherwise(F.ceil(width / 3))
    return rows.withColumn("at", F.explode(F.sequence(unit(first, ask), unit(start + F.ceil(width / 2), ask))))


def sets_differ(wanted: DataFrame, have: DataFrame, key: str) -> DataFrame:
    """Keys that are wanted but missing, and keys that are there but stale."""
    wanted, have = wanted.select(key).distinct(), have.select(key).distinct()
    missing = wanted.join(have, key, "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(have.join(wanted, key, "left_anti").withColumn("problem", F.lit("stale")))
