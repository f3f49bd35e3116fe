"""Mentions in documents: spans by rule and by model labels, repaired and relabelled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import catalog as C
from tessera.functions.spans import find_spans, once
from tessera.functions.text import overlaps

ENTITY = "struct<tipo:string,inicio:int,fim:int,confianca:double>"
RULE_CONFIDENCE = 0.995


@once
def rule_spans(text: Column, entities: Column) -> Column:
    """Entities with the rule spans: each match takes the place of what it overlaps and inherits the highest confidence there.

    Patterns apply one after another, so a later one takes the place of an earlier
    one's spans; within a document this is one fold over few spans.
    """
    found = F.concat(*(labelled(find_spans(text, pattern, long=True), label) for pattern, label in C.RULE_SPANS))

    def replace(acc: Column, s: Column) -> Column:
        hit = lambda e: overlaps(e["inicio"], e["fim"], s["inicio"], s["fim"])
        best = F.array_max(F.transform(F.filter(acc, hit), lambda e: e["confianca"]))
        new = F.struct(s["tipo"].alias("tipo"), s["inicio"].alias("inicio"), s["fim"].alias("fim"), F.coalesce(best, F.lit(RULE_CONFIDENCE)).alias("confianca"))
        return F.array_append(F.filter(acc, lambda e: ~hit(e)), new)

    return F.aggregate(found, entities.cast(f"array<{ENTITY}>"), replace)


def labelled(spans: Column, label: str) -> Column:
    return F.transform(spans, lambda s: F.struct(F.lit(label).alias("tipo"), s["start"].alias("inicio"), s["end"].alias("fim")))


def relabelled(tipo: Column, trecho: Column) -> Column:
    """Labels that the opening of a surface makes certain."""
    surface = F.regexp_replace(trecho, r"(?U)^\s+|\s+$", "")
    out = tipo
    for pattern, label in reversed(C.RELABELS):
        out = F.when(surface.rlike(pattern), label).otherwise(out)
    return out


def joined_neighbours(text: Column, entities: Column) -> Column:
    """Rulings (in text order) three characters apart or less, with nothing but numbers and capitals between, as one, in chains."""

    def step(acc: Column, e: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        gap = e["inicio"] - last["fim"]
        between = F.substr(text, last["fim"] + 1, F.greatest(e["fim"] - last["fim"], F.lit(0)))
        goes_on = F.coalesce((e["tipo"] == "ACOR") & (last["tipo"] == "ACOR") & gap.between(0, 3) & between.rlike(r"(?iU)^[A-Z\d.\-\s/]+$"), F.lit(False))
        whole = F.struct(last["tipo"].alias("tipo"), last["inicio"].alias("inicio"), e["fim"].alias("fim"), F.greatest(last["confianca"], e["confianca"]).alias("confianca"))
        return F.when(goes_on, F.array_append(F.slice(acc, F.lit(1), F.size(acc) - 1), whole)).otherwise(F.array_append(acc, e))

    return F.aggregate(entities, F.array().cast(f"array<{ENTITY}>"), step)


def identify(documents: DataFrame, entities: DataFrame | None = None, least: int = 4) -> DataFrame:
    """Mentions (documento_id, id, inicio, fim, tipo, confianca, trecho) of documents (documento_id, text).

    ``entities`` (documento_id, tipo, inicio, fim, confianca) are a model's spans.
    Surfaces of fewer than ``least`` characters are dropped. Entities meet their document as one array, and surfaces are cut
    before mentions become rows, so a text is read once and travels with none of them.
    """
    texts = documents.select("documento_id", "text")
    entity = lambda e: F.struct(e["tipo"].alias("tipo"), e["inicio"].alias("inicio"), e["fim"].alias("fim"), e["confianca"].alias("confianca"))
    if entities is not None:
        own = entities.groupBy("documento_id").agg(F.array_sort(F.collect_list(F.struct(*(F.col(c).cast(t).alias(c) for c, t in (("inicio", "int"), ("fim", "int"), ("tipo", "string"), ("confianca", "double")))))).alias("_e"))
        rows = texts.join(own, "documento_id", "left")
        held = joined_neighbours(F.col("text"), F.transform(F.coalesce("_e", F.array().cast("array<struct<inicio:int,fim:int,tipo:string,confianca:double>>")), entity))
    else:
        rows, held = texts, F.array().cast(f"array<{ENTITY}>")
    cut = lambda e: F.substr("text", e["inicio"] + 1, e["fim"] - e["inicio"])
    row = lambda e: F.struct(*(e[c].alias(c) for c in ("inicio", "fim", "tipo", "confianca")), cut(e).alias("trecho"))
    kept = F.filter(F.transform(rule_spans("text", "_held"), row), lambda e: F.length(F.regexp_replace(e["trecho"], r"(?U)^\s+|\s+$", "")) >= least)
    out = rows.select("documento_id", "text", held.alias("_held")).select("documento_id", F.array_sort(kept).alias("_s")).select("documento_id", F.posexplode("_s").alias("_n", "e"))
    return out.select("documento_id", F.concat(F.lit("c"), (F.col("_n") + 1).cast("string")).alias("id"), "e.inicio", "e.fim", relabelled(F.col("e.tipo"), F.col("e.trecho")).alias("tipo"), "e.confianca", "e.trecho")
