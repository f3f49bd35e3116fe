"""Envelopes of identified citations, extracted citation by citation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.extract import LABELS
from tessera.operators.pipeline import extracted
from tessera.operators.recognise import with_person
from tessera.sources.settle import dealt, settled

WANTED = ["documento_id", "text", "citacoes"]


def or_error(value: Column, wrong: Column, message: Column) -> Column:
    return F.when(F.coalesce(wrong, F.lit(False)), F.raise_error(message).cast("string")).otherwise(value)


def opened(envelopes: DataFrame) -> DataFrame:
    """documento_id, posicao, id, tipo, trecho (and inicio, fim if they are there) of each citation of envelopes (documento_id, text, citacoes).

    A citation without an id is ``c`` and its place, from 1. A missing column is an error at once; a null field of an envelope, and a missing
    or unknown field of a citation, are errors that name the place.
    """
    for c in WANTED:
        if c not in envelopes.columns:
            raise ValueError(f"missing field of the document: {c}")
    fields = envelopes.schema["citacoes"].dataType.elementType.fieldNames()
    of = lambda name: F.col(f"c.{name}") if name in fields else F.lit(None)
    rows = envelopes
    for c in WANTED[1:]:
        message = F.concat(F.lit("missing field of document "), F.coalesce("documento_id", F.lit("?")), F.lit(f": {c}"))
        rows = rows.withColumn("documento_id", or_error(F.col("documento_id"), F.col(c).isNull(), message))
    rows = rows.withColumn("documento_id", or_error(F.col("documento_id"), F.col("documento_id").isNull(), F.lit("missing field of the document: documento_id")))
    rows = rows.select("documento_id", F.posexplode("citacoes").alias("_n", "c"))
    place = F.concat(F.lit("citation "), (F.col("_n") + 1).cast("string"), F.lit(" of "), F.col("documento_id"))
    rows = rows.select("documento_id", "_n", *(of(name).cast(kind).alias(name) for name, kind in (("id", "string"), ("tipo", "string"), ("trecho", "string"), ("inicio", "int"), ("fim", "int"))), place.alias("_place"))
    for c in ("trecho", "tipo"):
        rows = rows.withColumn(c, or_error(F.col(c), F.col(c).isNull(), F.concat(F.lit("missing field of "), F.col("_place"), F.lit(f": {c}"))))
    rows = rows.withColumn("tipo", or_error(F.col("tipo"), ~F.col("tipo").isin(*LABELS), F.concat(F.lit("unknown label of "), F.col("_place"), F.lit(": "), F.col("tipo"))))
    return rows.select("documento_id", (F.col("_n") + 1).alias("posicao"), F.coalesce("id", F.concat(F.lit("c"), (F.col("_n") + 1).cast("string"))).alias("id"), "tipo", "trecho", "inicio", "fim")


def extract_document(envelopes: DataFrame, recognised: DataFrame | None = None) -> DataFrame:
    """One row per citation of ``envelopes``: documento_id, posicao, id, trecho, tipo_citacao, natureza and the fields of its nature.

    ``recognised`` (documento_id, rotulo, inicio, fim, texto) are a recogniser's entities, whose places are those of the text.
    """
    rows = opened(envelopes)
    held = settled(dealt(rows if recognised is None else with_person(rows, recognised)), "envelopes")
    return extracted(held, ["documento_id", "posicao", "id", "trecho"], enriched=False).drop("warnings")


def enveloped(citations: DataFrame, envelopes: DataFrame) -> DataFrame:
    """The envelopes (documento_id, text) with their extracted citations as an array in their order, empty where there are none."""
    fields = ["posicao", "id", "trecho", "tipo_citacao", "natureza", "acordao", "sumula", "dispositivo"]
    grouped = citations.groupBy("documento_id").agg(F.array_sort(F.collect_list(F.struct(*fields)), lambda a, b: a["posicao"] - b["posicao"]).alias("citacoes"))
    out = envelopes.select("documento_id", "text").join(grouped, "documento_id", "left")
    return out.withColumn("citacoes", F.coalesce("citacoes", F.array().cast(grouped.schema["citacoes"].dataType)))
