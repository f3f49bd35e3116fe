"""Entities of a name recogniser, joined to the mentions that contain them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labels of persons.
PERSONS = ["PERSON", "PER", "PESSOA"]
BIN = 256  # characters


def inside(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """(documento_id, id, inicio, fim, rotulo, texto) of entities that lie wholly inside a mention.

    An interval join by bins of positions: an entity is in the bin of its start alone, a mention in every bin that it
    touches, so a pair meets once and a long document is many keys.
    """
    last = F.greatest(F.col("fim") - 1, F.col("inicio"))
    bins = F.sequence(F.floor(F.col("inicio") / BIN), F.floor(last / BIN))
    held = mentions.where("inicio IS NOT NULL AND fim IS NOT NULL").select("documento_id", "id", F.col("inicio").alias("_from"), F.col("fim").alias("_to"), F.explode(bins).alias("_bin"))
    found = entities.select("documento_id", "rotulo", "inicio", "fim", "texto", F.floor(F.col("inicio") / BIN).alias("_bin"))
    pairs = held.join(found, ["documento_id", "_bin"]).where("inicio >= _from AND fim <= _to")
    return pairs.select("documento_id", "id", "inicio", "fim", "rotulo", "texto")


def with_person(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """``mentions`` with ``person``, the text of the one entity inside that is a person; null where there is none or more than one."""
    people = inside(mentions, entities.where(F.upper("rotulo").isin(PERSONS)))
    only = people.groupBy("documento_id", "id").agg(F.count("*").alias("_n"), F.min("texto").alias("person")).where("_n = 1")
    return mentions.join(only.select("documento_id", "id", "person"), ["documento_id", "id"], "left").select(*mentions.columns, "person")
