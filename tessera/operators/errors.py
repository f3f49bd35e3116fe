"""Errors as a relation: one row for each thing that went wrong, beside the rows that did not.

Columns: documento_id, citacao_id (null for a whole document), etapa, codigo, mensagem, recuperavel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = ["documento_id", "citacao_id", "etapa", "codigo", "mensagem", "recuperavel"]
SCHEMA = "documento_id string, citacao_id string, etapa string, codigo string, mensagem string, recuperavel boolean"
LIST = "array<struct<etapa:string,codigo:string,mensagem:string,recuperavel:boolean,citacao_id:string>>"
#: Stage and whether a run goes on, by code.
CODES = {
    "DOCUMENT_READ_ERROR": ("leitura", False),
    "IDENTIFICATION_ERROR": ("identificacao", False),
    "CITATION_PIPELINE_ERROR": ("citacao", True),
    "EXTRACTION_ERROR": ("extracao", True),
    "RETRIEVAL_ERROR": ("recuperacao", True),
}


def none(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame([], SCHEMA)


def raised(rows: DataFrame, code: str, message: Column, citation: Column | None = None) -> DataFrame:
    """An error of ``code`` for each of ``rows`` (documento_id)."""
    stage, goes_on = CODES[code]
    return rows.select("documento_id", (F.lit(None).cast("string") if citation is None else citation).alias("citacao_id"), F.lit(stage).alias("etapa"), F.lit(code).alias("codigo"), message.alias("mensagem"), F.lit(goes_on).alias("recuperavel"))


def of_citations(citations: DataFrame) -> DataFrame:
    """The errors of judged citations (documento_id, id, tipo, error)."""
    failed = citations.where("error IS NOT NULL")
    stage = F.create_map(*(F.lit(x) for code, (stage, _) in CODES.items() for x in (code, stage)))
    goes_on = F.create_map(*(F.lit(x) for code, (_, on) in CODES.items() for x in (code, on)))
    return failed.select("documento_id", F.col("id").alias("citacao_id"), stage[F.col("error")].alias("etapa"), F.col("error").alias("codigo"), F.coalesce("mensagem", F.lit("")).alias("mensagem"), goes_on[F.col("error")].alias("recuperavel"))


def listed(errors: DataFrame, key: str | list[str]) -> DataFrame:
    """``erros`` of each key, in the order of their stages' texts, and how many they are."""
    entry = F.struct("etapa", "codigo", "mensagem", "recuperavel", "citacao_id")
    return errors.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("erros"))
