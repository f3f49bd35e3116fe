"""From candidates to a verdict, a rule and a confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import exact_round

#: Rule, class and confidence of each decision, first match first.
DECISIONS = [
    ("ERRO_TECNICO", "incompleta", 0.35),
    ("MULTIPLOS_CANDIDATOS", "incompleta", 0.88),
    ("CANDIDATO_COM_CONFLITO", "incompleta", 0.75),
    ("UNICO_CONSISTENTE_EM_CONSULTA_PARCIAL", "real", 0.90),
    ("UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA", "real", 0.97),
    ("IDENTIDADE_SUFICIENTE_SEM_CANDIDATO", "inventada", 0.92),
    ("IDENTIDADE_INSUFICIENTE", "incompleta", 0.82),
]


def decision(candidates: Column, attempts: Column, sufficient: Column, error: Column, conflict: Column) -> Column:
    """struct(classificacao, regra, confianca, id_canonico)."""
    n = F.size(F.array_distinct(candidates))
    conditions = [error, n > 1, (n == 1) & conflict, (n == 1) & (attempts > 1), n == 1, sufficient, F.lit(True)]
    out = None
    for condition, (rule, verdict, confidence) in zip(conditions, DECISIONS):
        row = F.struct(F.lit(verdict).alias("classificacao"), F.lit(rule).alias("regra"), F.lit(confidence).alias("confianca"))
        condition = F.coalesce(condition, F.lit(False))
        out = F.when(condition, row) if out is None else out.when(condition, row)
    return out


def decide(rows: DataFrame) -> DataFrame:
    """``rows`` (candidates, attempts, sufficient; error and conflict if there are any) with the decision's columns."""
    flag = lambda c: F.col(c) if c in rows.columns else F.lit(False)
    out = rows.withColumn("_d", decision(F.col("candidates"), F.col("attempts"), F.col("sufficient"), flag("error"), flag("conflict")))
    single = F.when(F.col("_d.classificacao") == "real", F.element_at(F.array_distinct("candidates"), 1))
    return out.select(*rows.columns, "_d.classificacao", "_d.regra", F.col("_d.confianca").alias("confianca_decisao"), single.alias("id_canonico"))


def final_confidence(decided: Column, span: Column) -> Column:
    """0.85 of the decision's confidence and 0.15 of the span's, to 4 places."""
    return exact_round(F.lit(0.85) * decided + F.lit(0.15) * span, 4)
