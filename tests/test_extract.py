"""Literal texts and the fields they must give."""

from __future__ import annotations

import pytest

from tessera.operators.enrich import enrich_dispositivo, typed_number
from tessera.operators.extract import extract_acordao, extract_dispositivo, extract_sumula, nature, resolve_class
from pyspark.sql import functions as F

ACORDAOS = {
    # court named, class, number, state in brackets
    "No julgamento dos embargos, o STJ manteve o REsp 318.204 (PR)": {"tribunal": "STJ", "classe_processual": "REsp", "classe_processual_normalizada": "RECURSO ESPECIAL", "numero": "318.204", "uf": "PR"},
    # court by the segment of a long number, a state's name
    "apelação 7100456-88.2019.7.00.0000, da Bahia": {"tribunal": "STM", "uf": "BA", "numero": "7100456-88.2019.7.00.0000"},
    # misread digits
    "MS I2.3O4, vindo de SE": {"numero": "12.304", "uf": "SE"},
    # a chain of classes, a rapporteur up to a stop, the only year
    "agravo interno na petição 5.120, sob a relatoria de Nunes Marques; 2022": {"classe_processual": "agravo interno na petição", "classe_processual_normalizada": "AGRAVO INTERNO NA PETICAO", "ano": 2022, "relator": "Nunes Marques"},
    # a date alone gives no year; an abbreviation with two readings has no normal form
    "decisão plenária de 14/05/2016 no RE 640.905": {"ano": None, "classe_processual_normalizada": None, "classe_normalizada_candidatos": ["RECURSO EXTRAORDINARIO", "RECURSO ELEITORAL"]},
    # without a known class no short number counts
    "inquérito 4.781 do STF": {"tribunal": "STF", "numero": None},
    # two courts are none
    "TST e STJ divergem no conflito de competência 150.333": {"tribunal": None, "numero": "150.333"},
    # the court's own prefix is no part of the class; a year after the ruling's word
    "TST-AIRR 10222-31.2016.5.03.0044, acórdão de 2018": {"tribunal": "TST", "classe_processual": "AIRR", "ano": 2018},
    # of two numbers the one nearer to the class
    "MI 708 e MI 712, STF": {"numero": "708"},
    # the shorter name at the same place comes first in the catalogue
    "Rcl 33.905 MATO GROSSO DO SUL": {"uf": "MT"},
    # a year of publication does not count beside one of judgment
    "publicado no DJe de 2017, o HC 140.200 foi julgado em 2015": {"ano": 2015},
    # nor does a month's year
    "em outubro de 2013, MS 31.700, Rel. Min. Luiz Fux, 2012": {"ano": 2012, "relator": "Luiz Fux"},
    "sem qualquer número": {"tribunal": None, "numero": None, "classe_processual": None, "relator": None},
    "": {"tribunal": None, "numero": None, "classe_processual": None, "relator": None},
}
DISPOSITIVOS = {
    # statute by name, by number and year, and without articles
    "o consumidor invoca o Código de Defesa do Consumidor, art. 6º": {"diploma": "CDC", "artigo": ["6"]},
    "a Lei nº 13.105/2015 trata disso no art. 85": {"diploma": "CPC", "artigo": ["85"]},
    "Código Penal apenas": {"artigo": []},
    # items stand between articles
    "ver arts. 3, III, 8 e 19, VI, todos da Lei 9.784/99": {"artigo": ["3", "8", "19"], "inciso": ["III", "VI"]},
    # bare numbers before a statute
    "são aplicáveis 389, 395 e 404 do Código Civil": {"diploma": "CC", "artigo": ["389", "395", "404"]},
    # a point is part of a number
    "pelo CPC, art. 1.022, parágrafo 1º": {"artigo": ["1.022"], "paragrafo": ["1"]},
    # numbers after a plural sign are paragraphs up to what is too large for one
    "do CPC os artigos 77, §§ 1º e 4º, 81 e 98": {"artigo": ["77", "81", "98"], "paragrafo": ["1", "4"]},
    'art. 5º, parágrafo único, inciso LIV, alínea "a", da Constituição Federal': {"diploma": "CF/88", "inciso": ["LIV"], "paragrafo": ["UNICO"], "alinea": ["A"]},
    # two statutes are none
    "art. 9º do CPC combinado com art. 421 do Código Civil": {"diploma": None, "artigo": ["9", "421"]},
}
SUMULAS = {
    "o TST editou as súmulas 85 e 437": {"tribunal": "TST", "numero": [85, 437], "vinculante": False},
    "Súmula Vinculante 10 foi afastada": {"tribunal": "STF", "numero": [10], "vinculante": True},
    "a 5úmu1a 7 do STJ impede o exame": {"tribunal": "STJ", "numero": [7]},
    "211/STJ": {"tribunal": "STJ", "numero": [211]},
    "súmula aprovada em 2009": {"tribunal": None, "numero": []},
}


@pytest.mark.parametrize(("cases", "extract"), [(ACORDAOS, extract_acordao), (DISPOSITIVOS, extract_dispositivo), (SUMULAS, extract_sumula)])
def test_literals(spark, cases, extract):
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", extract("t").alias("x")).collect()
    for r in rows:
        got = r["x"].asDict()
        assert {k: got[k] for k in cases[r["t"]]} == cases[r["t"]], r["t"]


def test_unknown_label_is_an_error(spark):
    with pytest.raises(Exception, match="unknown label"):
        spark.createDataFrame([("X",)], "t string").select(nature(F.col("t"))).collect()


def test_ambiguous_class_lists_all_readings(spark):
    row = spark.createDataFrame([("AgInt no RE", None), ("RE", "STF")], "c string, t string").select(resolve_class(F.col("c"), F.col("t")).alias("r")).collect()
    assert row[0]["r"]["normalized"] is None and row[0]["r"]["candidates"] == ["AGRAVO INTERNO NO RECURSO EXTRAORDINARIO", "AGRAVO INTERNO NO RECURSO ELEITORAL"]
    assert row[1]["r"]["normalized"] == "RECURSO EXTRAORDINARIO"


def test_enrichment(spark):
    rows = spark.createDataFrame([("Rcl n. 1O.234", 1), ("processo 0001234-56.2020.5.01.0001", 2), ("nada", 3)], "t string, k int")
    got = [r[0] for r in rows.orderBy("k").select(typed_number(F.col("t"))).collect()]
    assert got == ["10234", "00012345620205010001", None]
    law = spark.createDataFrame([("art. 3 da Lei Complementar nº 123/2006",)], "t string").select(enrich_dispositivo(F.col("t"), extract_dispositivo("t")).alias("e")).first()["e"]
    assert law["data"]["diploma"] == "LC:123/2006" and law["warnings"] == ["diploma_fora_do_catalogo_conhecido"]
