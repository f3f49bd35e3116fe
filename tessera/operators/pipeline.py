"""From documents and an index to verified citations, with every failure as a row of its own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import compact_space, digits, level_of
from tessera.operators import errors as E
from tessera.operators.decide import decide, final_confidence
from tessera.operators.enrich import enrich_acordao, enrich_dispositivo, enrich_sumula, supported
from tessera.operators.evaluate import encode_cell
from tessera.operators.extract import LABELS, extract_acordao, extract_dispositivo, extract_sumula, resolve_class
from tessera.operators.recognise import with_person
from tessera.operators.retrieve import lookup_each, payload, retrieve_acordao
from tessera.sources.settle import dealt, settled, unsent

EXTRACTORS = {"acordao": (extract_acordao, enrich_acordao), "sumula": (extract_sumula, enrich_sumula), "dispositivo": (extract_dispositivo, enrich_dispositivo)}
#: What a mention with an unknown label counts as, and its confidence.
UNKNOWN, UNKNOWN_CONFIDENCE = ("jurisprudencia", "acordao"), 0.2


def extracted(mentions: DataFrame, keep: list[str], enriched: bool) -> DataFrame:
    """The ``keep`` columns of settled mentions with known labels (tipo, trecho), tipo_citacao, natureza, the fields of their nature and warnings.

    Each nature has its own branch of one union, so all run in one job and a task evaluates only the extractor of its rows.
    A rapporteur that the text does not name is the ``person`` that a recogniser found, if there is such a column.
    """
    parts = []
    for label, (kind, natureza) in LABELS.items():
        extract, enrich = EXTRACTORS[natureza]
        own = mentions.where(F.col("tipo") == label).withColumn("_x", extract("trecho"))
        if natureza == "acordao" and "person" in mentions.columns:
            own = own.withColumn("_x", F.col("_x").withField("relator", F.coalesce("_x.relator", compact_space("person"))))
        plain = F.struct(F.col("_x").alias("data"), F.array().cast("array<string>").alias("warnings"))
        own = own.withColumn("_e", enrich("trecho", "_x") if enriched else plain)
        parts.append(own.select(*keep, F.lit(kind).alias("tipo_citacao"), F.lit(natureza).alias("natureza"), F.col("_e.data").alias(natureza), F.col("_e.warnings").alias("warnings")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def typed(mentions: DataFrame, recognised: DataFrame | None = None) -> DataFrame:
    """Mentions with tipo_citacao, natureza and the enriched fields of their nature.

    Those that say too little have ``discarded`` set; one with an unknown label has an
    ``error`` with its ``mensagem`` and stops nothing else. ``recognised`` (documento_id, rotulo, inicio, fim, texto) are
    entities of a recogniser, whose only person inside a ruling is its rapporteur where the text names none.
    Mentions hold no document text; they are settled once, dealt evenly, and settled again with their fields.
    """
    keep = mentions.columns
    held = settled(dealt(mentions if recognised is None else with_person(mentions, recognised)), "mentions")
    rows = extracted(held, keep, enriched=True)
    unknown = held.where(~F.coalesce(F.col("tipo").isin(*LABELS), F.lit(False)))
    message = F.concat(F.lit("unknown label: "), F.coalesce("tipo", F.lit("null")))
    failed = unknown.select(*keep, F.lit(UNKNOWN[0]).alias("tipo_citacao"), F.lit(UNKNOWN[1]).alias("natureza"), F.array().cast("array<string>").alias("warnings"), F.lit("CITATION_PIPELINE_ERROR").alias("error"), message.alias("mensagem"))
    rows = rows.unionByName(failed, allowMissingColumns=True)
    says = supported(F.col("natureza"), F.col("acordao"), F.col("sumula"), F.col("dispositivo"))
    return settled(rows.withColumn("discarded", F.col("error").isNull() & ~F.coalesce(says, F.lit(False))), "typed")


def retrieved(mentions: DataFrame, index: dict[str, DataFrame]) -> DataFrame:
    """mention_id, attempts, candidates, sufficient, searched, log and confirmed of typed mentions, by nature.

    A class without a normal form is resolved again with the court that enrichment
    found; a binding statement without a court is one of the STF.
    """
    raw = F.nullif("acordao.classe_processual", F.lit(""))
    again = F.when(raw.isNotNull(), resolve_class(raw, F.col("acordao.tribunal"))["normalized"])
    rulings = mentions.where("natureza = 'acordao'").select(
        "mention_id",
        F.nullif(digits("acordao.numero"), F.lit("")).alias("numero"),
        "acordao.tribunal",
        F.coalesce("acordao.classe_processual_normalizada", again, raw).alias("classe"),
        "acordao.uf",
        "acordao.ano",
        "acordao.relator",
    )
    court = F.coalesce(F.nullif("sumula.tribunal", F.lit("")), F.when(F.col("sumula.vinculante"), "STF"))
    statements = mentions.where("natureza = 'sumula'").select("mention_id", "sumula.numero", court.alias("tribunal"))
    provisions = mentions.where("natureza = 'dispositivo'").select("mention_id", "dispositivo.artigo", F.upper("dispositivo.diploma").alias("diploma"))
    columns = ["mention_id", "attempts", "candidates", "sufficient", "searched", "log", "confirmed"]
    found = retrieve_acordao(rulings, index["acordao_key"], index["canonical_document"], index["acordao_class"]).select(*columns)
    found = found.unionByName(lookup_each(statements, "numero", "tribunal", index["sumula_key"], "numero", "tribunal", "sumula").select(*columns))
    return found.unionByName(lookup_each(provisions, "artigo", "diploma", index["dispositivo_key"], "artigo", "diploma", "dispositivo").select(*columns))


def judged(rows: DataFrame, index: dict[str, DataFrame]) -> DataFrame:
    """Typed mentions with verdict, rule, id, evidence of the candidates and final confidence; a failed one is undecided by ``ERRO_TECNICO``."""
    rows = rows.where("NOT discarded").withColumn("mention_id", F.concat_ws("#", "documento_id", "id"))
    found = settled(retrieved(rows.where("error IS NULL"), index), "retrieved")
    found = found.join(unsent(payload(found, index["canonical_document"])), "mention_id", "left")
    out = rows.withColumnRenamed("error", "_error").join(unsent(found), "mention_id", "left").withColumn("error", F.col("_error").isNotNull())
    out = out.withColumns({"attempts": F.coalesce("attempts", F.lit(0)), "candidates": F.coalesce("candidates", F.array().cast("array<long>")), "sufficient": F.coalesce("sufficient", F.lit(False)), "searched": F.coalesce("searched", F.lit(False))})
    out = decide(out)
    final = F.when(F.col("error"), UNKNOWN_CONFIDENCE).otherwise(final_confidence(F.col("confianca_decisao"), F.col("confianca")))
    return out.withColumn("confianca_final", final).drop("error").withColumnRenamed("_error", "error")


def verified(mentions: DataFrame, index: dict[str, DataFrame], recognised: DataFrame | None = None) -> DataFrame:
    """Supported mentions judged. ``mentions``: documento_id, id, tipo, inicio, fim, trecho, confianca."""
    return judged(typed(mentions, recognised), index)


def source_of(text: Column) -> Column:
    """struct(texto_len, sha256) of a document's text."""
    return F.struct(F.length(text).alias("texto_len"), F.sha2(text, 256).alias("sha256"))


def citation_json() -> Column:
    """A citation as a nested JSON record: where it stands, what was read, how it was looked up, and the verdict."""
    data = F.parse_json(F.coalesce(F.to_json("acordao"), F.to_json("sumula"), F.to_json("dispositivo"), F.lit("{}")))
    n = F.coalesce(F.size("candidates"), F.lit(0))
    status = F.when(F.col("error").isNotNull(), "erro_tecnico").when(~F.col("searched"), "consulta_nao_executada").when(n == 0, "nenhum_candidato").when(n == 1, "candidato_unico").otherwise("multiplos_candidatos")
    named = lambda **columns: F.struct(*(c.alias(k) for k, c in columns.items()))
    ambiguous = F.coalesce("acordao.classe_normalizada_candidatos", F.array().cast("array<string>"))
    return F.to_json(
        named(
            citacao_id=F.col("id"),
            inicio=F.col("inicio"),
            fim=F.col("fim"),
            trecho=F.col("trecho"),
            tipo=F.col("tipo_citacao"),
            natureza=F.col("natureza"),
            identificacao=named(rotulo_ner=F.col("tipo"), confianca=F.round("confianca", 6), span_ok=F.length("trecho") == F.col("fim") - F.col("inicio")),
            extracao=named(dados=data, campos_ambiguos=ambiguous, alertas=F.col("warnings")),
            recuperacao=named(executada=F.col("searched"), status=status, identidade_minima_suficiente=F.col("sufficient"), tentativas=F.col("log"), total_candidatos=n, candidatos=F.col("candidatos")),
            decisao=named(regra=F.col("regra")),
            classificacao=F.col("classificacao"),
            resolucao=F.when(F.col("id_canonico").isNotNull(), named(id_canonico=F.col("id_canonico").cast("long"))),
            confianca=F.col("confianca_final"),
            erros=F.coalesce("erros", F.array().cast(E.LIST)),
        )
    )


def document_json(citations: DataFrame, documents: DataFrame, discarded: DataFrame | None = None, errors: DataFrame | None = None, repairs: DataFrame | None = None) -> DataFrame:
    """One row per document (documento_id, text; null where it could not be read) with its citations as JSON, also where there are none.

    ``discarded``: the mentions (documento_id) that said too little; ``errors``: the error relation of documents and
    citations; ``repairs``: documento_id and ``reparos``, the labels repaired by the islands. Citations meet texts only as
    length and hash.
    """
    errors = E.of_citations(citations) if errors is None else errors
    own = E.listed(errors.where("citacao_id IS NOT NULL"), ["documento_id", "citacao_id"]).withColumnRenamed("citacao_id", "id")
    rows = citations.join(own, ["documento_id", "id"], "left")
    grouped = rows.groupBy("documento_id").agg(F.array_sort(F.collect_list(F.struct("inicio", "fim", "id", citation_json().alias("c")))).alias("x"), F.count("erros").alias("citacoes_com_erro"))
    out = documents.select("documento_id", source_of(F.col("text")).alias("fonte")).join(grouped, "documento_id", "left")
    counted = lambda df, c, name: df.groupBy("documento_id").agg(c.alias(name))
    out = out.join(counted(citations if discarded is None else discarded, F.count_if(F.lit(discarded is not None)), "_gone"), "documento_id", "left")
    out = out.join(counted(citations, F.lit(0), "_repairs") if repairs is None else counted(repairs, F.sum("reparos"), "_repairs"), "documento_id", "left")
    out = out.join(E.listed(errors, "documento_id").withColumnRenamed("erros", "_erros"), "documento_id", "left")
    listed = F.coalesce(F.transform("x", lambda x: x["c"]), F.array().cast("array<string>"))
    failed = F.exists(F.coalesce("_erros", F.array().cast(E.LIST)), lambda e: ~e["recuperavel"])
    whole = lambda c: F.when(~failed, F.coalesce(c, F.lit(0)))
    counts = F.struct(F.size(listed).alias("total_citacoes"), F.coalesce("_repairs", F.lit(0)).alias("reparos_bio"), whole("_gone").alias("entidades_descartadas"), whole("citacoes_com_erro").alias("citacoes_com_erro"))
    head = F.to_json(F.struct(F.lit("1.0").alias("schema_version"), "documento_id", level_of("documento_id").alias("nivel"), F.when(F.col("fonte.sha256").isNotNull(), F.col("fonte")).alias("fonte"), counts.alias("diagnostico"), F.coalesce("_erros", F.array().cast(E.LIST)).alias("erros")))
    record = F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(',"citacoes":['), F.array_join(listed, ","), F.lit("]}"))
    return out.select("documento_id", F.size(listed).alias("n_citacoes"), F.size(F.coalesce("_erros", F.array().cast(E.LIST))).alias("n_erros"), record.alias("json"))


def submission(citations: DataFrame, documents: DataFrame) -> DataFrame:
    """documento_id and its cell of citations."""
    spans = F.collect_list(F.struct("inicio", "fim", F.col("classificacao").alias("classe"), F.col("id_canonico").cast("long").alias("id_canonico"), F.col("confianca_final").alias("confianca")))
    cells = citations.groupBy("documento_id").agg(encode_cell(spans).alias("citacoes"))
    return documents.select("documento_id").join(unsent(cells), "documento_id", "left").select("documento_id", F.coalesce("citacoes", F.lit("-")).alias("citacoes"))


def document_counts(citations: DataFrame, documents: DataFrame, errors: DataFrame) -> DataFrame:
    """documento_id, citacoes and erros of every document: the summary's row for each."""
    counted = lambda df, name: df.groupBy("documento_id").agg(F.count("*").alias(name))
    out = documents.select("documento_id").join(counted(citations, "citacoes"), "documento_id", "left").join(counted(errors, "erros"), "documento_id", "left")
    return out.select("documento_id", F.coalesce("citacoes", F.lit(0)).alias("citacoes"), F.coalesce("erros", F.lit(0)).alias("erros"))


def run_summary(citations: DataFrame, documents: DataFrame, discarded: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row: documents, citations, discarded mentions, errors, and citations of each class."""
    counts = citations.agg(F.count("*").alias("citacoes"), *(F.count_if(F.col("classificacao") == c).alias(c) for c in ("real", "inventada", "incompleta")))
    wrong = (E.of_citations(citations) if errors is None else errors).agg(F.count("*").alias("erros"))
    return counts.crossJoin(documents.agg(F.count("*").alias("documentos"))).crossJoin(discarded.agg(F.count("*").alias("descartadas"))).crossJoin(wrong)
