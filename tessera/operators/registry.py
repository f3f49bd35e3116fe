"""The canonical index: identifying headers, numbers, classes and keys of each registry row.

Only the header is read for identity, since the body cites other rulings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import catalog as C
from tessera.functions.spans import find_spans, first_span, let, once
from tessera.functions.text import class_key, digits, fold
from tessera.sources.settle import dealt, settled

SCHEMA_VERSION, BUILDER_VERSION = "1", "1.0.0"
RECORD = "struct<number_digits:string,number_type:string,is_primary:boolean>"


@once
def header_slice(text: Column, tribunal: Column) -> Column:
    """struct(start, end, strategy) of the region that identifies a ruling."""
    n = F.length(text)
    row = lambda s, e, name: F.struct(F.greatest(s, F.lit(0)).cast("int").alias("start"), F.least(e, n).cast("int").alias("end"), name.alias("strategy"))
    labour = lambda pattern: F.when(tribunal == "TST", first_span(text, pattern))
    opening = F.substring(text, 1, 3000)
    marker = F.when(~tribunal.isin("TST", *C.HEADER_MARKERS), first_span(opening, C.EMENTA))
    for court, pattern in C.HEADER_MARKERS.items():
        marker = F.when(tribunal == court, first_span(opening, pattern)).otherwise(marker)

    def chosen(x: Column) -> Column:
        tst = (
            F.when(x["target"].isNotNull(), row(x["target"]["start"] - 180, x["target"]["end"] + 220, F.lit("tst_recurso_numero")))
            .when(x["code"].isNotNull(), row(x["code"]["start"] - 260, x["code"]["end"] + 220, F.lit("tst_codigo_processo")))
            .when(x["anywhere"].isNotNull(), row(x["anywhere"]["start"] - 200, x["anywhere"]["end"] + 100, F.lit("tst_fallback")))
            .otherwise(row(F.lit(0), F.lit(2000), F.lit("tst_limite_fallback")))
        )
        end = let(F.substr(text, x["marker"]["end"] + 1, F.lit(180)), lambda tail: x["marker"]["end"] + F.coalesce(first_span(tail, C.HEADER_STOP)["start"], F.least(F.length(tail), F.lit(120))))
        to_relator = row(F.lit(0), end, F.concat(F.lower(tribunal), F.lit("_ate_relator")))
        fallback = row(F.lit(0), F.coalesce(first_span(opening, C.EMENTA)["start"], F.lit(1200)), F.concat(F.lower(tribunal), F.lit("_fallback")))
        return F.when(tribunal == "TST", tst).when(x["marker"].isNotNull(), to_relator).otherwise(fallback)

    found = F.struct(labour(C.TST_TARGET_RAW).alias("target"), labour(C.TST_CODE_RAW).alias("code"), labour(C.TST_ANY_RAW).alias("anywhere"), marker.alias("marker"))
    return let(found, chosen)


@once
def number_records(header: Column, tribunal: Column) -> Column:
    """Distinct numbers of a header in order: struct(number_digits, number_type, is_primary).

    A fold adds candidates one by one; a candidate is primary always, never, or
    only if it is the first to be added.
    """
    one = lambda value, kind, primary: F.struct(digits(value).alias("d"), F.lit(kind).alias("kind"), primary.alias("primary"))
    group = lambda text, pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    labour = tribunal.isin("TST", "TSE", "STM")
    tst = F.when(tribunal == "TST", F.coalesce(group(header, C.TST_TARGET_RAW), group(header, C.TST_CODE_RAW)))
    cnj = F.transform(F.regexp_extract_all(header, F.lit(C.CNJ_RAW), F.lit(0)), lambda x, i: one(x, "cnj", F.when(labour & (i == 0), "yes").otherwise("no")))
    tails = F.when(labour, F.transform(find_spans(header, C.NUMBER_MARKER_RAW), lambda s: F.regexp_extract(F.substr(header, s["end"] + 1, F.lit(75)), r"^\d(?:[\d.\-\s]*\d)", 0)))
    scanned = F.coalesce(F.transform(F.filter(tails, lambda x: F.length(digits(x)) >= 14), lambda x: one(x, "cnj", F.lit("first"))), F.array().cast("array<struct<d:string,kind:string,primary:string>>"))
    labelled = F.transform(
        F.regexp_extract_all(header, F.lit(C.LABELLED_RAW), F.lit(0)),
        lambda x, i: one(F.regexp_extract(x, r"(\d{1,3}(?:\s*\.\s*\d{3})+|\d{2,8})$", 1), "traditional", F.when(i == 0, "first").otherwise("no")),
    )
    stf = F.when(tribunal == "STF", one(group(header, C.STF_NUMBER_RAW), "traditional", F.lit("alone")))
    state = F.when(tribunal == "STF", group(fold(header), C.STATE_NUMBER))

    def add(acc: Column, x: Column) -> Column:
        empty = F.size(acc) == 0
        skip = F.exists(acc, lambda y: y["number_digits"] == x["d"]) | ((x["primary"] == "alone") & ~empty)
        new = F.struct(x["d"].alias("number_digits"), x["kind"].alias("number_type"), ((x["primary"] == "yes") | (x["primary"].isin("first", "alone") & empty)).alias("is_primary"))
        return F.when(skip, acc).otherwise(F.array_append(acc, new))

    marked = lambda records, f: F.transform(records, lambda x, i: F.struct(x["number_digits"].alias("number_digits"), x["number_type"].alias("number_type"), f(x, i).alias("is_primary")))

    def finished(x: Column, records: Column) -> Column:
        by_state = marked(records, lambda r, i: r["number_digits"] == digits(x["state"]))
        return F.when(F.length(digits(x["state"])) >= 2, by_state).when(F.exists(records, lambda r: r["is_primary"]), records).otherwise(marked(records, lambda r, i: i == 0))

    def folded(x: Column) -> Column:
        last = F.array(F.when(x["state"].isNotNull(), one(x["state"], "traditional", F.lit("yes"))))
        every = F.concat(F.array(F.when(x["tst"].isNotNull(), one(x["tst"], "cnj", F.lit("yes")))), cnj, scanned, labelled, F.array(stf), last)
        kept = F.filter(F.array_compact(every), lambda c: F.length(c["d"]) >= 2)
        return let(F.aggregate(kept, F.array().cast(f"array<{RECORD}>"), add), lambda records: finished(x, records))

    return let(F.struct(tst.alias("tst"), state.alias("state")), folded)


def cnj_parts(number: Column, kind: Column) -> Column:
    """struct(cnj_ano, cnj_segmento, cnj_regiao), null unless the number has 20 digits or more.

    Their places, counted from the end, are fixed values of the index format.
    """
    full = (kind == "cnj") & (F.length(number) >= 20)
    return F.struct(
        F.when(full, F.substring(number, -13, 4).try_cast("int")).alias("cnj_ano"),
        F.when(full, F.substring(number, -9, 1).try_cast("int")).alias("cnj_segmento"),
        F.when(full, F.substring(number, -8, 2)).alias("cnj_regiao"),
    )


def infer_uf(header: Column, tribunal: Column, region: Column) -> Column:
    regions = F.create_map(*(F.lit(x) for pair in C.REGION_TO_UF.items() for x in pair))
    return F.coalesce(F.nullif(F.regexp_extract(fold(header), C.UF_IN_HEADER, 1), F.lit("")), F.when(tribunal == "TST", F.try_element_at(regions, region)))


def dictionary_classes(headers: DataFrame, entries: DataFrame, most: int = 8) -> DataFrame:
    """Classes of a dictionary whose surface stands in a header, of its first ``most`` hits.

    headers: id_canonico, header (as ``class_key`` writes it), tribunal; entries:
    surface_key, tribunal (null for any), classe. In such text a surface with no
    letter or digit beside it is a run of whole words, so the words of a header are
    joined to runs of each length the dictionary has, and runs meet surfaces in an
    equi-join. Hits are ordered by place, then longest surface, then class.
    """
    lengths = [r[0] for r in entries.where("surface_key != ''").select(F.size(F.split("surface_key", " ")).alias("n")).distinct().orderBy("n").collect()]
    words = headers.select("id_canonico", F.col("tribunal").alias("_court"), F.split("header", " ").alias("w"))
    at = lambda n: F.when(F.size("w") >= n, F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.struct(i.alias("at"), F.array_join(F.slice("w", i, n), " ").alias("surface_key"))))
    runs = F.flatten(F.array_compact(F.array(*(at(n) for n in lengths)))) if lengths else F.array().cast("array<struct<at:int,surface_key:string>>")
    runs = words.select("id_canonico", "_court", F.explode(runs).alias("r")).groupBy("id_canonico", "_court", "r.surface_key").agg(F.min("r.at").alias("at"))
    hits = runs.join(F.broadcast(entries), "surface_key").where(F.col("tribunal").isNull() | (F.col("tribunal") == F.col("_court")))
    ranked = hits.groupBy("id_canonico").agg(F.slice(F.array_sort(F.collect_set(F.struct("at", (-F.length("surface_key")).alias("k"), "classe"))), 1, most).alias("hits"))
    return ranked.select("id_canonico", F.array_distinct(F.transform("hits", lambda x: x["classe"])).alias("classes"))


def class_entries(dictionary: DataFrame) -> DataFrame:
    """Rows of the dictionary file (surface, entries array of tribunal and classe_normalizada) as join entries."""
    rows = dictionary.select(class_key("surface").alias("surface_key"), F.explode("entries").alias("e"))
    return rows.select("surface_key", "e.tribunal", class_key("e.classe_normalizada").alias("classe")).where("surface_key != '' AND classe != ''").distinct()


def headers(registry: DataFrame) -> DataFrame:
    """Registry rows with the places and the text of their header (``trecho``) instead of their body.

    Of a statement the first 500 characters count; of a provision its first line does as well.
    """
    ruling = F.col("natureza") == "acordao"
    whole = F.struct(F.lit(0).alias("start"), F.least(F.length("texto"), F.lit(500)).alias("end"), F.lit("documento").alias("strategy"))
    rows = registry.withColumn("_court", F.coalesce("tribunal", F.lit(""))).withColumn("_cut", F.when(ruling, header_slice("texto", "_court")).otherwise(whole))
    first_line = F.when(F.col("natureza") == "dispositivo", F.regexp_extract("texto", r"^\s*([^\n]*)", 1))
    cut = F.substr("texto", F.col("_cut.start") + 1, F.col("_cut.end") - F.col("_cut.start"))
    return rows.select(F.col("id").alias("id_canonico"), "documento_id", "natureza", "tribunal", "ano", "relator", "_cut", cut.alias("header_raw"), first_line.alias("first_line"))


def fields_of(rows: DataFrame) -> DataFrame:
    """What the headers say, all natures in one job: ``r`` and ``a`` of rulings, ``s`` of statements, ``diploma`` and ``artigo`` of provisions."""
    from tessera.operators.extract import extract_acordao, extract_dispositivo, extract_sumula

    own = lambda natureza, trecho: rows.where(F.col("natureza") == natureza).select("id_canonico", "natureza", "tribunal", "header_raw", F.col(trecho).alias("trecho"))
    rulings = own("acordao", "header_raw").withColumn("court", F.coalesce("tribunal", F.lit(""))).withColumn("r", number_records("header_raw", "court")).withColumn("a", extract_acordao("trecho")).drop("court")
    statements = own("sumula", "header_raw").withColumn("s", extract_sumula("trecho"))
    folded = fold("trecho")
    number = F.nullif(F.regexp_extract(folded, r"\bARTIGO\s+([0-9.]+(?:-[A-Z])?)", 1), F.lit(""))
    law64 = folded.rlike(r"LEI\s+COMPLEMENTAR.*\b64\b|\bLC\s*64\b")
    provisions = own("dispositivo", "first_line").select("*", law64.alias("law64"), number.alias("number"), extract_dispositivo("trecho").alias("d"))
    provisions = provisions.withColumn("diploma", F.when(F.col("law64"), "LC64/90").otherwise(F.col("d.diploma"))).withColumn("artigo", F.coalesce(F.regexp_replace("number", r"\.$", ""), F.try_element_at("d.artigo", F.lit(1)))).drop("law64", "number", "d")
    return rulings.unionByName(statements, allowMissingColumns=True).unionByName(provisions, allowMissingColumns=True).drop("trecho")


def build_index(registry: DataFrame, entries: DataFrame) -> dict[str, DataFrame]:
    """The tables of the index.

    registry: id, documento_id, tribunal, ano, relator, natureza, tipo, texto. Bodies are read once, for the headers; all else starts from those.
    """
    rows = settled(dealt(headers(registry)), "headers")
    fields = settled(fields_of(rows), "fields")
    rulings, statements, provisions = (fields.where(F.col("natureza") == n) for n in ("acordao", "sumula", "dispositivo"))
    exploded = rulings.select("id_canonico", "tribunal", "header_raw", F.explode("r").alias("r"))
    parts = exploded.withColumn("_p", cnj_parts(F.col("r.number_digits"), F.col("r.number_type")))
    own = rulings.select("id_canonico", F.explode(F.array_compact(F.concat(F.array("a.classe_processual_normalizada"), "a.classe_normalizada_candidatos"))).alias("classe_normalizada"))
    listed = dictionary_classes(rulings.select("id_canonico", class_key("header_raw").alias("header"), "tribunal"), entries).select("id_canonico", F.explode("classes").alias("classe_normalizada"))
    good_statement = (F.size("s.numero") == 1) & F.col("s.tribunal").isNotNull()
    good_provision = F.col("diploma").isNotNull() & F.col("artigo").isNotNull()
    warn = lambda df, code: df.select("id_canonico", F.lit(code).alias("codigo"), F.lit(None).cast("string").alias("detalhes"))
    return {
        "canonical_document": rows.select(
            "id_canonico",
            "documento_id",
            "natureza",
            "tribunal",
            "ano",
            fold("relator").alias("relator_normalizado"),
            F.col("_cut.start").alias("header_start"),
            F.col("_cut.end").alias("header_end"),
            F.col("_cut.strategy").alias("header_strategy"),
            "header_raw",
            fold("header_raw").alias("header_normalized"),
        ),
        "acordao_key": parts.select(
            "id_canonico",
            F.col("r.number_digits").alias("numero_digitos"),
            F.col("r.number_type").alias("numero_tipo"),
            F.col("r.is_primary").alias("principal"),
            infer_uf(F.col("header_raw"), F.col("tribunal"), F.col("_p.cnj_regiao")).alias("uf"),
            "_p.cnj_ano",
            "_p.cnj_segmento",
            "_p.cnj_regiao",
        ),
        "acordao_class": own.unionByName(listed).select("id_canonico", class_key("classe_normalizada").alias("classe_normalizada")).distinct(),
        "sumula_key": statements.where(good_statement).select("id_canonico", "s.tribunal", F.element_at("s.numero", 1).alias("numero"), "s.vinculante"),
        "dispositivo_key": provisions.where(good_provision).select("id_canonico", "diploma", "artigo"),
        "index_warning": warn(rulings.where(F.size("r") == 0), "NO_CASE_NUMBER").unionByName(warn(statements.where(~F.coalesce(good_statement, F.lit(False))), "SUMULA_PARSE_FAILED")).unionByName(warn(provisions.where(~good_provision), "DISPOSITIVO_PARSE_FAILED")),
    }


def index_metadata(index: dict[str, DataFrame], source_sha256: str) -> DataFrame:
    spark = index["canonical_document"].sparkSession
    fixed = spark.createDataFrame([("schema_version", SCHEMA_VERSION), ("builder_version", BUILDER_VERSION), ("source_sha256", source_sha256)], "key string, value string")
    return fixed.unionByName(index["index_warning"].agg(F.lit("warnings").alias("key"), F.count("*").cast("string").alias("value")))
