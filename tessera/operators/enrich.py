"""Gaps of extracted fields filled from the text as written."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import catalog as C
from tessera.functions.spans import let, once
from tessera.functions.text import digits, fold, ocr_digits_wide
from tessera.operators.extract import lookup, resolve_class

# --- fixed values: surfaces of numbers and classes in text as written ---------------
_O = "[0-9OIlLSGg]"
#: The fourteen digits are counted one by one, with no digit between: else the ways to share a longer row out among them are tried one after another.
LONG_NUMBER = rf"(?U)(?<!\w)({_O}(?:[.\-\s]*{_O}){{13}}(?:[0-9OIlLSGg.\-\s]*{_O})?)(?!\w)"
GROUPED_NUMBER = rf"(?U)(?<!\w)({_O}{{1,3}}(?:\s*(?:[.]\s*|\s+){_O}{{3}}){{1,2}})(?!\w)"
MARKED_NUMBER = rf"(?iU)\bN\s*[.º°O]*\s*({_O}(?:[0-9OIlLSGg.\-\s]*{_O})?)"
CLASS_NUMBER = rf"(?iU)\b(?:RCL|RECL(?:AMA[CÇ][AÃ]O)?|RESP|ARESP|AGRESP|R[.]?ESP[.]?|AR|RE|TEMA)\s*(?:N\s*[.º°O]*\s*)?({_O}[0-9OIlLSGg.\-\s]*{_O})"
CLASS_PREFIX = r"(?iU)^\s*(?:(?:EDCL|ED|AGRG|AGINT|AGR|AG)\s+(?:NO|NA)\s+)*(?:R[.]?ESP[.]?|RESP|ARESP|AGRESP|RCL|RECL(?:AMA[CÇ][AÃ]O)?|AR|RE|RESPE|RSE|APL|RR|AIRR)"
SUMULA_NUMBER = r"(?iU)(?:S[UÚ]M(?:ULA)?|5[UÚ]M(?:U1A|ULA)?)\s*[.]?\s*(?:N\s*[.º°O]*)?\s*(\d+)"
SUMULA_COURT = r"(?iU)\b(?:DO|DA)\s+(STF|STJ|TST|TSE|STM)\b"
OTHER_LAW = r"(?iU)\bLEI\s+(COMPLEMENTAR\s+)?(?:N\s*[.º°O]*\s*)?([\d.]+)\s*/\s*(\d{2,4})"


def typed_number(text: Column) -> Column:
    """The first number of four forms, misread letters as digits: long, grouped, marked, behind a class."""
    group = lambda p: F.nullif(F.regexp_extract(text, p, 1), F.lit(""))
    read = lambda c: digits(ocr_digits_wide(c))
    long = F.when(F.length(read(group(LONG_NUMBER))) >= 14, read(group(LONG_NUMBER)))
    marked = F.regexp_replace(group(MARKED_NUMBER), r"(?U)\s*[-/(]\s*[A-Za-z]$", "")
    found = lambda c: F.when(c.isNotNull(), read(c))
    return F.coalesce(long, found(group(GROUPED_NUMBER)), found(marked), found(group(CLASS_NUMBER)))


def class_surface(text: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(text, CLASS_PREFIX, 0)), F.lit(""))


@once
def enrich_acordao(text: Column, a: Column) -> Column:
    """struct(data, warnings): a ruling with a longer number, class, state, court and theme where they were missing."""
    present = lambda c: F.coalesce(c.cast("string"), F.lit("")) != ""

    def with_number(recovered: Column) -> Column:
        current = digits(a["numero"])
        better = F.coalesce((F.length(recovered) >= 2) & ((current == "") | (F.length(recovered) > F.length(current))), F.lit(False))
        short = ~better & (current != "") & (F.length(current) < 2)
        number = F.when(better, recovered).when(short, F.lit(None).cast("string")).otherwise(a["numero"])
        return F.struct(number.alias("numero"), better.alias("better"), short.alias("short"))

    def with_class(n: Column) -> Column:
        surface = class_surface(text)
        klass = F.when(present(a["classe_processual"]), a["classe_processual"]).otherwise(surface)
        states = F.regexp_extract_all(text, F.lit(C.UF_RAW), F.lit(1))
        uf = F.when(present(a["uf"]), a["uf"]).otherwise(F.upper(F.try_element_at(states, F.lit(-1))))
        number = digits(n["numero"])
        court = F.when(present(a["tribunal"]), a["tribunal"]).when(F.length(number) == 20, lookup(C.SEGMENT_TO_TRIBUNAL, F.substring(number, -9, 1)))
        return F.struct(klass.alias("klass"), uf.alias("uf"), court.alias("court"), (~present(a["classe_processual"]) & surface.isNotNull()).alias("recovered"))

    def data(n: Column, k: Column) -> Column:
        theme = fold(text).rlike(r"(?U)\bTEMA\b") & ~present(k["klass"])
        normal = F.when(present(a["classe_processual_normalizada"]), a["classe_processual_normalizada"]).when(present(k["klass"]), resolve_class(k["klass"], a["tribunal"])["normalized"])
        fields = F.struct(
            k["court"].alias("tribunal"),
            F.when(theme, "TEMA DE REPERCUSSAO GERAL").otherwise(k["klass"]).alias("classe_processual"),
            F.when(theme, "TEMA DE REPERCUSSAO GERAL").otherwise(normal).alias("classe_processual_normalizada"),
            a["classe_normalizada_candidatos"].alias("classe_normalizada_candidatos"),
            n["numero"].alias("numero"),
            k["uf"].alias("uf"),
            a["ano"].alias("ano"),
            a["relator"].alias("relator"),
        )
        warnings = F.array_compact(
            F.array(
                F.when(n["better"], "numero_recuperado_por_normalizacao_contextual").when(n["short"], "numero_curto_descartado"),
                F.when(k["recovered"], "classe_recuperada_por_fallback"),
            )
        )
        return F.struct(fields.alias("data"), warnings.alias("warnings"))

    return let(let(typed_number(text), with_number), lambda n: let(with_class(n), lambda k: data(n, k)))


@once
def enrich_sumula(text: Column, s: Column) -> Column:
    number = F.nullif(F.regexp_extract(text, SUMULA_NUMBER, 1), F.lit("")).try_cast("int")
    court = F.nullif(F.upper(F.regexp_extract(text, SUMULA_COURT, 1)), F.lit(""))
    numbers = F.when(F.size(s["numero"]) > 0, s["numero"]).otherwise(F.array_compact(F.array(number)))
    return F.struct(F.struct(F.coalesce(s["tribunal"], court).alias("tribunal"), numbers.alias("numero"), s["vinculante"].alias("vinculante")).alias("data"), F.array().cast("array<string>").alias("warnings"))


@once
def enrich_dispositivo(text: Column, d: Column) -> Column:
    """A statute outside the catalogue by number and year."""
    number = F.nullif(F.regexp_extract(text, OTHER_LAW, 2), F.lit(""))
    law = F.concat(F.when(F.regexp_extract(text, OTHER_LAW, 1) != "", "LC:").otherwise("LEI:"), digits(number), F.lit("/"), F.regexp_extract(text, OTHER_LAW, 3))
    new = d["diploma"].isNull() & number.isNotNull()
    fields = F.struct(F.when(new, law).otherwise(d["diploma"]).alias("diploma"), *(d[c].alias(c) for c in ("artigo", "inciso", "paragrafo", "alinea")))
    return F.struct(fields.alias("data"), F.when(new, F.array(F.lit("diploma_fora_do_catalogo_conhecido"))).otherwise(F.array().cast("array<string>")).alias("warnings"))


def supported(natureza: Column, acordao: Column, sumula: Column, dispositivo: Column) -> Column:
    """Whether a mention says enough to be looked up; others are dropped and counted."""
    present = lambda c: F.coalesce(c.cast("string"), F.lit("")) != ""
    ruling = present(acordao["numero"]) | (present(acordao["tribunal"]) & (present(acordao["ano"]) | present(acordao["relator"]))) | (present(acordao["ano"]) & present(acordao["relator"]))
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    return F.when(natureza == "acordao", ruling).when(natureza == "sumula", some(sumula["numero"])).when(natureza == "dispositivo", some(dispositivo["artigo"])).otherwise(False)
