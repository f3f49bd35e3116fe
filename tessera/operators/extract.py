"""Typed fields of a citation's text, as column expressions.

Each extractor takes the text of a mention and returns a struct. Text is folded
first; positions refer to the folded text and surfaces are cut from the original.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import catalog as C
from tessera.functions.spans import find_spans, first_span, hits_any, let, once, only, shifted, stable_unique
from tessera.functions.text import clean_article, compact_number, compact_space, digits, distance, four_digit_year, normalize_for_matching, normalize_value, ocr_digits, original_slice, output_form, overlaps, roman_values

NUMBER = "struct<value:string,start:int,end:int,score:int>"


def strings(*values: str) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def lookup(table: dict[str, str], key: Column) -> Column:
    pairs = ";".join(f"{k}={v}" for k, v in table.items())  # one foldable expression, whatever the table's size
    return F.try_element_at(F.str_to_map(F.lit(pairs), F.lit(";"), F.lit("=")), key)


def explicit_tribunals(text: Column, courts: list[str] | None = None) -> Column:
    """All courts that a text names."""
    return F.array_compact(F.array(*(F.when(text.rlike(f"(?U){p}"), F.lit(c)) for c, p in C.TRIBUNALS.items() if courts is None or c in courts)))


def tribunal_from_class(surface: Column) -> Column:
    """The court of a class: by phrases if they name one court, else by abbreviations if those do."""
    letters = F.regexp_replace(F.upper(surface), "[^A-Z]", "")
    phrases = only(F.array_compact(F.array(*(F.when(F.contains(letters, F.lit(p)), F.lit(c)) for p, c in C.PHRASE_TO_TRIBUNAL.items()))))
    words = F.regexp_extract_all(F.upper(surface), F.lit("[A-Z]+"), F.lit(0))
    tokens = only(F.array_compact(F.transform(words, lambda w: lookup(C.CLASS_TO_TRIBUNAL, w))))
    return F.coalesce(phrases, tokens)


def tribunal_from_cnj(number: Column) -> Column:
    """The court of a number with four points or more, by its segment."""
    segments = F.when(F.regexp_count(number, F.lit(r"\.")) >= 4, compact_number(number))
    out = F.lit(None).cast("string")
    for segment, court in reversed(C.SEGMENT_TO_TRIBUNAL.items()):
        out = F.when(segments.rlike(rf"\.{segment}\.\d{{2}}\."), court).otherwise(out)
    return out


def resolve_class(surface: Column, tribunal: Column) -> Column:
    """struct(normalized, candidates, ambiguous_keys): abbreviations written out.

    A class with several readings at the court has no normal form, but all
    combinations of readings as candidates.
    """
    text = normalize_value(surface)
    for pattern, replacement in C.CLASS_SUBSTITUTIONS:
        text = F.regexp_replace(text, f"(?U){pattern}", replacement)
    tokens = F.filter(F.split(output_form(text), " "), lambda t: t != "")
    court = F.upper(F.coalesce(tribunal, F.lit("")))

    def readings(token: Column) -> Column:
        out = F.array(F.coalesce(lookup(C.CLASS_EXPANSIONS, token), token))
        for key, (at_courts, everywhere) in C.AMBIGUOUS.items():
            options = strings(*everywhere)
            for pattern, reading in reversed(at_courts):
                options = F.when(court.rlike(pattern), strings(reading)).otherwise(options)
            out = F.when(token == key, options).otherwise(out)
        return F.struct(token.alias("token"), out.alias("options"))

    def written(groups: Column) -> Column:
        joined = F.aggregate(groups, strings(""), lambda acc, g: F.flatten(F.transform(acc, lambda a: F.transform(g["options"], lambda b: F.trim(F.concat_ws(" ", a, b))))))
        keys = F.array_distinct(F.transform(F.filter(groups, lambda g: F.size(g["options"]) > 1), lambda g: g["token"]))
        return F.struct(F.array_distinct(F.transform(joined, output_form)).alias("rendered"), keys.alias("keys"))

    return let(
        let(F.transform(tokens, readings), written),
        lambda x: F.struct(
            F.when((F.size(x["keys"]) == 0) & (F.element_at(x["rendered"], 1) != ""), F.element_at(x["rendered"], 1)).alias("normalized"),
            F.when(F.size(x["keys"]) > 0, x["rendered"]).otherwise(strings()).alias("candidates"),
            x["keys"].alias("ambiguous_keys"),
        ),
    )


def protected_dates(text: Column) -> Column:
    return F.concat(*(find_spans(text, p) for p in C.PROTECTED))


def number_candidates(text: Column, klass: Column, dates: Column) -> Column:
    """Case numbers in the order found, scored: one fold over seven forms, none overlapping a date or one accepted before."""
    based = lambda p, base: F.transform(find_spans(text, p), lambda s: F.struct(s["text"].alias("text"), s["start"].alias("start"), s["end"].alias("end"), F.lit(base).alias("base")))
    found = F.concat(*(based(p, base) for p, base in C.NUMBER_FORMS))

    def add(acc: Column, s: Column) -> Column:
        value = compact_number(s["text"])
        number = digits(value)
        year = (F.length(number) == 4) & number.try_cast("int").between(1800, 2099)
        before = F.substr(text, F.greatest(s["start"] - 12, F.lit(0)) + 1, s["start"] - F.greatest(s["start"] - 12, F.lit(0)))
        prefixed = before.rlike(C.NUMBER_PREFIX)
        near = distance(s["start"], s["end"], klass["start"], klass["end"])
        score = s["base"] + F.when(prefixed, 30).otherwise(0) + F.when(klass.isNotNull(), F.greatest(F.lit(0), 50 - near)).otherwise(0)
        far = klass.isNotNull() & (F.length(number) <= 4) & (near > 25) & ~prefixed
        unsafe = klass.isNull() & (s["base"] < 80)
        skip = hits_any(s, dates) | hits_any(s, acc) | (number == "") | year | F.coalesce(far, F.lit(False)) | unsafe
        return F.when(skip, acc).otherwise(F.array_append(acc, F.struct(value.alias("value"), s["start"].alias("start"), s["end"].alias("end"), score.cast("int").alias("score"))))

    return F.aggregate(found, F.array().cast(f"array<{NUMBER}>"), add)


def select_number(candidates: Column) -> Column:
    """The candidate of the highest score, then the earliest; null if the second has the same score and another value."""
    ranked = F.array_sort(F.transform(candidates, lambda c: F.struct((-c["score"]).alias("k"), c["start"].alias("start"), c["end"].alias("end"), c["value"].alias("value"))))

    def best(r: Column) -> Column:
        first, second = F.try_element_at(r, F.lit(1)), F.try_element_at(r, F.lit(2))
        return F.when(~F.coalesce((first["k"] == second["k"]) & (first["value"] != second["value"]), F.lit(False)), first)

    return let(ranked, best)


STATE_NAMES = rf"(?U)\b(?:{'|'.join(sorted(C.UF_NAMES.values(), key=len, reverse=True))})\b"
STATE_OF = {name: uf for uf, pattern in C.UF_NAMES.items() for name in ({"MINAS", "MINAS GERAIS"} if uf == "MG" else {pattern.replace(r"\s+", " ")})}
STATE_RANK = {name: str(list(C.UF_NAMES).index(uf)) for name, uf in STATE_OF.items()}


def lookup_rank(name: Column) -> Column:
    return lookup(STATE_RANK, name).cast("int")


def select_uf(text: Column, number: Column, klass: Column) -> Column:
    """The state nearest to the number; at equal scores the earlier, then the one first in the catalogue."""
    row = lambda uf, s, score, rank: F.struct((-score).alias("k"), s["start"].alias("start"), rank.alias("rank"), uf.alias("uf"))
    near = lambda s: distance(s["start"], s["end"], number["start"], number["end"])
    short = find_spans(text, rf"(?U)\b(?:{'|'.join(C.UFS)})\b")
    short = F.filter(short, lambda s: (near(s) <= 30) & ~F.coalesce(overlaps(s["start"], s["end"], klass["start"], klass["end"]), F.lit(False)))
    beside = lambda s: F.substr(text, F.greatest(s["start"] - 3, F.lit(0)) + 1, s["start"] - F.greatest(s["start"] - 3, F.lit(0))).rlike(r"(?U)[/\-\[(]\s*$")
    found = [F.transform(short, lambda s: row(s["text"], s, 50 - near(s) + F.when(beside(s), 20).otherwise(0), F.lit(-1)))]
    named = F.filter(find_spans(text, STATE_NAMES), lambda s: (near(s) <= 45) | s["text"].startswith("MATO"))
    state = lambda uf, s: row(lookup(STATE_OF, uf), s, 40 - near(s), lookup_rank(uf))

    def readings(s: Column) -> Column:
        """A name, and the shorter one that it begins with."""
        name = F.regexp_replace(s["text"], r"(?U)\s+", " ")
        short = F.regexp_replace(s["text"], r"(?U)\s+DO\s+SUL$", "")
        inner = F.struct(s["start"].alias("start"), (s["start"] + F.length(short)).alias("end"), short.alias("text"))
        both = F.array(state(name, s), F.when(name == "MATO GROSSO DO SUL", state(F.lit("MATO GROSSO"), inner)))
        return F.filter(F.array_compact(both), lambda x: x["k"] <= 5)

    found.append(F.flatten(F.transform(named, readings)))
    return F.when(number.isNotNull(), F.array_min(F.flatten(F.array_compact(F.array(*found))))["uf"])


def extract_year(text: Column, number: Column, dates: Column) -> Column:
    """The year of judgment, else the only year that is no part of a date, of the number, or of a publication."""
    stated = F.nullif(F.concat(F.regexp_extract(text, C.JUDGMENT_YEAR, 1), F.regexp_extract(text, C.JUDGMENT_YEAR, 2)), F.lit(""))
    before = lambda s: F.substr(text, F.greatest(s["start"] - 12, F.lit(0)) + 1, s["start"] - F.greatest(s["start"] - 12, F.lit(0)))
    free = F.filter(find_spans(text, C.ANY_YEAR), lambda s: ~F.coalesce(overlaps(s["start"], s["end"], number["start"], number["end"]), F.lit(False)) & ~hits_any(s, dates) & ~before(s).rlike(C.PUBLICATION))
    return F.coalesce(stated, only(F.transform(free, lambda s: s["text"]))).try_cast("int")


def extract_relator(norm: Column) -> Column:
    """The name after the first marker, as written: up to a stop or 90 characters, with a letter and at most 8 words."""
    text = norm["text"]

    def name(marker: Column) -> Column:
        tail = F.substr(text, marker["end"] + 1, F.length(text))
        end = let(tail, lambda t: F.coalesce(first_span(t, C.RELATOR_STOP)["start"], F.least(F.length(t), F.lit(90))))
        surface = let(marker["end"] + end, lambda e: F.regexp_replace(compact_space(original_slice(norm, marker["end"], e)), r"^[ ,;.\-–—]+|[ ,;.\-–—]+$", ""))
        return let(surface, lambda x: F.when(marker.isNotNull() & x.rlike(r"\p{L}") & (F.size(F.split(x, " ")) <= 8), x))

    return let(first_span(text, C.RELATOR_MARKER), name)


@once
def extract_acordao(trecho: Column | str, person: Column | None = None) -> Column:
    """A ruling: class, number, court, state, year, rapporteur. ``person`` is the only name a recogniser found, if there is one."""
    def fields(norm: Column, klass: Column, dates: Column, number: Column) -> Column:
        text = norm["text"]
        surface = F.regexp_replace(compact_space(original_slice(norm, klass["start"], klass["end"])), r"^[ ,;.\-–—]+|[ ,;.\-–—]+$", "")
        surface = F.when(klass.isNotNull(), F.trim(F.regexp_replace(surface, "(?i)^TST-", "")))
        court = let(
            explicit_tribunals(text),
            lambda named: F.when(F.size(named) == 1, F.element_at(named, 1)).when(F.size(named) == 0, F.coalesce(tribunal_from_cnj(number["value"]), tribunal_from_class(klass["text"]))),
        )

        def assembled(x: Column) -> Column:
            return let(
                resolve_class(x["surface"], x["court"]),
                lambda r: F.struct(
                    x["court"].alias("tribunal"),
                    x["surface"].alias("classe_processual"),
                    F.when(F.coalesce(x["surface"], F.lit("")) != "", r["normalized"]).alias("classe_processual_normalizada"),
                    F.when(F.coalesce(x["surface"], F.lit("")) != "", r["candidates"]).otherwise(strings()).alias("classe_normalizada_candidatos"),
                    number["value"].alias("numero"),
                    select_uf(text, number, klass).alias("uf"),
                    extract_year(text, number, dates).alias("ano"),
                    (extract_relator(norm) if person is None else F.coalesce(extract_relator(norm), compact_space(person))).alias("relator"),
                ),
            )

        return let(F.struct(surface.alias("surface"), court.alias("court")), assembled)

    number = lambda n, k, d: let(select_number(number_candidates(n["text"], k, d)), lambda x: fields(n, k, d, x))
    dated = lambda n, k: let(protected_dates(n["text"]), lambda d: number(n, k, d))
    return let(normalize_for_matching(trecho), lambda n: let(first_span(n["text"], C.CLASS_CHAIN), lambda k: dated(n, k)))


def diplomas(text: Column) -> Column:
    """Spans of statutes: struct(start, end, text) with the statute as text."""
    def which(surface: Column) -> Column:
        out = F.lit(None).cast("string")
        for d, patterns in C.DIPLOMA_NAMES.items():
            out = F.when(surface.rlike(f"(?U)^(?:{'|'.join(patterns)})$"), d).otherwise(out)
        return out

    every = "(?U)" + "|".join(p for patterns in C.DIPLOMA_NAMES.values() for p in patterns)
    named = F.transform(find_spans(text, every), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), which(s["text"]).alias("text")))
    bare = lambda s, p, k: digits(ocr_digits(F.regexp_extract(s, p, k)))
    by_year = F.transform(find_spans(text, C.LAW_IDENTITY), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), lookup(C.LAW_TO_DIPLOMA, F.concat_ws("/", bare(s["text"], C.LAW_IDENTITY, 1), four_digit_year(bare(s["text"], C.LAW_IDENTITY, 2)))).alias("text")))
    numbers = {k.partition("/")[0]: d for k, d in C.LAW_TO_DIPLOMA.items()}
    by_number = F.transform(find_spans(text, C.NAMED_LAW), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), lookup(numbers, bare(s["text"], C.NAMED_LAW, 1)).alias("text")))
    return F.filter(F.concat(named, by_year, by_number), lambda s: s["text"].isNotNull())


def paragraphs(region: Column) -> Column:
    """Paragraph numbers of a region, struct(start, end, text).

    After a singular sign the first number counts; after a plural one all up to a
    number over 20 or an article marker.
    """

    def after(marker: Column) -> Column:
        return let(F.substr(region, marker["end"] + 1, F.length(region)), lambda tail: numbered(marker, tail))

    def numbered(marker: Column, tail: Column) -> Column:
        plural = marker["text"].startswith("§§") | marker["text"].endswith("S")
        found = F.struct(find_spans(tail, r"(?U)\d{1,3}\s*(?:º|°|O)?").alias("n"), F.coalesce(first_span(tail, C.ARTICLE_MARKER)["start"] + 3, F.lit(1 << 30)).alias("article"))
        value = lambda n: F.regexp_extract(n["text"], r"^\d+", 0).try_cast("int")
        good = let(found, lambda x: let(F.array_position(F.transform(x["n"], lambda n: (x["article"] <= n["start"]) | (value(n) > 20)), F.lit(True)), lambda stop: F.when(stop > 0, F.slice(x["n"], F.lit(1), F.greatest(stop - 1, F.lit(0)).cast("int"))).otherwise(x["n"])))
        taken = let(good, lambda x: F.when(plural, x).otherwise(F.slice(x, 1, 1)))
        return F.transform(taken, lambda n: F.struct((marker["end"] + n["start"]).alias("start"), (marker["end"] + n["end"]).alias("end"), value(n).cast("string").alias("text")))

    return F.flatten(F.transform(find_spans(region, C.PARAGRAPH_MARKER), after))


def marked_articles(text: Column, protected: Column) -> Column:
    """Of each article marker with a number behind it: struct(values, start, end) of its region."""

    def at(marker: Column) -> Column:
        cut = lambda tail: let(first_span(tail, C.DIPLOMA_BOUNDARY), lambda c: F.when(c.isNotNull(), F.substr(tail, F.lit(1), c["start"])).otherwise(tail))
        region = let(F.substr(text, marker["end"] + 1, F.lit(180)), cut)
        return let(region, lambda r: let(F.nullif(F.regexp_extract(r, C.FIRST_ARTICLE, 1), F.lit("")), lambda first: listed(marker, r, first)))

    def listed(marker: Column, region: Column, first: Column) -> Column:
        own = F.struct(marker["end"].alias("start"), (marker["end"] + F.length(first)).alias("end"))
        more = F.filter(find_spans(region, C.NEXT_ARTICLE), lambda s: s["start"] >= F.length(first))
        more = F.transform(more, lambda s: let(F.regexp_extract(s["text"], C.NEXT_ARTICLE, 1), lambda v: F.struct((s["end"] - F.length(v)).alias("start"), s["end"].alias("end"), v.alias("text"))))
        more = let(paragraphs(region), lambda signs: F.filter(more, lambda s: ~hits_any(s, signs)))
        more = F.filter(shifted(more, marker["end"]), lambda s: ~hits_any(s, protected))
        values = F.concat(F.when(hits_any(own, protected), strings()).otherwise(F.array(clean_article(first))), F.transform(more, lambda s: clean_article(s["text"])))
        return F.when(first.isNotNull(), F.struct(values.alias("values"), marker["start"].alias("start"), (marker["end"] + F.length(region)).alias("end")))

    return F.array_compact(F.transform(find_spans(text, C.ARTICLE_MARKER), at))


def bare_articles(text: Column, statutes: Column) -> Column:
    """Numbers in the 120 characters before a statute, without a marker: struct(values, start, end)."""

    def before_statute(anchor: Column) -> Column:
        begin = F.greatest(anchor["start"] - 120, F.lit(0))
        prefix = F.substr(text, begin + 1, anchor["start"] - begin)
        numbers = shifted(find_spans(prefix, f"(?U){C.ARTICLE_VALUE}"), begin)

        def free(s: Column) -> Column:
            low = F.greatest(s["start"] - 18, F.lit(0))
            left = F.substr(text, low + 1, s["start"] - low)
            right = F.substr(text, s["end"] + 1, F.lit(20))
            return ~hits_any(s, statutes) & ~left.rlike(r"(?U)(?:§|PARAGRAFO|INCISO|ALINEA|LEI|DECRETO)\s*$|[/.-]\s*$") & ~right.rlike(r"(?U)^\s*[/.-]\s*\d")

        return let(
            F.filter(numbers, free),
            lambda kept: F.when(F.size(kept) > 0, F.struct(F.transform(kept, lambda s: clean_article(s["text"])).alias("values"), F.try_element_at(kept, F.lit(1))["start"].alias("start"), anchor["start"].alias("end"))),
        )

    return F.array_compact(F.transform(statutes, before_statute))


@once
def extract_dispositivo(trecho: Column | str) -> Column:
    """A provision: statute, articles, and the items, paragraphs and letters of their regions."""
    def found(text: Column, statutes: Column, statute: Column) -> Column:
        either = lambda marked: F.when(F.exists(marked, lambda r: F.size(r["values"]) > 0) | statute.isNull(), marked).otherwise(bare_articles(text, F.array_distinct(statutes)))
        return let(let(marked_articles(text, statutes), either), lambda regions: fields(text, statute, regions))

    def fields(text: Column, statute: Column, articles: Column) -> Column:
        regions = F.transform(articles, lambda r: F.substr(text, r["start"] + 1, r["end"] - r["start"]))
        groups = lambda r, p: F.regexp_extract_all(r, F.lit(p), F.lit(1))
        incisos = lambda r: F.concat(F.flatten(F.transform(groups(r, C.INCISO_EXPLICIT), roman_values)), groups(r, C.INCISO_CONTEXTUAL))
        unique = lambda r: F.transform(F.regexp_extract_all(r, F.lit(C.PARAGRAPH_UNIQUE), F.lit(0)), lambda t: F.when(F.regexp_replace(t, r"[.\s]", "") == "CAPUT", "CAPUT").otherwise("UNICO"))
        signs = lambda r: F.concat(F.transform(paragraphs(r), lambda s: s["text"]), unique(r))
        letters = lambda r: F.concat(F.flatten(F.transform(groups(r, C.ALINEA_EXPLICIT), lambda t: F.regexp_extract_all(t, F.lit(r"\b[A-Z]\b"), F.lit(0)))), F.transform(groups(r, C.ALINEA_PAREN), lambda t: F.lower(t)))
        each = lambda rs, f: stable_unique(F.flatten(F.transform(rs, lambda r: f(r))))
        return let(
            regions,
            lambda rs: F.struct(
                statute.alias("diploma"),
                stable_unique(F.flatten(F.transform(articles, lambda r: r["values"]))).alias("artigo"),
                each(rs, incisos).alias("inciso"),
                each(rs, signs).alias("paragrafo"),
                each(rs, letters).alias("alinea"),
            ),
        )

    one = lambda statutes: only(F.transform(statutes, lambda s: s["text"]))
    return let(normalize_value(trecho), lambda text: let(diplomas(text), lambda statutes: let(one(statutes), lambda statute: found(text, statutes, statute))))


@once
def extract_sumula(trecho: Column | str) -> Column:
    """Statements of precedent: court, numbers below 1800, and whether binding (then of the STF too)."""
    def fields(text: Column) -> Column:
        binding = text.rlike(r"(?U)\bVINCULANTE\b")
        courts = explicit_tribunals(text, C.SUMULA_TRIBUNALS)
        listed = F.coalesce(*(F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in (C.SUMULA_NUMBER_IN_ENUNCIADO, C.SUMULA_NUMBER_AFTER)))
        small = lambda xs: F.array_distinct(F.filter(F.transform(xs, lambda x: x.try_cast("int")), lambda x: x < 1800))
        bare = let(small(F.regexp_extract_all(text, F.lit(r"(?<!\d)\d{1,4}(?!\d)"), F.lit(0))), lambda x: F.when(F.size(x) == 1, x).otherwise(F.array().cast("array<int>")))
        numbers = let(listed, lambda x: F.when(x.isNotNull(), small(F.regexp_extract_all(x, F.lit(r"\d{1,4}"), F.lit(0)))).otherwise(bare))
        return F.struct(only(F.when(binding, F.array_append(courts, F.lit("STF"))).otherwise(courts)).alias("tribunal"), numbers.alias("numero"), binding.alias("vinculante"))

    return let(normalize_value(trecho), fields)


#: Label of a mention to (tipo, natureza).
LABELS = {"LEG": ("lei", "dispositivo"), "ACOR": ("jurisprudencia", "acordao"), "SUM": ("jurisprudencia", "sumula")}


def nature(label: Column) -> Column:
    """struct(tipo, natureza); an unknown label is an error."""
    out = F.raise_error(F.concat(F.lit("unknown label: "), F.coalesce(label, F.lit("null")))).cast("struct<tipo:string,natureza:string>")
    for name, (kind, natureza) in LABELS.items():
        out = F.when(label == name, F.struct(F.lit(kind).alias("tipo"), F.lit(natureza).alias("natureza"))).otherwise(out)
    return out


def extract_citation(trecho: Column | str, label: Column | str) -> Column:
    """struct(tipo, natureza, acordao, dispositivo, sumula), of which the one that fits the label is filled."""
    label = F.col(label) if isinstance(label, str) else label
    kind = nature(label)
    return F.struct(
        kind["tipo"].alias("tipo"),
        kind["natureza"].alias("natureza"),
        F.when(label == "ACOR", extract_acordao(trecho)).alias("acordao"),
        F.when(label == "LEG", extract_dispositivo(trecho)).alias("dispositivo"),
        F.when(label == "SUM", extract_sumula(trecho)).alias("sumula"),
    )
