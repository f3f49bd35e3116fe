"""Candidate retrieval: keyed joins and the relaxation cascade.

The cascade tries all given filters, then drops rapporteur, year, class and state
in that order, each only if given; the court is never dropped. Plans only loosen,
so for each pair of mention and candidate there is a first plan that accepts it:
the greatest drop rank of its mismatching fields. One join and one minimum for
each mention replace the loop over plans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import class_key, contains_word, fold, name_matches
from tessera.sources.settle import settled, unsent

RELAXED = ["relator", "ano", "classe", "uf"]
NEVER = 1 << 20


def first_pass(present: dict[str, Column], matches: dict[str, Column], court_ok: Column) -> Column:
    """Rank of the first plan that accepts a pair, NEVER if the court differs."""
    rank, worst = F.lit(0), F.lit(0)
    for field in RELAXED:
        rank = rank + present[field].cast("int")
        worst = F.greatest(worst, F.when(present[field] & ~F.coalesce(matches[field], F.lit(False)), rank).otherwise(0))
    return F.when(F.coalesce(court_ok, F.lit(False)), worst).otherwise(NEVER)


def resolved(pairs: DataFrame, mention: str, candidate: str, plans: Column, given: Column | None = None, kept: Column | None = None) -> DataFrame:
    """One row per mention: attempts made and accepted candidates in order.

    ``pairs`` has ``first_pass`` (null where a mention has no pair); ``plans`` is
    the number of fields of the mention that can be dropped. With ``given``, the
    names of those fields in the order of dropping, and ``kept``, the names of the fields that every
    plan uses, also ``log`` (each plan's name, fields and ids) and ``confirmed`` (the fields of the last plan).

    In two phases: the least rank of each mention is taken before anything is shuffled but that rank; then only pairs of that
    rank meet, so a number that a tenth of all rows have costs what its accepted candidates are. Plans before the last accept nothing.
    """
    about = {"_plans": plans} | ({} if given is None else {"_given": given, "_kept": kept})
    pairs = settled(pairs.select(mention, candidate, "first_pass", *(c.alias(name) for name, c in about.items())), "pairs")
    chosen = pairs.groupBy(mention).agg(F.min("first_pass").alias("_chosen"), *(F.first(c).alias(c) for c in about))
    asked = chosen.where(F.col("_chosen") < NEVER).select(F.col(mention).alias("_m"), "_chosen")
    met = pairs.where(F.col("first_pass") < NEVER).join(unsent(asked), (F.col(mention) == F.col("_m")) & (F.col("first_pass") == F.col("_chosen")))
    ids = met.groupBy(mention).agg(F.array_sort(F.collect_list(candidate)).alias("_ids"))
    rows = chosen.join(unsent(ids), mention, "left").withColumn("_ids", F.coalesce("_ids", F.array().cast("array<long>")))
    last = F.when(F.col("_chosen") < NEVER, F.col("_chosen")).otherwise(F.col("_plans")).cast("int")
    accepted = lambda k: F.when(k == last, F.col("_ids")).otherwise(F.array().cast("array<long>"))
    out = [mention, (last + 1).cast("int").alias("attempts"), F.col("_ids").alias("candidates"), F.transform(F.sequence(F.lit(0), last), lambda k: F.size(accepted(k))).alias("counts")]
    if given is not None:
        fields = lambda k: F.concat("_kept", F.reverse(F.slice("_given", k + 1, F.size("_given"))))
        name = lambda k: F.when(k == 0, "acordao_completo").otherwise(F.concat(F.lit("acordao_sem_"), F.try_element_at("_given", k)))
        out.append(F.transform(F.sequence(F.lit(0), last), lambda k: F.struct(name(k).alias("plano"), fields(k).alias("campos"), accepted(k).alias("ids"))).alias("log"))
        out.append(fields(last).alias("confirmed"))
    return rows.select(*out)


def payload(found: DataFrame, documents: DataFrame) -> DataFrame:
    """mention_id and ``candidatos``: what the registry says of each candidate (found: mention_id, candidates, confirmed)."""
    each = found.select("mention_id", "confirmed", F.explode("candidates").alias("id_canonico")).join(unsent(documents.select("id_canonico", "documento_id", "natureza", "tribunal", "ano", "header_strategy")), "id_canonico")
    row = F.struct("id_canonico", F.col("documento_id").alias("documento_id_base"), "natureza", "tribunal", "ano", F.col("confirmed").alias("campos_confirmados"), F.struct(F.lit("cabecalho").alias("origem"), F.col("header_strategy").alias("estrategia")).alias("evidencia"))
    return each.groupBy("mention_id").agg(F.array_sort(F.collect_list(row)).alias("candidatos"))


def retrieve_acordao(mentions: DataFrame, keys: DataFrame, documents: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidates of rulings by number and the cascade.

    mentions: mention_id, numero (digits), tribunal, classe, uf, ano, relator.
    keys: id_canonico, numero_digitos, uf, cnj_ano; documents: id_canonico,
    tribunal, ano, relator_normalizado, header_normalized; classes: id_canonico,
    classe_normalizada.
    """
    by_id = classes.groupBy("id_canonico").agg(F.collect_set("classe_normalizada").alias("_classes"))
    rows = keys.select("id_canonico", F.col("numero_digitos").alias("numero"), F.col("uf").alias("_uf"), F.col("cnj_ano").alias("_cnj_ano")).distinct()
    rows = rows.join(unsent(documents.select("id_canonico", F.col("tribunal").alias("_tribunal"), F.col("ano").alias("_ano"), F.col("relator_normalizado").alias("_relator"), F.col("header_normalized").alias("_header"))), "id_canonico")
    rows = rows.join(unsent(by_id), "id_canonico", "left")
    pairs = mentions.join(unsent(rows), "numero", "left")
    present = {f: F.coalesce(F.col(f).cast("string"), F.lit("")) != "" for f in [*RELAXED, "tribunal"]}
    matches = {
        "relator": name_matches(F.col("_relator"), F.col("relator")),
        "ano": (F.col("ano") == F.col("_ano")) | F.coalesce(F.col("ano") == F.col("_cnj_ano"), F.lit(False)),
        "classe": F.array_contains("_classes", class_key("classe")),
        "uf": (F.upper("uf") == F.col("_uf")) | F.coalesce(contains_word(F.col("_header"), F.upper("uf")), F.lit(False)),
    }
    court = ~present["tribunal"] | (fold("tribunal") == fold("_tribunal"))
    pairs = pairs.withColumn("first_pass", F.when(F.col("id_canonico").isNotNull(), first_pass(present, matches, court)))
    given = F.array_compact(F.array(*(F.when(present[f], f) for f in RELAXED)))
    kept = F.array_compact(F.array(F.lit("numero"), F.when(present["tribunal"], "tribunal")))
    best = settled(pairs.groupBy("mention_id", "id_canonico").agg(F.min("first_pass").alias("first_pass"), F.first(sum((present[f].cast("int") for f in RELAXED), F.lit(0))).alias("_plans"), F.first("numero").alias("numero"), F.first(F.struct("tribunal", "classe", "uf")).alias("_m"), F.first(given).alias("_given"), F.first(kept).alias("_kept")), "pairs")
    out = resolved(best, "mention_id", "id_canonico", F.col("_plans"), F.col("_given"), F.col("_kept"))
    sufficient = best.groupBy("mention_id").agg(
        F.first((F.length("numero") == 20) | (F.coalesce("_m.tribunal", F.lit("")) != "") | (F.coalesce("_m.classe", F.lit("")) != "") | (F.coalesce("_m.uf", F.lit("")) != "")).alias("sufficient"),
        F.first(F.coalesce("numero", F.lit("")) != "").alias("searched"),
    )
    return out.join(unsent(sufficient), "mention_id").withColumn("sufficient", F.col("searched") & F.coalesce("sufficient", F.lit(False)))


def lookup_each(mentions: DataFrame, values: str, qualifier: str, keys: DataFrame, key: str, key_qualifier: str, kind: str = "consulta") -> DataFrame:
    """Statements of precedent and provisions: each value of a mention is looked up, with the qualifier if it is given, and the ids united.

    One row per mention: attempts (one for each value), candidates in order, whether
    the identity is sufficient (a qualifier and exactly one value), ``log`` with the ids of
    each value in order, and the fields ``confirmed``.
    """
    asked = mentions.select("mention_id", F.nullif(qualifier, F.lit("")).alias("_q"), F.size(F.coalesce(values, F.array().cast(mentions.schema[values].dataType))).alias("_n"), F.posexplode_outer(values).alias("_at", "_v"))
    held = keys.select(F.col(key).alias("_v"), F.col(key_qualifier).alias("_kq"), "id_canonico")
    found = asked.join(unsent(held), "_v", "left").withColumn("_id", F.when(F.col("_q").isNull() | (F.col("_q") == F.col("_kq")), F.col("id_canonico")))
    each = found.groupBy("mention_id", "_at").agg(F.first("_q").alias("_q"), F.first("_n").alias("_n"), F.first(F.col("_v").cast("string")).alias("_v"), F.array_sort(F.collect_set("_id")).alias("_ids"))
    plan = F.when(F.col("_q").isNotNull(), f"{kind}_{qualifier}_{key}").otherwise(f"{kind}_{key}")
    attempt = F.struct("_at", plan.alias("plano"), F.col("_v").alias("valor"), F.col("_ids").alias("ids"))
    fields = F.array_compact(F.array(F.lit(key), F.when(F.col("_q").isNotNull(), qualifier)))
    return each.groupBy("mention_id").agg(
        F.first("_n").cast("int").alias("attempts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_ids")))).alias("candidates"),
        F.first(F.col("_q").isNotNull() & (F.col("_n") == 1)).alias("sufficient"),
        F.first(F.col("_n") > 0).alias("searched"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_n") > 0, attempt))), lambda x: F.struct(x["plano"].alias("plano"), F.array(x["valor"]).alias("campos"), x["ids"].alias("ids"))).alias("log"),
        F.first(fields).alias("confirmed"),
    )
