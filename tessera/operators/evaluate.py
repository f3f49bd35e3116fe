"""Evaluation: parsing of cells, one-to-one matching, scores."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.spans import greedy, let
from tessera.functions.text import norm_id

CLASSES = ["real", "inventada", "incompleta"]
WEIGHTS = {1: 1.0, 2: 2.0}
BONUS, SEVERE = 0.10, 0.5
#: A confidence as text; a cast alone would also take suffixes such as 0.5f.
DECIMAL = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"


def encode_cell(spans: Column) -> Column:
    """Structs (inicio, fim, classe, id_canonico, confianca) as one cell: fields by commas, spans by bars, ``-`` for what is absent."""
    part = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(
            ",",
            s["inicio"].cast("string"),
            s["fim"].cast("string"),
            s["classe"],
            F.when(F.coalesce(s["id_canonico"], F.lit(0)) == 0, "-").otherwise(s["id_canonico"].cast("string")),
            F.when(s["confianca"].isNotNull(), F.format_string("%.4f", s["confianca"])).otherwise("-"),
        ),
    )
    return F.when(F.size(spans) > 0, F.array_join(part, "|")).otherwise("-")


def blocks(cell: Column) -> Column:
    """Fields of each part of a cell, trimmed; an empty cell or ``-`` has none, and empty parts do not count."""
    whole = F.trim(F.coalesce(cell, F.lit("")))
    parts = F.filter(F.transform(F.split(whole, r"\|"), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(whole.isin("", "-"), F.array().cast("array<array<string>>")).otherwise(F.transform(parts, lambda p: F.transform(F.split(p, ","), lambda x: F.trim(x))))


def refused(spans: Column, clash: Callable[[Column, Column], Column]) -> Column:
    """``spans`` with ``error`` set also where one clashes with one before it."""
    return F.transform(spans, lambda x, i: x.withField("error", x["error"] | F.exists(F.slice(spans, 1, i), lambda y: F.coalesce(clash(x, y), F.lit(False)))))


def parse_prediction(cell: Column) -> Column:
    """Spans of a submission cell, with ``error`` where a part is malformed or repeats an earlier span (IoU of one half or more).

    Classes count in either case; an empty confidence or id is absent like ``-``; only a real citation needs an id, of digits.
    """
    item = lambda f, i: F.try_element_at(f, F.lit(i))
    absent = lambda c: F.coalesce(c, F.lit("")).isin("", "-")

    def row(f: Column) -> Column:
        start, end, classe = item(f, 1).try_cast("int"), item(f, 2).try_cast("int"), F.lower(item(f, 3))
        conf = F.when(item(f, 5).rlike(DECIMAL), item(f, 5).try_cast("double"))
        bad = (F.size(f) != 5) | start.isNull() | end.isNull() | (start < 0) | (end <= start) | ~classe.isin(CLASSES)
        bad = bad | ((classe == "real") & ~F.coalesce(item(f, 4).rlike("^[0-9]+$"), F.lit(False)))
        bad = bad | (~absent(item(f, 5)) & (conf.isNull() | ~conf.between(0, 1)))
        return F.struct(start.alias("inicio"), end.alias("fim"), classe.alias("classe"), F.when(~absent(item(f, 4)), norm_id(item(f, 4))).alias("id"), conf.alias("confianca"), F.coalesce(bad, F.lit(True)).alias("error"))

    return let(F.transform(blocks(cell), row), lambda spans: refused(spans, lambda x, y: iou(x, y) >= 0.5))


def parse_solution(cell: Column) -> Column:
    """Spans of a solution cell; ids are joined by colons, those empty or ``-`` absent.

    ``error``: no numbers, an unknown class, a real one without ids, or an overlap with one before.
    """
    item = lambda f, i: F.try_element_at(f, F.lit(i))

    def row(f: Column) -> Column:
        classe = F.lower(item(f, 3))
        given = F.filter(F.transform(F.split(F.coalesce(item(f, 4), F.lit("")), ":"), lambda x: F.trim(x)), lambda x: ~x.isin("", "-"))
        ids = F.transform(given, norm_id)
        bad = item(f, 1).try_cast("int").isNull() | item(f, 2).try_cast("int").isNull() | item(f, 4).isNull() | ~classe.isin(CLASSES) | ((classe == "real") & (F.size(ids) == 0))
        return F.struct(item(f, 1).try_cast("int").alias("inicio"), item(f, 2).try_cast("int").alias("fim"), classe.alias("classe"), ids.alias("ids"), F.coalesce(bad, F.lit(True)).alias("error"))

    return let(F.transform(blocks(cell), row), lambda spans: refused(spans, lambda x, y: intersection(x, y) > 0))


def intersection(a: Column, b: Column) -> Column:
    return F.greatest(F.least(a["fim"], b["fim"]) - F.greatest(a["inicio"], b["inicio"]), F.lit(0))


def iou(a: Column, b: Column) -> Column:
    both = intersection(a, b)
    return F.try_divide(both, (a["fim"] - a["inicio"]) + (b["fim"] - b["inicio"]) - both)


def by_document(gold: DataFrame, predicted: DataFrame, doc: str) -> DataFrame:
    """One row per document: nivel (if there is one), golds and preds, arrays of struct(i, s) in order of i."""
    level = [F.first("nivel").alias("nivel")] if "nivel" in gold.columns else []
    side = lambda df, i, s, name: df.groupBy(doc).agg(*level, F.array_sort(F.collect_list(F.struct(F.col(i).alias("i"), F.col(s).alias("s")))).alias(name))
    g, p = side(gold, "gi", "g", "golds"), side(predicted, "pi", "p", "preds")
    if level:
        p = p.withColumnRenamed("nivel", "_nivel")
    out = g.join(p, doc, "full")
    empty = lambda c: F.coalesce(c, F.array().cast(out.schema[c].dataType)).alias(c)
    return out.select(doc, *([F.coalesce("nivel", "_nivel").alias("nivel")] if level else []), empty("golds"), empty("preds"))


def matched_spans(golds: Column, preds: Column) -> Column:
    """One-to-one matches of spans with IoU of one half or more: struct(k, gi, pi), ``k`` the negative IoU.

    Pairs are taken in the order of (-iou, gi, pi), each if neither side is taken; gold
    spans are disjoint, so a document has few pairs and two of one prediction only at one half.
    """
    pairs = F.flatten(F.transform(golds, lambda g: F.filter(F.transform(preds, lambda p: F.struct((-iou(g["s"], p["s"])).alias("k"), g["i"].alias("gi"), p["i"].alias("pi"))), lambda x: x["k"] <= -0.5)))
    return greedy(F.array_sort(pairs), "struct<k:double,gi:int,pi:int>", lambda kept, x: (kept["gi"] == x["gi"]) | (kept["pi"] == x["pi"]))


def document_matches(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_m", matched_spans(F.col("golds"), F.col("preds")))


def matched(gold: DataFrame, predicted: DataFrame, doc: str) -> DataFrame:
    """One-to-one matches (doc, gi, pi, iou). gold: doc, gi, g (struct with inicio, fim); predicted: doc, pi, p."""
    rows = document_matches(by_document(gold, predicted, doc))
    return rows.select(doc, F.explode("_m").alias("m")).select(doc, "m.gi", "m.pi", (-F.col("m.k")).alias("iou"))


def spare(docs: DataFrame) -> tuple[Column, Column]:
    """Predictions of a document without a match: those that count as false, and those with nine tenths of their width inside a matched gold span, which do not."""
    taken = F.filter("golds", lambda g: F.exists("_m", lambda m: m["gi"] == g["i"]))
    loose = F.filter("preds", lambda p: ~F.exists("_m", lambda m: m["pi"] == p["i"]))
    within = lambda p: F.exists(taken, lambda g: (p["s"]["fim"] > p["s"]["inicio"]) & (intersection(p["s"], g["s"]) >= 0.9 * (p["s"]["fim"] - p["s"]["inicio"])))
    return F.filter(loose, lambda p: ~within(p)), F.filter(loose, within)


def contained(gold: DataFrame, predicted: DataFrame, doc: str) -> DataFrame:
    """(doc, pi) of unmatched predictions inside a matched gold span."""
    rows = document_matches(by_document(gold, predicted, doc))
    return rows.select(doc, F.explode(spare(rows)[1]).alias("x")).select(doc, F.col("x.i").alias("pi"))


def outcomes(docs: DataFrame) -> DataFrame:
    """One row per counted event: nivel, classe, and tp, fp, fn, support, severe, inventada, squared error and its count.

    docs: nivel, golds and preds. A match is right if the classes agree and, for real
    ones, the id is among the gold ids. A match of other classes is a false positive
    of one and a miss of the other; a real one with a wrong id is a false positive only.
    """
    rows = document_matches(docs)
    event = lambda classe, **n: F.struct(classe.alias("classe"), *(n.get(k, F.lit(0)).cast("double").alias(k) for k in MEASURES))
    invented = lambda g: (g["classe"] == "inventada").cast("int")

    def both(m: Column) -> Column:
        g = F.filter("golds", lambda x: x["i"] == m["gi"])[0]["s"]
        p = F.filter("preds", lambda x: x["i"] == m["pi"])[0]["s"]
        return F.struct(g.alias("g"), p.alias("p"))

    def hit(x: Column) -> Column:
        g, p = x["g"], x["p"]
        right = F.coalesce((g["classe"] == p["classe"]) & ((g["classe"] != "real") | F.array_contains(g["ids"], p["id"])), F.lit(False))
        error = F.when(p["confianca"].isNotNull(), F.pow(p["confianca"] - right.cast("double"), F.lit(2))).otherwise(0.0)
        severe = ((g["classe"] == "inventada") & (p["classe"] == "real")).cast("int")
        return F.array(
            event(g["classe"], tp=right.cast("int"), fn=(g["classe"] != p["classe"]).cast("int"), support=F.lit(1), severe=severe, invented=invented(g), squared=error, judged=p["confianca"].isNotNull().cast("int")),
            event(p["classe"], fp=(~right).cast("int")),
        )

    missed = F.filter("golds", lambda g: ~F.exists("_m", lambda m: m["gi"] == g["i"]))
    every = F.concat(
        F.flatten(F.transform(F.transform("_m", both), hit)),
        F.transform(missed, lambda g: event(g["s"]["classe"], fn=F.lit(1), support=F.lit(1), invented=invented(g["s"]))),
        F.transform(spare(rows)[0], lambda p: event(p["s"]["classe"], fp=F.lit(1))),
    )
    return rows.select("nivel", F.explode(every).alias("e")).select("nivel", "e.*")


MEASURES = ["tp", "fp", "fn", "support", "severe", "invented", "squared", "judged"]


def confusion(events: DataFrame) -> DataFrame:
    return events.groupBy("nivel", "classe").agg(*(F.sum(m).alias(m) for m in MEASURES))


def level_scores(counts: DataFrame) -> DataFrame:
    """Of each level: macro-F1 over classes with support, rate of severe errors, Brier score, bonus and score."""
    total = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    f1 = F.when(total > 0, 2 * F.col("tp") / total).otherwise(0.0)
    out = counts.groupBy("nivel").agg(
        F.avg(F.when(F.col("support") > 0, f1)).alias("macro_f1"),
        F.coalesce(F.sum("severe") / F.nullif(F.sum("invented"), F.lit(0.0)), F.lit(0.0)).alias("severe_rate"),
        (F.sum("squared") / F.nullif(F.sum("judged"), F.lit(0.0))).alias("brier"),
        F.sum("support").alias("support"),
    )
    bonus = F.when(F.col("brier").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(BONUS), BONUS * (1 - F.col("brier"))))).otherwise(0.0)
    base = F.col("macro_f1") * (1 - SEVERE * F.col("severe_rate"))
    return out.where("support > 0").withColumn("bonus", bonus).withColumn("score", base * (1 + F.col("bonus")))


def weighted_score(levels: DataFrame) -> DataFrame:
    """One row: the levels' scores by their weights; an error if there is no level."""
    weight = F.coalesce(F.create_map(*(F.lit(x) for pair in WEIGHTS.items() for x in pair))[F.col("nivel")], F.lit(1.0))
    total = levels.agg(F.sum(weight * F.col("score")).alias("s"), F.sum(weight).alias("w"))
    return total.select(F.when(F.col("w") > 0, F.col("s") / F.col("w")).otherwise(F.raise_error(F.lit("no level has a citation"))).alias("score"))


def first_rows(rows: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """Of repeated rows the first, by an explicit input order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def missing(solution: DataFrame, submission: DataFrame, key: str) -> DataFrame:
    return solution.select(key).distinct().join(submission.select(key), key, "left_anti")


def parsed_cells(solution: DataFrame, submission: DataFrame, order: str) -> DataFrame:
    """documento_id, nivel, golds, preds and ``problem`` (why a document cannot be scored, else null) of every solution row."""
    doc = "documento_id"
    sent = first_rows(submission, doc, order).select(doc, F.col("citacoes").alias("_sent"), F.lit(True).alias("_there"))
    rows = solution.select(doc, "nivel", parse_solution(F.col("citacoes")).alias("_g"), "citacoes").join(sent, doc, "left").withColumn("_p", parse_prediction(F.col("_sent")))
    broken = lambda c: F.exists(c, lambda x: x["error"])
    problem = F.when(F.col("_there").isNull(), "document not sent").when(broken(F.col("_g")), "malformed solution").when(broken(F.col("_p")), "malformed citation")
    numbered = lambda c: F.transform(c, lambda x, i: F.struct(i.alias("i"), x.alias("s")))
    return rows.select(doc, "nivel", numbered("_g").alias("golds"), numbered("_p").alias("preds"), problem.alias("problem"))


def cell_errors(solution: DataFrame, submission: DataFrame, order: str) -> DataFrame:
    """(documento_id, problem) of the documents that cannot be scored."""
    return parsed_cells(solution, submission, order).where("problem IS NOT NULL").select("documento_id", "problem")


def score(solution: DataFrame, submission: DataFrame, order: str) -> DataFrame:
    """The metric of a submission (documento_id, citacoes, an order column) against a solution (documento_id, nivel, citacoes); an error if any document cannot be scored."""
    rows = parsed_cells(solution, submission, order)
    fail = F.raise_error(F.concat_ws(": ", "problem", "documento_id")).cast("int")
    rows = rows.withColumn("nivel", F.when(F.col("problem").isNotNull(), fail).otherwise(F.col("nivel")))
    return weighted_score(level_scores(confusion(outcomes(rows))))
