"""Driver queries: matching, scores, contract checks and cells, on line items as spans of orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import evaluate as E
from tessera.operators.contract import sets_differ, violations
from tessera.plans.resolve import load
from tessera.sources.settle import settled

KINDS = ["real", "inventada", "incompleta"]


def kind(number) -> object:
    return F.element_at(F.array(*map(F.lit, KINDS)), (number % 3 + 1).cast("int"))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One span for each order and line number, 60 to 89 wide, a hundred apart."""
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supp"))
    start = F.col("l_linenumber") * 100
    span = F.struct(start.alias("inicio"), (start + 60 + F.col("part") % 30).cast("int").alias("fim"), kind(F.col("part")).alias("classe"), F.array((F.col("part") % 50).cast("string"), F.lit("7")).alias("ids"))
    return lines.select(F.col("l_orderkey").alias("doc"), (1 + F.col("l_orderkey") % 2).cast("int").alias("nivel"), F.col("l_linenumber").alias("gi"), span.alias("g"))


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same spans moved, narrowed, reclassified or left out by part and supplier; a second, narrow one inside some."""
    lines = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("part"), F.min("l_suppkey").alias("supp"))
    start = (F.col("l_linenumber") * 100 + F.col("supp") % 23).cast("int")
    wide = F.struct(start.alias("inicio"), (start + 40 + F.col("part") % 37).cast("int").alias("fim"), kind(F.col("part") + (F.col("supp") % 5 == 0).cast("int")).alias("classe"), (F.col("part") % 51).cast("string").alias("id"), F.when(F.col("supp") % 3 != 0, (F.col("part") % 16) / 16).alias("confianca"))
    first = lines.where("supp % 7 != 0").select(F.col("l_orderkey").alias("doc"), (1 + F.col("l_orderkey") % 2).cast("int").alias("nivel"), (F.col("l_linenumber") * 2).alias("pi"), wide.alias("p"))
    at = (F.col("l_linenumber") * 100 + 5).cast("int")
    narrow = F.struct(at.alias("inicio"), (at + 8).cast("int").alias("fim"), F.lit("incompleta").alias("classe"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("double").alias("confianca"))
    second = lines.where("part % 4 = 0").select(F.col("l_orderkey").alias("doc"), (1 + F.col("l_orderkey") % 2).cast("int").alias("nivel"), (F.col("l_linenumber") * 2 + 1).alias("pi"), narrow.alias("p"))
    return first.unionByName(second)


def span_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = E.matched(gold(spark, sf_dir), predicted(spark, sf_dir), "doc")
    return found.select("doc", "gi", "pi", F.round("iou", 6).alias("iou"))


def extra_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.contained(gold(spark, sf_dir), predicted(spark, sf_dir), "doc")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confusion(E.outcomes(E.by_document(gold(spark, sf_dir), predicted(spark, sf_dir), "doc")))


def metric_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).select("nivel", "classe", *(F.col(c).cast("long").alias(c) for c in E.MEASURES if c != "squared"), F.round("squared", 6).alias("squared"))


def metric_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of each level, and of all as level 0; the levels are one row for each, kept while the total is taken."""
    levels = settled(E.level_scores(counts(spark, sf_dir)))
    whole = E.weighted_score(levels).select(F.lit(0).alias("nivel"), "score")
    return levels.select("nivel", "score").unionByName(whole).select("nivel", F.round("score", 6).alias("score"))


def cells(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Cells of gold and predicted spans: every seventh class in capitals, some confidences empty."""
    g = gold(spark, sf_dir).groupBy("doc", "nivel").agg(F.array_sort(F.collect_list(F.struct("gi", "g"))).alias("x"))
    shout = lambda c, k: F.when(k % 7 == 0, F.upper(c)).otherwise(c)
    g = g.select(F.col("doc").cast("string").alias("documento_id"), "nivel", F.array_join(F.transform("x", lambda x: F.concat_ws(",", x["g"]["inicio"].cast("string"), x["g"]["fim"].cast("string"), shout(x["g"]["classe"], x["gi"]), F.array_join(x["g"]["ids"], ":"))), "|").alias("citacoes"))
    p = predicted(spark, sf_dir).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pi", "p"))).alias("x"))
    said = lambda x: F.concat_ws(",", x["p"]["inicio"].cast("string"), x["p"]["fim"].cast("string"), shout(x["p"]["classe"], x["pi"]), F.coalesce(x["p"]["id"], F.lit("-")), F.coalesce(x["p"]["confianca"].cast("string"), F.lit("")))
    p = p.select(F.col("doc").cast("string").alias("documento_id"), F.array_join(F.transform("x", said), "|").alias("citacoes"), F.lit(1).alias("n"))
    return g, g.select("documento_id", F.lit("-").alias("citacoes"), F.lit(2).alias("n")).unionByName(p)


def cell_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric from cells; a second row of a document does not count."""
    return E.score(*cells(spark, sf_dir), "n").select(F.round("score", 6).alias("score"))


def cell_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells spoilt by the document's number: why each cannot be scored."""
    g, p = cells(spark, sf_dir)
    k = F.col("documento_id").cast("long")
    first = lambda c: F.substring_index(c, "|", 1)
    spoilt = F.when(k % 9 == 1, F.concat_ws("|", first("citacoes"), first("citacoes"))).when(k % 9 == 2, "5,3,real,1,-").when(k % 9 == 3, "1,3,real,x,-").when(k % 9 == 4, "1,3,real,7,1.5").when(k % 9 == 5, "1,3,Inventada,x,").otherwise(F.lit("-"))
    gold_cell = F.when(k % 9 == 6, F.concat_ws("|", first("citacoes"), first("citacoes"))).when(k % 9 == 7, "1,3,real,-:").otherwise(F.col("citacoes"))
    return E.cell_errors(g.withColumn("citacoes", gold_cell), p.where(k % 9 != 8).withColumn("citacoes", spoilt), "n")


def stale_and_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without small lines, and lines of orders with a low number."""
    orders, lines = load(spark, sf_dir, "orders"), load(spark, sf_dir, "lineitem")
    wanted = orders.where("o_orderkey % 3 != 0").select(F.col("o_orderkey").alias("id"))
    have = lines.where("l_quantity < 30").select(F.col("l_orderkey").alias("id"))
    return sets_differ(wanted, have, "id")


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule breaks of predicted spans as citations of documents seven hundred long: some of unknown kind or class, with a wrong slice."""
    p, k = predicted(spark, sf_dir), F.col("pi")
    text = F.repeat(F.lit("0123456789"), F.lit(70))
    cut = F.substr(text, F.col("p.inicio") + 1, F.col("p.fim") - F.col("p.inicio"))
    rows = p.select(
        F.col("doc").cast("string").alias("doc"), k.alias("citation"), "p.inicio", "p.fim",
        F.when(k % 12 == 5, "outra").otherwise(F.col("p.classe")).alias("classificacao"), F.when(F.col("p.id").cast("int") % 9 != 0, F.col("p.id")).alias("id_canonico"), (F.col("p.confianca") * 1.1).alias("confianca"),
        text.alias("text"), F.when(k % 6 == 1, F.concat(cut, F.lit("x"))).otherwise(cut).alias("trecho"), F.when(k % 10 == 3, "outro").otherwise("lei").alias("tipo"), F.when(k % 10 == 8, F.lit(None)).otherwise("dispositivo").alias("natureza"), F.lit(700).alias("length"),
    )
    return violations(rows, "doc").select("doc", "citation", "rule")


def encode_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = predicted(spark, sf_dir)
    spans = F.collect_list(F.struct("p.inicio", "p.fim", F.col("p.classe").alias("classe"), F.when(F.col("p.classe") == "real", F.col("p.id").cast("long")).alias("id_canonico"), "p.confianca"))
    cells = p.groupBy("doc").agg(spans.alias("s"))
    everyone = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"))
    joined = everyone.join(cells, "doc", "left")
    return joined.select("doc", F.coalesce(E.encode_cell(F.col("s")), F.lit("-")).alias("citacoes"))


def cell_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells written and parsed again."""
    cells = encode_cell(spark, sf_dir)
    return cells.select("doc", F.explode(E.parse_prediction(F.col("citacoes"))).alias("p")).groupBy("doc").agg(
        F.count("*").alias("n"), F.sum("p.inicio").alias("inicio"), F.count("p.id").alias("n_ids"), F.count_if("p.error").alias("n_errors"), F.round(F.coalesce(F.sum("p.confianca"), F.lit(0.0)), 4).alias("confianca")
    )


QUERIES = {
    "span_match": span_match,
    "extra_containment": extra_containment,
    "metric_confusion": metric_confusion,
    "metric_score": metric_score,
    "cell_score": cell_score,
    "cell_errors": cell_errors,
    "stale_and_missing": stale_and_missing,
    "contract_violations": contract_violations,
    "encode_cell": encode_cell,
    "cell_round_trip": cell_round_trip,
}

_SPANS = """
l AS (SELECT l_orderkey AS doc, 1 + l_orderkey % 2 AS nivel, l_linenumber AS n, min(l_partkey) AS part, min(l_suppkey) AS supp FROM lineitem GROUP BY ALL),
g AS (
  SELECT doc, nivel, n AS gi, n * 100 AS gs, n * 100 + 60 + part % 30 AS ge, ['real', 'inventada', 'incompleta'][part % 3 + 1] AS gc,
         [CAST(part % 50 AS VARCHAR), '7'] AS ids FROM l),
p AS (
  SELECT doc, nivel, n * 2 AS pi, n * 100 + supp % 23 AS ps, n * 100 + supp % 23 + 40 + part % 37 AS pe,
         ['real', 'inventada', 'incompleta'][(part + CAST(supp % 5 = 0 AS INT)) % 3 + 1] AS pc, CAST(part % 51 AS VARCHAR) AS id,
         CASE WHEN supp % 3 <> 0 THEN CAST(part % 16 AS DOUBLE) / 16 END AS conf
  FROM l WHERE supp % 7 <> 0
  UNION ALL
  SELECT doc, nivel, n * 2 + 1, n * 100 + 5, n * 100 + 13, 'incompleta', NULL, NULL FROM l WHERE part % 4 = 0),
c AS (
  SELECT *, CAST(inter AS DOUBLE) / ((ge - gs) + (pe - ps) - inter) AS iou
  FROM (SELECT g.*, p.pi, ps, pe, pc, id, conf, greatest(least(ge, pe) - greatest(gs, ps), 0) AS inter FROM g JOIN p ON g.doc = p.doc)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY doc, gi ORDER BY iou DESC, pi) AS a, row_number() OVER (PARTITION BY doc, pi ORDER BY iou DESC, gi) AS b
  FROM c WHERE iou >= 0.5),
m AS (SELECT * FROM r WHERE a = 1 AND b = 1),
x AS (
  SELECT p.* FROM p WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.doc = p.doc AND m.pi = p.pi)
    AND EXISTS (SELECT 1 FROM m WHERE m.doc = p.doc AND greatest(least(ge, p.pe) - greatest(gs, p.ps), 0) >= 0.9 * (p.pe - p.ps)))
"""
_EVENTS = f"""{_SPANS},
ok AS (SELECT *, gc = pc AND (gc <> 'real' OR list_contains(ids, id)) AS good FROM m),
ev AS (
  SELECT nivel, gc AS classe, CAST(good AS INT) AS tp, 0 AS fp, CAST(gc <> pc AS INT) AS fn, 1 AS support, CAST(gc = 'inventada' AND pc = 'real' AS INT) AS severe,
         CAST(gc = 'inventada' AS INT) AS invented, coalesce(pow(conf - CAST(good AS INT), 2), 0) AS squared, CAST(conf IS NOT NULL AS INT) AS judged FROM ok
  UNION ALL SELECT nivel, pc, 0, CAST(NOT good AS INT), 0, 0, 0, 0, 0, 0 FROM ok
  UNION ALL SELECT nivel, gc, 0, 0, 1, 1, 0, CAST(gc = 'inventada' AS INT), 0, 0 FROM g WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.doc = g.doc AND m.gi = g.gi)
  UNION ALL SELECT nivel, pc, 0, 1, 0, 0, 0, 0, 0, 0 FROM p WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.doc = p.doc AND m.pi = p.pi) AND NOT EXISTS (SELECT 1 FROM x WHERE x.doc = p.doc AND x.pi = p.pi)),
cf AS (
  SELECT CAST(nivel AS INT) AS nivel, classe, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(support) AS BIGINT) AS support,
         CAST(sum(severe) AS BIGINT) AS severe, CAST(sum(invented) AS BIGINT) AS invented, CAST(sum(judged) AS BIGINT) AS judged, round(sum(squared), 6) AS squared
  FROM ev GROUP BY ALL)
"""
_CELLS = f"""{_SPANS},
cells AS (
  SELECT doc, string_agg(ps || ',' || pe || ',' || pc || ',' || CASE WHEN pc = 'real' AND CAST(id AS BIGINT) <> 0 THEN id ELSE '-' END || ',' || coalesce(printf('%.4f', conf), '-'), '|'
                         ORDER BY ps, pe, pc, CASE WHEN pc = 'real' THEN CAST(id AS BIGINT) END NULLS FIRST, conf NULLS FIRST) AS cell FROM p GROUP BY doc)
"""
ORACLES = {
    "span_match": f"WITH {_SPANS} SELECT doc, gi, pi, round(iou, 6) AS iou FROM m",
    "extra_containment": f"WITH {_SPANS} SELECT doc, pi FROM x",
    "metric_confusion": f"WITH {_EVENTS} SELECT * FROM cf",
    "metric_score": f"""WITH {_EVENTS},
f AS (SELECT nivel, avg(CASE WHEN support > 0 THEN CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END END) AS macro,
             CAST(sum(severe) AS DOUBLE) / sum(invented) AS tau, sum(squared) / sum(judged) AS brier FROM cf GROUP BY nivel),
s AS (SELECT nivel, macro * (1 - 0.5 * tau) * (1 + greatest(0, least(0.1, 0.1 * (1 - brier)))) AS score FROM f)
SELECT nivel, round(CAST(score AS DOUBLE), 6) AS score FROM s
UNION ALL SELECT 0, round(CAST(sum(score * nivel) / sum(nivel) AS DOUBLE), 6) FROM s""",
    "cell_score": f"""WITH {_EVENTS},
f AS (SELECT nivel, avg(CASE WHEN support > 0 THEN CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END END) AS macro,
             CAST(sum(severe) AS DOUBLE) / sum(invented) AS tau, sum(squared) / sum(judged) AS brier FROM cf GROUP BY nivel),
s AS (SELECT nivel, macro * (1 - 0.5 * tau) * (1 + greatest(0, least(0.1, 0.1 * (1 - brier)))) AS score FROM f)
SELECT round(CAST(sum(score * nivel) / sum(nivel) AS DOUBLE), 6) AS score FROM s""",
    "cell_errors": """
WITH d AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT CAST(k AS VARCHAR) AS documento_id, CASE k % 9 WHEN 8 THEN 'document not sent' WHEN 6 THEN 'malformed solution' WHEN 7 THEN 'malformed solution' ELSE 'malformed citation' END AS problem
FROM d WHERE k % 9 NOT IN (0, 5)""",
    "stale_and_missing": """
SELECT id, 'missing' AS problem FROM (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0 EXCEPT SELECT l_orderkey FROM lineitem WHERE l_quantity < 30)
UNION ALL SELECT id, 'stale' FROM (SELECT l_orderkey AS id FROM lineitem WHERE l_quantity < 30 EXCEPT SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)""",
    "contract_violations": f"""WITH {_SPANS},
q AS (SELECT CAST(doc AS VARCHAR) AS doc, pi AS citation, ps, pe, CASE WHEN pi % 12 = 5 THEN 'outra' ELSE pc END AS pc, CASE WHEN CAST(id AS INT) % 9 <> 0 THEN id END AS id, conf * 1.1 AS conf FROM p)
SELECT doc, citation, 'span_out_of_bounds' AS rule FROM q WHERE ps < 0 OR pe > 700 OR pe <= ps
UNION ALL SELECT doc, citation, 'slice_differs' FROM q WHERE citation % 6 = 1
UNION ALL SELECT doc, citation, 'unknown_kind' FROM q WHERE citation % 10 IN (3, 8)
UNION ALL SELECT doc, citation, 'unknown_class' FROM q WHERE citation % 12 = 5
UNION ALL SELECT doc, citation, 'real_without_id' FROM q WHERE pc = 'real' AND id IS NULL
UNION ALL SELECT doc, citation, 'id_without_real' FROM q WHERE pc <> 'real' AND id IS NOT NULL
UNION ALL SELECT doc, citation, 'confidence_out_of_range' FROM q WHERE conf > 1
UNION ALL SELECT a.doc, a.citation, 'duplicate_span' FROM q a JOIN q b ON a.doc = b.doc AND a.citation > b.citation
  WHERE CAST(greatest(least(a.pe, b.pe) - greatest(a.ps, b.ps), 0) AS DOUBLE) / ((a.pe - a.ps) + (b.pe - b.ps) - greatest(least(a.pe, b.pe) - greatest(a.ps, b.ps), 0)) >= 0.5""",
    "encode_cell": f"WITH {_CELLS} SELECT o_orderkey AS doc, coalesce(cell, '-') AS citacoes FROM orders LEFT JOIN cells ON doc = o_orderkey",
    "cell_round_trip": f"""WITH {_SPANS}
SELECT doc, count(*) AS n, CAST(sum(ps) AS BIGINT) AS inicio, count(*) FILTER (pc = 'real' AND CAST(id AS INT) <> 0) AS n_ids,
       count(*) FILTER (pc = 'real' AND CAST(id AS INT) = 0) AS n_errors, round(coalesce(sum(conf), 0), 4) AS confianca
FROM p WHERE doc IN (SELECT o_orderkey FROM orders) GROUP BY doc""",
}
