"""Driver queries: retrieval and decision, on orders and customers as the registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import class_key, fold
from tessera.operators.decide import decide, final_confidence
from tessera.operators.retrieve import RELAXED, first_pass, lookup_each, payload, resolved, retrieve_acordao
from tessera.sources.settle import settled, unsent


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as rulings: four share a number; court, rapporteur, year, class and state from their columns."""
    orders, customers = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    return orders.join(unsent(customers), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_orderkey") - F.col("o_orderkey") % 4).cast("string").alias("numero"),
        F.col("o_orderstatus").alias("tribunal"),
        F.col("c_mktsegment").alias("relator"),
        F.year("o_orderdate").alias("ano"),
        F.col("o_orderpriority").alias("classe"),
        F.col("c_nationkey").cast("string").alias("uf"),
    )


def mentions(registry: DataFrame) -> DataFrame:
    """A mention of each ruling, with fields left out or altered by its number."""
    k = F.col("id")
    return registry.select(
        k.alias("mention_id"),
        "numero",
        F.when(k % 5 != 0, F.when(k % 11 == 0, "X").otherwise(F.col("tribunal"))).alias("m_tribunal"),
        F.when(k % 3 != 0, F.col("relator")).alias("m_relator"),
        F.when(k % 7 != 0, F.when(k % 13 == 0, F.col("ano") + 1).otherwise(F.col("ano"))).alias("m_ano"),
        F.when(k % 2 != 0, F.col("classe")).alias("m_classe"),
        F.when(k % 4 != 1, F.when(k % 17 == 0, "ZZ").otherwise(F.col("uf"))).alias("m_uf"),
    )


def cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = settled(registry(spark, sf_dir), "registry")
    asked = mentions(held)
    pairs = asked.join(unsent(held), "numero")
    present = {f: F.col(f"m_{f}").isNotNull() for f in RELAXED}
    matches = {f: F.col(f"m_{f}") == F.col(f) for f in RELAXED}
    court = F.col("m_tribunal").isNull() | (F.col("m_tribunal") == F.col("tribunal"))
    pairs = pairs.withColumn("first_pass", first_pass(present, matches, court))
    plans = sum((present[f].cast("int") for f in RELAXED), F.lit(0))
    sufficient = asked.select("mention_id", (F.col("m_tribunal").isNotNull() | F.col("m_classe").isNotNull() | F.col("m_uf").isNotNull()).alias("sufficient"))
    return resolved(pairs, "mention_id", "id", plans).join(unsent(sufficient), "mention_id")


def resolve_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cascade(spark, sf_dir)
    return found.select("mention_id", "attempts", F.array_join(F.transform("candidates", lambda x: x.cast("string")), ":").alias("candidate_ids"), F.array_join(F.transform("counts", lambda x: x.cast("string")), ":").alias("counts"))


def resolve_decide(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decide(cascade(spark, sf_dir))
    return out.select("mention_id", "classificacao", "regra", F.col("id_canonico").cast("string").alias("id_canonico"), final_confidence(F.col("confianca_decisao"), F.lit(1.0)).alias("confianca"))


def retrieve_rulings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings by number, names, header states and class sets: the last plan, its fields and its candidates with their evidence."""
    orders, customers = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    k = F.col("o_orderkey")
    rows = orders.join(unsent(customers), F.col("o_custkey") == F.col("c_custkey")).select(
        k.alias("id_canonico"),
        (k - k % 4).cast("string").alias("numero"),
        F.element_at(F.array(*map(F.lit, ["STF", "STJ", "TST"])), (k % 3 + 1).cast("int")).alias("tribunal"),
        F.year("o_orderdate").alias("ano"),
        F.concat(F.lit("Min. "), F.col("c_mktsegment"), F.lit(" da "), F.col("o_orderstatus"), F.lit("x")).alias("relator"),
        F.element_at(F.array(*map(F.lit, ["SP", "RJ", "MG"])), (F.col("c_nationkey") % 3 + 1).cast("int")).alias("estado"),
        F.col("o_orderpriority").alias("classe"),
        F.concat(F.col("o_orderstatus"), F.lit("x "), F.col("c_mktsegment")).alias("turned"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("o_orderstatus"), F.lit("x")).alias("named"),
    )
    rows = settled(rows)
    i = F.col("id_canonico")
    keys = rows.select("id_canonico", F.col("numero").alias("numero_digitos"), F.when(i % 2 == 0, F.col("estado")).alias("uf"), F.when(i % 5 == 0, F.col("ano") + 1).alias("cnj_ano"))
    header = F.when(i % 2 == 1, F.concat(F.lit("RECURSO "), F.col("numero"), F.lit(" - "), F.col("estado"), F.lit(" RELATOR"))).otherwise("RECURSO SPX RJA")
    held = rows.select("id_canonico", F.concat(F.lit("o"), i.cast("string")).alias("documento_id"), F.lit("acordao").alias("natureza"), "tribunal", "ano", fold("relator").alias("relator_normalizado"), header.alias("header_normalized"), F.lit("x").alias("header_strategy"))
    classes = rows.select("id_canonico", class_key("classe").alias("classe_normalizada")).unionByName(rows.where("id_canonico % 3 = 0").select("id_canonico", F.lit("HC").alias("classe_normalizada")))
    asked = rows.select(
        i.alias("mention_id"),
        "numero",
        F.when(i % 5 != 0, F.when(i % 11 == 0, "X").otherwise(F.lower("tribunal"))).alias("tribunal"),
        F.when(i % 3 == 1, F.lower("named")).when(i % 3 == 2, F.col("turned")).alias("relator"),
        F.when(i % 7 != 0, F.col("ano") + (i % 13 == 0).cast("int")).alias("ano"),
        F.when(i % 6 == 1, "hc").when(i % 2 == 1, F.lower("classe")).alias("classe"),
        F.when(i % 4 != 1, F.lower("estado")).alias("uf"),
    )
    found = retrieve_acordao(asked, keys, held, classes)
    found = found.join(unsent(payload(found, held)), "mention_id", "left")
    last = F.element_at("log", -1)
    courts = F.array_join(F.transform("candidatos", lambda c: F.concat_ws(":", c["documento_id_base"], c["tribunal"])), ",")
    return found.select("mention_id", "attempts", last["plano"].alias("plano"), F.array_join(last["campos"], ",").alias("campos"), F.size("log").alias("n_log"), F.coalesce(courts, F.lit("")).alias("candidatos"), "sufficient")


def lookup_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts asked for by order, with the order's first supplier as qualifier where the order number is even."""
    lines = load(spark, sf_dir, "lineitem")
    asked = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_set("l_partkey")).alias("numeros"), F.min("l_suppkey").cast("string").alias("s"))
    asked = asked.select(F.col("l_orderkey").alias("mention_id"), "numeros", F.when(F.col("l_orderkey") % 2 == 0, F.col("s")).alias("tribunal"))
    held = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("numero"), (F.col("p_partkey") % 10).cast("string").alias("tribunal"), F.col("p_partkey").alias("id_canonico"))
    out = lookup_each(asked, "numeros", "tribunal", held, "numero", "tribunal")
    return out.select("mention_id", "attempts", F.array_join(F.transform("candidates", lambda x: x.cast("string")), ":").alias("candidate_ids"), "sufficient")


def lookup_no_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents asked for without a qualifier, by language and twenty of their number, so that matches stay few at every size."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", F.concat_ws("|", "lang", F.floor(F.col("doc_id") / 20).cast("string")).alias("artigo"))
    asked = docs.select(F.col("doc_id").alias("mention_id"), F.array("artigo").alias("artigos"), F.lit(None).cast("string").alias("diploma"))
    held = docs.select("artigo", F.col("source").alias("diploma"), F.col("doc_id").alias("id_canonico"))
    out = lookup_each(asked, "artigos", "diploma", held, "artigo", "diploma")
    return out.select("mention_id", F.size("candidates").cast("long").alias("n_candidates"), F.try_element_at("candidates", F.lit(1)).cast("string").alias("first_id"), "sufficient")


QUERIES = {
    "retrieve_rulings": retrieve_rulings,
    "resolve_cascade": resolve_cascade,
    "resolve_decide": resolve_decide,
    "lookup_multi_key": lookup_multi_key,
    "lookup_no_anchor": lookup_no_anchor,
}

_PLANS = """
reg AS (
  SELECT o_orderkey AS id, CAST(o_orderkey - o_orderkey % 4 AS VARCHAR) AS numero, o_orderstatus AS tribunal, c_mktsegment AS relator,
         CAST(year(o_orderdate) AS INT) AS ano, o_orderpriority AS classe, CAST(c_nationkey AS VARCHAR) AS uf
  FROM orders JOIN customer ON o_custkey = c_custkey),
men AS (
  SELECT id AS mention_id, numero,
         CASE WHEN id % 5 <> 0 THEN CASE WHEN id % 11 = 0 THEN 'X' ELSE tribunal END END AS t,
         CASE WHEN id % 3 <> 0 THEN relator END AS r,
         CASE WHEN id % 7 <> 0 THEN CASE WHEN id % 13 = 0 THEN ano + 1 ELSE ano END END AS a,
         CASE WHEN id % 2 <> 0 THEN classe END AS c,
         CASE WHEN id % 4 <> 1 THEN CASE WHEN id % 17 = 0 THEN 'ZZ' ELSE uf END END AS u
  FROM reg),
plans AS (
  SELECT *, k FROM men, (SELECT unnest(range(0, 5)) AS k)
  WHERE k <= CAST(r IS NOT NULL AS INT) + CAST(a IS NOT NULL AS INT) + CAST(c IS NOT NULL AS INT) + CAST(u IS NOT NULL AS INT)),
active AS (
  SELECT mention_id, numero, k, t,
         CASE WHEN CAST(r IS NOT NULL AS INT) > k THEN r END AS r,
         CASE WHEN CAST(r IS NOT NULL AS INT) + CAST(a IS NOT NULL AS INT) > k THEN a END AS a,
         CASE WHEN CAST(r IS NOT NULL AS INT) + CAST(a IS NOT NULL AS INT) + CAST(c IS NOT NULL AS INT) > k THEN c END AS c,
         CASE WHEN CAST(r IS NOT NULL AS INT) + CAST(a IS NOT NULL AS INT) + CAST(c IS NOT NULL AS INT) + CAST(u IS NOT NULL AS INT) > k THEN u END AS u
  FROM plans),
tried AS (
  SELECT active.mention_id, active.k, count(reg.id) AS n, string_agg(CAST(reg.id AS VARCHAR), ':' ORDER BY reg.id) AS ids, min(reg.id) AS one
  FROM active LEFT JOIN reg ON reg.numero = active.numero AND (t IS NULL OR t = reg.tribunal) AND (r IS NULL OR r = relator)
       AND (a IS NULL OR a = ano) AND (c IS NULL OR c = classe) AND (u IS NULL OR u = uf)
  GROUP BY ALL),
stop AS (SELECT mention_id, coalesce(min(CASE WHEN n > 0 THEN k END), max(k)) AS last FROM tried GROUP BY mention_id),
res AS (
  SELECT s.mention_id, CAST(last + 1 AS INT) AS attempts, coalesce(max(CASE WHEN k = last THEN ids END), '') AS candidate_ids,
         string_agg(CAST(n AS VARCHAR), ':' ORDER BY k) AS counts, max(CASE WHEN k = last THEN n END) AS n, max(CASE WHEN k = last THEN one END) AS one
  FROM stop s JOIN tried ON tried.mention_id = s.mention_id AND k <= last GROUP BY ALL)
"""

_RULINGS = """
reg AS (
  SELECT o_orderkey AS id, CAST(o_orderkey - o_orderkey % 4 AS VARCHAR) AS numero, ['STF', 'STJ', 'TST'][o_orderkey % 3 + 1] AS tribunal, CAST(year(o_orderdate) AS INT) AS ano,
         CASE WHEN o_orderkey % 5 = 0 THEN CAST(year(o_orderdate) AS INT) + 1 END AS cnj, ['SP', 'RJ', 'MG'][c_nationkey % 3 + 1] AS uf, o_orderpriority AS classe, c_mktsegment || o_orderstatus AS nome
  FROM orders JOIN customer ON o_custkey = c_custkey),
men AS (
  SELECT id AS mention_id, numero,
         CASE WHEN id % 5 <> 0 THEN CASE WHEN id % 11 = 0 THEN 'X' ELSE tribunal END END AS t,
         CASE WHEN id % 3 = 1 THEN nome WHEN id % 3 = 2 THEN 'turned' END AS r,
         CASE WHEN id % 7 <> 0 THEN ano + CAST(id % 13 = 0 AS INT) END AS a,
         CASE WHEN id % 6 = 1 THEN 'hc' WHEN id % 2 = 1 THEN classe END AS c,
         CASE WHEN id % 4 <> 1 THEN uf END AS u
  FROM reg),
given AS (SELECT *, list_filter([CASE WHEN r IS NOT NULL THEN 'relator' END, CASE WHEN a IS NOT NULL THEN 'ano' END, CASE WHEN c IS NOT NULL THEN 'classe' END, CASE WHEN u IS NOT NULL THEN 'uf' END], lambda x: x IS NOT NULL) AS g FROM men),
plans AS (SELECT *, list_slice(g, k + 1, len(g)) AS used FROM given, (SELECT unnest(range(0, 5)) AS k) WHERE k <= len(g)),
tried AS (
  SELECT mention_id, k, used, g, t, c, u, count(reg.id) AS n, coalesce(string_agg('o' || reg.id || ':' || reg.tribunal, ',' ORDER BY reg.id), '') AS ids
  FROM plans LEFT JOIN reg ON reg.numero = plans.numero AND (t IS NULL OR t = reg.tribunal) AND (NOT list_contains(used, 'relator') OR r = nome)
       AND (NOT list_contains(used, 'ano') OR a = reg.ano OR coalesce(a = cnj, false)) AND (NOT list_contains(used, 'classe') OR c = reg.classe OR (c = 'hc' AND reg.id % 3 = 0)) AND (NOT list_contains(used, 'uf') OR u = reg.uf)
  GROUP BY ALL),
stop AS (SELECT mention_id, coalesce(min(CASE WHEN n > 0 THEN k END), max(k)) AS last FROM tried GROUP BY mention_id)
"""

ORACLES = {
    "retrieve_rulings": f"""WITH {_RULINGS}
SELECT mention_id, CAST(last + 1 AS INT) AS attempts, CASE WHEN last = 0 THEN 'acordao_completo' ELSE 'acordao_sem_' || g[last] END AS plano,
       array_to_string(['numero'] || CASE WHEN t IS NULL THEN [] ELSE ['tribunal'] END || list_reverse(used), ',') AS campos, CAST(last + 1 AS INT) AS n_log, ids AS candidatos,
       t IS NOT NULL OR c IS NOT NULL OR u IS NOT NULL AS sufficient
FROM tried JOIN stop USING (mention_id) WHERE k = last""",
    "resolve_cascade": f"WITH {_PLANS} SELECT mention_id, attempts, candidate_ids, counts FROM res",
    "resolve_decide": f"""WITH {_PLANS},
dec AS (
  SELECT res.mention_id, n, one, CASE WHEN n > 1 THEN 2 WHEN n = 1 AND attempts > 1 THEN 4 WHEN n = 1 THEN 5 WHEN t IS NOT NULL OR c IS NOT NULL OR u IS NOT NULL THEN 6 ELSE 7 END AS d
  FROM res JOIN men USING (mention_id))
SELECT mention_id,
  CASE d WHEN 2 THEN 'incompleta' WHEN 4 THEN 'real' WHEN 5 THEN 'real' WHEN 6 THEN 'inventada' ELSE 'incompleta' END AS classificacao,
  CASE d WHEN 2 THEN 'MULTIPLOS_CANDIDATOS' WHEN 4 THEN 'UNICO_CONSISTENTE_EM_CONSULTA_PARCIAL' WHEN 5 THEN 'UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA'
         WHEN 6 THEN 'IDENTIDADE_SUFICIENTE_SEM_CANDIDATO' ELSE 'IDENTIDADE_INSUFICIENTE' END AS regra,
  CASE WHEN n = 1 THEN CAST(one AS VARCHAR) END AS id_canonico,
  CASE d WHEN 2 THEN 0.898e0 WHEN 4 THEN 0.915e0 WHEN 5 THEN 0.9745e0 WHEN 6 THEN 0.932e0 ELSE 0.847e0 END AS confianca
FROM dec""",
    "lookup_multi_key": """
WITH a AS (SELECT l_orderkey AS mention_id, l_partkey AS v, min(l_suppkey) OVER (PARTITION BY l_orderkey) AS s FROM lineitem),
b AS (SELECT DISTINCT mention_id, v, CASE WHEN mention_id % 2 = 0 THEN CAST(s AS VARCHAR) END AS q FROM a)
SELECT mention_id, CAST(count(*) AS INT) AS attempts,
       coalesce(string_agg(CASE WHEN p_partkey IS NOT NULL AND (q IS NULL OR q = CAST(p_partkey % 10 AS VARCHAR)) THEN CAST(p_partkey AS VARCHAR) END, ':' ORDER BY p_partkey), '') AS candidate_ids,
       max(q) IS NOT NULL AND count(*) = 1 AS sufficient
FROM b LEFT JOIN part ON v = p_partkey GROUP BY mention_id""",
    "lookup_no_anchor": """
WITH d AS (SELECT doc_id, concat_ws('|', lang, CAST(doc_id // 20 AS VARCHAR)) AS a FROM documents)
SELECT doc_id AS mention_id, count(*) OVER lot AS n_candidates, CAST(min(doc_id) OVER lot AS VARCHAR) AS first_id, false AS sufficient
FROM d WINDOW lot AS (PARTITION BY a)""",
}
