"""Driver queries: islands, merging, suppression and splits, on events and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.evaluate import first_rows
from tessera.operators.sequences import hash_split, label_islands, merge_adjacent, stable_ids, suppressed, token_windows
from tessera.plans.resolve import load


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as labelled tokens of their user: some open, some continue, some are outside."""
    events = load(spark, sf_dir, "events")
    k = F.col("event_id") % 7
    label = F.when(k == 6, "O").otherwise(F.concat(F.when(k < 2, "B-").otherwise("I-"), F.when(F.col("event_id") % 3 == 0, "ACOR").otherwise("LEG")))
    return events.select(
        F.col("user_id").alias("doc_id"),
        F.col("event_id").alias("pos"),
        F.col("event_id").alias("start"),
        (F.col("event_id") + 1).alias("end"),
        label.alias("label"),
        ((F.col("event_id") % 8) / 8).alias("prob"),
    )


def label_islands_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = label_islands(tokens(spark, sf_dir))
    return out.select("doc_id", "tipo", "inicio", "fim", F.round("confianca", 6).alias("confianca"), "repaired")


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as spans of their user, a hundred apart at most, wide by type."""
    events = load(spark, sf_dir, "events")
    width = 5 + F.col("event_id") % 40
    return events.select(
        F.col("user_id").alias("doc"),
        F.col("event_id").cast("int").alias("inicio"),
        (F.col("event_id") + width).cast("int").alias("fim"),
        F.when(F.col("event_id") % 2 == 0, "ACOR").otherwise("LEG").alias("tipo"),
        ((F.col("event_id") * 7 % 16) / 16).alias("confianca"),
    )


def adjacent_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours of one type up to 200 apart, unless the second begins at a multiple of 5."""
    out = merge_adjacent(spans(spark, sf_dir).withColumn("tipo", F.lit("ACOR")), "doc", F.col("inicio") % 5 != 0, gap=200)
    return stable_ids(out, "doc").select("doc", "id", "inicio", "fim", "confianca", "parts")


def nms_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppression among each user's spans in blocks of 500 places."""
    rows = spans(spark, sf_dir).withColumn("block", F.floor(F.col("inicio") / 500))
    rows = rows.withColumn("inicio", (F.col("inicio") % 500).cast("int")).withColumn("fim", (F.col("inicio") + 40).cast("int"))
    grouped = rows.groupBy("block").agg(F.collect_list(F.struct("confianca", "inicio", "fim", "tipo")).alias("s"))
    return grouped.select("block", F.explode(suppressed(F.col("s"))).alias("k")).select("block", F.col("k.inicio").cast("long").alias("inicio"), F.col("k.fim").cast("long").alias("fim"), "k.tipo", "k.confianca")


def hash_split_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(load(spark, sf_dir, "documents"), "source", "42", 0.2)


def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping windows over the words of documents."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.size(F.split("text", " ")).alias("n"))
    found = docs.select("doc_id", F.posexplode(token_windows(F.col("n"))).alias("w", "s"))
    return found.select("doc_id", F.col("w").cast("long").alias("w"), F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end_"))


def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(load(spark, sf_dir, "events"), "user_id", "event_id").select("user_id", "event_id", "event_type")


QUERIES = {
    "label_islands": label_islands_query,
    "adjacent_merge": adjacent_merge,
    "nms_spans": nms_spans,
    "hash_split": hash_split_query,
    "token_windows": windows,
    "keep_first": keep_first,
}

ORACLES = {
    "label_islands": """
WITH t AS (
  SELECT user_id AS doc_id, event_id AS pos, CASE WHEN event_id % 7 = 6 THEN NULL WHEN event_id % 3 = 0 THEN 'ACOR' ELSE 'LEG' END AS tipo,
         event_id % 7 < 2 AS b, (event_id % 8) / 8.0 AS prob FROM events),
o AS (SELECT *, coalesce(tipo IS NOT NULL AND (b OR tipo IS DISTINCT FROM lag(tipo) OVER (PARTITION BY doc_id ORDER BY pos)), false) AS opens FROM t),
i AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY pos) AS k FROM o)
SELECT doc_id, min(tipo) AS tipo, min(pos) AS inicio, max(pos) + 1 AS fim, round(avg(CAST(prob AS DOUBLE)), 6) AS confianca, bool_or(opens AND NOT b) AS repaired
FROM i WHERE tipo IS NOT NULL GROUP BY doc_id, k""",
    "adjacent_merge": """
WITH s AS (SELECT user_id AS doc, event_id AS inicio, event_id + 5 + event_id % 40 AS fim, CAST((event_id * 7 % 16) / 16.0 AS DOUBLE) AS c FROM events),
p AS (SELECT *, lag(fim) OVER w AS pf FROM s WINDOW w AS (PARTITION BY doc ORDER BY inicio, fim)),
q AS (SELECT *, CASE WHEN pf IS NOT NULL AND inicio - pf BETWEEN 0 AND 200 AND inicio % 5 <> 0 THEN 0 ELSE 1 END AS opens FROM p),
r AS (SELECT *, sum(opens) OVER (PARTITION BY doc ORDER BY inicio, fim) AS k FROM q),
g AS (SELECT doc, min(inicio) AS inicio, arg_max(fim, inicio) AS fim, max(c) AS confianca, count(*) AS parts FROM r GROUP BY doc, k)
SELECT doc, 'c' || row_number() OVER (PARTITION BY doc ORDER BY inicio, fim) AS id, CAST(inicio AS INT) AS inicio, CAST(fim AS INT) AS fim, confianca, parts FROM g""",
    "nms_spans": """
WITH RECURSIVE s AS (
  SELECT event_id // 500 AS block, event_id % 500 AS inicio, CASE WHEN event_id % 2 = 0 THEN 'ACOR' ELSE 'LEG' END AS tipo, CAST((event_id * 7 % 16) / 16.0 AS DOUBLE) AS c FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY c DESC, inicio, tipo) AS k FROM s),
f AS (
  SELECT block, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(i BIGINT, t VARCHAR, c DOUBLE)[]) AS kept FROM r GROUP BY block
  UNION ALL
  SELECT r.block, r.k, CASE WHEN len(list_filter(kept, lambda x: abs(x.i - inicio) < 40)) > 0 THEN kept ELSE list_append(kept, {'i': inicio, 't': tipo, 'c': r.c}) END
  FROM f JOIN r ON r.block = f.block AND r.k = f.k + 1),
z AS (SELECT block, unnest(arg_max(kept, k)) AS x FROM f GROUP BY block)
SELECT block, x.i AS inicio, x.i + 40 AS fim, x.t AS tipo, x.c AS confianca FROM z""",
    "hash_split": """
WITH g AS (SELECT source, count(*) AS n, sha256('42|' || source) AS h FROM documents GROUP BY source),
b AS (SELECT *, coalesce(sum(n) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER () AS total FROM g)
SELECT source, n, h, before < round_even(total * 0.2, 0) AS validation FROM b""",
    "token_windows": """
WITH d AS (SELECT doc_id, len(string_split(text, ' ')) AS n FROM documents),
w AS (SELECT doc_id, n, unnest(range(0, greatest(n - 97, 0) + 1, 414)) AS start FROM d)
SELECT doc_id, start // 414 AS w, start, least(start + 510, n) AS end_ FROM w""",
    "keep_first": "SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id",
}
