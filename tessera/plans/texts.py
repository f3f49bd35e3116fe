"""Driver queries: text functions and spans, on documents, pages and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import spans, text
from tessera.operators.evaluate import first_rows
from tessera.operators.extract import select_number
from tessera.operators.pipeline import source_of
from tessera.operators.registry import dictionary_classes, header_slice
from tessera.plans.resolve import load
from tessera.sources.readers import bio_tokens, metadata_index


def fold_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folded texts, as hashes; sharp s is spelt out first on both sides of the comparison."""
    docs = load(spark, sf_dir, "documents")
    plain = F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))
    return docs.select("doc_id", F.sha2(text.fold(plain), 256).alias("folded_sha256"), F.length(text.normalize_value(plain)).cast("long").alias("n_matching"))


def class_key_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and name tokens of part names, and whether the last token follows the first in order."""
    parts = load(spark, sf_dir, "part")
    name = F.concat_ws(" de ", "p_name", "p_type")
    tokens = text.name_tokens(name)
    return parts.select(
        "p_partkey",
        text.class_key(name).alias("key"),
        F.array_join(tokens, ",").alias("tokens"),
        text.name_matches(name, F.concat_ws(" ", F.element_at(tokens, 1), F.element_at(tokens, -1))).alias("in_order"),
        text.name_matches(name, F.concat_ws(" ", F.element_at(tokens, -1), F.element_at(tokens, 1))).alias("reversed"),
    )


def digit_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    found = docs.select("doc_id", F.posexplode(spans.find_spans(F.col("text"), "[0-9]+")).alias("n", "s"))
    return found.select("doc_id", F.col("n").cast("long").alias("n"), F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end_"), F.col("s.text").alias("digits"))


def typed_number_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best number of each document by length, then place; none if another of the same length differs from it."""
    docs = load(spark, sf_dir, "documents")
    scored = F.transform(spans.find_spans(F.col("text"), "[0-9]+"), lambda s: F.struct(s["text"].alias("value"), s["start"].alias("start"), s["end"].alias("end"), F.length(s["text"]).alias("score")))
    return docs.select("doc_id", select_number(scored)["value"].alias("numero"))


def unique_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one address-like number of a document outside longer numbers, or null."""
    docs = load(spark, sf_dir, "documents")
    found = F.transform(spans.find_spans(F.col("text"), r"[0-9]+"), lambda s: s["text"])
    return docs.select("doc_id", spans.only(F.filter(found, lambda x: F.length(x) == 3)).alias("unico"))


def dictionary_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the benchmark's openings found in documents with no letter beside them: first eight by place."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id_canonico"), text.class_key(F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))).alias("header"), F.lit(None).cast("string").alias("tribunal"))
    words = load(spark, sf_dir, "benchmark").select(F.substring_index(text.class_key(F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))), " ", 2).alias("surface_key")).where("length(surface_key) > 5").distinct()
    entries = words.select("surface_key", F.lit(None).cast("string").alias("tribunal"), F.col("surface_key").alias("classe"))
    found = dictionary_classes(docs, entries)
    return found.select(F.col("id_canonico").alias("doc_id"), F.array_join("classes", "|").alias("classes"))


def header_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    cut = header_slice(F.col("text"), F.upper("lang"))
    return docs.select("doc_id", F.col("lang").alias("lang"), cut["start"].cast("long").alias("start"), cut["end"].cast("long").alias("end_"), cut["strategy"].alias("strategy"))


def json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events")
    parsed = events.select("event_id", F.from_json("props", "k long").alias("j"))
    return parsed.select("event_id", F.col("j.k").cast("string").alias("k"))


def document_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    joined = docs.join(labels.select("doc_id", "quality", "toxic"), "doc_id", "left")
    return joined.groupBy("source").agg(
        F.count("*").alias("n_documents"),
        F.count("quality").alias("n_labelled"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("long").alias("n_toxic"),
        F.count_if(F.coalesce(F.col("quality") == 0, F.lit(False))).alias("n_discarded"),
        F.sum("n_chars").alias("n_chars"),
    )


def hash_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return docs.select("doc_id", source_of(F.col("text"))["sha256"].alias("sha256"))


def scalar_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small scalar functions over columns that have their shapes."""
    parts = load(spark, sf_dir, "part")
    raw = F.concat(F.lit("00"), F.col("p_partkey").cast("string"))
    return parts.select(
        "p_partkey",
        text.norm_id(raw).alias("norm_id"),
        text.ocr_digits(F.concat(F.lit("iOl-"), F.col("p_size").cast("string"))).alias("ocr"),
        text.compact_number(F.concat_ws(" . ", F.col("p_size").cast("string"), F.lit("5"))).alias("compact"),
        text.four_digit_year(F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0")).alias("year"),
        text.digits("p_brand").alias("digits"),
        text.output_form("p_type").alias("output"),
        text.normalize_uf(F.substring("p_name", 1, 2)).alias("uf"),
        F.coalesce(text.level_of(F.concat(F.lit("doc_n"), F.col("p_size").cast("string"), F.lit("_x"))).cast("string"), F.lit("-")).alias("level"),
        text.distance(F.col("p_size"), F.col("p_size") + 3, F.lit(20), F.lit(25)).cast("long").alias("distance"),
    )


def first_of_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first event of each user and type by time."""
    events = load(spark, sf_dir, "events")
    return first_rows(events, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


def metadata_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each user's events the greatest, by columns in order."""
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return metadata_index(events, "user_id")


def bio_token_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of label records made of events: each user's events as one record, every fifth token skipped."""
    events = load(spark, sf_dir, "events")
    k = F.col("event_id")
    token = F.struct(k, F.when(k % 5 == 0, -100).otherwise((k % 3).cast("int")).alias("label"), F.array((k % 50).cast("int"), (k % 50 + 2).cast("int")).alias("offset"))
    records = events.groupBy(F.col("user_id").cast("string").alias("id")).agg(F.array_sort(F.collect_list(token)).alias("t"))
    records = records.select("id", F.transform("t", lambda t: t["label"]).alias("labels"), F.transform("t", lambda t: t["offset"]).alias("offset_mapping"))
    return bio_tokens(records, {0: "O", 1: "B-X", 2: "I-X"}).select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end_"), "label")


QUERIES = {
    "metadata_index": metadata_rows,
    "bio_tokens": bio_token_rows,
    "fold_text": fold_text,
    "class_key_tokens": class_key_tokens,
    "digit_spans": digit_spans,
    "typed_number_pick": typed_number_pick,
    "unique_or_null": unique_or_null,
    "dictionary_topk": dictionary_topk,
    "header_slice": header_slices,
    "json_field": json_field,
    "document_summary": document_summary,
    "hash_of_text": hash_of_text,
    "scalar_forms": scalar_forms,
    "first_of_group": first_of_group,
}

_DIGITS = """
t AS (SELECT doc_id, regexp_extract_all(text, '[0-9]+') AS m, string_split_regex(text, '[0-9]+') AS g FROM documents),
u AS (SELECT doc_id, unnest(range(1, len(m) + 1)) AS i, m, g FROM t WHERE len(m) > 0),
s AS (SELECT doc_id, i, m[i] AS d, CAST(sum(length(g[i])) OVER w AS BIGINT) AS gaps, CAST(sum(length(m[i])) OVER w AS BIGINT) AS mats FROM u WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
f AS (SELECT doc_id, i - 1 AS n, gaps + mats - length(d) AS start, gaps + mats AS end_, d AS digits FROM s)
"""
_FOLD = "upper(strip_accents(replace(text, 'ß', 'ss')))"
_KEY = "trim(regexp_replace(upper(strip_accents({})), '[^A-Z0-9]+', ' ', 'g'))"
_NAME = "(p_name || ' de ' || p_type)"

ORACLES = {
    "metadata_index": "SELECT user_id, max(event_type) AS event_type, arg_max(event_id, (event_type, event_id)) AS event_id, arg_max(value, (event_type, event_id)) AS value FROM events GROUP BY user_id",
    "bio_tokens": """
SELECT CAST(user_id AS VARCHAR) AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, event_id % 50 AS start, event_id % 50 + 2 AS end_,
       CASE WHEN event_id % 5 = 0 THEN NULL ELSE ['O', 'B-X', 'I-X'][event_id % 3 + 1] END AS label FROM events""",
    "fold_text": f"SELECT doc_id, sha256(trim(regexp_replace({_FOLD}, '\\s+', ' ', 'g'))) AS folded_sha256, CAST(length({_FOLD}) AS BIGINT) AS n_matching FROM documents",
    "class_key_tokens": f"""
WITH t AS (
  SELECT p_partkey, {_KEY.format(_NAME)} AS key,
         list_filter(string_split({_KEY.format(_NAME)}, ' '), lambda x: x NOT IN ('', 'DE', 'DA', 'DO', 'DAS', 'DOS', 'E', 'MIN', 'MINISTRO', 'MINISTRA')) AS w FROM part)
SELECT p_partkey, key, array_to_string(w, ',') AS tokens,
       list_position(w, w[1]) < len(w) - list_position(list_reverse(w), w[-1]) + 1 AS in_order,
       list_position(w, w[-1]) < len(w) - list_position(list_reverse(w), w[1]) + 1 AS reversed FROM t""",
    "digit_spans": f"WITH {_DIGITS} SELECT doc_id, n, start, end_, digits FROM f",
    "typed_number_pick": f"""
WITH {_DIGITS},
r AS (SELECT doc_id, digits, row_number() OVER (PARTITION BY doc_id ORDER BY length(digits) DESC, start) AS k FROM f),
p AS (SELECT doc_id, max(CASE WHEN k = 1 THEN digits END) AS a, max(CASE WHEN k = 2 THEN digits END) AS b FROM r GROUP BY doc_id)
SELECT documents.doc_id, CASE WHEN b IS NULL OR length(a) <> length(b) OR a = b THEN a END AS numero FROM documents LEFT JOIN p USING (doc_id)""",
    "unique_or_null": f"""
WITH {_DIGITS} SELECT documents.doc_id, CASE WHEN count(DISTINCT digits) = 1 THEN min(digits) END AS unico
FROM documents LEFT JOIN f ON f.doc_id = documents.doc_id AND length(digits) = 3 GROUP BY documents.doc_id""",
    "dictionary_topk": f"""
WITH d AS (SELECT doc_id, ' ' || {_KEY.format("replace(text, 'ß', 'ss')")} || ' ' AS h FROM documents),
b AS (SELECT DISTINCT array_to_string(list_slice(string_split({_KEY.format("replace(text, 'ß', 'ss')")}, ' '), 1, 2), ' ') AS k FROM benchmark),
x AS (SELECT doc_id, k, strpos(h, ' ' || k || ' ') AS p FROM d JOIN b ON strpos(h, ' ' || k || ' ') > 0 WHERE length(k) > 5),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY p, -length(k), k) AS n FROM x)
SELECT doc_id, string_agg(k, '|' ORDER BY n) AS classes FROM r WHERE n <= 8 GROUP BY doc_id""",
    "header_slice": """
WITH t AS (SELECT doc_id, lang, text, strpos(upper(substr(text, 1, 3000)), 'EMENTA') AS e FROM documents)
SELECT doc_id, lang, CAST(0 AS BIGINT) AS start, CAST(least(length(text), 1200) AS BIGINT) AS end_, lower(lang) || '_fallback' AS strategy FROM t""",
    "json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
    "document_summary": """
SELECT source, count(*) AS n_documents, count(quality) AS n_labelled, CAST(coalesce(sum(toxic), 0) AS BIGINT) AS n_toxic,
       count(*) FILTER (quality = 0) AS n_discarded, CAST(sum(n_chars) AS BIGINT) AS n_chars
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source""",
    "hash_of_text": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "scalar_forms": """
SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS norm_id, '101-' || p_size AS ocr, p_size || '.5' AS compact,
       CAST(CASE WHEN p_partkey % 100 <= 30 THEN 2000 ELSE 1900 END + p_partkey % 100 AS VARCHAR) AS year,
       regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits, upper(p_type) AS output,
       CASE WHEN regexp_matches(upper(substr(p_name, 1, 2)), '^[A-Z][A-Z]$') THEN upper(substr(p_name, 1, 2)) END AS uf,
       CASE WHEN p_size IN (1, 2) THEN CAST(p_size AS VARCHAR) ELSE '-' END AS level,
       CAST(greatest(20 - (p_size + 3), p_size - 25, 0) AS BIGINT) AS distance
FROM part""",
    "first_of_group": "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1",
}
