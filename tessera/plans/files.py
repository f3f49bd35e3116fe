"""Driver queries: tables written by the library's sinks and read back by its readers, in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.pipeline import document_json
from tessera.plans.resolve import load
from tessera.sources import readers, writers
from tessera.sources.settle import shared_folder


def submission_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of parts with commas, quotes and line ends, as a CSV submission of exactly the expected documents."""
    parts = load(spark, sf_dir, "part")
    cells = parts.select(F.concat(F.lit("d"), F.col("p_partkey").cast("string")).alias("documento_id"), F.concat("p_name", F.lit(',"'), "p_brand", F.lit('"\n'), "p_type").alias("citacoes"))
    path = shared_folder(spark, "submission")
    writers.write_submission(cells, cells.select("documento_id"), path)
    return readers.read_csv(spark, path, "documento_id string, citacoes string")


def record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of documents as JSON lines: the whole text's length and digest."""
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("documento_id"), "text")
    cites = spark.createDataFrame([], "documento_id string, id string, inicio int, fim int, tipo string, confianca double, trecho string, tipo_citacao string, natureza string, acordao struct<numero:string,classe_normalizada_candidatos:array<string>>, sumula struct<numero:array<int>>, dispositivo struct<artigo:array<string>>, warnings array<string>, classificacao string, regra string, id_canonico long, log array<struct<plano:string>>, candidates array<long>, candidatos array<struct<id_canonico:long>>, searched boolean, sufficient boolean, confianca_final double, error string, mensagem string")
    path = shared_folder(spark, "records")
    writers.write_documents(document_json(cites, docs), path)
    rows = spark.read.schema("documento_id string, fonte struct<texto_len:long,sha256:string>, citacoes array<string>").json(path)
    return rows.select("documento_id", "fonte.texto_len", "fonte.sha256", F.size("citacoes").cast("long").alias("n_citacoes"))


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as token-label records, one JSON object a line, read and opened into tokens."""
    k = F.col("o_orderkey")
    each = lambda f: F.transform(F.sequence(F.lit(0), (k % 5).cast("int")), f)
    label = lambda i: F.when((k + i) % 4 == 3, -100).otherwise((k + i) % 4).cast("int")
    rows = load(spark, sf_dir, "orders").select(
        F.concat(F.lit("o"), k.cast("string")).alias("id"), F.lit("texto").alias("text"), each(lambda i: i + 1).alias("input_ids"), each(lambda i: F.lit(1)).alias("attention_mask"), each(label).alias("labels"), each(lambda i: F.array(i * 3, i * 3 + 2)).alias("offset_mapping")
    )
    path = shared_folder(spark, "tokens")
    rows.select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    found = readers.bio_tokens(readers.read_bio(spark, path), {0: "O", 1: "B-X", 2: "I-X"})
    return found.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end_"), "label")


def index_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of parts written twice, the second time with repeated keys: what it answers afterwards, and whether it is fresh."""
    parts = load(spark, sf_dir, "part")
    k = F.col("p_partkey")
    one = lambda keep, *columns: parts.where(keep).select(k.alias("id_canonico"), *columns)
    index = {
        "canonical_document": one(F.lit(True), F.concat(F.lit("d"), k.cast("string")).alias("documento_id")),
        "acordao_key": one(k % 2 == 0, F.col("p_size").cast("string").alias("numero_digitos")),
        "acordao_class": one(k % 2 == 0, F.col("p_type").alias("classe_normalizada")),
        "sumula_key": one(k % 3 == 0, F.col("p_size").alias("numero")),
        "dispositivo_key": one(k % 5 == 0, F.col("p_brand").alias("diploma")),
        "index_warning": one(k % 7 == 0, F.lit("NO_CASE_NUMBER").alias("codigo")),
    }
    path = shared_folder(spark, "index")
    writers.write_index(index, path, "first")
    try:
        writers.write_index(index | {"sumula_key": index["sumula_key"].unionByName(index["sumula_key"])}, path, "second")
        refused = False
    except ValueError:
        refused = True
    found = writers.read_index(spark, path)
    fresh = refused and writers.index_is_fresh(spark, path, "first") and not writers.index_is_fresh(spark, path, "second")
    counts = [df.agg(F.lit(name).alias("tabela"), F.count("*").alias("n"), F.sum("id_canonico").alias("soma")) for name, df in found.items()]
    out = counts[0]
    for df in counts[1:]:
        out = out.unionByName(df)
    return out.withColumn("fresco", F.lit(fresh))


QUERIES = {"submission_file": submission_file, "record_files": record_files, "token_files": token_files, "index_files": index_files}

ORACLES = {
    "submission_file": """SELECT 'd' || p_partkey AS documento_id, p_name || ',"' || p_brand || '"' || chr(10) || p_type AS citacoes FROM part""",
    "record_files": """SELECT CAST(doc_id AS VARCHAR) AS documento_id, CAST(length(text) AS BIGINT) AS texto_len, sha256(text) AS sha256, CAST(0 AS BIGINT) AS n_citacoes FROM documents""",
    "token_files": """
SELECT 'o' || o_orderkey AS doc_id, i AS pos, i * 3 AS start, i * 3 + 2 AS end_, CASE (o_orderkey + i) % 4 WHEN 0 THEN 'O' WHEN 1 THEN 'B-X' WHEN 2 THEN 'I-X' END AS label
FROM (SELECT o_orderkey, unnest(range(0, o_orderkey % 5 + 1)) AS i FROM orders)""",
    "index_files": """
SELECT tabela, count(*) AS n, CAST(sum(p_partkey) AS BIGINT) AS soma, true AS fresco
FROM part, (VALUES ('canonical_document', 1), ('acordao_key', 2), ('acordao_class', 2), ('sumula_key', 3), ('dispositivo_key', 5), ('index_warning', 7)) t(tabela, m)
WHERE p_partkey % m = 0 GROUP BY tabela""",
}
