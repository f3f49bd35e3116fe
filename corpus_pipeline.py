"""Corpus preparation in five stages, each over all that the one before kept.

1. language: documents without letters (``und``), or unlike every learnt language
   (more than ``MAX_PHRASE_RATE`` phrases a byte), go.
2. lines: lines of templates that an earlier document holds go; documents that lose
   lines and have only blank ones left go.
3. near_duplicates: the smallest doc_id of each component stays; rows of one
   doc_id stay together.
4. benchmark: documents that contain a benchmark window go.
5. bpe: every document with its token count and the hashes of its ids and decoded text.

A stage's result is written as Parquet in the shared folder and read again as the
next one's documents. The last stage's hashes cannot be written in SQL, so there is
no ORACLE_SQL; tests/llm/test_pipeline.py holds the rows against a brute-force version.

Defined results: null and empty texts, and texts without letters, go in the first
stage; a null lang, source or doc_id changes nothing else (a null doc_id counts as
the first document in the lines stage, and goes as a near duplicate only beside
an equal text with an id); of equal texts the smallest doc_id stays; rows of one
doc_id stay or go together in the near-duplicate stage; very long texts are judged
whole; further columns pass through, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chunks, contamination, language, neardup, templates
from tessera.llm.scratch import table, written

MAX_PHRASE_RATE = 0.6
ORACLE_SQL = None


def packed(docs: DataFrame) -> DataFrame:
    """``text`` and the whole row in one column, so that no name clashes with an operator's."""
    return docs.select("text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = language.identify(packed(docs), language.learn(docs), ["_row"])
    return judged.where((F.col("lang_pred") != "und") & (F.col("phrase_rate") <= MAX_PHRASE_RATE)).select("_row.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    kept = templates.drop_recurring(rows).where(F.expr("n_dropped = 0") | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    row = F.col("_row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", F.when(F.col("n_dropped") > 0, counted).otherwise(F.col("_row.n_chars")))
    return kept.select(row.alias("_row")).select("_row.*")


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = written(neardup.near_duplicates(docs, size=5, percent=80).where("NOT kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = contamination.contamination(packed(docs), table(spark, sf_dir, "benchmark").select("item_id", "text"), ["_row"])
    return judged.where("NOT contaminated").select("_row.*")


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunks.digests(chunks.encode(docs, public_tokenizers.path("word_bpe_49k.json"), ["doc_id"]))


STAGES = [
    ("language", by_language),
    ("lines", without_repeated_lines),
    ("near_duplicates", without_near_duplicates),
    ("benchmark", without_benchmark),
    ("bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
