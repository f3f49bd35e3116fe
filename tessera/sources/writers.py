"""Sinks: index, JSON, CSV, summaries, and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.contract import sets_differ
from tessera.operators.registry import SCHEMA_VERSION, index_metadata
from tessera.sources import snapshots

UNIQUE = {"canonical_document": [["id_canonico"], ["documento_id"]], "acordao_key": [["id_canonico", "numero_digitos"]], "acordao_class": [["id_canonico", "classe_normalizada"]], "sumula_key": [["id_canonico"]], "dispositivo_key": [["id_canonico"]]}


def write_index(index: dict[str, DataFrame], path: str, source_sha256: str) -> str:
    """A new snapshot of an index below ``path``: written, checked for unique keys, and only then published.

    Until then, and for good if the write breaks, the index before it answers. Returns the snapshot's folder.
    """
    spark = index["canonical_document"].sparkSession
    name, folder = snapshots.new(path)
    written = {}
    for table, df in index.items():
        df.write.parquet(f"{folder}/{table}")
        written[table] = spark.read.schema(df.schema).parquet(f"{folder}/{table}")
        for key in UNIQUE.get(table, []):
            if not written[table].groupBy(*key).count().where("count > 1").isEmpty():
                raise ValueError(f"{table}: repeated {key}")
    index_metadata(written, source_sha256).coalesce(1).write.parquet(f"{folder}/index_metadata")
    snapshots.publish(spark, path, name)
    return folder


def snapshot_of(spark: SparkSession, path: str) -> str:
    """The folder of the index that counts now."""
    folder = snapshots.current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no index at {path}")
    return folder


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, value string").parquet(f"{snapshot_of(spark, path)}/index_metadata")


def index_is_fresh(spark: SparkSession, path: str, source_sha256: str) -> bool:
    """Whether an index is of this schema version and source; anything missing or unreadable is not."""
    try:
        found = {r["key"]: r["value"] for r in read_metadata(spark, path).collect()}
    except Exception:  # whatever is wrong with it, it is to be built again
        return False
    return found.get("schema_version") == SCHEMA_VERSION and found.get("source_sha256") == source_sha256


def read_index(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of one snapshot: those that are read later are of the same build, whatever is published meanwhile."""
    folder = snapshot_of(spark, path)
    return {name: spark.read.parquet(f"{folder}/{name}") for name in [*UNIQUE, "index_warning"]}


def write_documents(rows: DataFrame, path: str) -> None:
    """``json`` of each row (documento_id, json) as JSON lines in the order of the ids, in as many files as their bytes need; Spark's committer makes the output appear at once."""
    rows.select("documento_id", F.col("json").alias("value")).repartitionByRange("documento_id").sortWithinPartitions("documento_id").select("value").write.mode("overwrite").text(path)


def write_submission(rows: DataFrame, expected: DataFrame, path: str) -> None:
    """documento_id and citacoes as CSV in the order of the ids, which must be exactly the expected ones."""
    broken = sets_differ(expected, rows, "documento_id").first()
    if broken is not None:
        raise ValueError(f"{broken['problem']} document: {broken['documento_id']}")
    rows.select("documento_id", "citacoes").repartitionByRange("documento_id").sortWithinPartitions("documento_id").write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_summary(summary: DataFrame, path: str, by_document: DataFrame | None = None) -> None:
    """The summary's one row as JSON below ``path/run``, and the row of each document (documento_id, citacoes, erros) as JSON lines in the order of the ids below ``path/documents``."""
    summary.coalesce(1).write.mode("overwrite").json(f"{path}/run")
    if by_document is not None:
        by_document.repartitionByRange("documento_id").sortWithinPartitions("documento_id").write.mode("overwrite").json(f"{path}/documents")
