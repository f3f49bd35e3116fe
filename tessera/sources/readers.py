"""Readers of the library's inputs as DataFrames."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.operators.errors import raised
from tessera.sources.files import kind_of, names, streamed_sha256

REGISTRY = "id long, documento_id string, tribunal string, ano int, relator string, natureza string, tipo string, texto string"
BIO = "id string, text string, input_ids array<int>, attention_mask array<int>, labels array<int>, offset_mapping array<array<int>>, spans string, _corrupt_record string"
ENTRIES = "map<string,array<struct<tribunal:string,classe_normalizada:string>>>"


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """``*.txt`` of a folder: documento_id (the file's stem) and text with line ends as ``\\n``. An empty folder is an error."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    if files.isEmpty():
        raise ValueError(f"no .txt in {path}")
    return files.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "").alias("documento_id"), F.regexp_replace("value", "\r\n?", "\n").alias("text"))


def read_documents(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``*.txt`` of a folder, each decoded on its own: documents (documento_id, arquivo, text; null where the bytes are no UTF-8), and an error row for each of those.

    One broken file stops no other. An empty folder is an error.
    """
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    if files.isEmpty():
        raise ValueError(f"no .txt in {path}")
    name = F.col("_metadata.file_name")
    rows = files.select(F.regexp_replace(name, r"\.txt$", "").alias("documento_id"), name.alias("arquivo"), F.is_valid_utf8("value").alias("_good"), "value")
    docs = rows.select("documento_id", "arquivo", F.when(F.col("_good"), F.regexp_replace("value", "\r\n?", "\n")).alias("text"))
    return docs, raised(rows.where("NOT _good"), "DOCUMENT_READ_ERROR", F.concat(F.lit("UnicodeDecodeError: "), F.col("arquivo"), F.lit(" is not UTF-8")))


#: The files that a model's folder must have.
MODEL_FILES = ("config.json", "model.safetensors", "tokenizer.json")


def input_faults(spark: SparkSession, database: str, input_dir: str, model: str | None = None, weights_sha256: str | None = None) -> list[tuple[str, str]]:
    """All that is wrong with the inputs of a run, as (path, fault), before any job starts; empty if nothing is.

    The weights are digested as a stream, only if everything else about the model is right.
    """
    out = []
    if kind_of(spark, database) is None or (database.endswith((".db", ".sqlite")) and kind_of(spark, database) != "file"):
        out.append((database, "registry not found"))
    if kind_of(spark, input_dir) != "folder":
        out.append((input_dir, "input folder not found"))
    elif not any(n.endswith(".txt") for n in names(spark, input_dir)):
        out.append((input_dir, "no .txt in the input folder"))
    if model is not None:
        missing = [n for n in MODEL_FILES if kind_of(spark, f"{model}/{n}") != "file"]
        out += [(f"{model}/{n}", "model file not found") for n in missing]
        if not missing and (not weights_sha256 or streamed_sha256(spark, f"{model}/{MODEL_FILES[1]}") != weights_sha256):
            out.append((f"{model}/{MODEL_FILES[1]}", "weights are not those of the approved digest"))
    return out


def check_inputs(spark: SparkSession, database: str, input_dir: str, model: str | None = None, weights_sha256: str | None = None) -> None:
    """Raise one error that lists every fault of the inputs."""
    found = input_faults(spark, database, input_dir, model, weights_sha256)
    if found:
        raise ValueError("; ".join(f"{fault}: {path}" for path, fault in found))


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header; quotes are doubled inside quoted fields, which may span lines; a byte order mark is skipped."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
    return (reader.schema(schema) if schema else reader).csv(path)


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A file whose root is an array of objects."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path, multiLine=True)


def read_json_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All ``*.json`` of a folder, one object each; none is an error."""
    rows = spark.read.schema(schema).json(path, multiLine=True, pathGlobFilter="*.json")
    if rows.isEmpty():
        raise ValueError(f"no .json in {path}")
    return rows


def read_bio(spark: SparkSession, path: str) -> DataFrame:
    """Token-label records, one JSON object a line; a bad record is an error that names its text."""
    rows = spark.read.schema(BIO).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    n = F.size("input_ids")
    good = F.col("_corrupt_record").isNull() & F.col("id").isNotNull() & F.col("text").isNotNull() & (n == F.size("attention_mask")) & (n == F.size("labels")) & (n == F.size("offset_mapping"))
    return rows.where(F.when(F.coalesce(good, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("bad token-label record: "), F.coalesce("_corrupt_record", "id", F.lit("no id")))))).drop("_corrupt_record")


def bio_tokens(records: DataFrame, labels: dict[int, str]) -> DataFrame:
    """doc_id, pos, start, end and label of each token; skipped tokens (label below 0) have a null label."""
    names = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    tokens = records.select(F.col("id").alias("doc_id"), F.posexplode(F.arrays_zip("labels", "offset_mapping")).alias("pos", "t"))
    return tokens.select("doc_id", "pos", F.element_at("t.offset_mapping", 1).alias("start"), F.element_at("t.offset_mapping", 2).alias("end"), F.try_element_at(names, F.col("t.labels")).alias("label"))


def read_class_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """surface and entries of a JSON object of surfaces."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.map_entries(F.from_json("value", ENTRIES))).alias("e")).select(F.col("e.key").alias("surface"), F.col("e.value").alias("entries"))


def metadata_index(rows: DataFrame, key: str) -> DataFrame:
    """One row per key; a repeated key keeps the greatest row."""
    others = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max(F.struct(*others)).alias("m")).select(key, "m.*")


class Range(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, schema, options):
        self.schema, self.path, self.table = schema, options["path"], options.get("dbtable", "documentos")
        self.key, self.parts = options.get("partitioncolumn", "id"), int(options.get("numpartitions", "8"))

    def connect(self) -> sqlite3.Connection:
        return sqlite3.connect(f"file:{quote(self.path)}?mode=ro", uri=True)

    def partitions(self) -> list[InputPartition]:
        with self.connect() as db:
            low, high = db.execute(f'SELECT min("{self.key}"), max("{self.key}") FROM "{self.table}"').fetchone()
        if low is None:
            return []
        step = max(1, -(-(high - low + 1) // self.parts))
        return [Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def read(self, partition: Range) -> Iterator[tuple]:
        columns = ", ".join(f'"{f.name}"' for f in self.schema)
        with self.connect() as db:
            yield from db.execute(f'SELECT {columns} FROM "{self.table}" WHERE "{self.key}" >= ? AND "{self.key}" < ?', (partition.low, partition.high))


class SqliteSource(DataSource):
    """Read-only tables of SQLite files that every executor can reach, by ranges of an integer key."""

    @classmethod
    def name(cls) -> str:
        return "tessera_sqlite"

    def schema(self) -> str:
        return REGISTRY

    def reader(self, schema) -> DataSourceReader:
        return SqliteReader(schema, self.options)


def read_registry(spark: SparkSession, path: str, parts: int = 8) -> DataFrame:
    """Rows of a registry: a SQLite file (``*.db``, ``*.sqlite``) or Parquet."""
    if path.endswith((".db", ".sqlite")):
        spark.dataSource.register(SqliteSource)
        return spark.read.format("tessera_sqlite").option("path", path).option("numPartitions", parts).load()
    return spark.read.schema(REGISTRY).parquet(path)
