"""Token counts as rollups that signed batches maintain.

A ledger is a folder. A batch of changes (insert, revise or delete of a document's
count under a tokenizer version) is compared with the entries before it and becomes
signed rows: minus what was counted, plus what is. Their sums by source, language
and tokenizer version are the batch's delta; totals are the sums of all deltas.

A batch writes its entries and its delta under a name of its own attempt, and last its
commit, a file of the next sequence number that only one writer can create. What a lost attempt
left is in no commit and never read; a committed batch is never applied again; a
writer that finds its number taken compares its changes anew with what the other
one committed. The delta is summed in each task before the shuffle, so a source with a third of all
documents is a few rows for each task. Of the entries before, only those of the documents at hand
are grouped; ``compact`` replaces all by the last of each document, so that a batch reads one
such table and the batches after it, not the whole history.

Defined results: of several changes of one document in a batch the last by
``change`` counts (ties: the greatest row); rows of one doc_id are one document;
a null doc_id is the document ``null``; a revision of an unknown document inserts
it, a deletion of one does nothing; null source or language is a group of its own;
groups without documents vanish from the totals; further columns of the changes are not
read; an empty batch commits and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.pieces import encoder, some
from tessera.llm.scratch import folder, table, written

ENTRY = "doc string, tokenizer string, source string, lang string, n_tokens long, live boolean, seq long"
DELTA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
COMMIT = "seq long, batch string, attempt string, base boolean"
GROUP = ["source", "lang", "tokenizer"]


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> list:
        """Commits in order; a folder that is not there has none, anything else unreadable is an error."""
        try:
            rows = self.spark.read.schema(COMMIT).option("mode", "FAILFAST").json(f"{self.path}/commits").orderBy("seq").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        if any(r["seq"] is None for r in rows):
            raise RuntimeError(f"a commit of {self.path} is not complete")
        return rows

    def create(self, name: str, line: str) -> bool:
        """Create a file of one line; False if it is there already."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/{name}.json")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        try:
            out = files.create(path, False)
        except Exception:
            if files.exists(path):
                return False
            raise
        out.write(bytearray(line.encode() + b"\n"))
        out.close()
        return True

    def record(self, seq: int, batch: str | None, attempt: str, base: bool) -> bool:
        return self.create(f"{seq:012d}", json.dumps({"seq": seq, "batch": batch, "attempt": attempt, "base": base}))

    def read(self, kind: str, schema: str, commits: list) -> DataFrame:
        """Rows of a kind: of the last compaction and the batches after it."""
        start = max((i for i, r in enumerate(commits) if r["base"]), default=0)
        paths = [f"{self.path}/{kind}/{r['attempt']}" for r in commits[start:]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def last(self, entries: DataFrame) -> DataFrame:
        """The last entry of each document and tokenizer version."""
        kept = entries.groupBy("doc", "tokenizer").agg(F.max_by(F.struct("source", "lang", "n_tokens", "live", "seq"), "seq").alias("e"))
        return kept.select("doc", "tokenizer", "e.*")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply ``changes`` (doc_id, tokenizer, source, lang, n_tokens, op, change); False if the batch was applied before."""
        doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
        new = changes.select(doc.alias("doc"), "tokenizer", F.struct("change", "source", "lang", "n_tokens", (F.col("op") != "delete").alias("live")).alias("e"))
        new = new.groupBy("doc", "tokenizer").agg(F.max("e").alias("e")).select("doc", "tokenizer", "e.source", "e.lang", F.when(F.col("e.live"), F.col("e.n_tokens")).otherwise(0).alias("n_tokens"), "e.live")
        while True:
            commits = self.commits()
            if any(r["batch"] == batch for r in commits):
                return False
            seq = max((r["seq"] for r in commits), default=0) + 1
            attempt = uuid.uuid4().hex
            new.withColumn("seq", F.lit(seq).cast("long")).write.parquet(f"{self.path}/entries/{attempt}")
            held = self.spark.read.schema(ENTRY).parquet(f"{self.path}/entries/{attempt}")
            old = self.last(self.read("entries", ENTRY, commits).join(held.select("doc", "tokenizer"), ["doc", "tokenizer"], "left_semi"))
            signed = old.withColumn("sign", F.lit(-1)).unionByName(held.withColumn("sign", F.lit(1))).where("live")
            delta = signed.groupBy(*GROUP).agg(F.sum("sign").alias("n_docs"), F.sum(F.col("sign") * F.col("n_tokens")).alias("n_tokens"))
            delta.write.parquet(f"{self.path}/deltas/{attempt}")
            if self.record(seq, batch, attempt, False):
                return True

    def compact(self) -> bool:
        """Replace all entries and deltas by the last entries of live documents and the totals; False if another writer came first."""
        commits = self.commits()
        attempt = uuid.uuid4().hex
        self.last(self.read("entries", ENTRY, commits)).where("live").write.parquet(f"{self.path}/entries/{attempt}")
        self.totals().write.parquet(f"{self.path}/deltas/{attempt}")
        return self.record(max((r["seq"] for r in commits), default=0) + 1, None, attempt, True)

    def totals(self) -> DataFrame:
        return self.read("deltas", DELTA, self.commits()).groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs != 0")


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, source, lang, and words and tokens of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in batches:
            for part in some(batch):
                n = np.array([len(x) // 4 for x in own.encode(part.column("text").to_pylist())], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "source", "lang")), pa.array(n)], ["doc_id", "source", "lang", "n_tokens"])

    return docs.select("doc_id", "source", "lang", "text").mapInArrow(run, "doc_id long, source string, lang string, n_tokens long")


def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over ``documents`` after inserts with a draft count, revisions to the exact one, a second version
    with the end id, of which German documents are deleted again, a compaction, deletions of documents without tokens, and a repeated batch."""
    import public_tokenizers

    counts = written(counted(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")), "counts")
    row = lambda op, n, version="byte_bpe_50k": counts.select("doc_id", F.lit(version).alias("tokenizer"), "source", "lang", n.alias("n_tokens"), F.lit(op).alias("op"), F.lit(0).alias("change"))
    ledger = Ledger(spark, folder(spark, "ledger"))
    ledger.commit("draft", row("insert", F.lit(1).cast("long")))
    ledger.commit("exact", row("revise", F.col("n_tokens")))
    ledger.commit("with end", row("insert", F.col("n_tokens") + 1, "byte_bpe_50k+end"))
    ledger.compact()
    ledger.commit("no German", row("delete", F.col("n_tokens"), "byte_bpe_50k+end").where("lang = 'de'"))
    ledger.commit("empty", row("delete", F.col("n_tokens")).where("n_tokens = 0"))
    ledger.commit("exact", row("revise", F.col("n_tokens")))
    return ledger.totals()
