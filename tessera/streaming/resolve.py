"""Citations of a stream of documents, verified against an index at rest.

Extraction keeps no state and the index is static, so each micro-batch is a batch
run; what is written for a batch replaces an earlier attempt of the same batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.identify import identify
from tessera.operators.pipeline import verified
from tessera.sources.writers import read_index


def follow(spark: SparkSession, documents: DataFrame, index_path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Start verifying a stream of (documento_id, text) into ``out/batch=<n>``.

    The index is one snapshot for the whole query: its tables are listed once, and an index published meanwhile counts from the next start.
    """
    index = read_index(spark, index_path)

    def one(batch: DataFrame, number: int) -> None:
        verified(identify(batch.select("documento_id", "text")), index).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return documents.writeStream.option("checkpointLocation", checkpoint).foreachBatch(one).trigger(availableNow=True).start()
