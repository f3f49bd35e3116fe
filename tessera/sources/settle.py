"""Results that later plans start from."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new, unused path in the folder that all executors share; a local one is made only where the session names none and runs on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tessera/{what}-{uuid.uuid4().hex}"


def settled(df: DataFrame, what: str = "rows") -> DataFrame:
    """``df`` computed once and kept as Parquet in the shared folder: plans after it start there, read only the columns and row groups they need, and know its size."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unsent(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that grows with the data: never collected by the driver and broadcast, whatever its files say of its size.

    Sizes are estimated by compressed files and the columns read from them, which is often a tenth of the rows in memory.
    """
    return df.hint("merge")


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over as many tasks as a shuffle has: for few, short rows that cost about a millisecond each."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
