"""Shared scratch space: the folder that driver and executors both see.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``; a local
one is made only where the session names none and runs on one machine (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, what: str) -> str:
    """A new, unused path below the shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tessera/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    path = folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_schema(df: DataFrame, keep: list[str], new: dict[str, str]) -> str:
    """Schema of the ``keep`` columns of ``df`` followed by the new ones."""
    return ", ".join(f"`{c}` {t}" for c, t in [*((c, df.schema[c].dataType.simpleString()) for c in keep), *new.items()])
