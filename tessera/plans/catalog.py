"""All driver queries of the library, and the SQL of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import citations, files, metric, resolve, sequences, texts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
for _module in (resolve, texts, sequences, metric, citations, files):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
