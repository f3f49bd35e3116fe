"""What only larger tables show: sides of joins that the driver would collect, numbers beyond a million, patterns that try too many ways."""

from __future__ import annotations

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.operators import contract, pipeline, registry, retrieve
from tessera.operators.enrich import LONG_NUMBER, typed_number
from tessera.plans import catalog, resolve
from test_queries import rows

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", ["resolve_decide", "build_index", "verify_citations", "submission_cells"])
def test_no_side_that_grows_is_broadcast(spark, monkeypatch, name):
    plans = []

    def planned(df):
        plans.extend(df._jdf.queryExecution().executedPlan().toString().splitlines())
        return df

    for module in (pipeline, registry, retrieve, resolve):
        monkeypatch.setattr(module, "settled", lambda df, *what, f=module.settled: f(planned(df), *what))
    planned(catalog.QUERIES[name](spark, SF))
    sent = [line for line in plans if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line]
    assert any("SortMergeJoin" in line for line in plans)
    assert [line for line in sent if "surface_key" not in line] == []  # the dictionary of classes does not grow


@pytest.mark.parametrize("name", ["extract_acordao", "extract_acordao_forms", "identify_mentions", "typed_numbers"])
def test_numbers_beyond_a_million_equal_sql(spark, tmp_path, name):
    db = duckdb.connect()
    for t, key, shift in (("orders", "o_orderkey", 1_799_500), ("customer", "c_custkey", 600_000)):
        db.execute(f"COPY (SELECT * REPLACE ({key} + {shift} + CASE WHEN {key} % 4 = 0 THEN 7000000 ELSE 0 END AS {key}) FROM '{SF}/{t}.parquet') TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got, wanted = catalog.QUERIES[name](spark, str(tmp_path)).toPandas(), db.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)


def test_long_numbers_are_read_in_time(spark):
    """The digits of a long number, as a pattern that shares them out in every way also finds them, and rows of digits that it would try for hours."""
    as_before = r"(?U)(?<!\w)([0-9OIlLSGg](?:[0-9OIlLSGg.\-\s]*[0-9OIlLSGg]){13,})(?!\w)"
    draw = random.Random(5)
    short = ["".join(draw.choice("0123456789OlS.- -x") for _ in range(draw.randint(14, 26))) for _ in range(400)] + ["0000001-56.2020.5.01.0001 fim", "1234567 8901234", "12345678901234x"]
    found = spark.createDataFrame([(x,) for x in short], "x string").select(F.regexp_extract("x", LONG_NUMBER, 1).alias("new"), F.regexp_extract("x", as_before, 1).alias("old")).collect()
    assert [r.new for r in found] == [r.old for r in found] and any(r.new for r in found)
    long = [("12 " * 30 + "3x", "12" * 30), ("1" * 5000, "1" * 5000), ("1" * 60 + "x", None)]
    out = spark.createDataFrame(long, "x string, digits string").select("digits", typed_number(F.col("x")).alias("n")).collect()
    assert [r.n for r in out] == [r.digits for r in out]


def test_duplicates_equal_brute_force_and_ask_in_few_places(spark):
    draw = random.Random(7)
    spans = [(d, c, a, a + draw.choice([1, 2, 3, 5, 8, 13, 31, 32, 33, 64, 90])) for d in range(6) for c in range(120) for a in [draw.randint(0, 300)]]
    df = spark.createDataFrame(spans, "doc int, citation int, inicio int, fim int")
    got = [tuple(r) for r in contract.duplicates(df, "doc").collect()]
    both = lambda a, b: max(0, min(a[3], b[3]) - max(a[2], b[2]))
    wanted = {(a[0], a[1], b[1]) for a in spans for b in spans if a[0] == b[0] and a[1] > b[1] and 2 * both(a, b) >= (a[3] - a[2]) + (b[3] - b[2]) - both(a, b)}
    assert len(got) == len(set(got)) and set(got) == wanted and len(wanted) > 100
    side = df.select("doc", "citation", F.struct("inicio", "fim").alias("s"), (F.length(F.bin(F.col("fim") - F.col("inicio"))) - 1).alias("k"))
    assert contract.asking(side).count() < 5 * len(spans)
