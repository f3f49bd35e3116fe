"""Every query with SQL against DuckDB on the same tables, and plans that must stay native."""

from __future__ import annotations

import os

import duckdb
import pytest

from tessera.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if x is None or x != x:
        return None
    return float(x) if hasattr(x, "dtype") and x.dtype.kind == "f" else x.item() if hasattr(x, "item") else x


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(map(plain, r)) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, wanted = catalog.QUERIES[name](spark, SF).toPandas(), db.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    assert rows(got) == rows(wanted)


@pytest.mark.parametrize("name", ["resolve_decide", "lookup_multi_key", "span_match", "extract_sumula", "fold_text"])
def test_plan_is_native(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_lookup_without_anchor_meets_several_candidates(spark):
    found = catalog.QUERIES["lookup_no_anchor"](spark, SF).toPandas()
    assert len(found) == duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    assert found["n_candidates"].min() >= 1 and found["n_candidates"].max() > 1
