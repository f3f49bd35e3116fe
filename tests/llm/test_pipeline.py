"""Queries with SQL, and the pipeline stage by stage, on the smallest tables."""

from __future__ import annotations

import os
import re
from collections import defaultdict

import duckdb
import pandas as pd
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import LOREM, TEXTS, WORD, brute_groups, digest, lower, text_of, words

import corpus_pipeline
from tessera.llm import chunks, language, registry, templates
from tessera.llm.scratch import written

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted((tuple(None if pd.isna(x) else float(x) if isinstance(x, (int, np.integer, float)) and not isinstance(x, bool) else x.item() if hasattr(x, "item") else x for x in r) for r in frame.itertuples(index=False, name=None)), key=repr)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert rows(registry.QUERIES[name](spark, SF).toPandas()) == rows(db.sql(registry.ORACLES[name]).df())


def test_stages_keep_columns_and_compose(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(spark.createDataFrame([(10_001, None, None, None, None), (10_002, "", "en", "s", 0), (10_003, "12 ?", "en", "s", 4)], "doc_id long, text string, lang string, source string, n_chars long"))
    columns, before = docs.columns, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = written(stage(spark, before, SF), name)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == columns
            assert after.select("doc_id").subtract(before.select("doc_id")).isEmpty() and after.count() <= before.count()
        before = after
    kept = {r[0] for r in before.select("doc_id").collect()}
    assert kept and not kept & {10_001, 10_002, 10_003}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, before.where(F.col("doc_id") < 10_000).collect()))


def brute_language(rows, samples):
    """Texts with a letter whose best language needs MAX_PHRASE_RATE phrases a folded byte or fewer, by substring search in each lane."""
    kept = []
    for i, x in rows:
        if not x or not re.search(r"[^\W\d_]", x):
            continue
        raw = np.frombuffer(x.encode(), dtype=np.uint8)
        data = language.folded(raw, np.array([0, len(raw)]))[0].tobytes()
        counts = []
        for _, sample in samples:
            n = 0
            for lane in (data[k : k + language.LANE] for k in range(0, len(data), language.LANE)):
                at = 0
                while at < len(lane):
                    size = 1
                    while at + size < len(lane) and lane[at : at + size + 1] in sample:
                        size += 1
                    n, at = n + 1, at + size
            counts.append(n)
        if min(counts) / len(data) <= corpus_pipeline.MAX_PHRASE_RATE:
            kept.append((i, x))
    return kept


def brute_lines(rows):
    """Texts without the lines that an earlier document's template covers, line by line."""
    depth, parsed = templates.DEPTH, []
    for i, x in rows:
        for pos, line in enumerate(x.split("\n")):
            raw = words(line)
            w = ["<*>" if re.search("[0-9]", y) else y for y in raw]
            if not raw:
                continue
            own = w if len(w) <= depth else w[depth:]
            same = tuple(raw) if all(y == "<*>" for y in own) else tuple(w)
            leaf = same if len(w) <= depth else (len(w), *w[:depth])
            parsed.append((i, pos, leaf, same, w[depth:] if len(w) > depth and set(own) != {"<*>"} else None))
    first, branch = {}, {}
    for i, pos, leaf, same, _ in sorted(parsed, key=lambda r: r[:2]):
        first.setdefault((leaf, same), (i, pos))
    vary = {(leaf, same): rest for _, _, leaf, same, rest in parsed if rest is not None}
    branches = lambda leaf, rest: [(leaf, -1), *((leaf, k, *(rest[templates.place(k, j) % len(rest)] for j in range(templates.PLACES))) for k in range(templates.BRANCHES))]
    for (leaf, same), rest in sorted(vary.items(), key=lambda kv: first[kv[0]]):
        for key in branches(leaf, rest):
            branch.setdefault(key, (leaf, same))
    of = {}
    for group, at in first.items():
        of[group] = at[0]
        if group in vary:
            for key in branches(group[0], vary[group]):
                t = branch[key]
                pairs = list(zip(vary[group], vary[t]))
                constant = sum(a != "<*>" or b != "<*>" for a, b in pairs)
                if first[t][0] < at[0] and templates.OF * sum(a == b != "<*>" for a, b in pairs) >= templates.AGREE * constant:
                    of[group] = min(of[group], first[t][0])
    drop = defaultdict(set)
    for i, pos, leaf, same, _ in parsed:
        if i > of[leaf, same]:
            drop[i].add(pos)
    out = [(i, "\n".join(y for k, y in enumerate(x.split("\n")) if k not in drop[i]), bool(drop[i])) for i, x in rows]
    return [(i, x) for i, x, fell in out if not fell or words(x)]


def brute_clean(rows, items):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = [v[k : k + 10] for v in (words(lower(x), pattern) for x in items) for k in range(max(len(v) - 9, 1) if v else 0)]
    hit = lambda w: any(w[s : s + len(v)] == v for v in windows for s in range(len(w) - len(v) + 1) if w[s] == v[0])
    return [(i, x) for i, x in rows if not hit(words(lower(x), pattern))]


def test_pipeline_equals_brute_force(spark, tmp_path):
    passage = "\n".join(text_of(60 + k, 14) for k in range(5))
    more = [
        (300, passage + "\nclosing words of document three hundred"),
        (301, passage.replace("1", "7") + "\nclosing words of the next document"),
        (302, passage),
        *[(310 + k, text_of(3, 80).replace(LOREM[4], f"other{'abc'[k % 3]}", k)) for k in range(6)],
        (320, text_of(9, 40) + " " + " ".join(text_of(2).split()[20:34])),
        (321, "qzx jkv wqp zxj kkq vzw " * 20),
        (322, "   \n\n "),
    ]
    rows = [(i, x) for i, x in {**dict(TEXTS), **dict(more)}.items()]
    frame = spark.createDataFrame([(i, x, None if i == 321 else "en" if i % 2 else "xx", "s", 0, "clash") for i, x in rows], "doc_id long, text string, lang string, source string, n_chars long, n_dropped string")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, " ".join(text_of(2).split()[18:36])), (2, None), (3, "five words of an item"), (3, "five words of an item")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = brute_language(rows, language.learn(frame))
    assert 0 < len(want) < len(rows)
    want = brute_lines(want)
    groups = brute_groups(want, 5, 80)
    want = [(i, x) for i, x in want if groups[i][1] == i]
    want = brute_clean(want, [x for _, x in items])
    library = chunks.tokenizer(WORD)
    want = sorted((i, *digest(ids := library.encode(x, add_special_tokens=False).ids, library.decode(ids, skip_special_tokens=False))) for i, x in want)
    assert {1, 300, 310} <= {r[0] for r in want} and not {302, 320, 321, 322} & {r[0] for r in want}
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect())) == want


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
