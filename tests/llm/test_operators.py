"""The training-data operators against brute force on small fixtures, with nulls, empty and very long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from tessera.llm import cascade, chunks, contamination, html, kernels, language, neardup, pieces, quality, registry, rollup, sstable, templates
from tessera.llm.pieces import Encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
LOREM = "the quick brown fox jumps over the lazy dog while seven small birds sing near an old stone wall and a river runs slowly past the mill".split()
ODDITIES = ["a\x1c b", "x²3 y½4", "l'eau d'été, \"q\"...  \n\n\t z <|endoftext|> b", "  lead", "trail  ", "ab,cd;ef's I'm don't", "日本語 テスト，word。", "áb c d e", "x\x85y", "ÀÉ_z", "４５６ 456abc", "\x00", "İstanbul ß ﬁ"]


def text_of(k: int, n: int = 60) -> str:
    return " ".join(LOREM[(k * 7 + i * (k % 5 + 1) + i * i) % len(LOREM)] + str((k + i) % 3) for i in range(n))


TEXTS = [
    (1, text_of(1)),
    (2, text_of(1)),
    (3, text_of(1) + " tail"),
    (4, text_of(2)),
    (5, None),
    (6, ""),
    (7, "one two"),
    (8, "one two"),
    (9, "Word " * 30_000),
    (10, "\n".join(["An identical line of seven words here"] * 3 + ["", "   "])),
    (11, "An identical line of seven words here\nother text that stands alone in this document"),
    (12, "Error 17 at host alpha while reading block 4 of the file today"),
    (13, "Error 99 at host alpha while reading block 8 of the file today\nkept"),
    (13, "Error 99 at host alpha while reading block 8 of the file today\nkept"),
    *[(100 + i, x) for i, x in enumerate(ODDITIES)],
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, x, "en" if i % 2 else None, None if i == 4 else "s", 0, "clash") for i, x in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")


def lower(text):
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


def test_kernel_words_and_hashes():
    arr = pa.array([x for _, x in TEXTS])
    seen = {}
    for piece in kernels.slices(arr, 1000):
        s, e, bounds = piece.spans(kernels.NOT_SPACE[piece.buf])
        h = piece.hashes(piece.prefix(lower=False), s, e)
        for i in range(piece.rows):
            own = words(TEXTS[piece.first + i][1])
            assert len(own) == bounds[i + 1] - bounds[i]
            for w, x in zip(own, h[bounds[i] : bounds[i + 1]].tolist()):
                assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_encoder_equals_library():
    own = Encoder(BYTE)
    texts = [x for _, x in TEXTS] * 2
    for x, got in zip(texts, own.encode(texts)):
        want = own.library.encode(x or "", add_special_tokens=False).ids
        assert got == b"".join(i.to_bytes(4, "little") for i in want)


def test_token_shards(spark, docs, tmp_path):
    path = f"file://{tmp_path}/shards"
    manifest = sstable.write(docs, path, BYTE)
    got = sorted(map(tuple, sstable.read(manifest, path).collect()))
    own, start, want = Encoder(BYTE), 0, []
    for i, x in sorted(TEXTS, key=lambda r: (r[0], r[1] or "")):
        ids = [*own.library.encode(x or "", add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(b"".join(k.to_bytes(4, "little") for k in ids))))
        start += len(ids)
    assert got == sorted(want)
    by_id = {i: [*own.library.encode(x or "", add_special_tokens=False).ids, 2] for i, x in TEXTS}
    for shard in manifest.collect():
        reader = sstable.Reader(open(f"{tmp_path}/shards/{shard['file']}", "rb"))
        for i, ids in by_id.items():
            found = reader.get(i)
            assert (found is not None) == (shard["first"] <= i <= shard["last"]) and (found is None or found.tolist() == ids)
        assert reader.get(987654321) is None and reader.get(None) is None
    (tmp_path / "shards" / "lost.sst").write_bytes(b"x")
    assert sstable.sweep(manifest, path) == 1 and sstable.read(manifest, path).count() == len(TEXTS)
    assert sstable.read(sstable.write(docs.where("false"), path, BYTE), path).count() == 0


def test_shards_follow_bytes_and_spread_one_id(spark, tmp_path):
    path = f"file://{tmp_path}/many"
    rows = spark.createDataFrame([(7, text_of(k, 30)) for k in range(400)] + [(k, "x") for k in (1, 9)], "doc_id long, text string")
    manifest = sstable.write(rows, path, BYTE, shard_bytes=20_000)
    got = sstable.read(manifest, path).orderBy("start").collect()
    assert manifest.count() > 3 and [r["doc_id"] for r in got] == [1] + [7] * 400 + [9]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in itertools.pairwise(got))
    with pytest.raises(Exception, match="does not fit"):
        sstable.write(rows, path, BYTE, width=1).count()


def test_bloom_filter_and_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(sstable, "BLOCK_BYTES", 500)
    import numpy as np

    writer = sstable.Writer(open(tmp_path / "s", "wb"), 4)
    for k in range(0, 4000, 2):
        writer.add(sstable.key_of(k, 0), np.arange(k % 7, dtype=np.uint32))
    writer.close()
    reader = sstable.Reader(open(tmp_path / "s", "rb"))
    assert len(reader.first) > 50 and reader.entries == 2000
    assert all(reader.get(k).tolist() == list(range(k % 7)) for k in range(0, 4000, 20))
    passed = sum((reader.filter[(at := sstable.probes(np.array([sstable.key_hash(sstable.key_of(k, 0))], dtype=np.uint64), 8 * len(reader.filter)).ravel().astype(np.int64)) >> 3] >> (at & 7) & 1).all() for k in range(1, 4000, 2))
    assert passed < 100 and all(reader.get(k) is None for k in range(1, 4000, 40))


def test_null_key_sorts_first(spark, tmp_path):
    path = f"file://{tmp_path}/nulls"
    rows = spark.createDataFrame([(None, "a"), (-5, "b"), (None, "c"), (3, None)], "doc_id long, text string")
    got = [(r["doc_id"], r["start"]) for r in sstable.read(sstable.write(rows, path, BYTE), path).orderBy("start").collect()]
    assert [i for i, _ in got] == [None, None, -5, 3] and [s for _, s in got] == [0, 2, 4, 6]


def brute_base(x):
    w = words(x)
    seen = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    inside = {k + j for k in range(len(w) - 7) if seen[tuple(w[k : k + 8])] > 1 for j in range(8)}
    lines, again = set(), 0
    for line in (x or "").split("\n"):
        if words(line):
            again += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x or "")), again, len(inside)


def test_quality(spark, docs, nothing):
    got = quality.judge(docs, None, ["doc_id", "text"]).collect()
    for r in got:
        assert tuple(r[c] for c in quality.COUNTS) == brute_base(r["text"])
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) and r["kept"] == (not r["base_failed"])
    assert quality.judge(nothing, None, ["doc_id"]).count() == 0


def test_equal_hashes_of_powers_of_two_are_no_repeats(spark):
    bits = lambda k: "".join("ab"[(i.bit_count() + k) & 1] for i in range(4096))
    rows = spark.createDataFrame([(1, bits(0) + "\n" + bits(1) + "\n" + bits(0), "clash")], "doc_id long, text string, kept string")
    assert quality.judge(rows, None, ["doc_id", "kept"]).first()["n_dup_lines"] == 1


def test_quality_model_tells_held_out_rows(spark):
    good = [(i, text_of(i), 1) for i in range(300)]
    bad = [(1000 + i, text_of(i).upper().replace(" ", "!! "), 0) for i in range(100)]
    rows = spark.createDataFrame(good[:200] + bad[:70], "doc_id long, text string, quality int")
    model = quality.train(rows.select("doc_id", "text"), rows.select("doc_id", "quality", F.lit("clash").alias("text")))
    held = spark.createDataFrame(good[200:] + bad[70:], "doc_id long, text string, quality int")
    out = quality.judge(held, model, ["doc_id", "quality"]).collect()
    assert sum((r["p_good"] >= quality.KEEP) == (r["quality"] == 1) for r in out) >= 0.95 * len(out)
    assert 0.001 < min(r["p_good"] for r in out) < 0.3 and 0.7 < max(r["p_good"] for r in out) < 0.9999
    assert quality.train(rows.select("doc_id", "text"), rows.where("false").select("doc_id", "quality")) is None


def test_url_rules(spark):
    urls = ["http://a.example.net/en/x", "http://example.net/EN/", "https://B.Example.COM/de/1?q", "http://x.org/fr/", "http://x.org/fr", "http://net", "http://net/", None, "no scheme", "", "http://", "ftp://evil.casino-win.io/a", "http://example.net", "a://b://c/d", "http://x.org/fr/" + "y" * 300_000, "http://" + "a." * 9_000 + "net/"]
    pages = spark.createDataFrame([(i, u, "clash", 1, "p", "r", "c") for i, u in enumerate(urls + urls)], "page_id long, url string, verdict string, host int, path string, rule string, `candidates.x` string")
    judged = cascade.judge(pages, cascade.BLOCK_RULES, cascade.ALLOW_RULES, cascade.BLOCKED_LABELS)
    assert judged.columns == ["page_id", "url", "candidates.x", "host", "path", "rule", "verdict"]
    got = cascade.judge(pages, cascade.BLOCK_RULES, cascade.ALLOW_RULES, cascade.BLOCKED_LABELS).collect()
    for r in got:
        rest = (r["url"] or "").partition("://")[2] if "://" in (r["url"] or "") else ""
        host = lower(re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [x for x in cascade.BLOCK_RULES + cascade.ALLOW_RULES if (host == x.partition("/")[0] or host.endswith("." + x.partition("/")[0])) and path.startswith("/" + x.partition("/")[2])]
        rule = max(fits, key=len, default=None)
        verdict = ("block" if rule in cascade.BLOCK_RULES else "allow") if rule else "block" if set(host.split(".")) & set(cascade.BLOCKED_LABELS) else "allow"
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict), r["url"]


def test_cascade_is_exact(spark):
    universe = spark.range(5000).select(F.xxhash64("id").alias("h"))
    listed = spark.range(0, 5000, 7).select(F.xxhash64("id").alias("h"))
    levels = cascade.build(universe, listed)
    assert len(levels) > 1
    keys = [r["h"] for r in universe.collect()]
    import numpy as np

    assert {k for k, m in zip(keys, cascade.member(levels, np.array(keys))) if m} == {r["h"] for r in listed.collect()}
    assert cascade.build(universe, listed.where("false")) == []


def test_url_shards_agree(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 9}.example.net/{'en/' if i % 2 else ''}{i}") for i in range(60)], "page_id long, url string")
    args = (cascade.BLOCK_RULES, cascade.ALLOW_RULES, cascade.BLOCKED_LABELS)
    whole = sorted(map(tuple, cascade.judge(pages, *args).collect()))
    listed = spark.createDataFrame([("h3",), ("h3",), (None,), ("nobody",)], "label string")
    tabled = {r["url"]: r["verdict"] for r in cascade.judge(pages, [], [], listed).collect()}
    assert all((v == "block") == ("//h3." in u) for u, v in tabled.items()) and "block" in tabled.values()
    assert cascade.judge(pages.where("false"), *args).count() == 0
    monkeypatch.setattr(cascade, "MAX_BITS", 128)
    assert sorted(map(tuple, cascade.judge(pages, *args).collect())) == whole


def test_contamination(spark, docs, nothing, monkeypatch):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    items = [(1, text_of(2)[20:200]), (2, "one two"), (3, None), (4, ""), (5, text_of(40)), (2, "one two"), (6, "ERROR 17 at host"), (10, "！？")]
    bench = spark.createDataFrame([(i, x, 1) for i, x in items], "item_id long, text string, doc_id long")

    def brute(x):
        w = words(lower(x), pattern)
        hit, names = set(), set()
        for i, y in items:
            v = words(lower(y), pattern)
            for k in range(max(len(v) - 9, 1) if v else 0):
                win = v[k : k + 10]
                for s in (s for s in range(len(w) - len(win) + 1) if w[s] == win[0]):
                    if w[s : s + len(win)] == win:
                        hit |= set(range(s, s + len(win)))
                        names.add(str(i))
        return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)

    clash = docs.withColumn("n_hit", F.lit("x"))
    for limit in (200_000, 5):
        monkeypatch.setattr(contamination, "CHUNK_WINDOWS", limit)
        for r in contamination.contamination(clash, bench, ["text", "n_hit"]).collect():
            assert tuple(r)[1:] == brute(r["text"]), r["text"]
    assert contamination.contamination(nothing, bench, ["doc_id"]).count() == 0
    assert contamination.contamination(docs, bench.where("false"), ["doc_id"]).where("contaminated").count() == 0


def test_line_templates(spark, docs, nothing):
    rows = {(r["doc_id"], r["text"]): r for r in templates.drop_recurring(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()}
    by = {i: [r for (k, _), r in rows.items() if k == i] for i, _ in TEXTS}
    assert by[1][0]["n_dropped"] == 0 and by[2][0]["n_dropped"] == 1 and by[2][0]["text"] == ""
    assert by[10][0]["n_dropped"] == 0 and by[11][0]["text"] == "other text that stands alone in this document"
    assert by[12][0]["n_dropped"] == 0 and all(r["text"] == "kept" for r in by[13])
    assert by[5][0]["text"] is None and by[5][0]["n_lines"] == 0 and by[6][0]["n_lines"] == 1
    assert templates.drop_recurring(docs).count() == len(TEXTS) and templates.drop_recurring(nothing).count() == 0
    plan = templates.drop_recurring(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def kept_lines(spark, *texts):
    rows = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    return [r["text"] for r in templates.drop_recurring(rows).orderBy("doc_id").collect()]


def test_short_and_variable_lines_need_real_equality(spark):
    first = "Anthnt that erndatou eawhing anstou, thou st.\none two three four five\n1 2 3 4 5 6"
    second = "Anthnt that erndatou eawhing reaned inesre and.\none two three four six\n9 8 7 6 5 4"
    assert kept_lines(spark, first, second, first) == [first, second, ""]


def test_long_lines_match_any_template_of_a_leaf_by_words(spark):
    words = [f"{a}{b}" for a in "abcdefghij" for b in "klmnopqrst"][:60]
    changed = lambda at, mark: " ".join(mark + w if i in at else w for i, w in enumerate(words))
    other = " ".join([*words[:4], *(w[::-1] for w in words[4:])])
    first, near, again = changed((), "x"), changed((5, 15, 25, 35, 45), "x"), other + "x"
    assert kept_lines(spark, first, near, other, again) == [first, "", other, ""]


def test_short_lines_recur_and_blank_rests_go(spark):
    first = "All rights reserved.\nPage 3\n7 8\nan own line of the first document"
    assert kept_lines(spark, first, "All rights reserved.\nPage 4\n9 8\n\n7 8") == [first, "9 8\n"]
    import corpus_pipeline

    rows = spark.createDataFrame([(1, first), (2, "All rights reserved.\n\n  \nPage 5"), (3, " \n"), (4, None)], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.without_repeated_lines(spark, rows, "").collect()} == {1, 3, 4}


def test_a_leaf_holds_several_templates_and_ties_go_to_the_first(spark):
    lead = "connection of user with "
    first = lead + "an entirely different rest of the line that nobody else writes here"
    log = lambda k: lead + f"name{'x' * k} was closed by the remote side after {k} seconds of silence"
    texts = [first, *(log(k) for k in range(6)), "Share this on Facebook"]
    assert [len(x.split()) for x in texts[:7]] == [len(texts[0].split())] * 7
    assert kept_lines(spark, *texts, texts[-1], texts[-1]) == [first, log(0), "", "", "", "", "", "Share this on Facebook", "", ""]
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f\n\nown")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["text"]) for r in templates.drop_recurring(twice).collect())
    assert got == [("1", ""), ("1", ""), ("2", "\nown"), ("None", "a b c d e f")]
    clash = twice.withColumn("n_lines", F.lit("x"))
    assert {r["n_lines"] for r in templates.drop_recurring(clash).collect()} == {1, 3}


def brute_groups(rows, size, percent):
    sets = {}
    for i, x in rows:
        w = words(lower(x))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_duplicates(spark, docs, nothing):
    rows = [(i, x) for i, x in TEXTS if i != 9] + [(500 + k, text_of(3, 200).replace("2 ", f"{k % 4}x ", k % 30)) for k in range(150)]
    want = brute_groups(rows, 3, 85)
    frame = spark.createDataFrame([(i, x, "clash") for i, x in rows], "doc_id long, text string, component_id string")
    got = neardup.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    assert neardup.near_duplicates(nothing).count() == 0
    lone = spark.createDataFrame([(None, text_of(1)), (1, text_of(1)), (None, None)], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in neardup.near_duplicates(lone).collect()) == [("1", "1"), ("None", "1"), ("None", "None")]


def test_components_of_a_long_path(spark):
    edges = spark.range(1, 60).select((F.col("id") - 1).alias("a"), F.col("id").alias("b")).union(spark.createDataFrame([(100, 101)], "a long, b long"))
    got = {r["node"]: r["component"] for r in neardup.components(edges).collect()}
    assert got == {**{i: 0 for i in range(60)}, 100: 100, 101: 100}


def test_rollup(spark, tmp_path):
    ledger = rollup.Ledger(spark, f"file://{tmp_path}/ledger")
    change = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, tokenizer string, source string, lang string, n_tokens long, op string, change int")
    assert ledger.totals().count() == 0
    assert ledger.commit("a", change((1, "v1", "s", "en", 10, "insert", 0), (2, "v1", "s", None, 5, "insert", 0), (3, "v1", "t", "en", 7, "insert", 0), (3, "v1", "t", "en", 8, "insert", 1)))
    assert not ledger.commit("a", change((1, "v1", "s", "en", 99, "revise", 0)))
    assert ledger.commit("b", change((1, "v1", "s", "fr", 4, "revise", 0), (3, "v1", "t", "en", 0, "delete", 0), (9, "v1", "t", "en", 0, "delete", 0), (2, "v2", "s", None, 6, "insert", 0), (None, "v1", "s", None, 1, "insert", 0)))
    got = {tuple(r) for r in ledger.totals().collect()}
    assert got == {("s", "fr", "v1", 1, 4), ("s", None, "v1", 2, 6), ("s", None, "v2", 1, 6)}
    assert ledger.commit("empty", change().where("false"))
    assert {tuple(r) for r in ledger.totals().collect()} == got


def test_ledger_is_safe_against_others_and_compacts(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/ledger"
    ledger, other = rollup.Ledger(spark, path), rollup.Ledger(spark, path)
    change = lambda *rows: spark.createDataFrame(list(rows), "doc_id long, tokenizer string, source string, lang string, n_tokens long, op string, change int")
    assert ledger.commit("a", change((1, "v", "s", "en", 10, "insert", 0), (2, "v", "s", "en", 5, "insert", 0)))
    honest, met = ledger.commits, []

    def late():
        seen = honest()
        if not met:  # another writer commits between what this one reads and what it writes
            met.append(other.commit("b", change((1, "v", "s", "en", 70, "revise", 0))))
        return seen

    monkeypatch.setattr(ledger, "commits", late)
    assert ledger.commit("c", change((1, "v", "s", "en", 3, "revise", 0))) and met == [True]
    monkeypatch.undo()
    assert [r["batch"] for r in ledger.commits()] == ["a", "b", "c"] and {tuple(r) for r in ledger.totals().collect()} == {("s", "en", "v", 2, 8)}
    assert ledger.compact() and {tuple(r) for r in ledger.totals().collect()} == {("s", "en", "v", 2, 8)}
    assert not ledger.commit("b", change((1, "v", "s", "en", 70, "revise", 0)))
    assert ledger.commit("d", change((2, "v", "s", "en", 0, "delete", 0))) and {tuple(r) for r in ledger.totals().collect()} == {("s", "en", "v", 1, 3)}
    (tmp_path / "ledger" / "commits" / "000000000099.json").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed|complete"):
        ledger.totals().count()


def test_token_rollup_query_equals_brute_force(spark, docs, tmp_path):
    docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "de").otherwise(F.col("lang"))).write.parquet(f"{tmp_path}/documents.parquet")
    library, want = Encoder(BYTE).library, Counter()
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{tmp_path}/documents.parquet").collect()}
    for r in rows.values():
        n = len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        if n:
            want[r["source"], r["lang"], "byte_bpe_50k", "n"] += 1
            want[r["source"], r["lang"], "byte_bpe_50k", "t"] += n
        if r["lang"] != "de":
            want[r["source"], r["lang"], "byte_bpe_50k+end", "n"] += 1
            want[r["source"], r["lang"], "byte_bpe_50k+end", "t"] += n + 1
    got = Counter()
    for r in registry.QUERIES["op7_token_rollup"](spark, str(tmp_path)).collect():
        got[r["source"], r["lang"], r["tokenizer"], "n"] += r["n_docs"]
        got[r["source"], r["lang"], r["tokenizer"], "t"] += r["n_tokens"]
    assert got == want


def test_counted(docs):
    library = Encoder(BYTE).library
    for r, (_, x) in zip(sorted(rollup.counted(docs, BYTE).collect(), key=lambda r: r["doc_id"]), sorted(TEXTS, key=lambda r: r[0])):
        assert r["n_tokens"] == len(library.encode(x or "", add_special_tokens=False).ids)


PAGES = {
    "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title &amp; more</h1><p>One <b>bold</b>ed\n text.<p>Two &eacute;</article><footer>foot</footer></body>": "Title & more One bolded text. Two é",
    "": "",
    None: "",
    "<script>var a='<p>no</p>'</script>": "",
    "<div>We use cookies</div><article><p>" + "Long text. " * 20 + "</p><p>End.</p></article><div><p>I liked it</p></div>": ("Long text. " * 20).strip() + " End.",
    "<main><p>Short.</p></main><aside>Side</aside><form>Name</form><!-- <p>no</p> -->": "Short.",
    "just text": "just text",
    "<p>unclosed <nav>menu words": "unclosed menu words",
    "<article><p>a&nbsp;&#65;&lt;p&gt;</p></article>": "a A<p>",
}


def test_main_text(spark):
    pages = spark.createDataFrame([(i, "u", p, "clash") for i, p in enumerate(list(PAGES) * 2)], "page_id long, url string, html string, text string")
    for r in html.extract(pages, ["page_id", "html"]).collect():
        assert r["text"] == PAGES[r["html"]] and r["n_chars"] == len(r["text"])
    assert html.main_text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"


def test_window_sums_decide_beside_article_marks():
    long = lambda w: " ".join([w] * 60)
    several = f"<article><p>{long('one')}</p></article><p>Between.</p><article><h2>Two</h2><p>{long('two')}</p><ul><li><a href='/'>a</a><li><a href='/'>b</a><li><a href='/'>c</a></ul><p>End.</p></article>"
    assert html.main_text(several) == f"{long('one')} Two {long('two')} End."
    outside = f"<article><p>Note.</p></article><p>{'<a href=x>more</a></p><p>' * 4}</p><div><p>{long('text')}</p></div>"
    assert html.main_text(outside) == long("text")
    assert html.main_text("<article><p>Note.</p></article><p>Short rest</p>") == "Note."


def brute_ranges(weights):
    """Blocks by the definition: a line belongs to one if there is a surge at or before it and no dive since."""
    total = [sum(weights[i : i + html.WINDOW]) for i in range(len(weights))]
    surge = [w > 0 and t > html.SURGE for w, t in zip(weights, total)]
    inside = [any(surge[s] and all(total[s + 1 : i + 1]) for s in range(i + 1)) for i in range(len(weights))]
    starts = [i for i, x in enumerate(inside) if x and (not i or not inside[i - 1])]
    return [(s, next((i for i in range(s, len(weights)) if not inside[i]), len(weights))) for s in starts]


def brute_kept(weights):
    ranges = brute_ranges(weights)
    sums = [sum(weights[a:b]) for a, b in ranges]
    kept = {i for (a, b), n in zip(ranges, sums) if html.SHARE * n >= max(sums) for i in range(a, b)}
    return [w > 0 and (i in kept or not ranges) for i, w in enumerate(weights)]


def test_block_distribution_equals_brute_force():
    r = random.Random(11)
    for _ in range(300):
        sizes = [r.choice([0, 0, 0, 2, 10, 30, 60, 120, 900]) for _ in range(r.randrange(1, 25))]
        assert html.blocks([("x", n, 0) for n in sizes]) == brute_ranges(sizes)
        page = "".join(f"<p>{('w%d' % i + 'x' * 999)[:n]}</p>" if n else "<p><a href='/'>link</a></p>" for i, n in enumerate(sizes))
        want = [("w%d" % i + "x" * 999)[:n] for i, n in enumerate(sizes) if brute_kept(sizes)[i]]
        assert html.main_text(page) == " ".join(want)


class Brute(HTMLParser):
    """Lines of a well-formed page by the definition, with a stack of open elements: text, length, article, whether it weighs."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.out, self.text, self.linked, self.articles = [], [], "", 0, 0

    def flush(self):
        text = " ".join(self.text.split())
        if text:
            article = next((n for tag, n in self.open if tag == "article"), 0)
            bad = any(tag in html.BOILERPLATE or (tag == "header" and not article) for tag, _ in self.open) or sum(tag == "article" for tag, _ in self.open) > 1
            if not bad:
                self.out.append((text, 0 if 2 * self.linked > len(text) else len(text), article))
            elif self.out and self.out[-1][1]:  # a whole element of boilerplate is one line without text
                self.out.append(("", 0, article))
        self.text, self.linked = "", 0

    def handle_starttag(self, tag, attrs):
        if tag not in html.INLINE:
            self.flush()
        if tag == "article" and not any(t == "article" for t, _ in self.open):
            self.articles += 1
        if tag not in ("br", "img", "hr"):
            self.open.append((tag, self.articles))

    def handle_endtag(self, tag):
        if tag not in html.INLINE:
            self.flush()
        self.open.pop()

    def handle_data(self, data):
        if not any(t in ("script", "style") for t, _ in self.open):
            self.text += data
            self.linked += len(data) * any(t == "a" for t, _ in self.open)

    def main(self):
        self.flush()
        rows, marked = self.out, any(w and a for _, w, a in self.out)
        weights = [w and ((w + html.MARK if a else max(1, w // html.WINDOW)) if marked else w) for _, w, a in rows]
        groups, ranges = {}, []
        for i, (_, _, a) in enumerate(rows):  # a line outside starts a new group after each article
            groups.setdefault((a, a or sum(1 for k in range(i) if rows[k][2] and (k + 1 == len(rows) or rows[k + 1][2] != rows[k][2]))), []).append(i)
        for (a, _), own in groups.items():
            found = brute_ranges([weights[i] for i in own])
            ranges += [own] if a and found else [own[s:e] for s, e in found]
        sums = [sum(weights[i] for i in x) for x in ranges]
        kept = {i for x, n in zip(ranges, sums) if html.SHARE * n >= max(sums) for i in x}
        if not kept:
            kept = {i for i, w in enumerate(weights) if w and rows[i][2]} or set(range(len(rows)))
        return " ".join(rows[i][0] for i in sorted(kept) if weights[i])


def random_page(r):
    words = lambda n: " ".join(r.choice(["alpha", "b&amp;c", "d&eacute;", "<b>bold</b>", "e\n f", "x&#65;", "&lt;p&gt;"]) for _ in range(n))
    para = lambda: f"<p>{words(r.choice([1, 3, 8, 30, 90]))}</p>"
    links = lambda: "<ul>" + "".join(f"<li><a href='/{i}'>{words(2)}</a></li>" for i in range(r.randrange(1, 6))) + "</ul>"
    inner = lambda: "".join(r.choice([para, para, para, links, lambda: f"<aside>{para()}</aside>", lambda: f"<header><h1>{words(4)}</h1></header>", lambda: f"<h2>{words(3)}</h2>", lambda: "<script>var a = 1;</script>", lambda: f"<article><p>{words(12)}</p></article>"])() for _ in range(r.randrange(1, 9)))
    outer = [lambda: f"<nav>{links()}</nav>", lambda: f"<header><p>{words(5)}</p></header>", lambda: f"<footer><p>{words(9)}</p></footer>", lambda: f"<div>{words(7)}</div>", lambda: f"<form><p>{words(6)}</p></form>", links, para, lambda: "<!-- <p>no</p> -->"]
    body = [r.choice(outer)() for _ in range(r.randrange(0, 8))] + [f"<article>{inner()}</article>" for _ in range(r.randrange(0, 3))]
    r.shuffle(body)
    return f"<html><head><style>p {{ margin: 0 }}</style></head><body>{''.join(body)}</body></html>"


def test_whole_pages_equal_brute_force():
    r, changed = random.Random(5), 0
    for _ in range(400):
        page = random_page(r)
        brute = Brute()
        brute.feed(page)
        brute.close()
        got = html.main_text(page)
        assert got == brute.main(), page
        changed += got != " ".join(t for t, w, _ in html.lines(page) if w)
    assert changed > 100  # the sums decide on many of them


def test_many_unclosed_elements_take_linear_time():
    import time

    began = time.time()
    assert html.main_text("<nav>" * 50_000 + "x" * 10) == "x" * 10
    assert time.time() - began < 20


def test_names_of_classes_decide_nothing():
    text = " ".join(["text"] * 60)
    for name in ("content-sidebar-wrap", "page has-sidebar", "sidebar", "comments", "header", "ad"):
        for inner in (f"<article><p>{text}</p></article>", f"<main><p>{text}</p></main>", f"<p>{text}</p>"):
            assert html.main_text(f"<div class='{name}'>{inner}</div>") == text, (name, inner)
    assert html.main_text(f"<form id='aspnet'><article><p>{text}</p></article></form>") == text
    readers = f"<article><p>{text} {text}</p><article><p>{text[:200]}</p></article></article><div><p>Buy it now, {text[:100]}</p></div>"
    assert html.main_text(readers) == f"{text} {text}"


def digest(ids, decoded):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(decoded)


def test_chunked_bpe(spark, docs, nothing, tmp_path):
    library = chunks.tokenizer(WORD)
    for r in chunks.digests(chunks.encode(docs.withColumn("ids", F.lit(1)), WORD, ["text", "ids"])).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == digest(ids, library.decode(ids, skip_special_tokens=False))
    assert chunks.encode(nothing, WORD, ["doc_id"]).count() == 0
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op9_chunked_bpe"](spark, str(tmp_path)).collect()
    whole = {x: digest(i := library.encode(x or "", add_special_tokens=False).ids, library.decode(i, skip_special_tokens=False)) for _, x in TEXTS}
    assert sorted(tuple(r) for r in got) == sorted((i, *whole[x]) for i, x in TEXTS)


def decoded(codec, ids):
    return codec.decode(pa.array([[int.from_bytes(ids[k : k + 4], "little") for k in range(0, len(ids), 4)]], pa.list_(pa.int32())))[0].as_py()


def odd_texts(seed, n=4000):
    """Texts of letters, marks, white space and signs from all of Unicode."""
    r = random.Random(seed)
    kinds = ["abcdeéñİISTZßïœ", " \t\n\r\x0b\x0c   ", ".,;:!?'\"()[]-_*&%$#@/\\|`~^<>{}0123456789", "\u0307\u0301\u200b\u3000\u2003\xa0\x85\x1c\x1f\u2028\u180eÀ'", ["<|endoftext|>", "<|startoftext|>", "'s", "'RE"]]

    def char():
        k = r.randrange(8)
        if k < 5:
            return r.choice(kinds[k])
        c = r.randrange(0x20, 0x3000 if k < 7 else 0x110000)
        return "x" if 0xD800 <= c < 0xE000 else chr(c)

    return ["".join(char() for _ in range(r.randrange(60))) for _ in range(n)] + ["HEPSİ.", "GELDİ, GİTTİ!", "İ,", "İ"]


def test_ids_equal_the_library_over_all_of_unicode(monkeypatch):
    texts = odd_texts(7)
    monkeypatch.setattr(chunks, "MASK", 3)
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 20_000)  # generations turn over
    codec, encoder = chunks.Codec(WORD), Encoder(BYTE)
    for piece in kernels.slices(pa.array(texts), 5000):
        cut, raw = [0, *chunks.cuts(piece).tolist(), len(piece.buf)], piece.buf.tobytes()
        own = [sorted({*(x for x in cut if a < x < b), a, b}) for a, b in zip(piece.off[:-1].tolist(), piece.off[1:].tolist())]
        got = codec.encode([[raw[a:b] for a, b in zip(e[:-1], e[1:])] for e in own])
        for x, ids in zip(texts[piece.first :], got):
            want = codec.library.encode(x, add_special_tokens=False).ids
            assert ids == b"".join(i.to_bytes(4, "little") for i in want) and decoded(codec, ids) == codec.library.decode(want, skip_special_tokens=False), x
    for x, ids in zip(texts, encoder.encode(texts)):
        assert ids == b"".join(i.to_bytes(4, "little") for i in encoder.library.encode(x, add_special_tokens=False).ids), x


def test_long_texts_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(pieces, "TOGETHER_CHARS", 100)
    text = " ".join(odd_texts(3, 200)).replace("\x1c", "").replace("\x1f", "").replace("\x85", "").replace("\u180e", "")
    encoder = Encoder(BYTE)
    assert len(list(pieces.parts(text))) > 5 and "".join(pieces.parts(text)) == text
    assert encoder.encode(["a", text, None, "b"])[1] == b"".join(i.to_bytes(4, "little") for i in encoder.library.encode(text, add_special_tokens=False).ids)


def test_long_texts_with_odd_separators_are_encoded_in_parts(monkeypatch):
    monkeypatch.setattr(pieces, "TOGETHER_CHARS", 100)
    text = "".join(x + " " for x in odd_texts(5, 400))
    encoder = Encoder(BYTE)
    assert len(list(pieces.parts(text))) > 50 and "".join(pieces.parts(text)) == text
    assert encoder.encode([text])[0] == b"".join(i.to_bytes(4, "little") for i in encoder.library.encode(text, add_special_tokens=False).ids)


def test_batches_are_cut_by_bytes(monkeypatch):
    monkeypatch.setattr(pieces, "TOGETHER_CHARS", 10)
    texts = ["abc", None, "é" * 3, "", "x" * 30, "d", "e" * 9, "f", None, "g"]
    got = [part.column("text").to_pylist() for part in pieces.some(pa.RecordBatch.from_pydict({"text": texts}).slice(1))]
    assert got == [[None, "éé\u00e9", ""], ["x" * 30], ["d", "e" * 9], ["f", None, "g"]]


def test_pieces_go_to_the_library_once_while_their_bytes_fit(monkeypatch):
    monkeypatch.setattr(pieces, "PIECE_BYTES", 1 << 20)
    encoder, sent = Encoder(BYTE), []
    together = encoder.together
    monkeypatch.setattr(encoder, "together", lambda x: sent.extend(x) or together(x))
    texts = [" ".join(f"w{k}x{j}" for j in range(100)) for k in range(120)]
    first = [encoder.encode([x])[0] for x in texts]
    assert [encoder.encode([x])[0] for x in texts] == first and len(sent) == len(set(sent)) == 12_000
    assert first == [b"".join(i.to_bytes(4, "little") for i in encoder.library.encode(x, add_special_tokens=False).ids) for x in texts]


def test_table_of_pieces_keeps_to_its_bytes():
    known = pieces.Known(10_000)
    for k in range(400):
        keys = [f"{k}-{j}".encode() for j in range(10)] + [b"always", b"x" * 5000 + str(k).encode()]
        row = known.bring(pa.array(keys, pa.large_binary()), lambda x: [y.encode()[:8].ljust(8) for y in x])
        end = known.count.cumsum()
        assert all(known.keys[r].as_py() == x and known.ids[end[r] - known.count[r] : end[r]].tobytes() == x[:8].ljust(8) for r, x in zip(row.tolist(), keys))
        assert known.cost().sum() < 20_000 and sum(len(x) > 4096 for x in known.keys.to_pylist()) == 1
    assert b"always" in known.keys.to_pylist() and len(known.keys) > 100


def test_cache_keeps_to_its_bytes():
    cache = pieces.Cache(10_000)
    for k in range(400):
        keys = {f"{k}-{j}" for j in range(10)} | {"always", "x" * 5000 + str(k)}
        found = cache.bring(keys, lambda ks: [x.encode() for x in ks])
        assert all(found[x] == x.encode() for x in keys)
        assert len(cache.young) + len(cache.old) < 120 and cache.size < 20_000
        assert sum(len(x) > 4096 for x in [*cache.young, *cache.old]) <= 1
    assert "always" in cache.young


def test_disagreeing_joins_are_repaired():
    codec = chunks.Codec(WORD)
    text = "alpha beta gamma"
    for parts in ([b"alpha be", b"ta gamma"], [b"alp", b"ha beta gam", b"ma"], [b"alpha", b" beta", b" gamma"]):
        ids = codec.library.encode(text, add_special_tokens=False).ids
        assert codec.encode([list(parts)])[0] == b"".join(i.to_bytes(4, "little") for i in ids)
        assert decoded(codec, codec.encode([list(parts)])[0]) == codec.library.decode(ids, skip_special_tokens=False)


def test_range_hashes_tell_apart_what_collides_modulo_powers_of_two():
    bits = lambda n, k: "".join("ab"[(i.bit_count() + k) & 1] for i in range(n))
    lines = [bits(4096, 0), bits(4096, 1)]
    piece = next(kernels.slices(pa.array(lines)))
    h = piece.hashes(piece.prefix(False), piece.off[:-1], piece.off[1:])
    assert h[0] != h[1]
    long = next(kernels.slices(pa.array(["x" * (kernels.SLICE_BYTES + 9) + "word", "word"]), 1 << 40))
    n = kernels.SLICE_BYTES + 9
    a, b = long.hashes(long.prefix(False), long.off[1:] - 4, long.off[1:])
    assert a == b and n and len(kernels._POWERS[0][0]) == kernels.SLICE_BYTES + 1


def test_cuts_are_content_defined():
    passage = " ".join(random.Random(5).choice(LOREM) + str(random.Random(i).randrange(99)) for i in range(1500))
    pieces = []
    for before in ("", "something else stands here first "):
        piece = next(kernels.slices(pa.array([before + passage])))
        raw, at = piece.buf.tobytes(), [0, *chunks.cuts(piece).tolist(), len(piece.buf)]
        pieces.append({raw[a:b] for a, b in zip(at[:-1], at[1:])})
    assert len(pieces[0] & pieces[1]) >= len(pieces[0]) - 2 > 3


def test_language(spark, docs, nothing):
    kinds = {"aa": "lorem ipsum dolor sit amet consectetur", "bb": "schnell brauner fuchs springt über faulen hund", "cc": "le renard brun saute par dessus le chien"}
    say = lambda k, i: " ".join(kinds[k].split()[(i * 3 + j * j) % len(kinds[k].split())] for j in range(12))
    rows = [(i, say(k, i), k) for n, k in enumerate(kinds) for i in range(n * 100, n * 100 + 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.learn(frame)
    assert [k for k, _ in samples] == ["aa", "bb", "cc"]
    out = language.identify(frame.select("doc_id", "text", F.col("lang").alias("score_")), samples, ["doc_id", "score_"]).collect()
    held = [r for r in out if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert held and all(r["lang_pred"] == r["score_"] for r in held) and all(0 <= r["score"] <= 1 for r in out)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !? 4"), (4, "日本")], "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(odd, samples, ["doc_id"]).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] in kinds
    assert language.identify(docs, (), ["doc_id"]).where("lang_pred != 'und'").count() == 0 and language.learn(nothing) == ()


def test_automaton_finds_longest_matches():
    data = b"abracadabra abra cadabra"
    moves = language.suffix_automaton(data)

    def known(s):
        state = 0
        for c in s:
            if c not in moves[state]:
                return False
            state = moves[state][c]
        return True

    for n in range(1, 7):
        for s in map(bytes, itertools.product(b"abrcd ", repeat=min(n, 4))):
            assert known(s) == (s in data)
    text = b"abracadcab zz abra"
    piece = kernels.Slice(__import__("numpy").frombuffer(text, "uint8"), __import__("numpy").array([0, len(text)]), 0)
    count, at = 0, 0
    while at < len(text):
        k = 1
        while at + k < len(text) and text[at : at + k + 1] in data:
            k += 1
        count, at = count + 1, at + k
    assert language.phrases(language.compiled((("x", data),)), piece)[0].tolist() == [[count]]


def test_registry_names_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11)) and set(registry.ORACLES) <= set(registry.QUERIES)
