"""Text functions, spans, decisions, the metric, identification, readers and writers on small inputs."""

from __future__ import annotations

import hashlib
import json
import os
import random
import re
import sqlite3
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import spans, text
from tessera.operators import envelope, evaluate, identify, inference, recognise, sequences
from tessera.operators.contract import duplicates, violations
from tessera.operators.decide import decide, final_confidence
from tessera.sources import files, readers, writers


def fold(s):
    s = "".join(c for c in unicodedata.normalize("NFD", s or "") if unicodedata.category(c) != "Mn")
    return re.sub(r"\s+", " ", s).strip().upper()


def test_fold_and_spans_equal_python(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aAéÇõ ñº12.- \n😀ßI/") for _ in range(rng.randrange(0, 30))) for _ in range(300)] + [None, ""]
    patterns = [r"[0-9]+", r"(?U)\b[0-9A-Z]+\b", r"(?U)(?<![0-9])[0-9]{1,2}(?![0-9])", r"(?U)\s+"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in rows.select("i", "t", text.fold("t").alias("f"), text.normalize_for_matching("t").alias("n"), *(spans.find_spans(F.col("t"), p).alias(f"p{k}") for k, p in enumerate(patterns))).collect():
        assert r["f"] == fold(r["t"])
        if r["t"] is None:
            continue
        assert len(r["n"]["source_indices"]) == len(r["n"]["text"]) and r["n"]["text"].count("SS") >= r["t"].count("ß")
        for k, p in enumerate(patterns):
            assert [(s["start"], s["end"]) for s in r[f"p{k}"]] == [m.span() for m in re.finditer(p.replace("(?U)", ""), r["t"])], (p, r["t"])


def test_exact_rounding(spark):
    values = [0.85 * c + 0.15 * 0.995 for c in (0.97, 0.92, 0.90, 0.88, 0.82, 0.75, 0.35)] + [random.Random(1).random() for _ in range(200)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", text.exact_round(F.col("v"), 4).alias("r")).collect()
    assert all(r["r"] == round(r["v"], 4) for r in rows)


def test_names_match_in_order(spark):
    rows = [("João da Silva Souza", "Min. João Souza", True), ("João da Silva", "Silva João", False), ("X", "", False), (None, "A", False)]
    got = spark.createDataFrame(rows, "c string, e string, want boolean").select(text.name_matches("c", "e").alias("g"), "want").collect()
    assert [r["g"] for r in got] == [r["want"] for r in got]


def test_decisions(spark):
    rows = [([1, 2], 1, True, False, "MULTIPLOS_CANDIDATOS"), ([5], 2, True, False, "UNICO_CONSISTENTE_EM_CONSULTA_PARCIAL"), ([5], 1, False, False, "UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA"), ([], 1, True, False, "IDENTIDADE_SUFICIENTE_SEM_CANDIDATO"), ([], 1, False, False, "IDENTIDADE_INSUFICIENTE"), ([5], 1, True, True, "ERRO_TECNICO")]
    out = decide(spark.createDataFrame(rows, "candidates array<long>, attempts int, sufficient boolean, error boolean, want string"))
    assert all(r["regra"] == r["want"] for r in out.collect())
    assert out.where("regra = 'UNICO_CONSISTENTE_EM_CONSULTA_PARCIAL'").select(final_confidence(F.col("confianca_decisao"), F.lit(0.995))).first()[0] == 0.9143


def score(spark, gold, said):
    solution = spark.createDataFrame(gold, "documento_id string, nivel int, citacoes string")
    sent = spark.createDataFrame([(d, c, i) for i, (d, c) in enumerate(said)], "documento_id string, citacoes string, n int")
    return evaluate.score(solution, sent, "n").first()["score"]


def test_metric(spark):
    gold = [("a", 1, "0,10,real,7:8|20,30,inventada,-"), ("b", 2, "0,10,incompleta,-"), ("c", 1, "-")]
    assert score(spark, gold, [("a", "0,10,real,8,-|20,30,inventada,-,-"), ("b", "0,10,incompleta,-,-"), ("c", "-")]) == 1.0
    assert score(spark, gold, [("a", "0,10,real,8,1|20,30,inventada,-,1"), ("b", "0,10,incompleta,-,1"), ("c", "-"), ("a", "-")]) == pytest.approx(1.1)
    assert score(spark, gold, [("a", "0,10,inventada,-,-|20,30,real,7,-"), ("b", "-"), ("c", "-")]) == 0.0
    assert score(spark, gold, [("a", "0,10,real,7,-|12,14,real,7,-|1,5,inventada,-,-|20,30,inventada,-,-"), ("b", "0,10,incompleta,-,-"), ("c", "-")]) == pytest.approx((2 / 3 / 2 + 1 / 2 + 2) / 3)
    with pytest.raises(Exception, match="not sent"):
        score(spark, gold, [("a", "-")])
    with pytest.raises(Exception, match="malformed"):
        score(spark, gold, [("a", "0,10,real,-,-"), ("b", "-"), ("c", "-")])


def test_tie_of_one_half_matches_once(spark):
    g = spark.createDataFrame([("d", 0, (0, 10)), ("d", 1, (10, 20))], "doc string, gi int, g struct<inicio:int,fim:int>")
    p = spark.createDataFrame([("d", 0, (0, 20))], "doc string, pi int, p struct<inicio:int,fim:int>")
    assert [(r["gi"], r["pi"], r["iou"]) for r in evaluate.matched(g, p, "doc").collect()] == [(0, 0, 0.5)]


def test_cells_are_read_in_either_case_and_with_gaps(spark):
    gold = [("a", 1, "0,10,Real,-:7:|20,30,inventada,-")]
    assert score(spark, gold, [("a", "0,10,REAL,007,|20,30,inventada,123,-|")]) == 1.0
    assert score(spark, gold, [("a", None)]) == 0.0 and score(spark, gold, [("a", " - ")]) == 0.0
    for cell in ("0,10,real,7,-|0,10,real,7,-", "0,10,real,7,-|1,10,inventada,-,-", "-|0,10,real,7,-", "0,10,real,7", "0,10,real,,1", "0,10,fim,-,1", "x,10,real,7,1", "0,10,real,7,nan", "0,10,real,7,0.5f", "0,10,real,7,0.5d"):
        with pytest.raises(Exception, match="malformed citation"):
            score(spark, gold, [("a", cell)])
    for cell in ("0,10,real,7|5,15,inventada,-", "0,10,real,-", "0,10,real,:-", "0,10,outra,-", "0,x,real,7"):
        with pytest.raises(Exception, match="malformed solution"):
            score(spark, [("a", 1, cell)], [("a", "-")])
    assert score(spark, gold, [("a", "0,10,real,7,-|20,24,inventada,-,-|20,30,inventada,-,-")]) == 1.0  # inside a match, below one half


def test_identification(spark):
    docs = {"a": "Ver Rcl 12.345 (SP) e art. 5º do CPC.", "b": "Reclamação nº 71.-\n602 (PE)", "c": "nada", "d": "APL 7357 51-18 fim"}
    frame = spark.createDataFrame(list(docs.items()), "documento_id string, text string")
    model = spark.createDataFrame([("d", "ACOR", 0, 8, 0.5), ("d", "ACOR", 9, 14, 0.7), ("a", "SUM", 4, 8, 0.9)], "documento_id string, tipo string, inicio int, fim int, confianca double")
    got = {(r["documento_id"], r["id"]): (r["tipo"], r["trecho"], r["confianca"]) for r in identify.identify(frame, model).collect()}
    assert got == {("a", "c1"): ("ACOR", "Rcl 12.345 (SP)", 0.9), ("a", "c2"): ("LEG", "art. 5º do CPC", 0.995), ("b", "c1"): ("ACOR", "Reclamação nº 71.-\n602 (PE)", 0.995), ("d", "c1"): ("ACOR", "APL 7357 51-18", 0.7)}


def test_islands_and_suppression(spark):
    rows = [("d", 0, 0, 1, "I-X", 0.5), ("d", 1, 1, 2, "I-X", 1.0), ("d", 2, 2, 2, "B-X", 1.0), ("d", 3, 3, 4, "B-X", 0.2), ("d", 4, 4, 5, "I-Y", 0.4), ("d", 5, 5, 6, "O", 1.0), ("d", 6, 6, 7, None, 1.0), ("d", 7, 7, 8, "I-Y", 0.1)]
    got = sequences.label_islands(spark.createDataFrame(rows, "doc_id string, pos int, start int, end int, label string, prob double")).orderBy("inicio").collect()
    assert [(r["tipo"], r["inicio"], r["fim"], r["confianca"], r["repaired"]) for r in got] == [("X", 0, 2, 0.75, True), ("X", 3, 4, 0.2, False), ("Y", 4, 5, 0.4, True), ("Y", 7, 8, 0.1, True)]
    s = spark.createDataFrame([([(0.9, 0, 5, "A"), (0.8, 3, 8, "A"), (0.7, 8, 9, "B"), (0.6, 0, 5, "A")],)], "s array<struct<confianca:double,inicio:int,fim:int,tipo:string>>")
    assert [(x["inicio"], x["fim"]) for x in s.select(sequences.suppressed(F.col("s")).alias("k")).first()["k"]] == [(0, 5), (8, 9)]


def test_contract(spark):
    rows = [("d", 1, 0, 5, "real", None, 0.5, 10), ("d", 2, 0, 5, "inventada", None, 2.0, 10), ("d", 3, 8, 20, "x", None, 0.1, 10)]
    got = {(r["citation"], r["rule"]) for r in violations(spark.createDataFrame(rows, "doc string, citation int, inicio int, fim int, classificacao string, id_canonico long, confianca double, length int"), "doc").collect()}
    assert got == {(1, "real_without_id"), (2, "confidence_out_of_range"), (2, "duplicate_span"), (3, "span_out_of_bounds"), (3, "unknown_class")}


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x_n1.txt").write_bytes("a\r\nç".encode())
    assert [tuple(r) for r in readers.read_texts(spark, str(tmp_path / "in")).collect()] == [("x_n1", "a\nç")]
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no .txt"):
        readers.read_texts(spark, str(tmp_path / "none"))
    good = {"id": "r", "text": "ab", "input_ids": [1, 2], "attention_mask": [1, 1], "labels": [0, -100], "offset_mapping": [[0, 1], [0, 0]]}
    (tmp_path / "bio.jsonl").write_text(json.dumps(good) + "\n")
    tokens = readers.bio_tokens(readers.read_bio(spark, str(tmp_path / "bio.jsonl")), {0: "O"}).collect()
    assert [(t["pos"], t["label"]) for t in tokens] == [(0, "O"), (1, None)]
    (tmp_path / "bad.jsonl").write_text(json.dumps(good | {"labels": [0]}) + "\n")
    with pytest.raises(Exception, match="bad token-label"):
        readers.read_bio(spark, str(tmp_path / "bad.jsonl")).collect()
    (tmp_path / "dict.json").write_text('{"Rcl": [{"tribunal": null, "classe_normalizada": "RECLAMACAO"}]}')
    assert readers.read_class_dictionary(spark, str(tmp_path / "dict.json")).first()["surface"] == "Rcl"
    db = sqlite3.connect(tmp_path / "r.db")
    db.execute("CREATE TABLE documentos (id INTEGER, documento_id TEXT, tribunal TEXT, ano INTEGER, relator TEXT, natureza TEXT, tipo TEXT, texto TEXT)")
    db.executemany("INSERT INTO documentos VALUES (?, ?, 'STF', 2020, NULL, 'sumula', 'jurisprudencia', 'x')", [(i, f"d{i}") for i in range(1, 21)])
    db.commit()
    assert readers.read_registry(spark, str(tmp_path / "r.db"), 4).agg(F.count("*"), F.sum("id")).first() == (20, 210)
    docs = spark.createDataFrame([("b",), ("a",)], "documento_id string")
    rows = docs.withColumn("citacoes", F.lit("1,2,real,3,0.5000"))
    writers.write_submission(rows, docs, str(tmp_path / "out"))
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "out")).collect())) == [("a", "1,2,real,3,0.5000"), ("b", "1,2,real,3,0.5000")]
    with pytest.raises(ValueError, match="missing document"):
        writers.write_submission(rows.where("documento_id = 'a'"), docs, str(tmp_path / "out2"))
    with pytest.raises(ValueError, match="overwrite"):
        files.refuse_same_path("/x/a", "/x/../x/a")
    assert not writers.index_is_fresh(spark, str(tmp_path / "no"), "h")
    assert files.file_sha256(spark, str(tmp_path / "dict.json")) == hashlib.sha256((tmp_path / "dict.json").read_bytes()).hexdigest()


def test_long_texts_give_the_same_spans(spark):
    texts = ["", "x", "a1b22c333" * 40, "7", *("".join(random.Random(k).choice("a1 ") for _ in range(k * 50)) for k in range(8))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", spans.find_spans(F.col("t"), "[0-9]+", long=True).alias("s")).collect()
    for r in rows:
        assert [(s["start"], s["end"], s["text"]) for s in r["s"]] == [(*m.span(), m.group()) for m in re.finditer("[0-9]+", r["t"])]


def test_duplicate_spans_equal_all_pairs(spark):
    rng = random.Random(4)
    rows = [(f"d{i % 3}", i, a := rng.randrange(0, 400), a + rng.choice([1, 2, 3, 7, 20, 90, 300])) for i in range(300)] + [("d0", 900, 5, 5), ("d0", 901, None, 5)]
    got = sorted(map(tuple, duplicates(spark.createDataFrame(rows, "doc string, citation int, inicio int, fim int"), "doc").collect()))
    iou = lambda a, b: (n := max(0, min(a[3], b[3]) - max(a[2], b[2]))) / (a[3] - a[2] + b[3] - b[2] - n)
    real = [r for r in rows if r[2] is not None and r[3] > r[2]]
    assert got == sorted((a[0], a[1], b[1]) for a in real for b in real if a[0] == b[0] and a[1] > b[1] and iou(a, b) >= 0.5) and len(got) > 50


def test_entities_inside_mentions_equal_all_pairs(spark):
    rng = random.Random(9)
    mentions = [("d", f"c{i}", a := rng.randrange(0, 5000), a + rng.choice([3, 40, 600, 3000])) for i in range(60)] + [("e", "c0", 0, 0), ("e", "c1", None, 4)]
    found = [("d", "PER", a := rng.randrange(0, 6000), a + rng.choice([1, 5, 30]), f"t{i}") for i in range(200)] + [("e", "PER", 0, 0, "z")]
    m = spark.createDataFrame(mentions, "documento_id string, id string, inicio int, fim int")
    got = sorted((r["id"], r["texto"]) for r in recognise.inside(m, spark.createDataFrame(found, "documento_id string, rotulo string, inicio int, fim int, texto string")).collect())
    assert got == sorted((x[1], e[4]) for x in mentions for e in found if x[0] == e[0] and x[2] is not None and x[2] <= e[2] and e[3] <= x[3])


def test_envelopes_name_the_place_of_an_error(spark):
    schema = "documento_id string, text string, citacoes array<struct<tipo:string,trecho:string,id:string>>"
    frame = lambda *rows: spark.createDataFrame(list(rows), schema)
    good = envelope.extract_document(frame(("a", "t", [("SUM", "Súmula 7 do STJ", None), ("SUM", "Súmula 9 do TST", "q")]), ("b", "t", [])))
    assert sorted((r["id"], r["sumula"]["numero"]) for r in good.collect()) == [("c1", [7]), ("q", [9])]
    with pytest.raises(ValueError, match="missing field of the document: text"):
        envelope.extract_document(frame().drop("text"))
    for row, why in (((None, "t", [("SUM", "x", None)]), "documento_id"), (("a", None, [("SUM", "x", None)]), "missing field of document a: text"), (("a", "t", [("SUM", "x", None), (None, "x", None)]), "missing field of citation 2 of a: tipo"), (("a", "t", [("SUM", None, None)]), "citation 1 of a: trecho"), (("a", "t", [("ABC", "x", None)]), "unknown label of citation 1 of a: ABC")):
        with pytest.raises(Exception, match=why):
            envelope.extract_document(frame(row)).collect()


def test_windows_of_a_scorer_are_one_text(spark):
    tokens = spark.createDataFrame([("d", [1, 2, 3, 4, 5, 6, 7], [[i * 2, i * 2 + 2] for i in range(7)]), ("none", [], [])], "doc_id string, input_ids array<int>, offset_mapping array<array<int>>")
    rows = inference.windows(tokens, size=4, overlap=2)
    assert [(r["window"], r["input_ids"]) for r in rows.orderBy("window").collect()] == [(0, [1, 2, 3, 4]), (1, [3, 4, 5, 6]), (2, [5, 6, 7])]

    def make():
        def predict(ids, mask):
            import numpy as np

            out = np.zeros((*ids.shape, 3), dtype=np.float32)
            out[..., 0] = 0.2
            out[..., 2] = np.where((ids == 3) | (ids == 4), np.where(np.arange(ids.shape[1]) < 2, 0.5, 0.75), 0)  # surer at the end of a window
            return (out * mask[..., None]).reshape(len(ids), -1)

        return predict

    found, repairs = inference.entities(inference.scored(rows, make, ["O", "B-X", "I-X"], size=4))
    assert [tuple(r) for r in found.collect()] == [("d", 4, 8, "X", 0.75)] and [tuple(r) for r in repairs.collect()] == [("d", 2)]
    with pytest.raises(ValueError, match="overlap"):
        inference.windows(tokens, size=4, overlap=4)


def test_faults_of_inputs_are_listed_together(spark, tmp_path):
    path = lambda *p: str(tmp_path.joinpath(*p))
    assert readers.input_faults(spark, path("r.db"), path("in"), path("model")) == [(path("r.db"), "registry not found"), (path("in"), "input folder not found"), *((path("model", n), "model file not found") for n in readers.MODEL_FILES)]
    for folder in ("in", "model"):
        (tmp_path / folder).mkdir()
    (tmp_path / "r.db").write_bytes(b"x")
    for n in readers.MODEL_FILES:
        (tmp_path / "model" / n).write_bytes(b"w")
    assert readers.input_faults(spark, path("r.db"), path("in"), path("model"), "0") == [(path("in"), "no .txt in the input folder"), (path("model", "model.safetensors"), "weights are not those of the approved digest")]
    (tmp_path / "in" / "a.txt").write_text("a")
    readers.check_inputs(spark, path("r.db"), path("in"), path("model"), hashlib.sha256(b"w").hexdigest())
    with pytest.raises(ValueError, match="registry not found.*no .txt"):
        readers.check_inputs(spark, path("x.db"), path("model"))


def test_digest_of_a_file_beyond_two_gigabytes(spark, tmp_path):
    """A sparse file: the digest streams through one buffer."""
    with open(tmp_path / "large.bin", "wb") as to:
        to.truncate((1 << 31) + 5)
        to.seek(1 << 31)
        to.write(b"end")
    with open(tmp_path / "large.bin", "rb") as of:
        assert files.file_sha256(spark, str(tmp_path / "large.bin")) == hashlib.file_digest(of, "sha256").hexdigest()
    (tmp_path / "small.bin").write_bytes(b"s")
    got = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in files.digests(spark, str(tmp_path)).collect()}
    assert got["small.bin"] == hashlib.sha256(b"s").hexdigest() and set(got) == {"small.bin", "large.bin"}
    assert len(files.file_sha256(spark, str(tmp_path))) == 64


def test_entry_names_every_query(spark):
    import __spark_entry__

    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    if os.path.isdir("/root/testdata/sf0.001"):
        assert __spark_entry__.entry(spark).count() > 0
