"""Whole runs on small documents: isolation of errors, retrieval by court, records, the index on disk, streams."""

from __future__ import annotations

import json
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tessera.operators import pipeline, registry, retrieve
from tessera.operators.decide import DECISIONS
from tessera.operators.errors import of_citations
from tessera.operators.identify import identify
from tessera.operators.registry import build_index
from tessera.sources import readers, settle, snapshots, writers
from tessera.streaming import resolve as streaming

REGISTRY = [
    (1, "r-1", "STF", 2020, "Ana Souza", "acordao", "RECLAMAÇÃO 12.345 BAHIA\nRELATORA : MIN. ANA SOUZA\nRECORRENTE : X"),
    (2, "s-1", "STF", 2010, None, "sumula", "Súmula Vinculante 25 do STF"),
    (3, "s-2", "STJ", 2010, None, "sumula", "Súmula 25 do STJ"),
    (4, "l-1", None, 2002, None, "dispositivo", "CÓDIGO CIVIL ARTIGO 186\nTexto."),
]
MENTIONS = [
    ("a_n1_1", "c1", "ACOR", 0, 10, "Rcl 12.345, STF, 2020", 0.9),
    ("a_n1_1", "c2", "SUM", 12, 30, "Súmula Vinculante 25", 0.9),
    ("a_n1_1", "c3", "LEG", 32, 50, "art. 186 do Código Civil", 0.9),
    ("a_n1_1", "c4", "XYZ", 52, 60, "o que for", 0.9),
    ("a_n1_1", "c5", "ACOR", 62, 70, "acórdão citado", 0.9),
    ("b", "c1", "SUM", 0, 9, "Súmula 25", 0.9),
    ("b", "c2", "ACOR", 10, 20, "HC 999.111", None),
]


@pytest.fixture(scope="module")
def index(spark):
    rows = spark.createDataFrame([(*r[:6], "x", r[6]) for r in REGISTRY], "id long, documento_id string, tribunal string, ano int, relator string, natureza string, tipo string, texto string")
    entries = spark.createDataFrame([("RECLAMACAO", None, "RECLAMACAO")], "surface_key string, tribunal string, classe string")
    return build_index(rows, entries)


@pytest.fixture(scope="module")
def citations(spark, index):
    rows = pipeline.typed(spark.createDataFrame(MENTIONS, "documento_id string, id string, tipo string, inicio int, fim int, trecho string, confianca double"))
    assert {(r["documento_id"], r["id"]) for r in rows.where("discarded").collect()} == {("a_n1_1", "c5")}
    return pipeline.judged(rows, index), rows.where("discarded")


def test_one_bad_label_stops_nothing_else(citations):
    got = {(r["documento_id"], r["id"]): r for r in citations[0].collect()}
    assert {k: (r["regra"], r["id_canonico"]) for k, r in got.items()} == {
        ("a_n1_1", "c1"): ("UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA", 1),
        ("a_n1_1", "c2"): ("UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA", 2),
        ("a_n1_1", "c3"): ("UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA", 4),
        ("a_n1_1", "c4"): ("ERRO_TECNICO", None),
        ("b", "c1"): ("MULTIPLOS_CANDIDATOS", None),
        ("b", "c2"): ("IDENTIDADE_SUFICIENTE_SEM_CANDIDATO", None),
    }
    failed = got["a_n1_1", "c4"]
    assert (failed["classificacao"], failed["confianca_final"], failed["error"], failed["natureza"]) == ("incompleta", 0.2, "CITATION_PIPELINE_ERROR", "acordao")
    assert {r[0] for r in DECISIONS} >= {r["regra"] for r in got.values()}


def test_attempts_and_evidence(citations):
    got = {(r["documento_id"], r["id"]): r for r in citations[0].collect()}
    ruling = got["a_n1_1", "c1"]
    assert ruling["log"][0]["plano"] == "acordao_completo" and ruling["log"][0]["ids"] == [1] and {"numero", "tribunal", "ano"} <= set(ruling["log"][0]["campos"])
    assert ruling["candidatos"][0]["documento_id_base"] == "r-1" and ruling["candidatos"][0]["evidencia"]["estrategia"] == "stf_ate_relator"
    binding, open_one = got["a_n1_1", "c2"], got["b", "c1"]
    assert binding["log"][0]["plano"] == "sumula_tribunal_numero" and binding["confirmed"] == ["numero", "tribunal"]
    assert open_one["log"][0]["plano"] == "sumula_numero" and open_one["candidates"] == [2, 3] and len(open_one["candidatos"]) == 2


def test_document_records_and_summary(spark, citations, tmp_path):
    docs = spark.createDataFrame([("a_n1_1", "texto"), ("b", "outro"), ("vazio", "")], "documento_id string, text string")
    found = {r["documento_id"]: json.loads(r["json"]) for r in pipeline.document_json(citations[0], docs, citations[1]).collect()}
    assert found["a_n1_1"]["nivel"] == 1 and "nivel" not in found["b"]
    assert found["a_n1_1"]["diagnostico"] == {"total_citacoes": 4, "reparos_bio": 0, "entidades_descartadas": 1, "citacoes_com_erro": 1}
    assert [c["citacao_id"] for c in found["a_n1_1"]["citacoes"]] == ["c1", "c2", "c3", "c4"] and found["vazio"]["citacoes"] == []
    writers.write_documents(pipeline.document_json(citations[0], docs, citations[1]), str(tmp_path / "json"))
    assert sorted(r[0] for r in spark.read.json(str(tmp_path / "json")).select("documento_id").collect()) == ["a_n1_1", "b", "vazio"]
    summary = pipeline.run_summary(citations[0], docs, citations[1])
    row = summary.first()
    assert (row["citacoes"], row["documentos"], row["descartadas"], row["real"], row["inventada"], row["incompleta"]) == (6, 3, 1, 3, 1, 2)
    assert row["erros"] == 1
    errors = of_citations(citations[0])
    assert [tuple(r) for r in errors.collect()] == [("a_n1_1", "c4", "citacao", "CITATION_PIPELINE_ERROR", "unknown label: XYZ", True)]
    assert [e["citacao_id"] for e in found["a_n1_1"]["erros"]] == ["c4"] and found["a_n1_1"]["citacoes"][3]["erros"][0]["mensagem"] == "unknown label: XYZ"
    first = found["a_n1_1"]["citacoes"][0]
    assert first["extracao"]["dados"]["numero"] == "12.345" and first["recuperacao"]["status"] == "candidato_unico" and first["resolucao"] == {"id_canonico": 1}
    writers.write_summary(summary, str(tmp_path / "summary"), pipeline.document_counts(citations[0], docs, errors))
    assert spark.read.json(str(tmp_path / "summary" / "run")).count() == 1
    assert sorted(map(tuple, spark.read.json(str(tmp_path / "summary" / "documents")).select("documento_id", "citacoes", "erros").collect())) == [("a_n1_1", 4, 1), ("b", 2, 0), ("vazio", 0, 0)]
    cells = {r["documento_id"]: r["citacoes"] for r in pipeline.submission(citations[0], docs).collect()}
    assert cells["vazio"] == "-" and cells["a_n1_1"].startswith("0,10,real,1,")


def test_a_broken_index_write_leaves_the_index_before_it(spark, index, tmp_path):
    path = str(tmp_path / "index")
    assert not writers.index_is_fresh(spark, path, "h1")
    with pytest.raises(FileNotFoundError, match="no index"):
        writers.read_index(spark, path)
    first = writers.write_index(index, path, "h1")
    reader = writers.read_index(spark, path)
    assert writers.index_is_fresh(spark, path, "h1") and not writers.index_is_fresh(spark, path, "h2")
    broken = index | {"sumula_key": index["sumula_key"].unionByName(index["sumula_key"])}
    with ThreadPoolExecutor(2) as pool:
        writer = pool.submit(writers.write_index, broken, path, "h2")
        while not writer.done():
            assert reader["sumula_key"].count() == 2
        with pytest.raises(ValueError, match="sumula_key"):
            writer.result()
    assert writers.index_is_fresh(spark, path, "h1") and not writers.index_is_fresh(spark, path, "h2") and writers.snapshot_of(spark, path) == first
    smaller = index | {"sumula_key": index["sumula_key"].where("vinculante")}
    assert writers.write_index(smaller, path, "h3") != first and writers.index_is_fresh(spark, path, "h3")
    assert reader["sumula_key"].count() == 2 and writers.read_index(spark, path)["sumula_key"].count() == 1


def test_snapshots_are_numbered_and_swept(spark, tmp_path):
    path = str(tmp_path / "s")
    folders = []
    for k in range(3):
        name, folder = snapshots.new(path)
        spark.range(k).write.parquet(f"{folder}/t")
        folders.append(folder)
        assert snapshots.publish(spark, path, name) == k + 1
    with ThreadPoolExecutor(4) as pool:  # many at once: each has a number of its own
        assert sorted(pool.map(lambda k: snapshots.publish(spark, path, f"n{k}"), range(4))) == [4, 5, 6, 7]
    assert snapshots.current(spark, path).endswith(snapshots.pointers(spark, path)[-1][1])
    snapshots.sweep(spark, path, keep=5)
    assert [n for n, _ in snapshots.pointers(spark, path)] == [3, 4, 5, 6, 7] and not os.path.exists(folders[0]) and os.path.exists(folders[2])


def test_one_broken_document_stops_no_other(spark, index, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(30):
        (tmp_path / "in" / f"d{k:02}_n1.txt").write_text(f"Ver Rcl 12.345 e art. 186 do Código Civil. {k}\r\n")
    (tmp_path / "in" / "d07_n1.txt").write_bytes(b"Ver Rcl 12.345 \xff\xfe")
    docs, errors = readers.read_documents(spark, str(tmp_path / "in"))
    assert docs.count() == 30 and [tuple(r)[:4] for r in errors.collect()] == [("d07_n1", None, "leitura", "DOCUMENT_READ_ERROR")]
    done = pipeline.verified(identify(docs), index)
    records = {r["documento_id"]: json.loads(r["json"]) for r in pipeline.document_json(done, docs, errors=errors.unionByName(of_citations(done))).collect()}
    bad, good = records["d07_n1"], records["d08_n1"]
    assert bad["citacoes"] == [] and "fonte" not in bad and bad["erros"][0]["recuperavel"] is False and bad["diagnostico"] == {"total_citacoes": 0, "reparos_bio": 0}
    assert good["diagnostico"] == {"total_citacoes": 2, "reparos_bio": 0, "entidades_descartadas": 0, "citacoes_com_erro": 0} and good["erros"] == [] and good["fonte"]["texto_len"] == len("Ver Rcl 12.345 e art. 186 do Código Civil. 8\n")
    assert sum(len(r["citacoes"]) for r in records.values()) == 58


def test_nothing_that_is_settled_holds_a_text(spark, index, monkeypatch):
    """Mentions travel without the text of their document, and index tables without the bodies of rulings."""
    seen = []
    for module in (pipeline, registry, retrieve):
        monkeypatch.setattr(module, "settled", lambda df, what="rows": seen.append((what, set(df.columns))) or settle.settled(df, what))
    docs = spark.createDataFrame([("d", "Ver Rcl 12.345.")], "documento_id string, text string")
    pipeline.verified(identify(docs), index).collect()
    build_index(spark.createDataFrame([(*r[:6], "x", r[6]) for r in REGISTRY], "id long, documento_id string, tribunal string, ano int, relator string, natureza string, tipo string, texto string"), spark.createDataFrame([], "surface_key string, tribunal string, classe string"))
    assert {w for w, _ in seen} >= {"mentions", "typed", "headers", "fields"} and not any(c & {"text", "texto"} for _, c in seen)


def test_stream_of_documents(spark, index, tmp_path):
    writers.write_index(index, str(tmp_path / "index"), "h")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps({"documento_id": "d", "text": "Ver Rcl 12.345 e art. 186 do Código Civil."}))
    source = spark.readStream.schema("documento_id string, text string").json(str(tmp_path / "in"))
    streaming.follow(spark, source, str(tmp_path / "index"), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    want = pipeline.verified(identify(spark.createDataFrame([("d", "Ver Rcl 12.345 e art. 186 do Código Civil.")], "documento_id string, text string")), index)
    columns = ["documento_id", "id", "classificacao", "id_canonico", "confianca_final"]
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect())) and got.count() == 2


def test_json_readers(spark, tmp_path):
    (tmp_path / "array.json").write_text('[{"id": 1, "t": "a"}, {"id": 2, "t": "b\\nc"}]')
    assert sorted(map(tuple, readers.read_json_array(spark, str(tmp_path / "array.json"), "id int, t string").collect())) == [(1, "a"), (2, "b\nc")]
    (tmp_path / "folder").mkdir()
    with pytest.raises(ValueError, match="no .json"):
        readers.read_json_folder(spark, str(tmp_path / "folder"), "id int")
    for i in range(3):
        (tmp_path / "folder" / f"{i}.json").write_text(json.dumps({"id": i, "m": {"k": i}}, indent=1))
    (tmp_path / "folder" / "note.txt").write_text("x")
    rows = readers.read_json_folder(spark, str(tmp_path / "folder"), "id int, m struct<k:int>")
    assert sorted(r["m"]["k"] for r in rows.collect()) == [0, 1, 2]
    twice = rows.unionByName(rows.withColumn("m", F.struct((F.col("m.k") + 5).alias("k"))))
    assert sorted((r["id"], r["m"]["k"]) for r in readers.metadata_index(twice, "id").collect()) == [(0, 5), (1, 6), (2, 7)]
    assert os.path.exists(tmp_path / "folder")
