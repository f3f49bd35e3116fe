"""Driver queries: mentions, fields and verdicts of citations written from orders, parts and customers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.decide import decide, final_confidence
from tessera.operators.enrich import typed_number
from tessera.operators.envelope import enveloped, extract_document
from tessera.operators.errors import of_citations, raised
from tessera.operators.extract import extract_acordao, extract_dispositivo, extract_sumula
from tessera.operators.identify import identify
from tessera.operators.inference import entities, scored, windows
from tessera.operators.pipeline import document_counts, document_json, run_summary, submission, typed, verified
from tessera.operators.registry import build_index
from tessera.plans.resolve import load
from tessera.sources.settle import dealt, unsent


def dotted(number: Column) -> Column:
    """A number with points between thousands."""
    return F.translate(F.format_number(number, 0), ",", ".")


def pointed(number: Column) -> Column:
    """A number with a point before its last three digits alone, as the SQL writes it (``_DOTTED``): above a million the first point is missing."""
    return F.concat(F.floor(number / 1000).cast("string"), F.lit("."), F.lpad((number % 1000).cast("string"), 3, "0"))


def extract_acordao_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Special appeals with number, state and year from orders."""
    orders = load(spark, sf_dir, "orders")
    uf = F.element_at(F.array(*map(F.lit, ["SP", "RJ", "MG", "RS"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    text = F.concat(F.lit("AgInt no REsp nº "), pointed(F.col("o_orderkey") + 100000), F.lit("/"), uf, F.lit(", Rel. Min. João da Silva, julgado em 12/03/"), F.year("o_orderdate").cast("string"))
    rows = dealt(orders.select("o_orderkey", text.alias("trecho"))).select("o_orderkey", extract_acordao("trecho").alias("a"))
    return rows.select("o_orderkey", "a.tribunal", "a.classe_processual", "a.classe_processual_normalizada", "a.numero", "a.uf", "a.ano", "a.relator")


def extract_dispositivo_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles and paragraphs from parts."""
    parts = load(spark, sf_dir, "part")
    text = F.concat(F.lit("art. "), F.col("p_size").cast("string"), F.lit(", § "), (F.col("p_partkey") % 9 + 1).cast("string"), F.lit("º, "), F.element_at(F.array(*map(F.lit, ["do CPC", "da Lei nº 8.078/1990", "do Código Civil", "da Lei 1.234/99"])), (F.col("p_partkey") % 4 + 1).cast("int")))
    rows = dealt(parts.select("p_partkey", text.alias("trecho"))).select("p_partkey", extract_dispositivo("trecho").alias("d"))
    return rows.select("p_partkey", "d.diploma", F.array_join("d.artigo", ",").alias("artigo"), F.array_join("d.paragrafo", ",").alias("paragrafo"))


def extract_sumula_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two statements of a court from parts, some binding."""
    parts = load(spark, sf_dir, "part")
    text = F.concat(F.lit("Súmulas "), F.when(F.col("p_partkey") % 5 == 0, "Vinculantes ").otherwise(""), F.col("p_size").cast("string"), F.lit(" e "), (F.col("p_size") + 1).cast("string"), F.lit(" do "), F.when(F.col("p_partkey") % 2 == 0, "STF").otherwise("STJ"))
    rows = parts.select("p_partkey", text.alias("trecho")).select("p_partkey", extract_sumula("trecho").alias("s"))
    return rows.select("p_partkey", "s.tribunal", F.array_join(F.transform("s.numero", lambda x: x.cast("string")), ",").alias("numero"), "s.vinculante")


def one_of(k: Column, *texts: Column | str) -> Column:
    """The text whose place is ``k`` modulo their number."""
    return F.element_at(F.array(*(F.lit(t) if isinstance(t, str) else t for t in texts)), (k % len(texts) + 1).cast("int"))


def acordao_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings of orders in six forms: courts named, by class, by long number, or two of them; misread digits; two numbers; a state's name."""
    orders = load(spark, sf_dir, "orders")
    k, year = F.col("o_orderkey"), F.year("o_orderdate").cast("string")
    n = pointed(k + 100000)
    text = one_of(
        k,
        F.concat(F.lit("acórdão de "), year, F.lit(": o STF concedeu o HC "), n),
        F.concat(F.lit("recurso de revista "), F.lpad(k.cast("string"), 7, "0"), F.lit("-31.2017.5.04.0009, conhecido")),
        F.concat(F.lit("no MS "), n, F.lit(" divergem o STF e o STJ")),
        F.concat(F.lit("vista da Rcl "), n, F.lit(" MATO GROSSO DO SUL em "), year),
        F.concat(F.lit("STJ: recusado o REsp "), F.translate(n, "0", "O"), F.lit(" [GO]")),
        F.concat(F.lit("o STF reuniu o HC "), n, F.lit(" ao HC "), pointed(k + 100001)),
    )
    rows = dealt(orders.select("o_orderkey", text.alias("trecho"))).select("o_orderkey", extract_acordao("trecho").alias("a"))
    return rows.select("o_orderkey", "a.tribunal", "a.classe_processual_normalizada", "a.numero", "a.uf", F.col("a.ano").cast("string").alias("ano"))


def dispositivo_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provisions of parts in five forms: items, plural signs, a sole paragraph and a letter, bare numbers, points in a number."""
    parts = load(spark, sf_dir, "part")
    k, a = F.col("p_partkey"), (F.col("p_size") % 7 + 1).cast("int")
    t = lambda c: c.cast("string")
    text = one_of(
        k,
        F.concat(F.lit("ver arts. "), t(a), F.lit(", "), one_of(k, "II", "IV", "XI"), F.lit(", "), t(a + 2), F.lit(" e "), t(a + 20), F.lit(", XII, todos da Lei 9.784/99")),
        F.concat(F.lit("do CPC os artigos "), t(a + 300), F.lit(", §§ "), t(a), F.lit("º e "), t(a + 1), F.lit("º, "), t(a + 400), F.lit(" e "), t(a + 500)),
        F.concat(F.lit("art. "), t(a + 30), F.lit(', parágrafo único, inciso XXI, alínea "b", da Constituição Federal')),
        F.concat(F.lit("são aplicáveis "), t(a + 180), F.lit(", "), t(a + 190), F.lit(" e "), t(a + 200), F.lit(" do Código Civil")),
        F.concat(F.lit("pelo CPC, art. 1.01"), t(a), F.lit(", parágrafo "), t(a), F.lit("º")),
    )
    rows = dealt(parts.select("p_partkey", text.alias("trecho"))).select("p_partkey", extract_dispositivo("trecho").alias("d"))
    return rows.select("p_partkey", "d.diploma", *(F.array_join(f"d.{c}", ",").alias(c) for c in ("artigo", "inciso", "paragrafo", "alinea")))


def sumula_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements of parts in four forms: binding, misread, number before the court, none."""
    parts = load(spark, sf_dir, "part")
    n = F.col("p_size").cast("string")
    text = one_of(F.col("p_partkey"), F.concat(F.lit("Súmula Vinculante "), n), F.concat(F.lit("5úmu1a "), n, F.lit(" do STJ")), F.concat(n, F.lit("/TST")), "Súmula de 2014")
    rows = parts.select("p_partkey", text.alias("trecho")).select("p_partkey", extract_sumula("trecho").alias("s"))
    return rows.select("p_partkey", "s.tribunal", F.array_join(F.transform("s.numero", lambda x: x.cast("string")), ",").alias("numero"), "s.vinculante")


def typed_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number that enrichment reads from a text, in its four forms and where there is none."""
    orders = load(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    text = one_of(
        k,
        F.concat(F.lit("processo "), F.lpad(k.cast("string"), 7, "0"), F.lit("-56.2020.5.01.0001 fim")),
        F.concat(F.lit("a decisão "), F.translate(dotted(k + 100000), "0", "O"), F.lit(" fim")),
        F.concat(F.lit("feito N. "), (k % 1000 + 10).cast("string"), F.lit(" fim")),
        F.concat(F.lit("RESP "), (k % 1000 + 10).cast("string"), F.lit(" fim")),
        "sem número algum",
    )
    return orders.select("o_orderkey", typed_number(text).alias("numero"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's text: a claim by number, with the state for some, and an article."""
    customers = dealt(load(spark, sf_dir, "customer").select("c_custkey"))  # one small file, much work
    n = F.col("c_custkey")
    text = F.concat(
        F.lit("Como decidido na Rcl "),
        pointed(n + F.when(n % 3 == 0, 500000).otherwise(100000)),
        F.when(n % 2 == 0, F.lit(" (SP)")).otherwise(""),
        F.lit(", e nos termos do art. "),
        (n % 40 + 1).cast("string"),
        F.lit(" do Código Civil, nega-se provimento."),
    )
    return customers.select(n.cast("string").alias("documento_id"), text.alias("text"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A claim of the STF for each customer and the first thirty articles of a code."""
    customers = dealt(load(spark, sf_dir, "customer").select("c_custkey"))  # one small file, much work
    n = F.col("c_custkey")
    claims = customers.select(
        (n + 1000).alias("id"),
        F.concat(F.lit("rcl-"), n.cast("string")).alias("documento_id"),
        F.lit("STF").alias("tribunal"),
        F.lit(2020).alias("ano"),
        F.lit("Ana Souza").alias("relator"),
        F.lit("acordao").alias("natureza"),
        F.lit("jurisprudencia").alias("tipo"),
        F.concat(F.lit("RECLAMAÇÃO "), dotted(n + 100000), F.lit(" SÃO PAULO\nRELATORA : MIN. ANA SOUZA\nRECORRENTE : FULANO\nEMENTA cita a Rcl 9.999")).alias("texto"),
    )
    articles = spark.range(1, 31).select(
        F.col("id"), F.concat(F.lit("cc-"), F.col("id").cast("string")).alias("documento_id"), F.lit(None).cast("string").alias("tribunal"), F.lit(2002).alias("ano"), F.lit(None).cast("string").alias("relator"),
        F.lit("dispositivo").alias("natureza"), F.lit("lei").alias("tipo"), F.concat(F.lit("CÓDIGO CIVIL ARTIGO "), F.col("id").cast("string"), F.lit("\nTexto do artigo.")).alias("texto"),
    )
    return claims.unionByName(articles)


def entries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("RECLAMACAO", None, "RECLAMACAO"), ("RCL", None, "RECLAMACAO")], "surface_key string, tribunal string, classe string")


def identify_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(documents(spark, sf_dir))
    return found.select("documento_id", "id", "tipo", "inicio", "fim", "trecho", "confianca")


def build_index_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(registry(spark, sf_dir), entries(spark))
    keys = index["acordao_key"].join(unsent(index["acordao_class"]), "id_canonico").join(unsent(index["canonical_document"].select("id_canonico", "header_strategy", "header_end")), "id_canonico")
    claims = keys.select("id_canonico", F.col("numero_digitos").alias("chave"), F.col("classe_normalizada").alias("grupo"), F.concat_ws("/", F.coalesce("uf", F.lit("-")), "header_strategy").alias("detalhe"))
    return claims.unionByName(index["dispositivo_key"].select("id_canonico", F.col("artigo").alias("chave"), F.col("diploma").alias("grupo"), F.lit("-").alias("detalhe")))


def courts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of parts as labour and electoral rulings, statements, and rows that only give a warning."""
    parts = load(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    kind = k % 5
    region = F.element_at(F.array(*map(F.lit, ["01", "04", "99"])), (k % 3 + 1).cast("int"))
    number = lambda year, segment: F.concat(F.lpad(k.cast("string"), 7, "0"), F.lit("-45."), year, F.lit(f".{segment}."), region, F.lit(".0009"))
    tst_year = F.when(k % 10 == 0, "2020").otherwise("2017")  # where a year ends in 0, the places that the index fixes read the segment as a region
    text = (
        F.when(kind == 0, F.concat(F.lit("RECURSO DE REVISTA COM AGRAVO Nº TST-ARR-"), number(tst_year, 5), F.lit("\nEMENTA cita o processo Nº 77.888")))
        .when(kind == 1, F.concat(F.lit("RECURSO ESPECIAL ELEITORAL Nº "), number(F.lit("2018"), 6), F.lit("\nRELATOR : MIN. FULANO\nRECORRENTE : BELTRANO\nEMENTA cita o Nº 1.234")))
        .when(kind == 2, F.concat(F.lit("Súmula nº "), size, F.when(k % 2 == 0, " do STJ").otherwise(" do TST")))
        .when(kind == 3, "Enunciado revogado")
        .otherwise("DECISÃO SEM INDICAÇÃO\nEMENTA nada")
    )
    court = F.when(kind == 0, "TST").when(kind == 1, "TSE").when(kind == 4, "STM")
    nature = F.when(kind.isin(2, 3), "sumula").otherwise("acordao")
    rows = parts.select(k.alias("id"), F.concat(F.lit("d"), k.cast("string")).alias("documento_id"), court.alias("tribunal"), F.lit(2020).alias("ano"), F.lit(None).cast("string").alias("relator"), nature.alias("natureza"), F.lit("jurisprudencia").alias("tipo"), text.alias("texto"))
    index = build_index(rows, entries(spark))
    out = lambda df, table, key, more: df.select("id_canonico", F.lit(table).alias("tabela"), key.cast("string").alias("chave"), more.alias("detalhe"))
    keys = index["acordao_key"].join(unsent(index["canonical_document"].select("id_canonico", "header_strategy")), "id_canonico")
    detail = F.concat_ws("/", "numero_tipo", F.col("principal").cast("string"), F.coalesce("uf", F.lit("-")), F.col("cnj_ano").cast("string"), F.col("cnj_segmento").cast("string"), "cnj_regiao", "header_strategy")
    found = out(keys, "acordao", F.col("numero_digitos"), detail)
    found = found.unionByName(out(index["sumula_key"], "sumula", F.col("numero"), F.concat_ws("/", "tribunal", F.col("vinculante").cast("string"))))
    return found.unionByName(out(index["index_warning"], "aviso", F.lit(None), F.col("codigo")))


def verify_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to verdicts: spans by rule, fields, retrieval, decision."""
    out = verified(identify(documents(spark, sf_dir)), build_index(registry(spark, sf_dir), entries(spark)))
    return out.select("documento_id", "id", "natureza", "classificacao", "regra", F.col("id_canonico").cast("string").alias("id_canonico"), F.col("confianca_final").alias("confianca"))


def submission_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return submission(verified(identify(docs), build_index(registry(spark, sf_dir), entries(spark))), docs)


def as_mentions(rows: DataFrame, key: str, tipo: Column | str, trecho: Column, start: Column | int = 0) -> DataFrame:
    """One mention for each row, whose document is the row's key."""
    start = F.lit(start) if isinstance(start, int) else start
    at = rows.select(F.col(key).cast("string").alias("documento_id"), F.lit("c1").alias("id"), (F.lit(tipo) if isinstance(tipo, str) else tipo).alias("tipo"), start.cast("int").alias("inicio"), trecho.alias("trecho"), F.lit(0.9).alias("confianca"))
    return at.select("documento_id", "id", "tipo", "inicio", (F.col("inicio") + F.length("trecho")).cast("int").alias("fim"), "trecho", "confianca")


def discarded_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions of parts in eight forms, some of which say too little, and what enrichment says of each."""
    parts = load(spark, sf_dir, "part")
    k, n = F.col("p_partkey"), (F.col("p_partkey") % 900 + 100).cast("string")
    text = one_of(
        k,
        F.concat(F.lit("HC 11."), n),
        "recurso do STF, sem mais",
        F.concat(F.lit("decisão do STJ em "), (k % 20 + 2000).cast("string")),
        "Súmula do TST",
        F.concat(F.lit("Súmula "), n, F.lit(" do STJ")),
        "parágrafo único do CPC",
        F.concat(F.lit("art. "), n, F.lit(" da Lei 4."), n, F.lit("/1999")),
        F.concat(F.lit("na espécie, N. 8"), n),
    )
    label = one_of(k, "ACOR", "ACOR", "ACOR", "SUM", "SUM", "LEG", "LEG", "ACOR")
    rows = typed(as_mentions(parts, "p_partkey", label, text))
    return rows.select("documento_id", "natureza", "discarded", F.array_join("warnings", ",").alias("warnings"))


def recognised_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rulings of parts with no, one or two persons inside, a person outside and an organisation inside; some name their rapporteur themselves."""
    parts = load(spark, sf_dir, "part")
    k = F.col("p_partkey")
    text = F.concat(F.lit("HC "), dotted(k + 100000), F.when(k % 5 == 0, ", Rel. Eva Reis").otherwise(", sem mais"))
    start = (k % 300).cast("int")
    rows = as_mentions(parts, "p_partkey", "ACOR", text, start)
    found = F.array(
        F.when(k % 3 > 0, entity("Person", start + 2, start + 6, F.lit(" Ana  Souza "))),
        F.when(k % 3 == 2, entity("PER", start + 7, start + 9, F.lit("Rui Lima"))),
        F.when(k % 2 == 0, entity("ORG", start + 1, start + 4, F.lit("Turma"))),
        entity("PESSOA", start + 900, start + 905, F.lit("Ivo Dias")),
        F.when(k % 7 == 0, entity("PESSOA", start - 1, start + 3, F.lit("Ada Cruz"))),
    )
    people = parts.select(k.cast("string").alias("documento_id"), F.explode(F.array_compact(found)).alias("e")).select("documento_id", "e.*")
    return typed(rows, people).select("documento_id", F.col("acordao.relator").alias("relator"))


def entity(label: str, start: Column, end: Column, text: Column) -> Column:
    return F.struct(F.lit(label).alias("rotulo"), start.cast("int").alias("inicio"), end.cast("int").alias("fim"), text.alias("texto"))


def envelopes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes of customers with up to three citations, the second without an id: fields in their order, empty envelopes too."""
    customers = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    cite = lambda trecho, tipo, name: F.struct(trecho.alias("trecho"), F.lit(tipo).alias("tipo"), name.alias("id"))
    every = F.array(
        cite(F.concat(F.lit("HC "), pointed(k + 100000), F.lit(", STF")), "ACOR", F.concat(F.lit("x"), k.cast("string"))),
        cite(F.concat(F.lit("Súmula "), (k % 90 + 1).cast("string"), F.lit(" do STJ")), "SUM", F.lit(None).cast("string")),
        cite(F.concat(F.lit("art. "), (k % 80 + 1).cast("string"), F.lit(" do CPC")), "LEG", F.lit("z")),
    )
    given = customers.select(k.cast("string").alias("documento_id"), F.lit("texto").alias("text"), F.slice(every, F.lit(1), (k % 4).cast("int")).alias("citacoes"))
    out = enveloped(extract_document(given), given)
    each = lambda f: F.array_join(F.transform("citacoes", f), ",")
    key = lambda c: F.coalesce(c["acordao"]["numero"], F.array_join(F.transform(c["sumula"]["numero"], lambda x: x.cast("string")), ";"), F.array_join(c["dispositivo"]["artigo"], ";"))
    return out.select("documento_id", each(lambda c: c["id"]).alias("ids"), each(lambda c: c["natureza"]).alias("naturezas"), each(key).alias("chaves"))


def identify_with_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of customers with a model's spans: neighbours that are joined, spans that a rule's match replaces, one that is too short."""
    customers = load(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    text = F.concat(F.lit("Na APL "), F.lpad(k.cast("string"), 7, "0"), F.lit(" 51-18 diz-se que o art. 7 do CPC vale, Sum. 9"))
    docs = customers.select(k.cast("string").alias("documento_id"), text.alias("text"))
    span = lambda tipo, a, b, c: F.struct(F.lit(tipo).alias("tipo"), F.lit(a).alias("inicio"), F.lit(b).alias("fim"), F.lit(c).alias("confianca"))
    spans = F.array(span("ACOR", 3, 14, 0.5), F.when(k % 2 == 0, span("ACOR", 15, 20, 0.75)), F.when(k % 3 == 0, span("SUM", 32, 36, 0.25)), span("SUM", 0, 2, 0.9), F.when(k % 5 == 0, span("LEG", 54, 60, 0.625)))
    model = customers.select(k.cast("string").alias("documento_id"), F.explode(F.array_compact(spans)).alias("e")).select("documento_id", "e.*")
    return identify(docs, model).select("documento_id", "id", "tipo", "inicio", "fim", "trecho", "confianca")


LABELS = ["O", "B-ACOR", "I-ACOR", "I-LEG"]


def table_scorer() -> Callable:
    """A scorer that looks labels and probabilities up by a token's id and its place in the window, so windows disagree about a token."""
    import numpy as np

    def predict(ids, mask):
        place = np.arange(ids.shape[1])[None, :]
        ids = ids.astype(np.int64)
        label = np.select([ids >= 10, ids >= 8, (ids == 7) & (place % 4 < 2)], [1, 2, 3], 0)
        prob = 0.5 + ((ids * 7 + place * 3) % 16) / 32
        out = np.zeros((*ids.shape, len(LABELS)), dtype=np.float32)
        np.put_along_axis(out, label[..., None], prob[..., None].astype(np.float32), axis=2)
        return out.reshape(len(ids), -1)

    return predict


def windowed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents as tokens of their length, ten places apart, scored window by window."""
    words = load(spark, sf_dir, "documents").select("doc_id", F.transform(F.split("text", " "), F.length).alias("input_ids"))
    tokens = words.select("doc_id", "input_ids", F.transform("input_ids", lambda _, i: F.array(i * 10, i * 10 + 8)).alias("offset_mapping"))
    found, repairs = entities(scored(windows(tokens), table_scorer, LABELS))
    out = found.select("doc_id", F.col("inicio").cast("long").alias("inicio"), F.col("fim").cast("long").alias("fim"), "tipo", F.round("confianca", 6).alias("confianca"))
    return out.unionByName(repairs.select("doc_id", F.lit(-1).cast("long").alias("inicio"), F.col("reparos").alias("fim"), F.lit("reparos").alias("tipo"), F.lit(0.0).alias("confianca")))


def citation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as judged citations of their order, but for orders whose document cannot be read."""
    lines = load(spark, sf_dir, "lineitem").where(~unreadable("l_orderkey")).groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("p"))
    n, p = F.col("l_linenumber"), F.col("p")
    void = lambda kind: F.lit(None).cast(kind)
    failed = p % 10 == 0
    columns = {
        "documento_id": document_name(F.col("l_orderkey")), "id": F.concat(F.lit("c"), n.cast("string")), "tipo": F.lit("LEG"), "inicio": n * 10, "fim": n * 10 + 5, "trecho": F.lit("xxxxx"), "confianca": F.lit(0.75),
        "tipo_citacao": F.lit("lei"), "natureza": F.lit("dispositivo"), "acordao": void("struct<numero:string,classe_normalizada_candidatos:array<string>>"), "sumula": void("struct<numero:array<int>>"), "dispositivo": F.struct(F.array(p.cast("string")).alias("artigo")),
        "classificacao": F.when(failed, "incompleta").otherwise(one_of(p, "real", "inventada", "incompleta")), "regra": F.lit("R"), "id_canonico": F.when(~failed & (p % 3 == 0), p), "log": void("array<struct<plano:string>>"),
        "candidates": F.when(failed, void("array<long>")).otherwise(F.slice(F.array(p, p + 1), F.lit(1), (p % 3).cast("int"))), "candidatos": void("array<struct<id_canonico:long>>"), "searched": ~failed, "sufficient": p % 2 == 0, "warnings": F.array(F.lit("aviso")), "confianca_final": F.lit(0.5),
        "error": F.when(failed, "CITATION_PIPELINE_ERROR"), "mensagem": F.when(failed, "unknown label"),
    }
    return lines.select(*(c.alias(name) for name, c in columns.items()))


def document_name(key: Column) -> Column:
    return F.concat(F.lit("d_N"), (key % 3).cast("string"), F.lit("_"), key.cast("string"))


def unreadable(key: str) -> Column:
    return F.col(key) % 97 == 5


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    return orders.select(document_name(F.col("o_orderkey")).alias("documento_id"), F.when(~unreadable("o_orderkey"), F.col("o_orderpriority")).alias("text"))


def order_errors(docs: DataFrame, cites: DataFrame) -> DataFrame:
    return raised(docs.where("text IS NULL"), "DOCUMENT_READ_ERROR", F.lit("UnicodeDecodeError")).unionByName(of_citations(cites))


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of orders as documents, read back: level, hash and length of the text, counters, repairs, errors, citations in text order; a document that cannot be read has its error alone."""
    docs, cites = order_documents(spark, sf_dir), citation_rows(spark, sf_dir)
    kept, gone = cites.where("id != 'c7'"), cites.where("id = 'c7'")
    key = F.regexp_extract("documento_id", r"(\d+)$", 1).cast("long")
    repairs = docs.where("text IS NOT NULL").where(key % 3 == 0).select("documento_id", (key % 5).alias("reparos"))
    out = document_json(kept, docs, gone, order_errors(docs, kept), repairs)
    get = lambda path, kind="string": F.get_json_object("json", path).cast(kind)
    record = F.from_json("json", "erros array<struct<codigo:string,citacao_id:string>>, citacoes array<struct<citacao_id:string,recuperacao:struct<status:string>,resolucao:struct<id_canonico:long>,erros:array<struct<codigo:string>>>>")
    out = out.withColumn("r", record)
    each = lambda c, f: F.array_join(F.transform(f"r.{c}", f), ",")
    return out.select(
        "documento_id", F.col("n_citacoes").cast("long").alias("n_citacoes"), F.col("n_erros").cast("long").alias("n_erros"), get("$.nivel").alias("nivel"), get("$.fonte.sha256").alias("sha256"), get("$.fonte.texto_len").alias("texto_len"),
        get("$.diagnostico.entidades_descartadas").alias("n_gone"), get("$.diagnostico.citacoes_com_erro").alias("n_error"), get("$.diagnostico.reparos_bio", "long").alias("reparos"),
        each("citacoes", lambda c: c["citacao_id"]).alias("ids"), each("citacoes", lambda c: c["recuperacao"]["status"]).alias("status"), each("citacoes", lambda c: F.coalesce(c["resolucao"]["id_canonico"].cast("string"), F.lit("-"))).alias("resolvidas"),
        each("erros", lambda e: F.concat_ws(":", e["codigo"], e["citacao_id"])).alias("erros"), each("citacoes", lambda c: F.size(c["erros"]).cast("string")).alias("erros_de_cada"),
    )


def run_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, cites = order_documents(spark, sf_dir), citation_rows(spark, sf_dir)
    kept = cites.where("id != 'c7'")
    return run_summary(kept, docs, cites.where("id = 'c7'"), order_errors(docs, kept))


def document_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary's row for each document, also those without citations and those that cannot be read."""
    docs, cites = order_documents(spark, sf_dir), citation_rows(spark, sf_dir)
    return document_counts(cites, docs, order_errors(docs, cites))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of decision on orders: errors, several candidates, a conflict, one or more attempts, identities."""
    k = F.col("o_orderkey")
    rows = load(spark, sf_dir, "orders").select(
        k.alias("mention_id"), F.slice(F.array(k, k + 1, k), F.lit(1), (k % 4).cast("int")).alias("candidates"), (k % 2 + 1).cast("int").alias("attempts"), (k % 5 < 2).alias("sufficient"), (k % 11 == 0).alias("error"), (k % 3 == 0).alias("conflict"),
    )
    out = decide(rows)
    return out.select("mention_id", "classificacao", "regra", F.col("id_canonico").cast("string").alias("id_canonico"), final_confidence(F.col("confianca_decisao"), F.lit(0.8)).alias("confianca"))


QUERIES = {
    "extract_acordao_forms": acordao_forms,
    "extract_dispositivo_forms": dispositivo_forms,
    "extract_sumula_forms": sumula_forms,
    "typed_numbers": typed_numbers,
    "document_records": document_records,
    "run_summary": run_summaries,
    "extract_acordao": extract_acordao_query,
    "extract_dispositivo": extract_dispositivo_query,
    "extract_sumula": extract_sumula_query,
    "identify_mentions": identify_query,
    "build_index": build_index_query,
    "build_index_courts": courts_query,
    "verify_citations": verify_citations,
    "submission_cells": submission_cells,
    "discarded_mentions": discarded_mentions,
    "recognised_persons": recognised_persons,
    "envelope_extraction": envelopes_query,
    "identify_with_model": identify_with_model,
    "windowed_entities": windowed_entities,
    "document_counts": document_counts_query,
    "decisions": decisions,
}

_DOTTED = "({0}) // 1000 || '.' || lpad(CAST(({0}) % 1000 AS VARCHAR), 3, '0')"
_TEXTS = f"""
t AS (
  SELECT c_custkey AS n, 'Como decidido na ' AS a,
         'Rcl ' || {_DOTTED.format("c_custkey + CASE WHEN c_custkey % 3 = 0 THEN 500000 ELSE 100000 END")} || CASE WHEN c_custkey % 2 = 0 THEN ' (SP)' ELSE '' END AS rcl,
         ', e nos termos do ' AS b, 'art. ' || (c_custkey % 40 + 1) || ' do Código Civil' AS art
  FROM customer),
v AS (
  SELECT CAST(n AS VARCHAR) AS documento_id, 'c1' AS id, 'acordao' AS natureza, length(a) AS s, length(a || rcl) AS e,
         CASE WHEN n % 3 <> 0 THEN 'real' ELSE 'inventada' END AS classificacao,
         CASE WHEN n % 3 = 0 THEN 'IDENTIDADE_SUFICIENTE_SEM_CANDIDATO' WHEN n % 2 = 0 THEN 'UNICO_CONSISTENTE_EM_CONSULTA_PARCIAL' ELSE 'UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA' END AS regra,
         CASE WHEN n % 3 <> 0 THEN CAST(n + 1000 AS VARCHAR) END AS id_canonico, CASE WHEN n % 3 = 0 THEN 0.9313e0 WHEN n % 2 = 0 THEN 0.9143e0 ELSE 0.9738e0 END AS confianca FROM t -- headers name states, not their codes
  UNION ALL
  SELECT CAST(n AS VARCHAR), 'c2', 'dispositivo', length(a || rcl || b), length(a || rcl || b || art),
         CASE WHEN n % 40 < 30 THEN 'real' ELSE 'inventada' END, CASE WHEN n % 40 < 30 THEN 'UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA' ELSE 'IDENTIDADE_SUFICIENTE_SEM_CANDIDATO' END,
         CASE WHEN n % 40 < 30 THEN CAST(n % 40 + 1 AS VARCHAR) END, CASE WHEN n % 40 < 30 THEN 0.9738e0 ELSE 0.9313e0 END FROM t)
"""
_CITES = """
l AS (SELECT *, p % 10 = 0 AS failed FROM (SELECT l_orderkey AS k, l_linenumber AS n, min(l_partkey) AS p FROM lineitem WHERE l_orderkey % 97 <> 5 GROUP BY ALL))
"""
ORACLES = {
    "extract_acordao_forms": f"""
WITH o AS (SELECT o_orderkey AS k, CAST(year(o_orderdate) AS INT) AS y, {_DOTTED.format("o_orderkey + 100000")} AS d FROM orders)
SELECT k AS o_orderkey, ['STF', 'TST', NULL, NULL, 'STJ', 'STF'][k % 6 + 1] AS tribunal,
       ['HABEAS CORPUS', 'RECURSO DE REVISTA', 'MANDADO DE SEGURANCA', 'RECLAMACAO', 'RECURSO ESPECIAL', 'HABEAS CORPUS'][k % 6 + 1] AS classe_processual_normalizada,
       CASE WHEN k % 6 = 1 THEN lpad(CAST(k AS VARCHAR), 7, '0') || '-31.2017.5.04.0009' ELSE d END AS numero,
       CASE k % 6 WHEN 3 THEN 'MT' WHEN 4 THEN 'GO' END AS uf, CASE WHEN k % 6 IN (0, 3) THEN CAST(y AS VARCHAR) END AS ano FROM o""",
    "extract_dispositivo_forms": """
WITH q AS (SELECT p_partkey AS k, p_size % 7 + 1 AS a FROM part)
SELECT k AS p_partkey, [NULL, 'CPC', 'CF/88', 'CC', 'CPC'][k % 5 + 1] AS diploma,
       CASE k % 5 WHEN 0 THEN a || ',' || (a + 2) || ',' || (a + 20) WHEN 1 THEN (a + 300) || ',' || (a + 400) || ',' || (a + 500) WHEN 2 THEN CAST(a + 30 AS VARCHAR)
                  WHEN 3 THEN (a + 180) || ',' || (a + 190) || ',' || (a + 200) ELSE '1.01' || a END AS artigo,
       CASE k % 5 WHEN 0 THEN ['II', 'IV', 'XI'][k % 3 + 1] || ',XII' WHEN 2 THEN 'XXI' ELSE '' END AS inciso,
       CASE k % 5 WHEN 1 THEN a || ',' || (a + 1) WHEN 2 THEN 'UNICO' WHEN 4 THEN CAST(a AS VARCHAR) ELSE '' END AS paragrafo, CASE k % 5 WHEN 2 THEN 'B' ELSE '' END AS alinea FROM q""",
    "extract_sumula_forms": """
SELECT p_partkey, ['STF', 'STJ', 'TST', NULL][p_partkey % 4 + 1] AS tribunal, CASE WHEN p_partkey % 4 = 3 THEN '' ELSE CAST(p_size AS VARCHAR) END AS numero, p_partkey % 4 = 0 AS vinculante FROM part""",
    "typed_numbers": """
SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN lpad(CAST(o_orderkey AS VARCHAR), 7, '0') || '5620205010001' WHEN 1 THEN CAST(o_orderkey + 100000 AS VARCHAR)
       WHEN 4 THEN NULL ELSE CAST(o_orderkey % 1000 + 10 AS VARCHAR) END AS numero FROM orders""",
    "document_records": f"""
WITH {_CITES},
c AS (SELECT k, count(*) AS m, count(*) FILTER (failed) AS err, string_agg('c' || n, ',' ORDER BY n) AS ids,
             string_agg(CASE WHEN failed THEN 'erro_tecnico' ELSE ['nenhum_candidato', 'candidato_unico', 'multiplos_candidatos'][p % 3 + 1] END, ',' ORDER BY n) AS status,
             string_agg(CASE WHEN NOT failed AND p % 3 = 0 THEN CAST(p AS VARCHAR) ELSE '-' END, ',' ORDER BY n) AS resolvidas,
             string_agg('CITATION_PIPELINE_ERROR:c' || n, ',' ORDER BY n) FILTER (failed) AS erros, string_agg(CASE WHEN failed THEN '1' ELSE '0' END, ',' ORDER BY n) AS each_erros
      FROM l WHERE n <> 7 GROUP BY k),
g AS (SELECT k, count(*) AS gone FROM l WHERE n = 7 GROUP BY k)
SELECT 'd_N' || o_orderkey % 3 || '_' || o_orderkey AS documento_id, coalesce(m, 0) AS n_citacoes, CASE WHEN o_orderkey % 97 = 5 THEN 1 ELSE coalesce(err, 0) END AS n_erros, CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 3 AS VARCHAR) END AS nivel,
       CASE WHEN o_orderkey % 97 <> 5 THEN sha256(o_orderpriority) END AS sha256, CASE WHEN o_orderkey % 97 <> 5 THEN CAST(length(o_orderpriority) AS VARCHAR) END AS texto_len,
       CASE WHEN o_orderkey % 97 <> 5 THEN CAST(coalesce(gone, 0) AS VARCHAR) END AS n_gone, CASE WHEN o_orderkey % 97 <> 5 THEN CAST(coalesce(err, 0) AS VARCHAR) END AS n_error,
       CASE WHEN o_orderkey % 97 <> 5 AND o_orderkey % 3 = 0 THEN o_orderkey % 5 ELSE 0 END AS reparos,
       coalesce(ids, '') AS ids, coalesce(status, '') AS status, coalesce(resolvidas, '') AS resolvidas, CASE WHEN o_orderkey % 97 = 5 THEN 'DOCUMENT_READ_ERROR' ELSE coalesce(erros, '') END AS erros, coalesce(each_erros, '') AS erros_de_cada
FROM orders LEFT JOIN c ON c.k = o_orderkey LEFT JOIN g ON g.k = o_orderkey""",
    "run_summary": f"""
WITH {_CITES}, bad AS (SELECT count(*) AS n FROM orders WHERE o_orderkey % 97 = 5)
SELECT count(*) FILTER (n <> 7) AS citacoes, count(*) FILTER (n <> 7 AND NOT failed AND p % 3 = 0) AS "real", count(*) FILTER (n <> 7 AND NOT failed AND p % 3 = 1) AS inventada, count(*) FILTER (n <> 7 AND (failed OR p % 3 = 2)) AS incompleta,
       (SELECT count(*) FROM orders) AS documentos, count(*) FILTER (n = 7) AS descartadas, count(*) FILTER (n <> 7 AND failed) + (SELECT n FROM bad) AS erros FROM l""",
    "document_counts": f"""
WITH {_CITES}, c AS (SELECT k, count(*) AS m, count(*) FILTER (failed) AS err FROM l GROUP BY k)
SELECT 'd_N' || o_orderkey % 3 || '_' || o_orderkey AS documento_id, coalesce(m, 0) AS citacoes, CASE WHEN o_orderkey % 97 = 5 THEN 1 ELSE coalesce(err, 0) END AS erros
FROM orders LEFT JOIN c ON k = o_orderkey""",
    "recognised_persons": """
SELECT CAST(p_partkey AS VARCHAR) AS documento_id, CASE WHEN p_partkey % 5 = 0 THEN 'Eva Reis' WHEN p_partkey % 3 = 1 THEN 'Ana Souza' END AS relator FROM part""",
    "envelope_extraction": f"""
WITH c AS (SELECT c_custkey AS k, c_custkey % 4 AS m, {_DOTTED.format("c_custkey + 100000")} AS n FROM customer)
SELECT CAST(k AS VARCHAR) AS documento_id, array_to_string(['x' || k, 'c2', 'z'][:m], ',') AS ids, array_to_string(['acordao', 'sumula', 'dispositivo'][:m], ',') AS naturezas,
       array_to_string([n, CAST(k % 90 + 1 AS VARCHAR), CAST(k % 80 + 1 AS VARCHAR)][:m], ',') AS chaves FROM c""",
    "decisions": """
WITH o AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS n, o_orderkey % 2 + 1 AS attempts FROM orders),
d AS (SELECT *, CASE WHEN k % 11 = 0 THEN 1 WHEN n > 1 THEN 2 WHEN n = 1 AND k % 3 = 0 THEN 3 WHEN n = 1 AND attempts > 1 THEN 4 WHEN n = 1 THEN 5 WHEN k % 5 < 2 THEN 6 ELSE 7 END AS r FROM o)
SELECT k AS mention_id, ['incompleta', 'incompleta', 'incompleta', 'real', 'real', 'inventada', 'incompleta'][r] AS classificacao,
       ['ERRO_TECNICO', 'MULTIPLOS_CANDIDATOS', 'CANDIDATO_COM_CONFLITO', 'UNICO_CONSISTENTE_EM_CONSULTA_PARCIAL', 'UNICO_CONSISTENTE_EM_CONSULTA_COMPLETA', 'IDENTIDADE_SUFICIENTE_SEM_CANDIDATO', 'IDENTIDADE_INSUFICIENTE'][r] AS regra,
       CASE WHEN r IN (4, 5) THEN CAST(k AS VARCHAR) END AS id_canonico, [0.4175e0, 0.868e0, 0.7575e0, 0.885e0, 0.9445e0, 0.902e0, 0.817e0][r] AS confianca FROM d""",
    "windowed_entities": """
WITH RECURSIVE w AS (SELECT doc_id, unnest(list_transform(string_split(text, ' '), lambda x: length(x))) AS id, generate_subscripts(string_split(text, ' '), 1) - 1 AS i, len(string_split(text, ' ')) AS n FROM documents),
s AS (SELECT *, x * 414 AS first FROM w, (SELECT unnest(range(0, 100)) AS x) WHERE x * 414 <= i AND i < x * 414 + 510 AND x * 414 <= greatest(n - 97, 0)),
t AS (SELECT doc_id, x, i, id, i - first AS p FROM s),
l AS (SELECT *, CASE WHEN id >= 8 THEN 'ACOR' WHEN id = 7 AND p % 4 < 2 THEN 'LEG' END AS tipo, id >= 10 AS b, 0.5 + ((id * 7 + p * 3) % 16) / 32.0 AS prob FROM t),
o AS (SELECT *, tipo IS NOT NULL AND (b OR tipo IS DISTINCT FROM lag(tipo) OVER (PARTITION BY doc_id, x ORDER BY i)) AS opens FROM l),
k AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY doc_id, x ORDER BY i) AS island FROM o),
e AS MATERIALIZED (SELECT doc_id, x, island, min(tipo) AS tipo, min(i) * 10 AS a, max(i) * 10 + 8 AS z, avg(CAST(prob AS DOUBLE)) AS c, bool_or(opens AND NOT b) AS repaired FROM k WHERE tipo IS NOT NULL GROUP BY ALL),
h AS (SELECT *, coalesce(a >= max(z) OVER (PARTITION BY doc_id ORDER BY a, z, x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS apart FROM e),
q AS (SELECT *, count(*) FILTER (apart) OVER (PARTITION BY doc_id ORDER BY a, z, x ROWS UNBOUNDED PRECEDING) AS chain FROM h),
r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY doc_id, chain ORDER BY c DESC, a, z DESC, tipo) AS rank FROM q),
f AS (
  SELECT doc_id, chain, CAST(0 AS BIGINT) AS rank, CAST([] AS STRUCT(a BIGINT, z BIGINT, t VARCHAR, c DOUBLE)[]) AS kept FROM r GROUP BY doc_id, chain
  UNION ALL
  SELECT r.doc_id, r.chain, r.rank, CASE WHEN len(list_filter(kept, lambda y: y.a < r.z AND r.a < y.z)) > 0 THEN kept ELSE list_append(kept, {'a': r.a, 'z': r.z, 't': r.tipo, 'c': r.c}) END
  FROM f JOIN r ON r.doc_id = f.doc_id AND r.chain = f.chain AND r.rank = f.rank + 1),
g AS (SELECT doc_id, unnest(arg_max(kept, rank)) AS y FROM f GROUP BY doc_id, chain)
SELECT doc_id, y.a AS inicio, y.z AS fim, y.t AS tipo, round(y.c, 6) AS confianca FROM g
UNION ALL SELECT doc_id, -1, count(*), 'reparos', 0.0 FROM e WHERE repaired GROUP BY doc_id""",
    "identify_with_model": """
WITH t AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS documento_id, lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS n FROM customer)
SELECT documento_id, 'c1' AS id, 'ACOR' AS tipo, 3 AS inicio, CASE WHEN k % 2 = 0 THEN 20 ELSE 14 END AS fim, 'APL ' || n || CASE WHEN k % 2 = 0 THEN ' 51-18' ELSE '' END AS trecho, CASE WHEN k % 2 = 0 THEN 0.75e0 ELSE 0.5e0 END AS confianca FROM t
UNION ALL SELECT documento_id, 'c2', 'LEG', 34, 47, 'art. 7 do CPC', CASE WHEN k % 3 = 0 THEN 0.25e0 ELSE 0.995e0 END FROM t -- a rule's match inherits the model's confidence there
UNION ALL SELECT documento_id, 'c3', 'SUM', 54, 60, 'Sum. 9', 0.625e0 FROM t WHERE k % 5 = 0 -- the opening makes the label certain""",
    "extract_acordao": f"""
SELECT o_orderkey, 'STJ' AS tribunal, 'AgInt no REsp' AS classe_processual, 'AGRAVO INTERNO NO RECURSO ESPECIAL' AS classe_processual_normalizada,
       {_DOTTED.format("o_orderkey + 100000")} AS numero, ['SP', 'RJ', 'MG', 'RS'][o_orderkey % 4 + 1] AS uf, CAST(year(o_orderdate) AS INT) AS ano, 'João da Silva' AS relator
FROM orders""",
    "extract_dispositivo": """
SELECT p_partkey, ['CPC', 'CDC', 'CC', NULL][p_partkey % 4 + 1] AS diploma, CAST(p_size AS VARCHAR) AS artigo, CAST(p_partkey % 9 + 1 AS VARCHAR) AS paragrafo FROM part""",
    "extract_sumula": """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'STF' ELSE 'STJ' END AS tribunal, p_size || ',' || (p_size + 1) AS numero, false AS vinculante FROM part""",
    "identify_mentions": f"""WITH {_TEXTS}
SELECT CAST(n AS VARCHAR) AS documento_id, 'c1' AS id, 'ACOR' AS tipo, CAST(length(a) AS INT) AS inicio, CAST(length(a || rcl) AS INT) AS fim, rcl AS trecho, 0.995e0 AS confianca FROM t
UNION ALL SELECT CAST(n AS VARCHAR), 'c2', 'LEG', CAST(length(a || rcl || b) AS INT), CAST(length(a || rcl || b || art) AS INT), art, 0.995e0 FROM t""",
    "build_index": f"""
SELECT c_custkey + 1000 AS id_canonico, CAST(c_custkey + 100000 AS VARCHAR) AS chave, 'RECLAMACAO' AS grupo, '-/stf_ate_relator' AS detalhe FROM customer
UNION ALL SELECT i, CAST(i AS VARCHAR), 'CC', '-' FROM (SELECT unnest(range(1, 31)) AS i)""",
    "build_index_courts": """
WITH p AS (SELECT p_partkey AS k, p_size, ['01', '04', '99'][p_partkey % 3 + 1] AS r FROM part)
SELECT k AS id_canonico, 'acordao' AS tabela, lpad(CAST(k AS VARCHAR), 7, '0') || CASE WHEN k % 10 = 0 THEN '4520205' WHEN k % 5 = 0 THEN '4520175' ELSE '4520186' END || r || '0009' AS chave,
       CASE WHEN k % 10 = 0 THEN 'cnj/true/BA/4520/2/05/tst_recurso_numero' WHEN k % 5 = 0 THEN 'cnj/true/-/4520/1/75/tst_recurso_numero' ELSE 'cnj/true/-/4520/1/86/tse_ate_relator' END AS detalhe FROM p WHERE k % 5 < 2 -- year, segment and region by the places that the index fixes
UNION ALL SELECT k, 'acordao', left(lpad(CAST(k AS VARCHAR), 7, '0'), 6), 'traditional/false/-/tse_ate_relator' FROM p WHERE k % 5 = 1 -- a labelled number ends before what makes it a long one
UNION ALL SELECT k, 'acordao', '77888', 'traditional/false/-/tst_recurso_numero' FROM p WHERE k % 5 = 0
UNION ALL SELECT k, 'sumula', CAST(p_size AS VARCHAR), CASE WHEN k % 2 = 0 THEN 'STJ' ELSE 'TST' END || '/false' FROM p WHERE k % 5 = 2
UNION ALL SELECT k, 'aviso', NULL, CASE k % 5 WHEN 3 THEN 'SUMULA_PARSE_FAILED' ELSE 'NO_CASE_NUMBER' END FROM p WHERE k % 5 > 2""",
    "verify_citations": f"WITH {_TEXTS} SELECT documento_id, id, natureza, classificacao, regra, id_canonico, confianca FROM v",
    "submission_cells": f"""WITH {_TEXTS}
SELECT documento_id, string_agg(s || ',' || e || ',' || classificacao || ',' || coalesce(id_canonico, '-') || ',' || printf('%.4f', confianca), '|' ORDER BY s) AS citacoes FROM v GROUP BY documento_id""",
    "discarded_mentions": """
SELECT CAST(p_partkey AS VARCHAR) AS documento_id, ['acordao', 'acordao', 'acordao', 'sumula', 'sumula', 'dispositivo', 'dispositivo', 'acordao'][p_partkey % 8 + 1] AS natureza,
       p_partkey % 8 IN (1, 3, 5) AS discarded, CASE p_partkey % 8 WHEN 1 THEN 'classe_recuperada_por_fallback' WHEN 6 THEN 'diploma_fora_do_catalogo_conhecido' WHEN 7 THEN 'numero_recuperado_por_normalizacao_contextual' ELSE '' END AS warnings FROM part""",
}
