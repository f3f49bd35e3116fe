"""Entities of texts by a token scorer over overlapping windows.

Windows are rows, so a long text is many tasks' work. The scorer is the caller's: its labels and probabilities become
islands window by window, and of the spans of all windows of a text those are kept that overlap no surer one.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from tessera.functions.spans import let
from tessera.operators.sequences import suppressed, token_windows
from tessera.sources.settle import settled

SIZE, OVERLAP = 510, 96


def windows(tokens: DataFrame, doc: str = "doc_id", size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """(doc, window, input_ids, offset_mapping) of token sequences (doc, input_ids, offset_mapping), at most ``size`` tokens each; a text without tokens has none."""
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be smaller than the window")
    part = lambda c, w: F.transform(F.sequence(w["start"] + 1, w["end"]), lambda i: F.element_at(c, i)).alias(c)
    cut = F.transform(token_windows(F.size("input_ids"), size, overlap), lambda w: F.struct(part("input_ids", w), part("offset_mapping", w)))  # before it is rows, so that no row holds a whole text
    return tokens.where(F.size("input_ids") > 0).select(doc, F.posexplode(cut).alias("window", "w")).select(doc, "window", "w.input_ids", "w.offset_mapping")


def likeliest(make_predict: Callable, size: int, n_labels: int) -> Callable:
    """``make_predict`` with the number of the likeliest label of each token, the first of equal ones, and then its probability."""

    def make() -> Callable:
        inner = make_predict()

        def predict(ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
            every = np.asarray(inner(ids, mask)).reshape(len(ids), size, n_labels)
            return np.concatenate([every.argmax(axis=2), every.max(axis=2)], axis=1).astype(np.float32)

        return predict

    return make


def scored(rows: DataFrame, make_predict: Callable, labels: list[str], doc: str = "doc_id", size: int = SIZE, batch: int = 32) -> DataFrame:
    """(doc, window, tokens) of the windows, tokens an array of struct(start, end, label, prob).

    ``make_predict`` is called once a worker and returns a function of padded ids and masks, (n, size) each, that gives the
    probabilities (n, size * labels) of all labels of all tokens. A token has its likeliest label.
    """
    predict = predict_batch_udf(likeliest(make_predict, size, len(labels)), return_type=ArrayType(FloatType()), batch_size=batch, input_tensor_shapes=[[size], [size]])
    padded = lambda x: F.concat(x, F.array_repeat(F.lit(0.0).cast("float"), F.lit(size) - F.size("input_ids")))
    out = rows.withColumn("_p", predict(padded(F.transform("input_ids", lambda x: x.cast("float"))), padded(F.transform("input_ids", lambda _: F.lit(1.0).cast("float")))))
    names = F.array(*map(F.lit, labels))
    at = lambda i: F.element_at("_p", i + 1)
    token = lambda o, i: F.struct(F.element_at(o, 1).cast("int").alias("start"), F.element_at(o, 2).cast("int").alias("end"), F.element_at(names, at(i).cast("int") + 1).alias("label"), at(i + size).cast("double").alias("prob"))
    return out.select(doc, "window", F.transform("offset_mapping", token).alias("tokens"))


def window_islands(tokens: Column) -> Column:
    """Islands of one window's tokens: struct(confianca, inicio, fim, tipo, repaired), by the rules of ``label_islands``.

    A window has few tokens, so its islands are slices of its array and no token is ever a row.
    """
    kind = lambda t: F.when(t["label"] != "O", F.substring(t["label"], 3, 1 << 20))

    def marked(own: Column) -> Column:
        before = lambda i: kind(F.element_at(own, F.greatest(i, F.lit(1))))
        goes_on = lambda t, i: t["label"].startswith("I-") & (i > 0) & kind(t).eqNullSafe(before(i))
        return F.transform(own, lambda t, i: F.struct(t.alias("t"), kind(t).alias("tipo"), F.when(kind(t).isNull(), 0).when(goes_on(t, i), 1).otherwise(2).alias("step"), (i + 1).alias("at")))

    def cut(rows: Column) -> Column:
        edges = F.concat(F.transform(F.filter(rows, lambda r: r["step"] != 1), lambda r: r["at"]), F.array(F.size(rows) + 1))
        return let(edges, lambda ends: F.transform(F.filter(rows, lambda r: r["step"] == 2), lambda r: island(r, F.slice(rows, r["at"], F.element_at(ends, F.array_position(ends, r["at"]).cast("int") + 1) - r["at"]))))

    def island(first: Column, own: Column) -> Column:
        total = F.aggregate(own, F.lit(0.0), lambda n, r: n + r["t"]["prob"])
        return F.struct((total / F.size(own)).alias("confianca"), first["t"]["start"].alias("inicio"), F.array_max(F.transform(own, lambda r: r["t"]["end"])).alias("fim"), first["tipo"].alias("tipo"), first["t"]["label"].startswith("I-").alias("repaired"))

    kept = F.filter(tokens, lambda t: t["label"].isNotNull() & (t["start"] < t["end"]))
    return let(let(kept, marked), cut)


def entities(rows: DataFrame, doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Entities (doc, inicio, fim, tipo, confianca) of scored windows, and (doc, reparos), the labels that had to be repaired.

    An entity's confidence is the mean of its tokens' probabilities in its window. Spans are the first rows that are shuffled, and they compete
    only with those that they are chained to by overlaps, so each such chain is an array of its own, however long its text is.
    """
    islands = settled(rows.select(doc, F.explode(window_islands(F.col("tokens"))).alias("e")).select(doc, "e.*"), "islands")
    order = Window.partitionBy(doc).orderBy("inicio", "fim")
    apart = F.coalesce(F.col("inicio") >= F.max("fim").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    chained = islands.withColumn("_apart", apart.cast("int")).withColumn("_chain", F.sum("_apart").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = chained.groupBy(doc, "_chain").agg(F.collect_list(F.struct("confianca", "inicio", "fim", "tipo")).alias("s"))
    kept = spans.select(doc, F.explode(suppressed(F.col("s"))).alias("e")).select(doc, "e.inicio", "e.fim", "e.tipo", "e.confianca")
    return kept, islands.where("repaired").groupBy(doc).agg(F.count("*").alias("reparos"))
