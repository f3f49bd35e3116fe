"""Ordered operators: label islands, suppression, adjacent merge, ids and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.functions.spans import greedy
from tessera.functions.text import overlaps


def label_islands(tokens: DataFrame, doc: str | list[str] = "doc_id") -> DataFrame:
    """Spans of token labels.

    tokens: doc, pos, start, end, label (``B-X``, ``I-X`` or ``O``; null is skipped,
    as are tokens with start = end), prob. ``I`` continues a span of its own type
    only; elsewhere it opens one, which counts as a repair. One row per span with
    type, start, end, mean prob, and whether it was repaired.
    """
    keys = [doc] if isinstance(doc, str) else doc
    order = Window.partitionBy(*keys).orderBy("pos")
    rows = tokens.where("label IS NOT NULL AND start < end")
    kind = F.when(F.col("label") != "O", F.substring("label", 3, 1 << 20))
    rows = rows.withColumn("tipo", kind).withColumn("_before", F.lag("tipo").over(order))
    opens = F.col("tipo").isNotNull() & ~(F.col("label").startswith("I-") & F.col("tipo").eqNullSafe(F.col("_before")))
    rows = rows.withColumn("_opens", opens).withColumn("_island", F.sum(F.col("_opens").cast("int")).over(order))
    return rows.where("tipo IS NOT NULL").groupBy(*keys, F.col("_island").alias("island")).agg(
        F.first("tipo").alias("tipo"),
        F.min("start").alias("inicio"),
        F.max("end").alias("fim"),
        F.avg("prob").alias("confianca"),
        F.max(F.col("_opens") & F.col("label").startswith("I-")).alias("repaired"),
    )


def suppressed(spans: Column) -> Column:
    """Non-maximum suppression: of structs (confianca, inicio, fim, tipo), by confidence, then start, then length, those that overlap none kept before; in text order.

    Equal spans of one type keep their highest confidence, which comes first anyway.
    """
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct((-s["confianca"]).alias("k"), s["inicio"].alias("inicio"), (-s["fim"]).alias("nfim"), s["tipo"].alias("tipo"))))
    kept = greedy(ranked, "struct<k:double,inicio:int,nfim:int,tipo:string>", lambda a, b: overlaps(a["inicio"], -a["nfim"], b["inicio"], -b["nfim"]))
    return F.array_sort(F.transform(kept, lambda s: F.struct(s["inicio"].alias("inicio"), (-s["nfim"]).cast("int").alias("fim"), s["tipo"].alias("tipo"), (-s["k"]).alias("confianca"))))


def merge_adjacent(spans: DataFrame, doc: str, mergeable: Column, gap: int = 3) -> DataFrame:
    """Neighbours of one type joined, in chains.

    ``mergeable`` says of a row (with ``_before``, the struct of the row before it)
    whether text and type allow it to continue that row; the gap must be 0 to
    ``gap``. The merged span ends where its last part ends and has the highest
    confidence.
    """
    order = Window.partitionBy(doc).orderBy("inicio", "fim")
    rows = spans.withColumn("_before", F.lag(F.struct("tipo", "inicio", "fim")).over(order))
    distance = F.col("inicio") - F.col("_before.fim")
    continues = F.coalesce((F.col("tipo") == F.col("_before.tipo")) & distance.between(0, gap) & mergeable, F.lit(False))
    rows = rows.withColumn("_chain", F.sum((~continues).cast("int")).over(order))
    return rows.groupBy(doc, "_chain").agg(
        F.min_by("tipo", F.struct("inicio", "fim")).alias("tipo"),
        F.min("inicio").alias("inicio"),
        F.max_by("fim", F.struct("inicio", "fim")).alias("fim"),
        F.max("confianca").alias("confianca"),
        F.count("*").alias("parts"),
    ).drop("_chain")


def stable_ids(spans: DataFrame, doc: str) -> DataFrame:
    """``c1``, ``c2``, ... in text order within a document."""
    order = Window.partitionBy(doc).orderBy("inicio", "fim")
    return spans.withColumn("id", F.concat(F.lit("c"), F.row_number().over(order).cast("string")))


def hash_split(items: DataFrame, group: str, seed: str, fraction: float) -> DataFrame:
    """Whole groups by order of ``sha256(seed|group)`` into validation until it holds the wanted count.

    The order runs over 4,096 ranges of the hash: sums of the ranges are few, so they
    are added up together and broadcast; groups are ordered within their range alone.
    """
    sizes = items.groupBy(group).agg(F.count("*").alias("n")).withColumn("h", F.sha2(F.concat(F.lit(f"{seed}|"), F.col(group)), 256))
    sizes = sizes.withColumn("_range", F.coalesce(F.substring("h", 1, 3), F.lit("")))
    order = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("_range").agg(F.sum("n").alias("_n"))  # at most 4,097 rows
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    within = Window.partitionBy("_range").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before") + F.coalesce(F.sum("n").over(within), F.lit(0))
    return sizes.join(F.broadcast(ranges), "_range").withColumn("validation", before < F.bround(F.col("_all") * F.lit(fraction), 0)).select(group, "n", "h", "validation")


def token_windows(lengths: Column, size: int = 510, overlap: int = 96) -> Column:
    """Starts and ends of the windows of a token sequence, each ``size`` tokens, ``overlap`` shared with the one before."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(lengths - overlap - 1, F.lit(0)), F.lit(step))
    return F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(s + size, lengths).alias("end")))
