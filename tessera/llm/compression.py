"""Quality by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained on pieces of labelled texts, one on good and one on bad ones. A
text is cut into pieces of ``PIECE`` bytes, each is compressed with either dictionary, and the difference
of the two sums over the number of bytes is the margin: the bytes that each byte saves by being like good text.
A logistic curve fitted to other labelled rows makes it a probability. Beside the margin it takes the
density, the smaller sum over the number of bytes: text that repeats itself is small with either dictionary, so that
its margin says little.

Bounds of the labelled samples: at most ``SAMPLE`` rows of each kind for the dictionaries, of each at most ``PIECES`` pieces spread over
the whole text, and at most ``CALIBRATION`` rows for the curve. All of them are picked by a hash of doc_id, the
two kinds of samples from different remainders, so no row serves both. Scoring reads every text whole.

Defined results: null or empty text has margin and density 0 and the score of the curve there; without labels of both kinds every score is
the share of good labels in the sample, 1 without any; of rows that repeat a doc_id and label the smallest text is learnt from; very
long texts are compressed piece by piece; columns of ``keep`` that are named like a new one are replaced by
it, other columns never matter; ties are scored alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import kernels
from tessera.llm.scratch import kept_schema, table

SAMPLE, PIECES, CALIBRATION = 1500, 8, 3000  # bounds of what is learnt from
PIECE, DICTIONARY_BYTES, LEVEL = 512, 64 << 10, 3
KEEP = 0.3
FOLDS, CURVE_FOLD = 5, 4
NEW = {"score": "double", "margin": "double", "density": "double"}


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def pieces(text: bytes, most: int = PIECES) -> list[bytes]:
    """At most ``most`` pieces at even distances over the whole text."""
    n = -(-len(text) // PIECE)
    picked = range(n) if n <= most else (k * (n - 1) // (most - 1) for k in range(most))
    return [text[k * PIECE : (k + 1) * PIECE] for k in picked]


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of ``samples``; where they are too few to train one, the samples themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


class Sizer:
    """Compressed sizes with one dictionary, which is digested once."""

    def __init__(self, data: bytes):
        held = zstandard.ZstdCompressionDict(data)
        held.precompute_compress(level=LEVEL)
        self.one = zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)

    def __call__(self, text: memoryview) -> int:
        return sum(len(self.one.compress(text[at : at + PIECE])) for at in range(0, len(text), PIECE))


def measures(texts: pa.Array, good: Sizer, bad: Sizer) -> np.ndarray:
    """Margin (bytes saved a byte by the good dictionary against the bad one) and density of each text, as rows."""
    out = [np.zeros((2, 0))]
    for piece in kernels.slices(texts):
        whole, off = memoryview(piece.buf), piece.off.tolist()
        sizes = [np.array([by(whole[a:b]) for a, b in zip(off[:-1], off[1:])], dtype=np.float64) for by in (good, bad)]
        out.append(np.stack([sizes[1] - sizes[0], np.minimum(*sizes)]) / np.maximum(np.diff(piece.off), 1))
    return np.concatenate(out, axis=1)


def curve(points: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Slope of each measure (rows of ``points``) and intercept of a label's logistic curve, by Newton's method with halved steps on a lightly penalised loss."""
    design = np.vstack([points, np.ones(points.shape[1])])
    scale = np.maximum(np.abs(design).max(axis=1), 1e-9)
    design = design / scale[:, None]
    penalty = 1e-3
    loss = lambda c: np.logaddexp(0, c @ design).sum() - (label * (c @ design)).sum() + penalty * (c @ c) / 2
    at = np.zeros(len(design))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(at @ design, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))) @ design.T + penalty * np.eye(len(at)), design @ (p - label) + penalty * at)
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
    return at / scale


class Model:
    """The two dictionaries and the curve; without dictionaries every text has the score ``share``."""

    def __init__(self, good: bytes = b"", bad: bytes = b"", share: float = 1.0):
        self.good, self.bad, self.share = good, bad, share
        self.curve = np.array([50.0, 0.0, 0.0])  # where labels of both kinds are too few to fit one

    def sizers(self) -> tuple[Sizer, Sizer] | None:
        return (Sizer(self.good), Sizer(self.bad)) if self.good and self.bad else None

    def score(self, points: np.ndarray) -> np.ndarray:
        if not (self.good and self.bad):
            return np.full(points.shape[1], self.share)
        return 1 / (1 + np.exp(-np.clip(self.curve[:2] @ points + self.curve[2], -30, 30)))


def learnt_rows(docs: DataFrame, labels: DataFrame, wanted: Column, most: int) -> DataFrame:
    """doc_id, quality and text of at most ``most`` labelled rows."""
    picked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(wanted).select("doc_id", F.col("quality").cast("int").alias("quality")).distinct()
    picked = picked.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most)  # so the broadcast is bounded
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled rows that are not held out. Pieces of at most SAMPLE texts of each kind, and margins, reach the driver."""
    own = fold(F.col("doc_id"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [pieces((x or "").encode()) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.list_(pa.binary()))], ["doc_id", "pieces"])

    found = {}
    for quality in (0, 1):
        rows = learnt_rows(docs, labels, ~own.isin(0, CURVE_FOLD) & (F.col("quality") == quality), SAMPLE)
        got = rows.select("doc_id", "text").mapInArrow(cut, "doc_id long, pieces array<binary>").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
        found[quality] = [bytes(x) for r in got for x in r["pieces"]]
    if not (any(found[0]) and any(found[1])):
        return Model(share=float(bool(found[1]) or not found[0]))
    model = Model(dictionary(found[1]), dictionary(found[0]))
    rows = learnt_rows(docs, labels, own == CURVE_FOLD, CALIBRATION)
    got = np.array(sorted(tuple(r) for r in measured(rows, model, ["quality"]).select("quality", "margin", "density").collect())).reshape(-1, 3)
    if len(set(got[:, 0])) == 2:
        model.curve = curve(got[:, 1:].T, got[:, 0])
    return model


def measured(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with ``score``, ``margin`` and ``density``; ``docs`` needs ``text``."""
    keep = [c for c in keep if c not in NEW]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of DICTIONARY_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizers = shared.value.sizers()
        for batch in batches:
            points = measures(batch.column("text"), *sizers) if sizers else np.zeros((2, batch.num_rows))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(shared.value.score(points)), *map(pa.array, points)], [*keep, *NEW])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, kept_schema(docs, keep, NEW))


def op13_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = measured(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= KEEP).cast("int").alias("predicted"), "margin", "density")
