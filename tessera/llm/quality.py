"""Quality rules: exact base counts, and a calibrated n-gram classifier.

Word 1- and 2-grams and character 4-grams (of UTF-8 bytes) are hashed into
``BUCKETS`` weights each; a text's features are the shares of its n-grams in each
bucket. Logistic regression is fitted on at most ``SAMPLE`` labelled rows, picked
by a hash of doc_id; a fifth of them is kept apart to fit the two numbers of the
probability calibration. Scoring runs over Arrow batches; a text is kept if its
calibrated probability is at least ``KEEP``.

Defined results: null or empty text: no words, all counts 0, base_failed; no
labelled rows, or labels of one kind: probability 1 for every text; repeated
label rows count as they come; clashing columns of ``labels`` are not read; texts of one content are
judged alike, a probability of exactly ``KEEP`` keeps; very long texts are counted whole; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import kernels
from tessera.llm.scratch import kept_schema, table

U = np.uint64
BUCKETS, SAMPLE, KEEP = 1 << 15, 2000, 0.5
MIN_WORDS, MAX_REPEATED = 20, 30
SYMBOL = kernels.byte_class(r"[#*$%&|<>]")
CONTINUES = (np.arange(256) & 0xC0) == 0x80
GRAM = 4
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
NEW = {c: "long" for c in COUNTS} | {"base_failed": "boolean", "p_good": "double", "kept": "boolean"}


class Words:
    def __init__(self, piece: kernels.Slice):
        self.is_word = kernels.NOT_SPACE[piece.buf]
        self.start, end, self.bounds = piece.spans(self.is_word)
        self.prefix = piece.prefix(lower=False)
        self.hash = piece.hashes(self.prefix, self.start, end)
        self.owner = kernels.owners(self.bounds)
        self.salt = kernels.mix(np.arange(piece.rows, dtype=U))


def base_counts(piece: kernels.Slice, words: Words) -> list[np.ndarray]:
    """The base counts of each text, in the order of COUNTS."""
    line_start, line_end, line_bounds = piece.spans(piece.buf != 10)
    owner = kernels.owners(line_bounds)
    full = np.searchsorted(words.start, line_end) > np.searchsorted(words.start, line_start)
    key = piece.hashes(words.prefix, line_start[full], line_end[full]) ^ words.salt[owner[full]]
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), dtype=bool)
    again[first] = False
    window, at = kernels.windows(words.hash, words.owner, 8)
    twice = at[kernels.repeats(window ^ words.salt[words.owner[at]])]
    repeated = kernels.covered(twice, np.full(len(twice), 8), len(words.hash))
    per = lambda x: np.bincount(x, minlength=piece.rows)
    return [
        np.diff(words.bounds),
        piece.per_text(words.is_word & ~CONTINUES[piece.buf]),
        piece.per_text(SYMBOL[piece.buf]),
        per(owner[full][again]),
        per(words.owner[repeated]),
    ]


def grams(piece: kernels.Slice, words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Text and bucket of each n-gram, family by family, in text order."""
    bucket = lambda h, k: (h >> U(49)).astype(np.int32) + k * BUCKETS
    pair, at = kernels.windows(words.hash, words.owner, 2)
    out = [(words.owner, bucket(words.hash, 0)), (words.owner[at], bucket(pair, 1))]
    buf = piece.buf.astype(np.uint32)
    if len(buf) >= GRAM:
        n = len(buf) - GRAM + 1
        h = buf[:n] | (buf[1 : n + 1] << np.uint32(8)) | (buf[2 : n + 2] << np.uint32(16)) | (buf[3 : n + 3] << np.uint32(24))
        h *= np.uint32(0x9E3779B1)
        text = np.repeat(np.arange(piece.rows), np.maximum(np.diff(piece.off), 0))
        inside = text[:n] == text[GRAM - 1 :]
        out.append((text[:n][inside], (h[inside] >> np.uint32(17)).astype(np.int32) + 2 * BUCKETS))
    return out


def features(piece: kernels.Slice) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text, its buckets and their shares."""
    found = grams(piece, Words(piece))
    out = []
    for i in range(piece.rows):
        at, share = [], []
        for text, bucket in found:
            own = bucket[slice(*np.searchsorted(text, [i, i + 1]))]
            k, n = np.unique(own, return_counts=True)
            at.append(k)
            share.append(n / max(len(own), 1))
        out.append((np.concatenate(at), np.concatenate(share)))
    return out


class Model:
    """Weights for each bucket, and the slope and intercept of the calibration."""

    def __init__(self, weights: np.ndarray, slope: float, intercept: float):
        self.weights, self.slope, self.intercept = weights, slope, intercept

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.intercept, -30, 30)))

    def margins(self, piece: kernels.Slice, words: Words) -> np.ndarray:
        total = np.zeros(piece.rows)
        for text, bucket in grams(piece, words):
            n = np.bincount(text, minlength=piece.rows)
            total += np.bincount(text, self.weights[bucket], minlength=piece.rows) / np.maximum(n, 1)
        return total


def fitted(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model | None:
    """Logistic regression by Adagrad on (label, buckets, shares), calibrated on every fifth row."""
    labels = np.array([y for y, _, _ in rows], dtype=np.float64)
    apart = np.arange(len(rows)) % 5 == 4
    if len(set(labels[~apart])) < 2 or len(set(labels[apart])) < 2:
        return None
    owner = np.repeat(np.arange(len(rows)), [len(k) for _, k, _ in rows])
    bucket = np.concatenate([k for _, k, _ in rows])
    value = np.concatenate([v for _, _, v in rows]) * 100
    weights, squares, bias = np.zeros(3 * BUCKETS), np.full(3 * BUCKETS, 1e-3), 0.0
    share = labels[~apart].mean()
    importance = np.where(apart, 0, np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)))
    for _ in range(60):
        margin = np.bincount(owner, weights[bucket] * value, minlength=len(rows)) + bias
        error = importance * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels) / (~apart).sum()
        slope = np.bincount(bucket, error[owner] * value, minlength=3 * BUCKETS) + 1e-5 * weights
        squares += slope**2
        weights -= 0.2 * slope / np.sqrt(squares)
        bias -= 2 * error.sum()
    margin = np.bincount(owner, weights[bucket] * value, minlength=len(rows)) + bias
    x, y = margin[apart], labels[apart]
    y = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))  # Platt's targets
    scale = max(float(np.abs(x).max()), 1e-9)
    design = np.stack([x / scale, np.ones(len(x))])
    loss = lambda c: np.logaddexp(0, c @ design).sum() - (y * (c @ design)).sum()
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at @ design, -30, 30)))
        step = np.linalg.solve((design * np.maximum(p * (1 - p), 1e-9)) @ design.T + 1e-6 * np.eye(2), design @ (p - y))
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        at = at - size * step
    a, b = at[0] / scale, at[1]
    return Model((weights * 100).astype(np.float32), float(a), float(a * bias + b))


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from at most SAMPLE labelled rows; their features, not their texts, reach the driver."""
    picked = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [x for piece in kernels.slices(batch.column("text")) for x in features(piece)]
            data = [[x[0].astype(np.int32).tobytes() for x in got], [x[1].astype(np.float32).tobytes() for x in got]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), *(pa.array(x, pa.binary()) for x in data)], ["doc_id", "quality", "at", "share"])

    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("doc_id", "quality", "text")
    got = rows.mapInArrow(run, "doc_id long, quality int, at binary, share binary").orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    return fitted([(r["quality"], np.frombuffer(r["at"], np.int32), np.frombuffer(r["share"], np.float32)) for r in got])


def judge(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with the base counts, base_failed, p_good and kept. Columns of ``keep`` that are named like a new one are replaced by it."""
    keep = [c for c in keep if c not in NEW]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kernels.slices(batch.column("text")):
                words = Words(piece)
                counts = base_counts(piece, words)
                failed = (counts[0] < MIN_WORDS) | (100 * counts[4] > MAX_REPEATED * counts[0])
                good = np.ones(piece.rows) if shared.value is None else shared.value.probability(shared.value.margins(piece, words))
                own = [batch.column(c).slice(piece.first, piece.rows) for c in keep]
                yield pa.RecordBatch.from_arrays([*own, *(pa.array(c.astype(np.int64)) for c in counts), pa.array(failed), pa.array(good), pa.array(~failed & (good >= KEEP))], [*keep, *NEW])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, kept_schema(docs, keep, NEW))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
