"""Benchmark decontamination: exact containment of item windows, found by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter one).
Containment 1 needs every word of the window, so its necessary prefix is one
word: the rarest, by counts over all documents. A document word that is the
prefix of some window fixes where the window would lie (positional bound), the
window must fit into the document (length bound), and then its words are
compared one by one. Words are compared by a 64-bit hash taken modulo a prime.

Counts of words and prefixes of windows are relations: each task sends one count for each
word that it met, and windows meet the counts in a join. The windows are then broadcast as
flat arrays, ``CHUNK_WINDOWS`` (about 100 bytes each) at a time; a larger benchmark takes one more
reading of the documents for each chunk, which writes only the documents that it hits.

Defined results: null or empty text, or text without words: 0 words, no hits;
items without words never hit; a null item_id covers words but is not listed;
repeated document rows are judged each; repeated items count once by item_id; columns
of ``keep`` that are named like a new one are replaced by it; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import kernels
from tessera.llm.scratch import kept_schema, table, written

WINDOW = 10
CHUNK_WINDOWS, SIFT = 400_000, 20
U = np.uint64


def words(piece: kernels.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words, their texts, and the first word of each text."""
    s, e, bounds = piece.spans(kernels.WORD_LIKE[piece.buf])
    return piece.hashes(piece.prefix(lower=True), s, e), kernels.owners(bounds), bounds


class Sieve:
    """Fast look-up of hashes in a small sorted set: a table on 16 bits, then a binary search."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bits = np.zeros(1 << 16, dtype=bool)
        self.bits[(self.keys & U(0xFFFF)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``h`` of members, and their numbers in ``keys``."""
        at = np.flatnonzero(self.bits[(h & U(0xFFFF)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[k] == h[at]
        return at[ok], k[ok]


def item_windows(benchmark: DataFrame) -> DataFrame:
    """One row per distinct window: its word hashes and its item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("item").to_pylist()
            for piece in kernels.slices(batch.column("text")):
                h, _, bounds = words(piece)
                items, rows = [], []
                for i in range(piece.rows):
                    own = h[bounds[i] : bounds[i + 1]].view(np.int64)
                    for k in range(max(min(len(own), 1), len(own) - WINDOW + 1)):
                        items.append(ids[piece.first + i])
                        rows.append(own[k : k + WINDOW])
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(rows, pa.list_(pa.int64()))], ["item", "words"])

    return benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(run, "item string, words array<long>").distinct()


def word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Occurrences over all documents of each word of the vocabulary.

    A task sends one row for each word of a slice, which are summed before and after the
    shuffle. Words are sifted by ``SIFT`` bits of their hash first: at most 2**SIFT values
    reach the driver, and a large vocabulary only makes the sieve coarser.
    """
    bits = np.zeros(1 << SIFT, dtype=bool)
    bits[np.asarray(vocabulary.select(F.col("word").bitwiseAND(F.lit((1 << SIFT) - 1)).alias("b")).distinct().toArrow().column("b"))] = True
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kernels.slices(batch.column("text")):
                h = words(piece)[0]
                word, n = np.unique(h[shared.value[(h & U((1 << SIFT) - 1)).astype(np.int64)]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    counts = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.join(vocabulary, "word", "left_semi")


def anchored(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """Windows (item, words) with ``offset``, the place of the rarest word; of equally rare ones the first."""
    each = windows.select("item", "words", F.posexplode("words").alias("at", "word"))
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    rare = each.join(word_counts(docs, written(vocabulary, "vocabulary")), "word", "left").groupBy("item", "words").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "at")).alias("best"))
    return rare.select("item", "words", F.col("best.at").alias("offset"))


class Index:
    """Windows by their rarest word."""

    def __init__(self, windows: pa.Table):
        """windows: item, words, offset."""
        names = windows.column("item").combine_chunks()
        names = names.cast(pa.string())
        self.items = sorted(x for x in names.unique().to_pylist() if x is not None)
        self.item = np.asarray(pa.compute.fill_null(pa.compute.index_in(names, pa.array(self.items, pa.string())), -1), dtype=np.int64)
        lists = windows.column("words").combine_chunks()
        self.length = np.asarray(lists.value_lengths(), dtype=np.int64)
        self.offset = np.asarray(windows.column("offset").combine_chunks(), dtype=np.int64)
        self.words = np.zeros((len(lists), WINDOW), dtype=np.int64)
        row, k = kernels.expand(self.length)
        self.words[row, k] = np.asarray(lists.flatten())
        anchor = self.words[np.arange(len(lists)), self.offset].view(U)
        self.sieve = Sieve(anchor)
        group = np.searchsorted(self.sieve.keys, anchor)
        self.order = np.argsort(group, kind="stable")
        self.begin = np.searchsorted(group[self.order], np.arange(len(self.sieve.keys) + 1))

    def occurrences(self, h: np.ndarray, owner: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and window of every occurrence of a window."""
        at, key = self.sieve.find(h)
        row, k = kernels.expand(self.begin[key + 1] - self.begin[key])
        w = self.order[self.begin[key[row]] + k]
        start = at[row] - self.offset[w]
        text = owner[at[row]]
        ok = (start >= bounds[text]) & (start + self.length[w] <= bounds[text + 1])
        start, w = start[ok], w[ok]
        signed = h.view(np.int64)
        for k in range(WINDOW):
            short = self.length[w] <= k
            same = short | (signed[np.minimum(start + k, len(signed) - 1)] == self.words[w, k])
            start, w = start[same], w[same]
        return start, w


NEW = {"n_words": "long", "n_hit": "long", "n_items": "long", "items_sha256": "string", "contaminated": "boolean"}


def found_in(index: Index, piece: kernels.Slice, before: list[tuple] | None) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    """Of the texts of a slice: bounds of their words, which words are hit, and the items. ``before``: ranges and items of each text found earlier."""
    h, owner, bounds = words(piece)
    hit = np.zeros(len(h), dtype=bool)
    items: list[set[str]] = [set() for _ in range(piece.rows)]
    for i, (ranges, named) in enumerate(before or ()):
        items[i].update(named or ())
        for a, b in zip((ranges or ())[::2], (ranges or ())[1::2]):
            hit[bounds[i] + a : bounds[i] + b] = True
    start, w = index.occurrences(h, owner, bounds)
    if len(start):
        hit |= kernels.covered(start, index.length[w], len(h))
        for pair in np.unique(owner[start] * (len(index.items) + 1) + index.item[w] + 1).tolist():
            text, item = divmod(pair, len(index.items) + 1)
            if item:
                items[text].add(index.items[item - 1])
    return bounds, hit, items


def hits(docs: DataFrame, index: Index) -> DataFrame:
    """(doc_key, ranges, items) of the documents (doc_key, text) in which a window of the index occurs; ranges are starts and ends of runs of hit words."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kernels.slices(batch.column("text")):
                bounds, hit, items = found_in(shared.value, piece, None)
                some = [i for i in range(piece.rows) if hit[bounds[i] : bounds[i + 1]].any()]
                edges = [np.flatnonzero(np.diff(np.concatenate([[0], hit[bounds[i] : bounds[i + 1]].astype(np.int8), [0]]))) for i in some]
                keys = batch.column("doc_key").take(pa.array([piece.first + i for i in some], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, pa.array(edges, pa.list_(pa.int64())), pa.array([sorted(items[i]) for i in some], pa.list_(pa.string()))], ["doc_key", "ranges", "items"])

    return docs.select("doc_key", "text").mapInArrow(run, "doc_key binary, ranges array<long>, items array<string>")


def judged(rows: DataFrame, index: Index, keep: list[str]) -> DataFrame:
    """``keep`` and NEW of ``rows`` (text; ranges and items where earlier chunks have been searched)."""
    shared = rows.sparkSession.sparkContext.broadcast(index)
    earlier = [c for c in ("_ranges", "_items") if c in rows.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kernels.slices(batch.column("text")):
                part = batch.slice(piece.first, piece.rows)
                before = list(zip(*(part.column(c).to_pylist() for c in earlier))) if earlier else None
                bounds, hit, items = found_in(shared.value, piece, before)
                n_hit = np.bincount(kernels.owners(bounds)[hit], minlength=piece.rows)
                listed = [sorted(x) for x in items]
                new = [
                    pa.array(np.diff(bounds), pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([len(x) for x in listed], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in listed], pa.string()),
                    pa.array(n_hit > 0),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *new], [*keep, *NEW])

    return rows.select(*dict.fromkeys([*keep, "text", *earlier])).mapInArrow(run, kept_schema(rows, keep, NEW))


def contamination(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with n_words, n_hit, n_items, items_sha256 and contaminated."""
    keep = [c for c in keep if c not in NEW]
    windows = written(anchored(written(item_windows(benchmark), "windows"), docs), "anchored")
    chunks = max(1, -(-windows.count() // CHUNK_WINDOWS))
    chunk = lambda c: Index((windows if chunks == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(chunks)) == c)).toArrow())
    if chunks == 1:
        return judged(docs, chunk(0), keep)
    # Equal texts have equal hits, so a text's digest brings its hits back to each of its rows.
    keyed = docs.withColumn("doc_key", F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256)))
    parts = [written(hits(keyed, chunk(c)), "hits") for c in range(chunks - 1)]
    merged = reduce(DataFrame.unionByName, parts).groupBy("doc_key").agg(F.flatten(F.collect_list("ranges")).alias("_ranges"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("_items"))
    return judged(keyed.join(merged, "doc_key", "left"), chunk(chunks - 1), keep)


def op4_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs.select("doc_id", "text"), benchmark.select("item_id", "text"), ["doc_id"])


ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, list_slice(w, k, k + 9) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (
  SELECT r, k, n, list_slice(w, k, k + n - 1) AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, k, n, item FROM dw JOIN bw USING (win)),
pos AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM hits) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
