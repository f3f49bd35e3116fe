"""Language identification by cross-parsing entropy.

For each language a suffix automaton holds every substring of a bounded sample of
labelled text. A document is parsed into longest phrases found in that sample; the
language whose sample needs the fewest phrases per folded byte wins.

Texts are folded to bytes (ASCII and Latin-1 letters lower-cased, runs of other
ASCII one space, bytes of other characters kept) and parsed in lanes of ``LANE`` bytes, all
lanes and languages in step, so that numpy does each step for thousands of lanes. A lane starts
a phrase of its own, so a text counts at most one phrase more for each lane, alike for all languages.

Defined results: null text, or text without a letter: ``und`` with score 0; no
labelled text at all: ``und``; equal counts: the language first in code-point
order; repeated rows are judged alike; other columns never matter; columns of
``keep`` that are named like a new one are replaced by it; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm import kernels
from tessera.llm.scratch import kept_schema, table

LANE = 256
SAMPLE_DOCS, SAMPLE_BYTES = 40, 24_000  # bound of the labelled sample, for each language
LETTER = re.compile(r"[^\W\d_]")
FOLD = np.array([b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)], dtype=np.uint8)
NEW = {"lang_pred": "string", "score": "double", "phrase_rate": "double"}


def folded(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Folded bytes and offsets of the same texts."""
    out = FOLD[buf]
    accented = np.flatnonzero((buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E) & (buf[1:] != 0x97)) + 1
    out[accented] += 32  # U+00C0 to U+00DE
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != 32) | (out[:-1] != 32)
    starts = off[:-1]
    keep[starts[starts < len(out)]] = True
    at = np.zeros(len(out) + 1, dtype=np.int64)
    np.cumsum(keep, out=at[1:])
    return out[keep], at[off]


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of ``data``; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return moves


Built = tuple[np.ndarray, np.ndarray, np.ndarray, int]


def compiled(samples: tuple[tuple[str, bytes], ...]) -> Built:
    """Symbol of each byte, the start of each language, and one flat transition table.

    An entry is the offset of the next state's row; the complement of an entry
    says that the phrase ended before this symbol and where the next one stands.
    The last symbol pads lanes and changes nothing; the one before is any byte
    that no sample has. Built once for each task and gone with it.
    """
    seen = sorted(set().union(*(set(data) for _, data in samples)))
    other, pad = len(seen), len(seen) + 1
    symbol = np.full(256, other, dtype=np.int32)
    symbol[seen] = np.arange(len(seen))
    width = pad + 1
    parts, starts, base = [], [], 0
    for _, data in samples:
        moves = suffix_automaton(data)
        dead = len(moves)  # stands for one byte that the sample lacks
        part = np.full((dead + 1, width), -1, dtype=np.int32)
        rows = np.repeat(np.arange(dead, dtype=np.int32), [len(m) for m in moves])
        part[rows, symbol[np.fromiter((c for m in moves for c in m), np.uint8, len(rows))]] = np.fromiter((s for m in moves for s in m.values()), np.int32, len(rows))
        del moves, rows
        part[0, part[0] < 0] = dead
        ended = ~((part[0] + base) * width)
        part = np.where(part >= 0, (part + base) * width, ended[None, :])
        part[:, pad] = (np.arange(dead + 1) + base) * width
        parts.append(part.ravel())
        starts.append(base * width)
        base += dead + 1
    return symbol, np.array(starts, dtype=np.int32), np.concatenate(parts), pad


def phrases(built: Built, piece: kernels.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of each text (rows) by each language (columns), and folded bytes of each text."""
    symbol, starts, moves, pad = built
    data, off = folded(piece.buf, piece.off)
    size = np.diff(off)
    lanes = -(-size // LANE)
    row, k = kernels.expand(lanes)
    begin = off[:-1][row] + k * LANE
    left = np.minimum(off[1:][row] - begin, LANE)
    out = np.zeros((piece.rows, len(starts)), dtype=np.int64)
    if len(row):
        padded = np.concatenate([symbol[data], np.full(LANE, pad, dtype=np.int32)])
        state = np.repeat(starts[:, None], len(row), axis=1)
        ended = np.zeros(state.shape, dtype=np.int32)
        for step in range(int(left.max())):
            here = np.where(step < left, padded[begin + step], pad)
            state = moves[state + here]
            over = state >> 31
            ended -= over
            state ^= over
        np.add.at(out, row, ended.T + 1)
    return out, size


def judged(names: list[str], built: Built | None, texts: pa.Array) -> Iterator[tuple[list[str], list[float], list[float]]]:
    """Language, score and phrases per folded byte, slice by slice."""
    for piece in kernels.slices(texts):
        if built is None:
            yield ["und"] * piece.rows, [0.0] * piece.rows, [1.0] * piece.rows
            continue
        count, size = phrases(built, piece)
        best = count.argmin(axis=1)
        low = count[np.arange(piece.rows), best]
        rest = np.sort(count, axis=1)[:, min(1, len(names) - 1)]
        score = rest / np.maximum(low + rest, 1)
        rate = low / np.maximum(size, 1)
        raw = piece.buf.tobytes()
        letters = [bool(LETTER.search(raw[a:b].decode())) for a, b in zip(piece.off[:-1].tolist(), piece.off[1:].tolist())]
        yield (
            [names[i] if ok else "und" for i, ok in zip(best.tolist(), letters)],
            [s if ok else 0.0 for s, ok in zip(score.tolist(), letters)],
            [r if ok else 1.0 for r, ok in zip(rate.tolist(), letters)],
        )


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame) -> tuple[tuple[str, bytes], ...]:
    """Labelled samples: for each language the whole texts of at most SAMPLE_DOCS rows, cut to SAMPLE_BYTES folded bytes.

    Rows are picked by a hash of doc_id; only ids are ranked, first in salted parts of
    each language, then among what those leave. What reaches the driver is bounded by the number of
    languages.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("doc_id"), "doc_id"))).where(F.col("rank") <= SAMPLE_DOCS)
    salted = rows.select("lang", "doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(64)).alias("salt")).distinct()
    picked = ranked(ranked(salted, "lang", "salt").drop("rank"), "lang").drop("salt")
    texts = rows.where(F.col("text").isNotNull()).select("lang", "doc_id", F.substring("text", 1, SAMPLE_BYTES).alias("text"))
    got = texts.join(F.broadcast(picked), ["lang", "doc_id"]).groupBy("lang", "rank").agg(F.min("text").alias("text")).orderBy("lang", "rank").collect()
    out: dict[str, bytes] = {}
    for r in got:
        raw = np.frombuffer(r["text"].encode(), dtype=np.uint8)
        data = folded(raw, np.array([0, len(raw)]))[0].tobytes()
        out[r["lang"]] = (out.get(r["lang"], b"") + b" " + data)[:SAMPLE_BYTES]
    return tuple(sorted((k, v) for k, v in out.items() if v.strip()))


def identify(docs: DataFrame, samples: tuple[tuple[str, bytes], ...], keep: list[str]) -> DataFrame:
    """The ``keep`` columns of every row with ``lang_pred``, ``score`` and ``phrase_rate``; ``docs`` needs ``text``."""
    keep = [c for c in keep if c not in NEW]
    shared = docs.sparkSession.sparkContext.broadcast(samples)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = None
        names = [name for name, _ in shared.value]
        for batch in batches:
            if built is None and names:
                built = compiled(shared.value)
            lang, score, rate = [], [], []
            for a, b, c in judged(names, built, batch.column("text")):
                lang += a
                score += b
                rate += c
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())], [*keep, *NEW])

    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, kept_schema(docs, keep, NEW))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learn(docs), ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "phrase_rate")
