"""Vector code compression: product quantisation by rounds of RDD.treeAggregate over NumPy blocks.

Components become whole numbers; a vector is cut into ``PARTS`` parts, and each part is
replaced by the place of the nearest of ``ENTRIES`` codebook entries. The vectors are written once as
columnar blocks (a row for each dimension) of about ``BLOCK_BYTES``. A round is one treeAggregate: a task adds
the distances of its blocks up dimension by dimension, and adds parts and counts to int64 tensors by ``np.add.at``;
the tensors, whose size is that of the codebooks alone, meet in a tree of tasks before the driver adds the last few.

All is whole-number arithmetic, so results do not depend on the order of blocks or tasks.

Defined results: vectors that are null, empty, or hold a null or non-finite component are dropped; fewer than ``ENTRIES`` vectors:
as many entries; ties of distance go to the lower index; repeated vec_ids are ordered by their vectors,
and a null vec_id comes last; a null label is a label of its own; columns of other names are not read,
those of ``keep`` that are named like a new one are replaced by it; an empty table gives no rows. Vectors of
different lengths, lengths that the parts do not divide, and components of ``LIMIT`` / ``SCALE`` or more, whose squares
would not fit, are errors that name the reason.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import kept_schema, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 28  # of a component: PARTS times a part's squared distance stays below 2**63 up to 32 dimensions a part
BLOCK_BYTES = 4 << 20
NEW = {"code": "string", "error": "long"}
HEX = np.frombuffer(b"".join(b"%02x" % i for i in range(ENTRIES)), dtype=np.uint8).reshape(ENTRIES, 2)


def sound(vector: Column) -> Column:
    """Whether a vector is there, not empty, and all its components are finite."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers, floor(SCALE * x)."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"a component of {LIMIT // SCALE} or more is too large for whole-number distances")
    return scaled.astype(np.int32)


def batches_of(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """First row and columnar blocks (dimension, row) of a column of vectors, each of about BLOCK_BYTES."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) and not (np.diff(column.offsets.to_numpy()) == width).all():
        raise ValueError(f"vectors of other lengths than {width}")
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    step = max(1, BLOCK_BYTES // (4 * width))
    for at in range(0, len(flat), step):
        yield at, np.ascontiguousarray(whole(flat[at : at + step]).T)


def nearest(block: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and its squared distance, for each part (rows) and vector (columns)."""
    parts, entries, size = codebooks.shape
    at = np.zeros((parts, block.shape[1]), dtype=np.int64)
    least = np.zeros((parts, block.shape[1]), dtype=np.int64)
    for p in range(parts):
        total = np.zeros((entries, block.shape[1]), dtype=np.int64)
        for j in range(size):
            apart = block[p * size + j].astype(np.int64) - codebooks[p, :, j, None]
            apart *= apart
            total += apart
        at[p] = total.argmin(axis=0)  # the first of equal ones
        least[p] = np.take_along_axis(total, at[p][None], axis=0)[0]
    return at, least


Sums = tuple[np.ndarray, np.ndarray]


def added(codebooks: np.ndarray, acc: Sums, block: np.ndarray) -> Sums:
    """Sums and counts of the parts by entry with those of a block."""
    sums, counts = acc
    at, _ = nearest(block, codebooks)
    for p in range(len(codebooks)):
        np.add.at(counts[p], at[p], 1)
        for j in range(codebooks.shape[2]):
            np.add.at(sums[p, :, j], at[p], block[p * codebooks.shape[2] + j].astype(np.int64))
    return sums, counts


def merged(a: Sums, b: Sums) -> Sums:
    return a[0] + b[0], a[1] + b[1]


def columnar(vectors: DataFrame, width: int) -> DataFrame:
    """``vectors`` (embedding) as blocks of int32, one binary a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in batches_of(batch.column(0), width):
                yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary())], ["block"])

    return vectors.mapInArrow(run, "block binary")


def codebooks_of(vectors: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, position) of sound ``vectors`` (vec_id, embedding); empty without any."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).collect()
    if not first:
        return np.zeros((PARTS, 0, 0), dtype=np.int64)
    width = len(first[0]["embedding"])
    if width % PARTS:
        raise ValueError(f"{PARTS} equal parts do not divide vectors of {width}")
    if {len(r["embedding"]) for r in first} != {width}:
        raise ValueError(f"vectors of other lengths than {width}")
    start = whole(np.array([r["embedding"] for r in first])).astype(np.int64)
    codebooks = np.ascontiguousarray(start.reshape(len(first), PARTS, width // PARTS).transpose(1, 0, 2))
    blocks = written(columnar(vectors.select("embedding"), width), "blocks").rdd.map(lambda r: np.frombuffer(r[0], dtype=np.int32).reshape(width, -1))
    for _ in range(rounds):
        zero = (np.zeros_like(codebooks), np.zeros(codebooks.shape[:2], dtype=np.int64))
        sums, counts = blocks.treeAggregate(zero, lambda acc, block, books=codebooks: added(books, acc, block), merged, depth=2)
        used = counts > 0
        codebooks = codebooks.copy()
        codebooks[used] = sums[used] // counts[used][:, None]
    return codebooks


def encoded(vectors: DataFrame, codebooks: np.ndarray, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of sound ``vectors`` (embedding) with ``code`` and ``error``."""
    keep = [c for c in keep if c not in NEW]
    width = codebooks.shape[0] * codebooks.shape[2]
    shared = vectors.sparkSession.sparkContext.broadcast(codebooks)  # PARTS x ENTRIES x a part's length, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, block in batches_of(batch.column("embedding"), width):
                at, error = nearest(block, shared.value)
                n = block.shape[1]
                digits = np.ascontiguousarray(HEX[at.T].reshape(n, -1)).view(f"S{2 * len(at)}")[:, 0]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(first, n) for c in keep), pa.array(digits.astype(str), pa.string()), pa.array(error.sum(axis=0))], [*keep, *NEW])

    return vectors.select(*dict.fromkeys([*keep, "embedding"])).mapInArrow(run, kept_schema(vectors, keep, NEW))


def compress(embeddings: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code and error of every sound row of ``embeddings`` (vec_id, embedding, label), and the codebooks."""
    vectors = embeddings.select("vec_id", "embedding", "label").where(sound(F.col("embedding")))
    codebooks = codebooks_of(vectors)
    return encoded(vectors, codebooks, ["vec_id", "label"]), codebooks


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = compress(table(spark, sf_dir, "embeddings"))
    codes = written(codes, "codes")
    # Written, so that Spark knows its size and sends it to all tasks only if it is small.
    totals = written(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "_label")
    out = codes.join(totals, F.col("label").eqNullSafe(F.col("_label")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def _oracle() -> str:
    assigned = lambda k: f"""
a{k} AS MATERIALIZED (
  SELECT row, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT v.row, v.part, c.entry, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN c{k} c USING (part, pos) GROUP BY ALL)
  GROUP BY row, part)"""  # noqa: E731
    updated = lambda k: f""",{assigned(k)},
c{k + 1} AS MATERIALIZED (
  SELECT part, pos, c.entry, coalesce(u.x, c.x) AS x FROM c{k} c LEFT JOIN (
    SELECT part, pos, entry, CAST((sum(x)::BIGINT - ((sum(x)::BIGINT % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM v JOIN a{k} USING (row, part) GROUP BY ALL) u USING (part, pos, entry))"""  # noqa: E731
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS row, vec_id, label, embedding, len(embedding) // {PARTS} AS m FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (
  SELECT row, CAST((i - 1) // m AS INTEGER) AS part, CAST((i - 1) % m AS INTEGER) AS pos, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT row, m, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
c0 AS MATERIALIZED (SELECT part, pos, CAST(row - 1 AS INTEGER) AS entry, x FROM v WHERE row <= {ENTRIES})
{"".join(updated(k) for k in range(ROUNDS))},{assigned(ROUNDS)},
coded AS MATERIALIZED (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{ROUNDS} GROUP BY row),
labelled AS MATERIALIZED (SELECT label, sum(error)::BIGINT AS label_error FROM coded JOIN kept USING (row) GROUP BY label)
SELECT vec_id, code, error, label_error, (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{ROUNDS}) AS codebooks_sha256
FROM coded JOIN kept USING (row) JOIN labelled ON kept.label IS NOT DISTINCT FROM labelled.label
"""


ORACLE = _oracle()
