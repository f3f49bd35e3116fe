"""Near-duplicate documents by MinHash with tensored banding, confirmed on full sets.

A document's set is its distinct 3-word shingles. Two collections of ``SLOTS``
half-keys (``ROWS`` minhashes each) are computed; every pair of one half-key from
each collection is the key of a table, so SLOTS**2 tables of 2*ROWS minhashes cost
2*SLOTS*ROWS minhash functions in place of 2*SLOTS**2*ROWS. A link of similarity
s is missed with probability 1 - (1 - (1 - s**ROWS)**SLOTS)**2, 2e-5 at 0.85 and
7e-4 at 0.8; of pairs at 0.5, 22 % meet in some table, at 0.3, 2 in a thousand.

1. Documents with equal sets are one class (128-bit fingerprint), represented by
   the smallest doc_id; everything below handles representatives only.
2. Half-keys held by one representative drop out before pairs are formed.
3. Each table key makes its members candidates of its smallest one: a star. Members
   are compared with the centre on full sets, a star of many in parts of ``STAR``, in
   one stream that holds two sets at a time.
4. Stars that share members are a cluster. Most are then connected by confirmed links and done.
   Of the others every pair not yet connected is compared on full sets, ``BLOCK`` x ``BLOCK`` at a
   time, so no task or row ever holds a whole cluster; a task passes on only the
   links that join something new (a spanning forest).
5. Connected components by contraction, each round written to the shared folder.

Defined results: null or empty text, or no words: 0 shingles, its own component,
kept; repeated rows with one doc_id are one document, each row returned; a null
doc_id takes the component of an equal set, or null, and is then kept; very long texts are
shingled whole; ties go to the smallest doc_id; an empty table gives no rows; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import kernels
from tessera.llm.scratch import kept_schema, table, written

U = np.uint64
SLOTS, ROWS, BLOCK, STAR = 20, 5, 64, 2048
COLUMNS = 1 << 14
ODD = kernels.mix(np.arange(1, 2 * SLOTS * ROWS + 1, dtype=U) * U(0xA24BAED4963EE407)) | U(1)


def shingles(piece: kernels.Slice, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles, ordered by text, and the first of each text."""
    s, e, bounds = piece.spans(kernels.NOT_SPACE[piece.buf])
    h = piece.hashes(piece.prefix(lower=True), s, e)
    owner = kernels.owners(bounds)
    found, texts = [], []
    for n in range(1, size + 1):
        w, at = kernels.windows(h, owner, n)
        if n < size:  # a text of fewer words is one shingle
            only = np.diff(bounds)[owner[at]] == n
            w, at = kernels.mix(w[only] + U(n)), at[only]
        found.append(w)
        texts.append(owner[at])
    h, owner = np.concatenate(found), np.concatenate(texts)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(piece.rows + 1))


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, the set's fingerprint (f1, f2) and its half-keys (empty for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kernels.slices(batch.column("text")):
                h, bounds = shingles(piece, size)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                f = np.zeros((2, piece.rows), dtype=U)
                half = np.zeros((len(full), 2 * SLOTS), dtype=U)
                if len(full):
                    at = bounds[full]
                    f[0, full] = np.add.reduceat(h, at)
                    f[1, full] = np.add.reduceat(kernels.mix(h ^ U(0x5851F42D4C957F2D)), at)
                    for k in range(2 * SLOTS):
                        for m in range(ROWS):
                            half[:, k] = half[:, k] * U(0x9E3779B97F4A7C15) + np.minimum.reduceat(h * ODD[k * ROWS + m], at)
                    half = kernels.mix(half)
                size_of = np.zeros(piece.rows + 1, dtype=np.int32)
                size_of[full + 1] = 2 * SLOTS
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(size_of, dtype=np.int32)), pa.array(half.view(np.int64).ravel()))
                ids = batch.column("doc_id").slice(piece.first, piece.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n.astype(np.int64)), pa.array(f[0].view(np.int64)), pa.array(f[1].view(np.int64)), lists], ["doc_id", "n_shingles", "f1", "f2", "half"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, f1 long, f2 long, half array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the undirected edges (a, b); a component is named by its smallest node.

    In each round every node moves to its smallest neighbour and edges follow; the
    rounds end when no edge is left, after about the logarithm of the longest path.
    """
    edges = written(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    home = None
    while not edges.isEmpty():
        lowest = written(edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("a").alias("to")), F.struct(F.col("b").alias("node"), F.col("a").alias("to")))).alias("x")).groupBy("x.node").agg(F.min("x.to").alias("to")), "lowest")
        moved = edges.join(lowest.toDF("a", "ta"), "a").join(lowest.toDF("b", "tb"), "b")
        edges = written(moved.where("ta != tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
        if home is None:
            home = lowest.toDF("node", "component")
        else:
            home = written(home.join(lowest.toDF("component", "next"), "component", "left").select("node", F.coalesce("next", "component").alias("component")), "home")
    return edges.sparkSession.createDataFrame([], "node long, component long") if home is None else home


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of incidence columns, COLUMNS shingles at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keys, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[column]
    owner, place = owner[place >= 0], place[place >= 0]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        a, b = np.searchsorted(place, [low, low + COLUMNS])
        part = np.zeros((len(sets), int(place[b - 1]) - low + 1), dtype=np.float32)
        part[owner[a:b], place[a:b] - low] = 1
        out += part @ part.T
    return np.diag([float(len(s)) for s in sets]) + out * (1 - np.eye(len(sets)))


def forest(ids: list[int], sets: list[np.ndarray], block: list[bool], label: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that join components, among pairs of other labels of the two blocks (all such pairs if there is one)."""
    shared = overlaps(sets)
    n = np.array([len(s) for s in sets], dtype=np.float64)
    linked = np.triu(100 * shared >= percent * (n[:, None] + n[None, :] - shared), 1)
    side, known = np.array(block), np.array(label)
    linked &= known[:, None] != known[None, :]
    if side.any() and not side.all():
        linked &= side[:, None] != side[None, :]
    parent = list(range(len(ids)))
    out = []
    for x, y in np.argwhere(linked).tolist():
        i, j = ids[x], ids[y]
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def edges_of(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], ["a", "b"])


def sets_of(docs: DataFrame, seats: DataFrame, size: int) -> DataFrame:
    """``seats`` (node and more) with the shingle set of the node's text, as bytes.

    A merge join at every size: candidates grow with the documents, so they are never broadcast.
    """
    texts = docs.select(F.col("doc_id").alias("node"), "text").join(seats.hint("merge"), "node")
    carried = seats.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in kernels.slices(batch.column("text")):
                h, bounds = shingles(piece, size)
                raw = h.tobytes()
                data = [raw[8 * a : 8 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(piece.first, piece.rows) for c in carried), pa.array(data, pa.binary())], [*carried, "set"])

    return texts.mapInArrow(run, kept_schema(seats, carried, {"set": "binary"}))


def star_links(docs: DataFrame, candidates: DataFrame, size: int, percent: int) -> DataFrame:
    """Of the candidates (a, b), a the centre of a star, those that are links."""
    parts = F.ceil(F.col("g") / STAR).cast("int")
    stars = written(candidates.groupBy("a").agg(F.count("*").alias("g")).select("a", parts.alias("parts")), "stars")
    arms = candidates.join(stars, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("salt"), F.lit(1).alias("arm"))
    heads = stars.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(0).alias("arm"))
    seats = written(arms.unionByName(heads).groupBy("node").agg(F.collect_list(F.struct("a", "salt", "arm")).alias("seats")), "seats")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centre, out = None, None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a", "salt", "arm", "node")]
            for a, salt, arm, node, data in zip(*columns, batch.column("set")):
                own = np.frombuffer(data.as_buffer(), dtype=U)
                if not arm:
                    key, centre = (a, salt), own.copy()
                elif (a, salt) == key and 100 * min(len(own), len(centre)) >= percent * max(len(own), len(centre)):
                    at = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
                    both = int((centre[at] == own).sum())
                    if 100 * both >= percent * (len(own) + len(centre) - both):
                        out.append((a, node))
            yield edges_of(out)
            out.clear()

    dealt = sets_of(docs, seats, size).select("node", "set", F.explode("seats").alias("s")).select("node", "set", "s.a", "s.salt", "s.arm")
    return dealt.repartition("a", "salt").sortWithinPartitions("a", "salt", "arm").mapInArrow(compare, "a long, b long")


def cluster_links(docs: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) that connect what is linked but not of one label within each cluster (node, component, label)."""
    sizes = written(clusters.groupBy("component").agg(F.count("*").alias("g")), "sizes")
    parts = F.ceil(F.col("g") / BLOCK).cast("int")
    placed = clusters.join(sizes, "component").select("node", "component", "label", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("own"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, out = None, {}, []

        def flush() -> None:
            if len(members) > 1:
                own = list(members.values())
                out.extend(forest(list(members), [s for s, _, _ in own], [b for _, b, _ in own], [k for _, _, k in own], percent))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("component", "p", "q", "node", "own", "label")]
            for component, p, q, node, own, label, data in zip(*columns, batch.column("set")):
                if (component, p, q) != key:
                    flush()
                    key, members = (component, p, q), {}
                members[node] = np.frombuffer(data.as_buffer(), dtype=U), own == q, label
            if len(out) > 10_000:
                yield edges_of(out)
                out.clear()
        flush()
        yield edges_of(out)

    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    dealt = sets_of(docs, written(placed, "placed"), size).select("node", "component", "label", "own", "set", other)
    dealt = dealt.select("node", "component", "label", "own", "set", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"))
    return dealt.repartition("component", "p", "q").sortWithinPartitions("component", "p", "q").mapInArrow(compare, "a long, b long")


def links(docs: DataFrame, candidates: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges (a, b) with the components of all links among the documents of each cluster of candidates."""
    confirmed = written(star_links(docs, candidates, size, percent), "confirmed")
    label = components(confirmed).toDF("node", "label")
    clusters = components(candidates).join(label, "node", "left").select("node", "component", F.coalesce("label", "node").alias("label"))
    clusters = written(clusters, "clusters")
    mixed = written(clusters.groupBy("component").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("component"), "mixed")
    return confirmed.unionByName(cluster_links(docs, clusters.join(mixed, "component"), size, percent))


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row; ``docs`` needs doc_id and text.

    ``size`` words make a shingle; linked: 100 * intersection >= percent * union.
    """
    prints = written(fingerprints(docs, size), "prints")
    classes = written(
        prints.where("n_shingles > 0").groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.first("half").alias("half")).where("rep IS NOT NULL"),
        "classes",
    )
    half = classes.select("rep", F.posexplode("half").alias("slot", "key"))
    shared = written(half.groupBy("slot", "key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("slot", "key"), "shared")
    live = half.join(shared, ["slot", "key"])
    side = lambda cond: F.collect_list(F.when(cond, F.struct("slot", "key")))
    pairs = live.groupBy("rep").agg(side(F.col("slot") < SLOTS).alias("x"), side(F.col("slot") >= SLOTS).alias("y"))
    keys = written(pairs.select("rep", F.explode(F.flatten(F.transform("x", lambda a: F.transform("y", lambda b: F.xxhash64(a["slot"], b["slot"], a["key"], b["key"]))))).alias("key")), "keys")
    lowest = written(keys.groupBy("key").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo < hi").select("key", "lo"), "tables")
    candidates = keys.join(lowest, "key").where("rep != lo").select(F.col("rep").alias("b"), F.col("lo").alias("a")).distinct()
    found = components(links(docs, written(candidates, "candidates"), size, percent))
    moved = classes.select("f1", "f2", "rep", "n").join(found.toDF("rep", "component"), "rep", "left").where("n > 1 OR component != rep")
    moved = written(moved.select("f1", "f2", F.coalesce("component", "rep").alias("component_id")), "moved")
    out = prints.select("doc_id", "n_shingles", "f1", "f2").join(moved, ["f1", "f2"], "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_slice(w, k, k + 2) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM x JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * i >= 85 * (p.n + q.n - i)),
l AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.doc_id WHERE r.root < l.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c.root AS component_id, d.doc_id = c.root AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) c USING (doc_id)
"""
