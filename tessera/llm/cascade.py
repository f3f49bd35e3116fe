"""URL filters by a Bloom filter cascade.

Keys are rule keys (host suffix and path prefix) and host labels. Level 1 encodes
the listed keys; level 2 the keys of the corpus that level 1 passes wrongly; level
3 the listed keys that level 2 passes; and so on until a level passes nothing
wrongly. The levels are built against the complete set of keys that the corpus
has, so membership of every corpus key is exact, and no join is needed.

A cascade that would be larger than ``MAX_BITS`` is cut into shards of the hashed
keys; each has a cascade of its own and a pass of its own over the rows, so that
no more than one shard is broadcast at a time.

A url's candidate keys have the shapes of the rules: a host suffix of so many
labels and a path prefix of so many characters, longest first, so each url has at
most as many candidates as there are shapes. If no rule fits, the verdict is block
if one of the host's labels is listed in ``BLOCKED_LABELS``, else allow.

Defined results: null url, or one without ``://``: empty host and path, no rule,
allow; an empty list passes nothing; repeated rows are judged alike; of fitting rules of one length the one
first in code-point order is named; urls are read whole, however long; an empty table gives no rows; columns named
host, path, rule or verdict are replaced by the new ones, other columns pass through, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import kernels
from tessera.llm.scratch import table, written

U = np.uint64
MAX_BITS = 1 << 28
BLOCK_RULES = ["net/", "example.com/de/"]
ALLOW_RULES = ["example.net/en/", "org/fr/"]
BLOCKED_LABELS = ["casino-win", "ads-track", "spam-farm", "adult-x", "cheap-pills", "free-bets"]


def positions(h: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """The bits of each key, a row for each hash function."""
    a = kernels.mix(h.view(U) ^ kernels.mix(np.array([level + 1], dtype=U)))
    b = kernels.mix(a) | U(1)
    return np.stack([(a + U(k) * b) % U(bits) for k in range(hashes)])


class Level:
    def __init__(self, number: int, words: np.ndarray, bits: int, hashes: int):
        self.number, self.words, self.bits, self.hashes = number, words, bits, hashes

    def passes(self, h: np.ndarray) -> np.ndarray:
        at = positions(h, self.number, self.bits, self.hashes)
        return ((self.words[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1)).astype(bool).all(axis=0)


def member(levels: list[Level], h: np.ndarray) -> np.ndarray:
    """Which keys are listed: the first level that does not pass a key tells."""
    out = np.full(len(h), len(levels) % 2 == 1)
    left = np.arange(len(h))
    for level in levels:
        ok = level.passes(h[left])
        out[left[~ok]] = level.number % 2 == 1
        left = left[ok]
    return out


def encoded(keys: DataFrame, number: int, bits: int, hashes: int) -> Level:
    """A Bloom filter of the column ``h``: each task sets bits, equal words are merged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(positions(np.asarray(batch.column("h")), number, bits, hashes))
            word, first = np.unique(at >> U(6), return_index=True)
            value = np.bitwise_or.reduceat(U(1) << (at & U(63)), first) if len(at) else at
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(value.view(np.int64))], ["word", "value"])

    words = np.zeros(-(-bits // 64), dtype=U)
    for r in keys.mapInArrow(run, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).collect():  # at most MAX_BITS / 64 rows
        words[r["word"]] = np.array([r["value"]]).view(U)[0]
    return Level(number, words, bits, hashes)


def passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = np.asarray(batch.column("h"))
            yield pa.RecordBatch.from_arrays([pa.array(h[shared.value.passes(h)])], ["h"])

    return keys.mapInArrow(run, "h long")


def build(universe: DataFrame, listed: DataFrame) -> list[Level]:
    """The cascade for the distinct ``h`` of ``listed`` that is exact on the ``h`` of ``universe``."""
    inside = written(listed.distinct(), "listed")
    outside = written(universe.join(inside, "h", "left_anti"), "unlisted")
    levels: list[Level] = []
    n = inside.count()
    share = 0.5 * n / max(outside.count(), 1)
    while n:
        rate = min(max(share, 1e-6), 0.5)
        bits = max(64, 64 * math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 64))
        level = encoded(inside, len(levels), bits, max(1, round(bits / n * math.log(2)) if bits > 64 else 3))
        levels.append(level)
        inside, outside = written(passing(outside, level), "passed"), inside
        n, share = inside.count(), 0.5
    return levels


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def shapes(rules: list[str]) -> list[tuple[int, int]]:
    """(labels of the host suffix, characters of the path prefix) of the rules, longest path first, then longest host."""
    cut = [r.partition("/") for r in rules]
    return sorted({(h.count(".") + 1, len(p) + 1) for h, _, p in cut}, key=lambda s: (-s[0], -s[1]))


def keyed(pages: DataFrame, rules: list[str]) -> DataFrame:
    """``pages`` (with ``url``) and host, path, candidate rules by shape, and the host's labels as keys."""
    host, path = parts(F.col("url"))
    out = pages.withColumn("host", host).withColumn("path", path)
    candidates = [
        F.when((F.size(F.split("host", r"\.")) >= labels) & (F.length("path") >= chars), F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, chars)))
        for labels, chars in shapes(rules)
    ]
    out = out.withColumn("candidates", F.array_sort(F.array_compact(F.array(*candidates)), longer_first) if candidates else F.array().cast("array<string>"))
    return out.withColumn("labels", F.transform(F.split("host", r"\."), lambda x: F.concat(x, F.lit(":"))))


def longer_first(a: Column, b: Column) -> Column:
    return F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)


def marked(rows: DataFrame, lists: dict[str, list[Level]], shard: int, shards: int) -> DataFrame:
    """``rows`` with candidates_blocked, candidates_allowed and labels_blocked set for the keys of one shard."""
    shared = rows.sparkSession.sparkContext.broadcast(lists)
    tests = [("candidates", "blocked"), ("candidates", "allowed"), ("labels", "blocked")]
    new = [f"{c}_{name}" for c, name in tests]
    old = [c for c in rows.columns if c not in new]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in old), *(f"{c} array<boolean>" for c in new)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for column, name in tests:
                keys = batch.column(f"{column}_h")
                h = np.asarray(keys.flatten(), dtype=np.int64)
                own = h.view(U) % U(shards) == U(shard)
                found = member(shared.value[name], h) & own
                if shard:
                    found |= np.asarray(batch.column(f"{column}_{name}").flatten())
                ends = np.concatenate([[0], np.cumsum(keys.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(found)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in old), *out], [*old, *new])

    return rows.mapInArrow(run, schema)


def judge(pages: DataFrame, block: list[str], allow: list[str], labels: list[str] | DataFrame) -> DataFrame:
    """All columns of ``pages`` with host, path, rule and verdict, which replace columns of these names.

    ``labels``: the host labels that block where no rule fits, as a list or as a table of any size with a column ``label``.
    """
    spark = pages.sparkSession
    listed = labels if isinstance(labels, DataFrame) else spark.createDataFrame([(x,) for x in labels], "label string")
    listed = written(listed.where("label IS NOT NULL").select(F.concat("label", F.lit(":")).alias("key")).distinct(), "labels")
    rules = lambda x: spark.createDataFrame([(k,) for k in x], "key string")
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    names = [F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(others)]
    rows = keyed(pages.select(F.struct(*names).alias("_row"), "url"), block + allow)
    hashed = lambda c: F.transform(c, lambda k: F.xxhash64(k)).alias(f"{c}_h")
    rows = rows.select("_row", "host", "path", "candidates", hashed("candidates"), hashed("labels"))
    universe = written(rows.select(F.explode(F.array_distinct(F.concat("candidates_h", "labels_h"))).alias("h")).distinct(), "universe")
    lists = {"blocked": rules(block).unionByName(listed), "allowed": rules(allow)}
    shards = max(1, -(-32 * (len(block) + len(allow) + listed.count()) // MAX_BITS))
    for shard in range(shards):
        own = (F.shiftrightunsigned("h", 1) % shards * 2 + F.col("h").bitwiseAND(F.lit(1))) % shards == shard if shards > 1 else F.lit(True)
        keys = lambda x: x.select(F.xxhash64("key").alias("h"))
        rows = marked(rows if not shard else written(rows, "marked"), {name: build(universe.where(own), keys(x).where(own)) for name, x in lists.items()}, shard, shards)
    zipped = F.arrays_zip("candidates", "candidates_blocked", "candidates_allowed")
    fit = F.try_element_at(F.filter(zipped, lambda x: x["candidates_blocked"] | x["candidates_allowed"]), F.lit(1))
    out = rows.withColumn("_fit", fit).select(
        *(F.col(f"_row._{k}").alias(c) for k, c in enumerate(others)),
        "host",
        "path",
        F.col("_fit.candidates").alias("rule"),
        F.when(F.coalesce("_fit.candidates_blocked", F.exists("labels_blocked", lambda x: x)), "block").otherwise("allow").alias("verdict"),
    )
    return out


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), BLOCK_RULES, ALLOW_RULES, BLOCKED_LABELS)
    return judged.select("page_id", "host", "path", "rule", "verdict")


_FITS = "(host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}')"
_RULES = [(r, v) for rules, v in ((BLOCK_RULES, "block"), (ALLOW_RULES, "allow")) for r in rules]
_CASES = "\n".join(
    f"    WHEN {_FITS.format(h=r.partition('/')[0], p=r[r.index('/'):])} THEN '{r}'" for r, _ in sorted(_RULES, key=lambda x: -len(x[0]))
)
ORACLE = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
{_CASES}
  END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({", ".join(f"'{r}'" for r in BLOCK_RULES)}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN len(list_intersect(string_split(host, '.'), [{", ".join(f"'{x}'" for x in BLOCKED_LABELS)}])) > 0 THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
