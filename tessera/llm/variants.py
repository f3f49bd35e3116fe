"""Spelling variant grouping: an even-partition pigeonhole join over the words of a corpus.

A word of length l is cut into two segments of l // 2 and the other characters. One
edit leaves one of them whole, so two words one edit apart share the first segment at
its place, or the last one at the end of the word. Both segments of each word are indexed
by length; a word probes the index for its own length and for one shorter, where the last
segment stands one place later. A pair that meets in both segments counts at the first only,
and each pair is verified by its edit distance inside the join, so candidates are never rows.

Each word's form is its most frequent near word, if that is frequent enough; roots follow
forms to their end by doubling. A form occurs ``RATIO`` times as often as its word, so chains
are as long as the logarithm of the largest count; and a form has only as many words as
one edit can make, so no key of these joins is hot.

Defined results: null or empty text has no words; a null doc_id is written as the
empty string in the hash; repeated rows count as often as they come; ties go to the first word in
code-point order; very long texts are read whole, word by word; other columns, whatever their
names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import table, written

LEAST_CHARS, LEAST_COUNT, RATIO, EVERY = 6, 5, 5, 199
RUN = r"[A-Za-zÀ-ÿ]{%d,}"


def occurrences(docs: DataFrame, least_chars: int = LEAST_CHARS, every: int = EVERY) -> DataFrame:
    """``word`` of each run of letters of ``docs`` (doc_id, text), one code point less where the hash says so."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN % least_chars), F.lit(0))).alias("run"))
    runs = runs.select("doc_id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = runs.withColumn("h", F.crc32(named.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return runs.select(F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n`` of the words that are long and frequent enough; counts are added up before they are shuffled."""
    return words.where(F.length("word") >= least_chars).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def segments(word: Column, length: Column) -> Column:
    """Segments of a word as one of ``length`` characters has them, each at its end: structs of part and segment."""
    half = F.floor(length / 2).cast("int")
    own = F.char_length(word)
    first = F.struct(F.lit(1).alias("part"), F.substring(word, F.lit(1), half).alias("segment"))
    last = F.struct(F.lit(2).alias("part"), F.substring(word, own - length + half + 1, length - half).alias("segment"))
    return F.array(first, last)


def near_pairs(vocab: DataFrame) -> DataFrame:
    """Pairs (a, n_a, b, n_b) of words that are one edit apart, each pair once."""
    length = F.char_length("word")
    index = vocab.select(F.col("word").alias("b"), F.col("n").alias("n_b"), length.alias("length"), F.explode(segments(F.col("word"), length)).alias("s"))
    targets = vocab.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.explode(F.array(length, length - 1)).alias("length"))
    probes = targets.select("a", "n_a", "length", F.explode(segments(F.col("a"), F.col("length"))).alias("s"))
    index, probes = (df.select("*", "s.part", "s.segment").drop("s") for df in (index, probes))
    half = F.floor(F.col("length") / 2).cast("int")
    same_length = F.char_length("a") == F.col("length")
    again = (F.col("part") == 2) & (F.substring("a", F.lit(1), half) == F.substring("b", F.lit(1), half))
    held = index.withColumnsRenamed({c: f"_{c}" for c in ("length", "part", "segment")})
    keys = (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part")) & (F.col("segment") == F.col("_segment"))
    near = (~same_length | (F.col("a") < F.col("b"))) & ~again & (F.levenshtein("a", "b", 1) == 1)
    return probes.join(held, keys & near).select("a", "n_a", "b", "n_b")


def forms(vocab: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, and form and form_n (null where no near word is frequent enough)."""
    side = lambda w, o, n: pairs.select(F.col(w).alias("word"), F.struct((-F.col(n)).alias("k"), F.col(o).alias("form")).alias("other"))
    both = side("a", "b", "n_b").unionByName(side("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("other").alias("best"))
    chosen = F.coalesce(-F.col("best.k") >= ratio * F.col("n"), F.lit(False))
    return vocab.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("best.form")).alias("form"), F.when(chosen, -F.col("best.k")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """``found`` with ``root``, the end of each word's chain of forms."""
    links = written(found.where("form IS NOT NULL").select("word", F.col("form").alias("to")), "links")
    while True:
        onward = links.select(F.col("word").alias("to"), F.col("to").alias("_next"))
        moved = links.join(onward, "to", "left").select("word", F.coalesce("_next", "to").alias("to"), F.col("_next").isNotNull().alias("moved"))
        step = written(moved, "links")
        links = step.select("word", "to")
        if step.where("moved").isEmpty():
            break
    return found.join(links, "word", "left").withColumn("root", F.coalesce("to", "word")).drop("to")


def group_variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root of the words of ``docs`` (doc_id, text)."""
    vocab = written(vocabulary(occurrences(docs)), "vocabulary")
    found = written(forms(vocab, near_pairs(vocab)), "forms")
    return roots(found)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return group_variants(docs).select("word", "form", "root", "n", "n_near", "form_n")


_STEP = "xor(c >> 1, CASE WHEN (c & 1) = 1 THEN 3988292384 ELSE 0 END)"
ORACLE = f"""
WITH RECURSIVE crc_step(b, k, c) AS (
  SELECT b, 0, CAST(b AS BIGINT) FROM range(256) r(b)
  UNION ALL SELECT b, k + 1, {_STEP} FROM crc_step WHERE k < 8),
crc AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM crc_step WHERE k = 8),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS k FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= {LEAST_CHARS} GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, k, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS MATERIALIZED (
  SELECT run, k, xor(4294967295, list_reduce(
    list_transform(range(CAST(length(x) // 2 AS BIGINT)), lambda i: CAST(CAST('0x' || substr(x, CAST(2 * i + 1 AS BIGINT), 2) AS INTEGER) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) AS h
  FROM bytes, crc),
vocab AS MATERIALIZED (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT CASE WHEN h % {EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, k FROM hashed)
  WHERE length(word) >= {LEAST_CHARS} GROUP BY word HAVING sum(k) >= {LEAST_COUNT}),
less AS MATERIALIZED (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS MATERIALIZED (
  SELECT DISTINCT * FROM (
    SELECT a.word, b.word AS other, b.n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION ALL SELECT a.word, b.word, b.n FROM less a JOIN vocab b ON a.rest = b.word
    UNION ALL SELECT b.word, a.word, a.n FROM less a JOIN vocab b ON a.rest = b.word)),
best AS (
  SELECT word, count(*) AS n_near, max(n) AS top FROM near GROUP BY word),
form AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.top >= {RATIO} * v.n THEN b.top END AS form_n,
         CASE WHEN b.top >= {RATIO} * v.n THEN (SELECT min(other) FROM near x WHERE x.word = v.word AND x.n = b.top) END AS form
  FROM vocab v LEFT JOIN best b USING (word)),
chain(word, tip, depth) AS (
  SELECT word, word, 0 FROM form
  UNION ALL SELECT c.word, f.form, depth + 1 FROM chain c JOIN form f ON f.word = c.tip WHERE f.form IS NOT NULL),
root AS (SELECT word, max_by(tip, depth) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM form JOIN root USING (word)
"""
