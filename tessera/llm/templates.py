"""Line dedup by a log-template tree, in DataFrame operations only.

A line is parsed to a fixed depth: its words that hold a digit become ``<*>``, and
its leaf is (number of words, first ``DEPTH`` words). A line of ``DEPTH`` words or
fewer is a leaf of its own. Equal masked lines are one line; lines without a constant word
beyond the first ``DEPTH`` (a short one: without any) are one only if really equal.

Below the leaf, the words at ``PLACES`` places beyond the first ``DEPTH``, drawn alike
for all lines of one length, form a branch; each line hangs on ``BRANCHES`` branches
and on the leaf itself. The first line of a branch, by doc_id and position, is its
template. A line is an instance of a template before it if, of the words beyond the
first ``DEPTH`` that are not ``<*>`` in both, at least ``AGREE`` of ``OF`` are equal at
the same places, so words that vary are fields of the template and a leaf holds as many
templates as it needs. With nine tenths of the words equal, a line meets a template on some branch but
for 3 of a million; with four fifths, for 2 of a thousand.

An instance in a later document than its template is dropped there: the first
document keeps its lines, so that copies never erase the only instance of a text.

Every step groups or joins by a hash, with partial sums before the shuffle; nothing
collects the lines of a leaf, and a hot leaf or line is one row a task after them.
The joins that bring lines back meet one row for each key, so a hot key has one large
side only, which adaptive execution splits. Leaves seen in one document drop out first;
equal lines have equal leaves, so nothing else can recur.

Defined results: null text stays null with 0 lines; an empty text is one line of
no words; lines of no words are always kept; a null doc_id counts as the first
document; rows of one doc_id are one document; of equal lines the first by doc_id and
position stands for all; columns named n_lines and n_dropped are replaced; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import table, written

DEPTH, BRANCHES, PLACES = 4, 12, 4
AGREE, OF = 4, 6
NULL_ID = -(1 << 63)
SPACE, ANY = r"[\x20\x09-\x0D]+", "<*>"


def place(branch: int, i: int) -> int:
    """A number whose remainder by the words beyond the first DEPTH is a place of a branch (Knuth's multiplicative rule)."""
    return (branch * PLACES + i + 1) * 2654435761 % (1 << 31)


def spaced(line: Column) -> Column:
    """Words joined by one space."""
    messy = F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    for run in ("  ", "\t", "\r", "\x0b", "\x0c"):
        messy = messy | F.contains(line, F.lit(run))
    return F.when(messy, F.trim(F.regexp_replace(line, SPACE, " "))).otherwise(line)


def masked(words: Column) -> Column:
    """Words joined by one space, those with a digit as ``<*>``."""
    return F.when(words.rlike("[0-9]"), F.regexp_replace(words, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*+", ANY)).otherwise(words)


def parsed(docs: DataFrame) -> DataFrame:
    """One row per line of words: document, text hash, position, leaf, and the line where it is longer than its leaf."""
    lines = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), F.xxhash64("text").alias("th"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.select("doc", "th", "pos", spaced(F.col("line")).alias("line")).where("line != ''")
    lines = lines.withColumn("n", F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1)
    lead = masked(F.substring_index("line", " ", DEPTH))
    varied = F.replace(F.replace(lead, F.lit(ANY), F.lit("")), F.lit(" "), F.lit("")) == ""
    short = F.col("n") <= DEPTH
    leaf = F.when(short & varied, F.xxhash64(F.lit("="), "line")).otherwise(F.xxhash64(F.least("n", F.lit(DEPTH + 1)), F.when(short, 0).otherwise(F.col("n")), lead))
    return lines.select("doc", "th", "pos", leaf.alias("leaf"), F.when(~short, F.col("line")).alias("line"))


def beyond(line: Column) -> Column:
    """Hashes of the masked words of a line beyond the first DEPTH."""
    return F.transform(F.slice(F.split(masked(line), " "), DEPTH + 1, 1 << 30), lambda w: F.hash(w))


def agrees(x: Column, y: Column) -> Column:
    """Whether two lists of word hashes of one length are equal at the share of places that the rule asks for."""
    count = lambda test: F.aggregate(F.zip_with(x, y, lambda a, b: test(a, b).cast("int")), F.lit(0), lambda n, k: n + k)
    varies = F.hash(F.lit(ANY))
    constant = count(lambda a, b: (a != varies) | (b != varies))
    return OF * count(lambda a, b: (a == b) & (a != varies)) >= AGREE * constant


def branches(w: Column, leaf: Column) -> Column:
    """Keys of the leaf itself and of the branches of a line."""
    words = lambda k: [F.element_at(w, (F.lit(place(k, i)) % F.size(w)).cast("int") + 1) for i in range(PLACES)]
    return F.array(leaf, *(F.xxhash64(leaf, F.lit(k), *words(k)) for k in range(BRANCHES)))


def recurring(docs: DataFrame) -> DataFrame:
    """Lines to drop: (doc, th, pos)."""
    lines = written(parsed(docs), "lines")
    leaves = written(lines.groupBy("leaf").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("leaf"), "leaves")
    shared = lines.join(leaves, "leaf").withColumn("w", F.when(F.col("line").isNotNull(), beyond(F.col("line"))))
    fixed = F.size(F.array_remove("w", F.hash(F.lit(ANY)))) == 0
    same = F.when(F.col("w").isNull(), F.col("leaf")).when(fixed, F.xxhash64(F.lit("="), "line")).otherwise(F.xxhash64("w"))
    shared = written(shared.select("doc", "th", "pos", "leaf", same.alias("same"), F.when(~fixed, F.col("w")).alias("w")), "shared")
    groups = written(shared.groupBy("leaf", "same").agg(F.min(F.struct("doc", "th", "pos")).alias("at"), F.first("w", ignorenulls=True).alias("w")), "groups")
    keys = groups.where("w IS NOT NULL").select("leaf", "same", "at", F.explode(branches(F.col("w"), F.col("leaf"))).alias("key"))
    firsts = keys.groupBy("key").agg(F.min(F.struct("at", "leaf", "same")).alias("first"), F.count("*").alias("n")).where("n > 1")
    pairs = keys.join(firsts, "key").where((F.col("first.leaf") == F.col("leaf")) & (F.col("first.at.doc") < F.col("at.doc")))
    pairs = written(pairs.select("leaf", "same", F.col("first.same").alias("template"), F.col("first.at.doc").alias("of")).distinct(), "pairs")
    held = groups.where("w IS NOT NULL").select("leaf", "same", "w")
    met = pairs.join(held, ["leaf", "same"]).join(held.toDF("leaf", "template", "t"), ["leaf", "template"]).where(agrees(F.col("w"), F.col("t")))
    of = written(met.groupBy("leaf", "same").agg(F.min("of").alias("of")), "templates")
    judged = groups.select("leaf", "same", F.col("at.doc").alias("own")).join(of, ["leaf", "same"], "left").select("leaf", "same", F.coalesce("of", "own").alias("of"))
    return shared.join(written(judged, "judged"), ["leaf", "same"]).where("doc > of").select("doc", "th", "pos")


def drop_recurring(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with the kept lines as ``text``, and n_lines and n_dropped."""
    drops = written(recurring(docs).groupBy("doc", "th").agg(F.collect_set("pos").alias("_drop")), "drops")
    keyed = docs.withColumn("_doc", F.coalesce("doc_id", F.lit(NULL_ID))).withColumn("_th", F.xxhash64("text"))
    joined = keyed.join(drops.toDF("_doc", "_th", "_drop"), ["_doc", "_th"], "left")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    n_dropped = F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop"))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), F.col("_drop"))
    kept = F.array_join(F.transform(stay, lambda i: F.element_at("_lines", i + 1)), "\n")
    out = joined.withColumn("n_lines", n_lines.cast("long")).withColumn("n_dropped", n_dropped.cast("long"))
    out = out.withColumn("_lines", F.when(F.col("n_dropped") > 0, F.split("text", "\n")))
    return out.withColumn("text", F.when(F.col("n_dropped") > 0, kept).otherwise(F.col("text"))).drop("_doc", "_th", "_drop", "_lines")


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped, and length and SHA-256 of the kept text."""
    out = drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


_DRAWN = ", ".join(f"[{', '.join(str(place(k, i)) for i in range(PLACES))}]" for k in range(BRANCHES))
ORACLE = rf"""
WITH d AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, pos, line, list_filter(string_split_regex(line, '[ 	-
]+'), lambda x: x <> '') AS raw FROM d),
m AS (SELECT doc_id, pos, raw, list_transform(raw, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{ANY}' ELSE x END) AS w, len(raw) AS n FROM w WHERE len(raw) > 0),
l AS (
  SELECT doc_id, pos, n, list_slice(w, 1, {DEPTH}) AS lead, list_slice(w, {DEPTH} + 1, n) AS rest,
         CASE WHEN len(list_filter(CASE WHEN n <= {DEPTH} THEN w ELSE list_slice(w, {DEPTH} + 1, n) END, lambda x: x <> '{ANY}')) = 0 THEN raw ELSE [] END AS exact
  FROM m),
g AS (SELECT n, lead, rest, exact, min(doc_id) AS doc, min(doc_id * 1000000 + pos) AS seq FROM l GROUP BY ALL),
b AS (
  SELECT n, lead, rest, doc, seq, k, CASE WHEN k = 0 THEN [] ELSE list_transform([{_DRAWN}][k], lambda a: rest[a % len(rest) + 1]) END AS key
  FROM (SELECT *, unnest(range(0, {BRANCHES} + 1)) AS k FROM g WHERE n > {DEPTH} AND len(exact) = 0)),
f AS (SELECT n, lead, k, key, arg_min(rest, seq) AS t, arg_min(doc, seq) AS tdoc FROM b GROUP BY ALL),
i AS (
  SELECT n, lead, rest, min(tdoc) AS tdoc FROM b JOIN f USING (n, lead, k, key)
  WHERE tdoc < doc AND {OF} * len(list_filter(list_zip(rest, t), lambda p: p[1] = p[2] AND p[1] <> '{ANY}')) >= {AGREE} * len(list_filter(list_zip(rest, t), lambda p: p[1] <> '{ANY}' OR p[2] <> '{ANY}'))
  GROUP BY ALL),
o AS (SELECT g.n, g.lead, g.rest, exact, least(doc, coalesce(tdoc, doc)) AS first FROM g LEFT JOIN i ON g.n = i.n AND g.lead = i.lead AND g.rest = i.rest AND len(exact) = 0),
x AS (SELECT DISTINCT doc_id, pos FROM l JOIN o USING (n, lead, rest, exact) WHERE doc_id > first),
k AS (
  SELECT d.doc_id, count(*) AS n_lines, count(x.pos) AS n_dropped, coalesce(string_agg(CASE WHEN x.pos IS NULL THEN line END, chr(10) ORDER BY d.pos), '') AS kept
  FROM d LEFT JOIN x ON x.doc_id = d.doc_id AND x.pos = d.pos GROUP BY d.doc_id)
SELECT documents.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped,
       CAST(length(kept) AS BIGINT) AS kept_chars, sha256(kept) AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id)
"""
