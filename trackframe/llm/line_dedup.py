"""Line deduplication by content-defined chunks.

A text is a run of lines; sentences that end within a line end a line here too, and white space, blank lines included, belongs to the
line behind it. Each line has a hash, and a rolling hash over a line and the next names every two neighbouring lines. A chunk is a run
of lines whose rolling hashes all occur before in the corpus: it begins and ends where they stop repeating. So its boundaries are set
by contents alone, are the same wherever a passage is copied to, and no line is lost at its rim because of what stands around it.
(Boundaries at minima of the rolling hash, which this operator had before, need about six lines to come to rest and missed most
passages of 50 to 100 words.)

Every repeated pair of neighbouring lines stays whole at its first occurrence (smallest id, then smallest hash of the text, then first
place). All other lines of repeated pairs are removed. Equal hashes only name candidates: the bytes of all candidates of a hash are
compared (without white space around them), and pairs whose hashes stand for two contents are left alone.

Only hashes are shuffled to find candidates; groups are combined locally first, and a pair that a third of all rows hold is looked up
in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import computed_once
from .common import looked_up, stage

#: Lines end before white space with a line feed, and before the space behind a sentence.
ENDS = r"(?=[ \t\n\x0B\f\r])(?:(?<=[.!?])(?= )|(?<=[^ \t\n\x0B\f\r])(?=[ \t\x0B\f\r]*\n))"
_BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(text, ENDS)


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS))


def _key(a: Column, b: Column) -> Column:
    """The rolling hash of two neighbouring lines."""
    return F.xxhash64(a, b)


def line_hashes(docs: DataFrame) -> DataFrame:
    """(id, th, h) of `docs` (id, th, text): the hashes of the lines in order."""
    return docs.select("id", "th", F.transform(_lines(F.col("text")), lambda u: F.xxhash64(_bare(u))).alias("h"))


def neighbours(hashed: DataFrame) -> DataFrame:
    """(id, th, i, key): the rolling hash of the lines i and i + 1; what stands behind the last line may be blank and is none."""
    pair = lambda a, i: _key(a, F.get("h", i + 1))
    last = F.when(F.get("h", F.size("h") - 1) == F.xxhash64(F.lit("")), F.size("h") - 2).otherwise(F.size("h") - 1)
    return hashed.select("id", "th", F.posexplode(F.transform(F.slice("h", F.lit(1), F.greatest(last, F.lit(0))), pair)).alias("i", "key"))


def doubtful_keys(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(key) of candidate pairs whose hashes don't stand for the same bytes everywhere; none, unless 64-bit hashes collide.
    spans: (id, th, found) with the places of each text's candidates."""
    held = computed_once(texts.join(spans, ["id", "th"]).select(_lines(F.col("text")).alias("lines"), F.col("found.i").alias("at")))
    bare = lambda i: _bare(F.get("lines", i))
    # a line feed parts the two, since no line has one inside
    pairs = held.select(F.explode(F.transform("at", lambda i: F.concat(bare(i), F.lit("\n"), bare(i + 1)))).alias("x"))
    pairs = computed_once(pairs).select(_key(F.xxhash64(F.substring_index("x", "\n", 1)), F.xxhash64(F.substring_index("x", "\n", -1))).alias("key"), "x")
    two = pairs.groupBy("key", "x").agg(F.count("*").alias("n")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return stage(two.select("key"), "doubtful-pairs")


def removable(found: Column) -> Column:
    """The lines to remove, in order, from the sorted places `found` (i, stays) of a text's repeated pairs: those of pairs that don't
    stay, but for lines that they share with pairs that do."""
    def lines(p: Column, k: Column) -> Column:
        before, after = F.get(found, k - 1), F.get(found, k + 1)
        held = F.coalesce((before["i"] == p["i"] - 1) & before["stays"], F.lit(False))
        follows = F.coalesce((after["i"] == p["i"] + 1) & after["stays"], F.lit(False))
        return F.array(F.when(~p["stays"] & ~held, p["i"]), F.when(~p["stays"] & ~follows, p["i"] + 1))

    return F.array_distinct(F.filter(F.flatten(F.transform(found, lines)), lambda i: i.isNotNull()))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, text (cleaned), n_removed (lines).

    A null text stays null; an empty one stays empty. Null ids come last when the first occurrence is chosen; ids that are no whole
    numbers raise an error. Rows that repeat an id and its text are one document and get the same result. An empty table gives no
    rows. Nothing but lines of repeated pairs is taken away: all other characters stay, white space included."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("id"), F.col(text_col).alias("text"))
    keyed = keyed.withColumn("th", F.xxhash64("text"))
    texts = keyed.where("text is not null").select("id", "th", "text")
    hashed = stage(line_hashes(texts), "line-hashes")
    pairs = neighbours(hashed)
    total = hashed.agg(F.coalesce(F.sum(F.size("h")), F.lit(0))).first()[0]

    place = F.struct("id", "th", "i")
    first = pairs.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = stage(first, "first-pairs")
    found = looked_up(pairs, first, "key", "n", total, F.xxhash64("id", "th", "i"))
    spans = found.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("i", (place == F.col("first")).alias("stays")))).alias("found"))
    spans = stage(spans, "candidates")
    doubtful = doubtful_keys(texts, spans)
    if doubtful.limit(1).count():
        found = found.join(doubtful, "key", "left_anti")
        spans = stage(found.groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("i", (place == F.col("first")).alias("stays")))).alias("found")), "sure-candidates")

    plan = computed_once(spans.select("id", "th", removable(F.col("found")).alias("gone")).where("size(gone) > 0"))
    rows = keyed.join(plan, ["id", "th"], "left").select("doc_id", "text", "gone", F.when(F.col("gone").isNotNull(), _lines(F.col("text"))).alias("lines"))
    rows = computed_once(rows)
    until = lambda g, i: F.slice("lines", F.when(i == 0, F.lit(0)).otherwise(F.get("gone", i - 1) + 1) + 1, g - F.when(i == 0, F.lit(0)).otherwise(F.get("gone", i - 1) + 1))
    tail = F.get("gone", F.size("gone") - 1) + 1
    kept = F.array_join(F.concat(F.flatten(F.transform("gone", until)), F.slice("lines", tail + 1, F.size("lines") - tail)), "")
    none = F.col("gone").isNull()
    return rows.select("doc_id", F.when(none, F.col("text")).otherwise(kept).alias("text"), F.when(none, F.lit(0)).otherwise(F.size("gone")).cast("long").alias("n_removed"))


ORACLE_SQL = r"""
WITH s AS (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(text, '([^ \t\n\v\f\r])([ \t\v\f\r]*\n)', '\1' || chr(1) || '\2', 'g'), '([.!?])( )', '\1' || chr(1) || '\2', 'g'), chr(1)) AS ls
  FROM documents WHERE text IS NOT NULL
), l AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM s
), u AS (
  SELECT *, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM l
), f AS (
  SELECT *, CASE WHEN lead(body) OVER w <> '' THEN lead(body) OVER w END AS next_body FROM u WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), p AS (
  SELECT *, next_body IS NOT NULL AND count(*) OVER (PARTITION BY body, next_body) > 1 AS again,
         row_number() OVER (PARTITION BY body, next_body ORDER BY doc_id, i) = 1 AS first_one FROM f
), g AS (
  SELECT *, (again OR coalesce(lag(again) OVER w, false)) AND NOT (again AND first_one) AND NOT coalesce(lag(again AND first_one) OVER w, false) AS gone
  FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), c AS (
  SELECT doc_id, string_agg(CASE WHEN gone THEN '' ELSE line END, '' ORDER BY i) AS text, count(*) FILTER (WHERE gone) AS n_removed FROM g GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN c.doc_id IS NULL THEN d.text ELSE c.text END AS text, coalesce(c.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN c ON d.doc_id = c.doc_id
"""
