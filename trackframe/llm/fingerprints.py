"""Document fingerprints by I-Match over randomised lexicon subsets.

The lexicon holds the terms whose document frequency lies in a band: at least `RAREST` and at most `COMMONEST` of all
documents. Each of `SERIES` hash seeds nests `LEVELS` random subsets of the lexicon, of which each keeps one in `STEP` terms
of the one before. A document's distinct lexicon terms are sorted and the part of them that falls into a subset is hashed;
the fingerprint lists these hashes ('-' where a subset holds no term of the document).

Two fingerprints are as like as the share of series whose sparsest subset that holds a term of either text has the same hash
in both. A text without lexicon terms uses all its terms in place of them.

A term in the band has at least RAREST * N documents, so the lexicon has at most (mean distinct terms of a document) / RAREST
terms, however large the corpus is. It is broadcast if its size, which is counted, is below `MOST_BROADCAST`, and joined by
shuffle otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD_BREAK, ascii_lower, stage

RAREST, COMMONEST = 1 / 1000, 1 / 5
SERIES, LEVELS, STEP = 16, 5, 4
MOST_BROADCAST = 2_000_000
#: Ids per block: the documents of a block meet in one task to see their neighbours.
BLOCK = 1024
#: Documents of a task that are grouped in memory before Spark sorts instead.
GROUPS_IN_MEMORY = "20000"


def term_hashes(text: Column) -> Column:
    """The hashes of a text's distinct words, A to Z lower-cased."""
    words = F.array_distinct(F.split(ascii_lower(text), WORD_BREAK))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def lexicon_of(docs: DataFrame, text_col: str = "text", rarest: float = RAREST, commonest: float = COMMONEST) -> DataFrame:
    """The terms (hashes) in the band, with their document frequencies over all of `docs`."""
    n = docs.count()
    terms = docs.select(F.explode(term_hashes(F.col(text_col))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return stage(terms.where((F.col("df") >= max(1.0, rarest * n)) & (F.col("df") <= commonest * n)), "lexicon")


def subset_hashes(grouped: DataFrame) -> DataFrame:
    """Adds `marks`: an array of SERIES * LEVELS hashes (null where the subset is empty) of the sorted array `terms`."""
    kept = [c for c in grouped.columns if c != "terms"]
    out = grouped.select(*kept, *(F.col("terms").alias(f"s{s}") for s in range(SERIES)))
    hashes: list[str] = []
    for level in range(LEVELS):
        def part(s: int, level: int = level) -> Column:
            draw = lambda t: F.pmod(F.shiftrightunsigned(F.xxhash64(t, F.lit(s)), 5 * level), F.lit(STEP)) == 0
            return F.filter(F.col(f"s{s}"), draw)

        out = out.select(*kept, *hashes, *(part(s).alias(f"s{s}") for s in range(SERIES)))
        new = [F.when(F.size(f"s{s}") > 0, F.xxhash64(F.col(f"s{s}"))).alias(f"h{s}_{level}") for s in range(SERIES)]
        out = out.select(*kept, *hashes, *new, *(f"s{s}" for s in range(SERIES)))
        hashes += [f"h{s}_{level}" for s in range(SERIES)]
    return out.select(*kept, F.array(*(f"h{s}_{level}" for s in range(SERIES) for level in range(LEVELS))).alias("marks"))


def as_text(marks: Column) -> Column:
    return F.array_join(F.transform(marks, lambda h: F.coalesce(F.lower(F.hex(h)), F.lit("-"))), " ")


def likeness(a: Column, b: Column) -> Column:
    """Share of series that agree on their sparsest subset with a term of either; 1 if no series has any and 0 if one
    side is missing."""
    hits, used = F.lit(0), F.lit(0)
    for s in range(SERIES):
        same, any_ = F.lit(0), F.lit(0)
        for level in range(LEVELS):
            x, y = a[s * LEVELS + level], b[s * LEVELS + level]
            held = x.isNotNull() | y.isNotNull()
            same = F.when(held, x.eqNullSafe(y).cast("int")).otherwise(same)
            any_ = F.when(held, F.lit(1)).otherwise(any_)
        hits, used = hits + same, used + any_
    return F.when(a.isNull() | b.isNull(), F.lit(0.0)).when(used == 0, F.lit(1.0)).otherwise(hits / used).cast("double")


def with_neighbours(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (block, pos, guest, doc_id, text, next_text), partitioned by block. The first document of each block is also a
    guest at the end of the block before (of the last block, if it is the first of all), so that every document's successor
    by id is in its own block. Null ids come last; equal ids are ordered by text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    block = F.coalesce(F.floor(F.col("doc_id") / F.lit(BLOCK)).cast("long"), F.lit(2**62))
    rows = rows.withColumn("block", block)
    # every block learns which one is before it: within a superblock by a window, and across superblocks likewise
    firsts = stage(
        rows.groupBy("block").agg(F.min("doc_id").alias("first_id")).withColumn("upper", F.floor(F.col("block") / F.lit(BLOCK * 16)).cast("long")), "blocks"
    )
    tops = firsts.groupBy("upper").agg(F.max("block").alias("top")).withColumn("whole", F.lit(1))
    all_tops = W.partitionBy("whole").orderBy("upper")
    tops = tops.select("upper", F.coalesce(F.lag("top").over(all_tops), F.max("top").over(W.partitionBy("whole"))).alias("top_before"))
    firsts = firsts.join(tops, "upper").withColumn("before", F.coalesce(F.lag("block").over(W.partitionBy("upper").orderBy("block")), F.col("top_before")))
    firsts = stage(firsts.select("first_id", F.col("block").alias("own"), "before"), "block-firsts")

    guests = rows.join(firsts, rows["doc_id"].eqNullSafe(firsts["first_id"]) & (rows["block"] == firsts["own"]))
    guests = guests.select("doc_id", "text", F.col("before").alias("block"), F.lit(1).alias("guest"))
    ordered = W.partitionBy("block").orderBy("guest", F.col("doc_id").asc_nulls_last(), "text")
    both = rows.select("doc_id", "text", "block", F.lit(0).alias("guest")).unionByName(guests)
    return both.withColumn("pos", F.row_number().over(ordered)).withColumn("next_text", F.lead("text").over(ordered))


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lexicon: DataFrame | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces the last floor(n_chars / 2) code points by the first as many (or all) of the next document; the
    next of the last is the first, and a single document is its own next. Null texts are empty and have the fingerprint of
    no terms, which is like itself only. An empty table gives no rows."""
    spark = docs.sparkSession
    lexicon = lexicon_of(docs, text_col) if lexicon is None else lexicon
    in_band = lexicon.select("term", F.lit(True).alias("in_band"))
    if lexicon.count() <= MOST_BROADCAST:
        in_band = F.broadcast(in_band)

    rows = with_neighbours(docs, id_col, text_col)
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", "text"), F.lit(1), half))
    )
    rows = rows.select(
        "block", "pos", "guest", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        F.array(term_hashes(F.col("text")), term_hashes(F.col("edited"))).alias("both"),
    )
    key = ["block", "pos", "which"]
    info = ["guest", "doc_id", "n_chars", "edited_sha256"]
    each = rows.select("block", "pos", *info, F.posexplode("both").alias("which", "hashes"))
    each = each.select(*key, *info, F.explode_outer("hashes").alias("term")).join(in_band, "term", "left")
    grouped = each.groupBy(*key).agg(
        *(F.first(c).alias(c) for c in info),
        F.collect_list(F.when(F.col("in_band"), F.col("term"))).alias("terms"),
        F.sum(F.when(F.col("in_band").isNull(), F.col("term")).cast("decimal(20,0)")).alias("rest"),
    )
    terms = F.when((F.size("terms") == 0) & F.col("rest").isNotNull(), F.array(F.xxhash64("rest"))).otherwise(F.sort_array("terms"))
    marked = subset_hashes(grouped.select(*key, *info, terms.alias("terms")))
    side = lambda w: F.first(F.when(F.col("which") == w, F.col("marks")), ignorenulls=True)
    paired = marked.groupBy("block", "pos").agg(*(F.first(c).alias(c) for c in info), side(0).alias("own"), side(1).alias("edited"))
    paired = paired.withColumn("next", F.lead("own").over(W.partitionBy("block").orderBy("pos")))
    result = paired.where("guest = 0").select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"), likeness(F.col("own"), F.coalesce("next", "own")).alias("near_next"),
    )
    knob = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(knob)
    spark.conf.set(knob, GROUPS_IN_MEMORY)
    try:
        return stage(result, "fingerprints")
    finally:
        spark.conf.set(knob, before)
