"""Mixing sources to target weights by systematic sampling.

Every document of a source expects target / size copies. Documents are ordered within their source by (size, id, content), the
expected copies are summed along that order from one random offset, and a document is emitted once for every integer that
its step crosses. Ordering by size keeps the words taken near the target, not only the number of documents.

The prefix sum needs no source in one task: ranks come from counts by (source, size, block of ids), of which a block holds
at most `BLOCK` distinct ids, and the offsets of the blocks are sums over these counts.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage, word_count

#: Ids per block; a group of equal (source, size) is ranked in blocks of this many ids.
BLOCK = 512
#: A table of sources larger than this is an error rather than a broadcast.
MOST_SOURCES = 1_000_000


def offset_of(source: str | None, seed: int) -> float:
    """The source's random offset in [0, 1): the first 32 bits of an md5 of the seed and the name."""
    name = f"{seed}/" + ("n" if source is None else f"s{source}")
    return int(hashlib.md5(name.encode()).hexdigest()[:8], 16) / 4294967296.0


def share_out(sizes: list[int], weights: list[int], most: float) -> list[float]:
    """Targets by weight that stop at `most` times a size; what is above is reshared by weight until none is above."""
    total, targets, open_ = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        level = (total - sum(most * sizes[i] for i in range(len(sizes)) if i not in open_)) / sum(weights[i] for i in open_)
        full = {i for i in open_ if level * weights[i] > most * sizes[i]}
        if not full:
            for i in open_:
                targets[i] = level * weights[i]
            break
        for i in full:
            targets[i] = most * sizes[i]
        open_ -= full
    return targets


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=(1, 2, 3), most=3, seed=17, carry=False) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken; with `carry` also `row`, all its columns.

    Sources are ordered by code point, null last, and weigh `weights` in turn. Size is the number of words (null: 0). A
    source without words has the target 0 and gives nothing. A null id comes last among rows of its source and size.
    Rows that repeat an id are ranked by a hash of all their columns, so only rows that are equal in every column are interchangeable
    and reruns agree. Ids that are no whole numbers (text that isn't one, say) raise an error. An empty table gives no rows."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), F.xxhash64(*docs.columns).alias("content"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    if not carry:
        rows = stage(rows, "mix-sizes")
    by_source = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(by_source) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    by_source.sort(key=lambda r: (r["source"] is None, (r["source"] or "").encode()))
    sizes = [int(r["size"]) for r in by_source]
    targets = share_out(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
    plan = spark.createDataFrame(
        [(i, r["source"], s, float(t), (float(t) / s if s else 0.0), offset_of(r["source"], seed)) for i, (r, s, t) in enumerate(zip(by_source, sizes, targets, strict=True))],
        "sid int, source string, source_size long, target double, rate double, start double",
    )
    same = rows["source"].eqNullSafe(plan["source"])
    rows = rows.join(F.broadcast(plan.select("sid", "source")), same).drop("source")
    # rows without an id are dealt to the same number of blocks behind all others, in the order of their contents
    unnamed = F.lit(2**62) + F.shiftrightunsigned(F.col("content"), 48)
    block = F.floor(F.col("doc_id") / F.lit(BLOCK)).cast("long")
    rows = rows.withColumn("block", F.when(F.col("doc_id").isNull(), unnamed).otherwise(block))

    counts = rows.groupBy("sid", "size", "block").agg(F.count("*").alias("n"))
    counts = stage(counts, "mix-counts")
    in_size = counts.withColumn("before", F.sum("n").over(W.partitionBy("sid", "size").orderBy("block")) - F.col("n"))
    of_size = counts.groupBy("sid", "size").agg(F.sum("n").alias("n"))
    of_size = of_size.withColumn("smaller", F.sum("n").over(W.partitionBy("sid").orderBy("size")) - F.col("n")).drop("n")
    offsets = in_size.join(of_size, ["sid", "size"]).select("sid", "size", "block", (F.col("before") + F.col("smaller")).alias("before"))

    within = F.row_number().over(W.partitionBy("sid", "size", "block").orderBy(F.col("doc_id").asc_nulls_last(), F.shiftrightunsigned("content", 1), "content"))
    ranked = rows.withColumn("within", within).join(offsets, ["sid", "size", "block"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within")).join(F.broadcast(plan.drop("source")), "sid")

    def crossed(rank: Column) -> Column:
        return F.floor(F.col("start") + F.col("rate") * rank)

    copies = crossed(F.col("rank")) - crossed(F.col("rank") - F.lit(1))
    return ranked.withColumn("copies", copies.cast("long")).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["row"] if carry else [])
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document's row, as many times as the mix takes it, with the columns of `docs`."""
    taken = mix(docs, carry=True, **options).where(F.col("copies") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM d GROUP BY source
), w AS (
  SELECT *, 1 + (i - 1) % 3 AS weight, 3.0::DOUBLE * source_size AS cap FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / sum(weight) OVER (ORDER BY cap / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY cap / weight, i) AS k
  FROM w
), p AS (
  SELECT *, least(cap, (SELECT arg_min(level, k) FROM l WHERE level <= cap / weight) * weight) AS target,
         ('0x' || substr(md5('17/' || CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM l
), r AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.start,
         CASE WHEN p.source_size = 0 THEN 0.0::DOUBLE ELSE p.target / p.source_size END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) AS rank
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
), c AS (
  SELECT *, CAST(floor(start + rate * rank) - floor(start + rate * (rank - 1)) AS BIGINT) AS copies FROM r
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM c
"""
