"""Exact deduplication by skew-safe combining.

Rows are combined in three steps, each of which groups by the full normalised content beside its digest:
every task folds its own copies, so a text leaves a task once; the partial winners of a digest meet in one of `salts` groups, by the
task they come from; and the winners of the salts meet at last. A text that a third of all rows hold is therefore one row for each
task, then one for each salt, then one.

Rows find their class by digest. Classes above `hot_share` of all rows (at most 1 / hot_share of them, which bounds what is
broadcast) are looked up in place, so their rows are never gathered; a digest that several contents share is resolved by content.

Texts are equal when they are identical after lower-casing A to Z; null counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stage

#: A class is hot when it holds more than this share of all rows.
HOT_SHARE = 1 / 2000
SALTS = 64


def _sha256(norm: Column) -> Column:
    return F.sha2(norm, 256)


def equal_classes(keyed: DataFrame, salts: int = SALTS) -> DataFrame:
    """One row (digest, content, keep_id, group_size, contents) for each class of equal texts among rows (doc_id, norm, digest).
    content is null unless the digest belongs to several contents, whose number is `contents`."""
    salted = keyed.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    winners = salted.groupBy("digest", "salt", "norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    merged = winners.groupBy("digest", "norm").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    # a digest with one content, which is every one in practice, needs no content from here on
    slim = stage(merged.select("digest", "keep_id", "group_size"), "classes")
    shared = slim.groupBy("digest").agg(F.count("*").alias("contents")).where("contents > 1")
    if not shared.limit(1).count():
        return slim.select("digest", F.lit(None).cast("string").alias("content"), "keep_id", "group_size", F.lit(1).cast("long").alias("contents"))
    full = merged.join(shared, "digest", "left").withColumn("contents", F.coalesce("contents", F.lit(1).cast("long")))
    content = F.when(F.col("contents") > 1, F.col("norm"))
    return stage(full.select("digest", content.alias("content"), "keep_id", "group_size", "contents"), "classes-by-content")


def _keyed(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], *more: Column) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), ascii_lower(F.col(text_col)).alias("norm"), *more)
    return rows.withColumn("digest", digest(F.col("norm")))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, hot_share: float = HOT_SHARE, digest: Callable[[Column], Column] = _sha256
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    keep_id is the largest id of the group and group_size counts rows. A null id is smaller than any other; a group of
    null ids only has a null keep_id and keeps it. Rows that repeat an id and its text are one document: all of them
    say kept. An empty table gives no rows. Other columns of `docs` play no part."""
    keyed = _keyed(docs, id_col, text_col, digest)
    classes = equal_classes(keyed, salts)
    several = "content" if classes.where("content is not null").limit(1).count() else None
    least = F.lit(max(1.0, hot_share * (classes.agg(F.coalesce(F.sum("group_size"), F.lit(0))).first()[0])))
    rows = keyed.select("doc_id", "digest", *(["norm"] if several else []))
    plain = classes.where("contents = 1").select("digest", "keep_id", "group_size")
    hot = plain.where(F.col("group_size") > least).select("digest", F.col("keep_id").alias("hot_id"), F.col("group_size").alias("hot_size"))
    # rows of hot classes are answered here; a key of their own then spreads them over the join of the others
    rows = rows.join(F.broadcast(hot), "digest", "left")
    spread = F.concat(F.col("digest"), F.lit("/"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = rows.withColumn("key", F.when(F.col("hot_size").isNotNull(), spread).otherwise(F.col("digest")))
    cold = plain.where(F.col("group_size") <= least).select(F.col("digest").alias("key"), F.col("keep_id").alias("cold_id"), F.col("group_size").alias("cold_size"))
    rows = rows.join(cold, "key", "left")
    keep_id = F.when(F.col("hot_size").isNotNull(), F.col("hot_id")).otherwise(F.col("cold_id"))
    size = F.coalesce("hot_size", "cold_size")
    if several:
        by_content = classes.where("contents > 1").select("digest", F.col("content").alias("norm"), F.col("keep_id").alias("own_id"), F.col("group_size").alias("own_size"))
        rows = rows.join(by_content, ["digest", "norm"], "left")
        keep_id = F.when(F.col("own_size").isNotNull(), F.col("own_id")).otherwise(keep_id)
        size = F.coalesce(size, "own_size")
    answered = rows.select("doc_id", keep_id.alias("keep_id"), size.cast("long").alias("group_size"), "digest")
    return answered.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS, digest: Callable[[Column], Column] = _sha256) -> DataFrame:
    """The rows of `docs` that stay, with all their columns, one row for each group of equal texts. Where rows repeat
    an id and its text, the one with the smallest hash of all columns stays."""
    classes = equal_classes(_keyed(docs, id_col, text_col, digest), salts)
    rows = _keyed(docs, id_col, text_col, digest, F.struct("*").alias("row"))
    # by digest and id: a hot digest has one winner, so its rows need not meet
    winners = classes.select(F.col("digest").alias("d"), F.xxhash64("digest", "keep_id").alias("key"), "keep_id", "content")
    rows = rows.withColumn("key", F.xxhash64("digest", "doc_id"))
    # written so that key and digest alone deal the rows, which then also serves the grouping
    named = F.coalesce(rows["doc_id"] == winners["keep_id"], rows["doc_id"].isNull() & winners["keep_id"].isNull())
    same = (rows["key"] == winners["key"]) & (rows["digest"] == winners["d"]) & named
    kept = rows.join(winners, same & (winners["content"].isNull() | (rows["norm"] == winners["content"])))
    kept = kept.select(rows["key"].alias("k"), rows["digest"].alias("d"), F.coalesce(winners["content"], F.lit("")).alias("c"), rows["row"])
    one = kept.groupBy("k", "d", "c").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select("row.*")


ORACLE_SQL = """
WITH n AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
), g AS (
  SELECT doc_id, text_sha256, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM n
)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""
