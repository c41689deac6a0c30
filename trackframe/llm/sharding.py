"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns `vnodes` points of a ring of `CELLS` cells; a document's place is the hash of its text, so that equal texts
lie together, and it goes to the next point clockwise. Loads are bounded exactly: the capacities of the shards sum to the
number of rows and differ by one at most. Documents enter in ring order, and one that meets a full shard continues
clockwise to the next point whose shard has room. So row counts are at most one apart, and a change of the number of shards
or rows moves what the changed arcs hold and what overflows from them.

Along the ring documents are ordered by (cell, place, lane, id): copies of a text follow one another, so they part only where a
shard fills up among them. Ranks come from counts by (cell, place, lane) within cells and counts of cells within arcs; lanes split
the copies of one text by a hash of the id, so a text that a third of all rows hold spreads over `LANES` groups. Only the counts of
the arcs (shards x vnodes of them) reach the driver, which turns them into at most arcs + shards intervals of ranks, each with its
shard and first slot.
"""

from __future__ import annotations

from bisect import bisect_left

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stage

#: Places of the ring and groups within a place.
CELLS, LANES = 65_536, 1024


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """The ring's points in clockwise order: (cell, shard)."""
    return sorted((xxhash.xxh64_intdigest(f"shard {s} point {v}") % CELLS, s) for s in range(shards) for v in range(vnodes))


def arc_of_cell(points: list[tuple[int, int]]) -> list[int]:
    """For each cell the index of the point at or after it, going round."""
    cells = [c for c, _ in points]
    return [bisect_left(cells, c) % len(points) for c in range(CELLS)]


def fill(points: list[tuple[int, int]], arc_rows: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Intervals (arc, first rank, end rank, shard, first slot) of the rows that enter in ring order."""
    total = sum(arc_rows.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, plan = [0] * shards, []
    onward = list(range(1, len(points))) + [0]  # the next point that may have room, shortened as shards fill

    def next_open(k: int) -> int:
        path = []
        while used[points[k][1]] >= room[points[k][1]]:
            path.append(k)
            k = onward[k]
        for p in path:
            onward[p] = k
        return k

    for arc in range(len(points)):
        done, rows = 0, arc_rows.get(arc, 0)
        while done < rows:
            shard = points[next_open(arc)][1]
            n = min(rows - done, room[shard] - used[shard])
            plan.append((arc, done, done + n, shard, used[shard]))
            used[shard] += n
            done += n
    return plan


def text_place(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shard_rows(docs: DataFrame, shards: int = 40, vnodes: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null under this law),
    place (the hash that sets the place on the ring).

    Size is the UTF-8 bytes of the text plus 16; a null text has no bytes and lies where the empty text does. A null id is
    hashed as null and comes first among rows of equal text. Rows that repeat id and text are interchangeable and get a slot
    each. With fewer rows than shards some shards stay empty; an empty table gives no rows."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), text_place(F.col(text_col)).alias("place"),
    )
    rows = rows.withColumn("cell", F.pmod("place", F.lit(CELLS)).cast("int")).withColumn("lane", F.pmod(F.xxhash64("doc_id"), F.lit(LANES)).cast("int"))
    rows = stage(rows, "shard-rows")
    points = ring(shards, vnodes)
    cells = spark.createDataFrame(list(enumerate(arc_of_cell(points))), "cell int, arc int")

    counts = rows.groupBy("cell", "place", "lane").agg(F.count("*").alias("n"))
    in_cell = W.partitionBy("cell").orderBy("place", "lane")
    counts = stage(counts.withColumn("in_cell", F.sum("n").over(in_cell) - F.col("n")), "shard-counts")
    of_cell = counts.groupBy("cell").agg(F.sum("n").alias("n")).join(F.broadcast(cells), "cell")
    start = points[-1][0] + 1  # the first arc also holds the cells after the last point, which come first clockwise
    along = W.partitionBy("arc").orderBy(F.pmod(F.col("cell") - F.lit(start), F.lit(CELLS)))
    of_cell = stage(of_cell.withColumn("in_arc", F.sum("n").over(along) - F.col("n")), "shard-cells")
    arc_rows = {r["arc"]: int(r["n"]) for r in of_cell.groupBy("arc").agg(F.sum("n").alias("n")).collect()}
    plan = spark.createDataFrame(fill(points, arc_rows, shards), "arc int, first long, end long, shard int, slot0 long")

    within = F.row_number().over(W.partitionBy("cell", "place", "lane").orderBy("doc_id")) - 1
    ranked = rows.withColumn("within", within).join(counts.drop("n"), ["cell", "place", "lane"]).join(F.broadcast(of_cell.drop("n")), "cell")
    ranked = ranked.withColumn("rank", F.col("in_arc") + F.col("in_cell") + F.col("within"))
    placed = ranked.join(F.broadcast(plan), (ranked["arc"] == plan["arc"]) & (ranked["rank"] >= plan["first"]) & (ranked["rank"] < plan["end"]))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "place",
    )
