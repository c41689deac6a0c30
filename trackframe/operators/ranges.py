"""Ranges of frames and what workers bring back for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def frame_ranges(totals: DataFrame, chunks: int) -> DataFrame:
    """(video, chunk, start, end): contiguous ranges [start, end) of each video's frame_count, the earlier ones longer by one; no more
    ranges than frames, one at least."""
    n = F.col("frame_count")
    k = F.greatest(F.lit(1).cast("long"), F.least(F.lit(chunks).cast("long"), n))
    each = totals.select("video", n.alias("n"), k.alias("k"), F.explode(F.sequence(F.lit(0).cast("long"), k - 1)).alias("chunk"))
    base, extra = F.floor(F.col("n") / F.col("k")), F.col("n") % F.col("k")
    start = F.col("chunk") * base + F.least(F.col("chunk"), extra)
    return each.select("video", "chunk", start.alias("start"), (start + base + (F.col("chunk") < extra).cast("long")).alias("end"))


def chunk_of_frame(frames: DataFrame, ranges: DataFrame) -> DataFrame:
    """Adds each frame's chunk: an equi-join by video with a range condition, over a few ranges a video."""
    r = ranges.select(F.col("video").alias("v"), "chunk", "start", "end")
    return frames.join(r, (F.col("video") == F.col("v")) & (F.col("frame") >= F.col("start")) & (F.col("frame") < F.col("end"))).drop("v", "start", "end")


def chunk_integrity(ranges: DataFrame, results: DataFrame) -> DataFrame:
    """(video, chunks, complete, first_error): a video is complete when every range has a result of its length without an error; the
    first error is that of the smallest bad chunk ('missing', 'short' or the reported one)."""
    joined = ranges.join(results.select("video", "chunk", "rows", "error"), ["video", "chunk"], "left")
    why = F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("rows").isNull(), "missing").when(F.col("rows") != F.col("end") - F.col("start"), "short")
    return joined.groupBy("video").agg(
        F.count("*").alias("chunks"), (F.count(why) == 0).alias("complete"), F.min(F.when(why.isNotNull(), F.struct("chunk", why.alias("why"))))["why"].alias("first_error")
    )


def stitch(frames: DataFrame, integrity: DataFrame) -> DataFrame:
    """Frames of complete videos; sort by (video, frame) or write sorted by them to have them in order."""
    return frames.join(integrity.where("complete").select("video"), "video", "left_semi")


def ordered_values(frames: DataFrame, value: str) -> DataFrame:
    """(video, values): the values of each video in frame order."""
    return frames.groupBy("video").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame", value))), lambda s: s[value]).alias("values"))
