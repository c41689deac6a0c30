"""Frame series: windows, offsets, strides, ranges and projections of prediction tables.

Prediction tables are long: video, frame, individual, bodypart, x, y, likelihood.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import clustering_total, finite, window_start, window_stop
from ..functions.paths import parse_crop


def bodypart_projection(predictions: DataFrame, bodyparts: list[str]) -> DataFrame:
    """Rows of the named bodyparts; all rows when none is named. Names of which no row has any are an error."""
    if not bodyparts:
        return predictions
    found = predictions.where(F.col("bodypart").isin(bodyparts))
    if not found.limit(1).count() and predictions.limit(1).count():
        raise ValueError(f"none of the bodyparts {', '.join(map(repr, bodyparts))} is in the predictions")
    return found


def keypoint_series(predictions: DataFrame) -> DataFrame:
    """Adds keypoint, the position (from 0) of (individual, bodypart) among those of its video."""
    keys = predictions.select("video", "individual", "bodypart").distinct()
    order = W.partitionBy("video").orderBy("individual", "bodypart")
    numbered = keys.withColumn("keypoint", (F.row_number().over(order) - 1).cast("int"))
    return predictions.join(numbered, ["video", "individual", "bodypart"])


def wide_pivot(predictions: DataFrame, bodyparts: list[str]) -> DataFrame:
    """One row per video, frame and individual with columns <bodypart>_x, _y and _likelihood."""
    parts = [F.max(F.when(F.col("bodypart") == b, F.col(c))).alias(f"{b}_{c}") for b in bodyparts for c in ("x", "y", "likelihood")]
    return predictions.groupBy("video", "frame", "individual").agg(*parts)


def long_unpivot(wide: DataFrame, bodyparts: list[str]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(b).alias("bodypart"), *(F.col(f"{b}_{c}").alias(c) for c in ("x", "y", "likelihood"))) for b in bodyparts))
    return wide.select("video", "frame", "individual", F.explode(rows).alias("p")).select("video", "frame", "individual", "p.*")


def frame_window(frames: DataFrame, start: float, stop: float) -> DataFrame:
    """Frames at positions floor(n * start) up to, but without, ceil(n * stop) of their video; adds position and n. Positions are
    of distinct frames, so a frame of several keypoints counts once."""
    of_video = W.partitionBy("video")
    ranked = frames.withColumn("position", F.dense_rank().over(of_video.orderBy("frame")).cast("long") - 1)
    ranked = ranked.withColumn("n", F.max("position").over(of_video) + 1)
    return ranked.where((F.col("position") >= window_start(F.col("n"), start)) & (F.col("position") < window_stop(F.col("n"), stop)))


def crop_offset(predictions: DataFrame, metadata: DataFrame, config: DataFrame) -> DataFrame:
    """Shifts x and y by the crop that the metadata (video, cropped, x1, y1) had over the configured crop (video, crop), for videos
    whose metadata says cropped; other videos stay. The configuration is looked up by the exact path; without an entry its crop
    starts at 0."""
    crop = parse_crop(F.col("crop"), "error")
    configured = config.select("video", F.get(crop, F.lit(0)).alias("cx"), F.get(crop, F.lit(2)).alias("cy"))
    about = metadata.join(configured, "video", "left")
    about = about.select("video", F.when(F.col("cropped"), F.col("x1") - F.coalesce("cx", F.lit(0))).alias("dx"), F.when(F.col("cropped"), F.col("y1") - F.coalesce("cy", F.lit(0))).alias("dy"))
    moved = predictions.join(about, "video", "left")
    for c, d in (("x", "dx"), ("y", "dy")):
        moved = moved.withColumn(c, F.col(c) + F.coalesce(d, F.lit(0)))
    return moved.drop("dx", "dy")


def video_crops(videos: DataFrame, config: DataFrame, project_crop: list[int] | None, cropping: bool) -> DataFrame:
    """(video, crop): the video's own registered crop, else the project's rectangle when `cropping`, else null."""
    own = config.select("video", parse_crop(F.col("crop"), "null").alias("own"))
    project = F.array(*map(F.lit, project_crop)).cast("array<int>") if project_crop else F.lit(None).cast("array<int>")
    return videos.join(own, "video", "left").select("video", F.when(F.lit(cropping), F.coalesce("own", project)).alias("crop"))


def candidate_stride(candidates: DataFrame, step: int) -> DataFrame:
    """Every step-th candidate of each video, in frame order from the first."""
    position = F.row_number().over(W.partitionBy("video").orderBy("frame")) - 1
    return candidates.withColumn("k", position).where(F.col("k") % step == 0).drop("k")


def candidate_window_crop(candidates: DataFrame, counts: DataFrame, start: float, stop: float) -> DataFrame:
    """Candidates strictly inside the window (floor(n * start), ceil(n * stop)) of their video's frame count: frame 0 never is."""
    n = F.col("frame_count")
    inside = (F.col("frame") > F.floor(n * F.lit(start))) & (F.col("frame") < F.ceil(n * F.lit(stop)))
    return candidates.join(counts, "video").where(inside).drop("frame_count")


def candidate_range(counts: DataFrame, start: float, stop: float, step: int) -> DataFrame:
    """The generated candidates of each video: floor(n * start), stepping, below ceil(n * stop)."""
    n = F.col("frame_count")
    first, last = F.floor(n * F.lit(start)), F.ceil(n * F.lit(stop)) - 1
    frames = F.when(last >= first, F.sequence(first, last, F.lit(step).cast("long")))
    return counts.select("video", F.explode(frames).alias("frame"))


def clustering_totals(counts: DataFrame, start: float, stop: float, stride: int) -> DataFrame:
    return counts.select("video", clustering_total(F.col("frame_count"), start, stop, stride).alias("total"))


def candidate_density(candidates: DataFrame, most_gap: float = 200.0) -> DataFrame:
    """Per video the candidates' number and mean gap, and whether they are dense enough to stream: two at least, with a mean gap of
    at most `most_gap`."""
    by = candidates.groupBy("video").agg(F.count("*").alias("candidates"), F.min("frame").alias("lo"), F.max("frame").alias("hi"))
    gap = F.try_divide((F.col("hi") - F.col("lo")).cast("double"), (F.col("candidates") - 1).cast("double"))
    return by.select("video", "candidates", gap.alias("mean_gap"), F.coalesce(gap <= most_gap, F.lit(False)).alias("stream"))


def feature_centering(features: DataFrame, column: str = "features") -> DataFrame:
    """Adds centered: the array minus the mean of each of its places over the video."""
    each = features.select("video", F.posexplode(column).alias("place", "value"))
    means = each.groupBy("video", "place").agg(F.avg("value").alias("mean"))
    means = means.groupBy("video").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "mean"))), lambda s: s["mean"]).alias("means"))
    return features.join(means, "video").withColumn("centered", F.zip_with(column, "means", lambda a, m: a - m)).drop("means")


def finite_positions(predictions: DataFrame) -> DataFrame:
    for c in ("x", "y", "likelihood"):
        predictions = predictions.withColumn(c, finite(F.col(c)))
    return predictions
