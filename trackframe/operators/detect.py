"""Outlier detection over prediction tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import finite


def uncertain_outliers(predictions: DataFrame, minimum_confidence: float = 0.01) -> DataFrame:
    """(video, frame) where any keypoint's likelihood is below the minimum; a missing likelihood isn't."""
    return predictions.where(finite(F.col("likelihood")) < minimum_confidence).select("video", "frame").distinct()


def jump_steps(predictions: DataFrame, colocate: bool = True) -> DataFrame:
    """(video, frame, bodypart, step): squared displacement since the individual's frame before, summed over x, y and individuals. A
    missing coordinate adds 0, as does the first frame. With `colocate` one exchange by video serves every step of the plan; without
    it the rows of a very long video spread by keypoint at the price of two more exchanges."""
    rows = predictions.repartition("video") if colocate else predictions
    before = W.partitionBy("video", "individual", "bodypart").orderBy("frame")
    step = lambda c: F.coalesce(F.pow(finite(F.col(c)) - F.lag(finite(F.col(c))).over(before), 2), F.lit(0.0))
    squared = rows.select("video", "frame", "bodypart", (step("x") + step("y")).alias("squared"))
    return squared.groupBy("video", "frame", "bodypart").agg(F.sum("squared").alias("step"))


def jump_outliers(predictions: DataFrame, pixel_distance: float = 20.0, colocate: bool = True) -> DataFrame:
    """(video, frame) where any bodypart moved by more than the distance since the frame before."""
    far = jump_steps(predictions, colocate).where(F.col("step") > pixel_distance**2)
    return far.groupBy("video", "frame").agg(F.count("*").alias("n")).select("video", "frame")


def list_outliers(videos: DataFrame, frames: list[int]) -> DataFrame:
    """The given frames, sorted and distinct, for every video."""
    wanted = F.array(*(F.lit(int(f)).cast("long") for f in sorted(set(frames))))
    return videos.select("video", F.explode(wanted).alias("frame"))


def nanmean_deviation(deviations: DataFrame) -> DataFrame:
    """(video, frame, deviation): mean over keypoints without missing values; NaN where all are missing."""
    return deviations.groupBy("video", "frame").agg(F.coalesce(F.avg(finite(F.col("deviation"))), F.lit(float("nan"))).alias("deviation"))


def deviation_outliers(mean_deviations: DataFrame, frames_per_video: int, pixel_distance: float) -> DataFrame:
    """(video, position) where the deviation exceeds the distance. Videos with fewer than 2 * frames_per_video such frames, but more
    frames than that, give their 2 * frames_per_video most deviating positions instead; NaN ranks first there, ties by the later
    position."""
    least = 2 * frames_per_video
    of_video = W.partitionBy("video")
    ranked = mean_deviations.select(
        "video", F.col("frame").alias("position"), "deviation",
        F.row_number().over(of_video.orderBy(F.col("deviation").desc(), F.col("frame").desc())).alias("rank"),
        F.coalesce(finite(F.col("deviation")) > pixel_distance, F.lit(False)).alias("far"),
    )
    ranked = ranked.withColumn("n_far", F.count(F.when(F.col("far"), 1)).over(of_video)).withColumn("n", F.count("*").over(of_video))
    fallback = (F.col("n_far") < least) & (F.col("n") > least)
    return ranked.where(F.when(fallback, F.col("rank") <= least).otherwise(F.col("far"))).select("video", "position")


def sorted_distinct(candidates: DataFrame) -> DataFrame:
    return candidates.select("video", "frame").distinct()


#: Strategies by name: predictions and options to (video, frame).
DETECTORS: dict[str, Callable[..., DataFrame]] = {
    "jump": lambda predictions, pixel_distance=20.0, **_: jump_outliers(predictions, pixel_distance),
    "uncertain": lambda predictions, minimum_confidence=0.01, **_: uncertain_outliers(predictions, minimum_confidence),
    "list": lambda predictions, frames=(), **_: list_outliers(predictions.select("video").distinct(), list(frames)),
}


def detect_outliers(predictions: DataFrame, algorithm: str = "jump", bodyparts: tuple[str, ...] = (), step: int = 1, **options) -> DataFrame:
    """The whole path: projection to bodyparts, detection, distinct frames, stride."""
    from . import series, trajectory

    if step < 1:
        raise ValueError("the candidate step must be at least 1")
    if algorithm == "list" and not options.get("frames"):
        raise ValueError("the algorithm 'list' needs frames")
    rows = series.bodypart_projection(predictions, list(bodyparts))
    if algorithm == "fitting":
        found = trajectory.fitting_outliers(rows, **options)
    elif algorithm in DETECTORS:
        found = DETECTORS[algorithm](rows, **options)
    else:
        raise ValueError(f"unknown algorithm {algorithm!r}")
    return series.candidate_stride(sorted_distinct(found), step)
