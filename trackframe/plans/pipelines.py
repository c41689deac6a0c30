"""The two extractions from end to end, over a project's tables.

Both plan, clear by mode, choose frames and tell the outcome of every video; a video that can't be served is told of and doesn't stop
the others. They return plans: nothing is deleted or written before a caller writes the results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import detect, labelsets, reconcile, sampling, select, series
from ..sources.config import check_arguments
from .report import OutlierSummary

TABLES = ("videos", "predictions", "human", "machine", "refined", "disk", "counts")


@dataclass(frozen=True)
class Project:
    """videos (video, ord, path, group); predictions; human and refined (video, image, x, y); machine (video, iteration, image); disk
    (video, image); counts (video, frame_count)."""

    videos: DataFrame
    predictions: DataFrame
    human: DataFrame
    machine: DataFrame
    refined: DataFrame
    disk: DataFrame
    counts: DataFrame
    iteration: int = 0

    @classmethod
    def load(cls, spark: SparkSession, folder: str, iteration: int = 0) -> Project:
        return cls(*(spark.read.parquet(f"{folder}/{t}") for t in TABLES), iteration=iteration)


@dataclass(frozen=True)
class Extraction:
    """frames (video, frame) to extract; cleared (video, image) to remove first; outcomes (video, status, written)."""

    frames: DataFrame
    cleared: DataFrame
    outcomes: DataFrame

    def summary(self) -> OutlierSummary:
        row = reconcile.run_status_rollup(self.outcomes).first()
        return OutlierSummary(row["ok"], row["not_analyzed"], row["errors"], row["written"])


def _requested(project: Project, requested: DataFrame | None) -> DataFrame:
    """The registered videos that are asked for, all where nothing is; requests that match none are an error."""
    if requested is None:
        return project.videos
    found = project.videos.join(reconcile.registered_match(project.videos, requested).select("ord"), "ord", "left_semi")
    if not found.limit(1).count():
        raise ValueError("no requested video is registered")
    return found


def _outcomes(videos: DataFrame, frames: DataFrame, served: DataFrame) -> DataFrame:
    """ok with the frames written; not_analyzed where a video isn't among the served; error where a served one gives no frame."""
    written = frames.groupBy("video").agg(F.count("*").alias("written"))
    known = videos.select("video").distinct().join(written, "video", "left").join(served.select("video").distinct().withColumn("served", F.lit(True)), "video", "left")
    status = F.when(F.col("served").isNull(), "not_analyzed").when(F.col("written").isNull(), "error").otherwise("ok")
    return known.select("video", status.alias("status"), F.coalesce("written", F.lit(0)).cast("long").alias("written"))


def extract_outliers(
    project: Project, requested: DataFrame | None = None, algorithm: str = "jump", selector: str = "uniform", frames_per_video: int = 20, start: float = 0.0, stop: float = 1.0,
    step: int = 1, bodyparts: tuple[str, ...] = (), features: DataFrame | None = None, overwrite: bool = False, reset: bool = False, **options,
) -> Extraction:
    """Likely-wrong frames of the analyzed videos among the requested ones: window, detection, stride, then `frames_per_video` of the
    candidates by the selector ('uniform', or 'kmeans' over `features`). 'overwrite' clears the iteration's outliers of the served
    videos first, 'reset' those of every video; frames with a finite human label stay."""
    check_arguments(overwrite=overwrite, reset=reset, stride=step)
    if selector not in select.SELECTORS or (selector == "kmeans" and features is None):
        raise ValueError(f"unknown selector {selector!r}, or no features for it")
    if frames_per_video < 1:
        raise ValueError("frames_per_video must be positive")
    videos = _requested(project, requested)
    served = reconcile.analyzed_videos(videos.select("video"), project.predictions)
    if not served.limit(1).count():
        raise ValueError("none of the videos has been analyzed")
    rows = project.predictions.join(served, "video", "left_semi")
    rows = series.frame_window(rows, start, stop).drop("position", "n")
    if algorithm == "fitting":
        options = {"frames_per_video": frames_per_video, "index_base": "label"} | options
    candidates = detect.detect_outliers(rows, algorithm, bodyparts, step, **options)
    pool = candidates if features is None else features.join(candidates, ["video", "frame"], "left_semi")
    frames = select.SELECTORS[selector](pool, frames_per_video)
    scope = None if reset else served if overwrite else served.where("false")
    cleared = labelsets.removable_outliers(project.machine, project.human, project.iteration, scope)
    return Extraction(frames, cleared, _outcomes(videos, frames, served))


def extract_frames(
    project: Project, requested: DataFrame | None = None, ceiling: int = 20, budget: int = -1, balanced: bool = False, exclusive: bool = False, start: float = 0.0, stop: float = 1.0,
    stride: int = 1, overwrite: bool = False, reset: bool = False,
) -> Extraction:
    """Diverse frames for a start: every video below `ceiling` is topped up to it, or with a budget just enough of them to reach it.
    Videos in refinement are out of bounds, and asking to overwrite one is an error. Requested videos are pins of a budget, or with
    'exclusive' the whole set. 'overwrite' clears the bare frames of the chosen videos first, 'reset' those of all."""
    check_arguments(overwrite=overwrite, reset=reset, exclusive=exclusive, videos=() if requested is None else (1,), budget=budget, stride=stride)
    reconcile.require_unique_stems(project.videos)
    refined = reconcile.in_refinement(project.machine, project.refined)
    asked = None if requested is None else _requested(project, requested)
    if overwrite and asked is not None and asked.join(refined, "video", "left_semi").limit(1).count():
        raise ValueError("a requested video is in refinement already")
    videos = reconcile.refinement_exclusion(asked if exclusive else project.videos, project.machine, project.refined)
    bare = labelsets.bare_frames(project.disk, project.human, project.machine).join(videos.select("video"), "video", "left_semi")
    kept = project.disk.join(bare, ["video", "image"], "left_anti") if overwrite or reset else project.disk
    counted = videos.join(sampling.extracted_counts(videos.select("video"), kept), "video")
    pins = project.videos.where("false") if asked is None or exclusive else asked
    candidates = sampling.with_pins(counted.select("video", "ord", "group", "existing"), pins)
    if budget == -1 or exclusive:
        chosen = sampling.pick_counts(candidates, ceiling)
    else:
        status = sampling.budget_status(candidates, ceiling, budget).first()
        if status["unreachable"]:
            raise ValueError(f"{status['capacity']} more frames can't reach the budget of {budget}")
        fill = sampling.balanced_fill if balanced else sampling.uniform_fill
        chosen = fill(candidates, ceiling, budget).select("video", F.col("cap").alias("picks")).where("picks > 0")
    pool = series.candidate_range(project.counts.join(chosen, "video", "left_semi"), start, stop, stride)
    ranked = select.uniform_counts(pool, chosen)
    cleared = bare if reset else bare.join(chosen, "video", "left_semi") if overwrite else bare.where("false")
    return Extraction(ranked, cleared, _outcomes(chosen, ranked, project.counts))
