"""Project configuration: one YAML file, read and written on the driver."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import yaml
from pyspark.sql import DataFrame, SparkSession

VIDEO_SCHEMA = "ord long, path string, crop string"


@dataclass(frozen=True)
class ProjectConfig:
    project_path: str = ""
    scorer: str = ""
    iteration: int = 0
    start: float = 0.0
    stop: float = 1.0
    frames_per_video: int | None = None
    cropping: bool = False
    crop: tuple[int, ...] = ()
    cutoff: float = 0.6
    training_fractions: tuple[float, ...] = ()
    videos: dict[str, str | None] = field(default_factory=dict)

    def videos_frame(self, spark: SparkSession) -> DataFrame:
        """(ord, path, crop) in the file's order."""
        return spark.createDataFrame([(i, p, c) for i, (p, c) in enumerate(self.videos.items())], VIDEO_SCHEMA)


def load_config(path: str, frames_per_video: int = -1, write_back: bool = True) -> ProjectConfig:
    """Reads a project file and notes where it lies; `frames_per_video` overrides its count unless -1, and must be positive."""
    if frames_per_video != -1 and frames_per_video < 1:
        raise ValueError("frames_per_video must be positive, or -1 to leave it")
    with open(path) as f:
        raw = yaml.safe_load(f) or {}
    known = {"project_path": os.path.dirname(os.path.abspath(path))} | ({"numframes2pick": frames_per_video} if frames_per_video != -1 else {})
    if write_back and any(raw.get(k) != v for k, v in known.items()):
        with open(path, "w") as f:
            yaml.safe_dump(raw | known, f, sort_keys=False)
    raw |= known
    count = raw.get("numframes2pick")
    if count is not None and (isinstance(count, bool) or not isinstance(count, int) or count < 1):
        raise ValueError("numframes2pick must be a positive whole number")
    edges = tuple(raw[k] for k in ("x1", "x2", "y1", "y2") if k in raw)
    return ProjectConfig(
        project_path=raw["project_path"], scorer=raw.get("scorer", ""), iteration=raw.get("iteration", 0), start=float(raw.get("start", 0)), stop=float(raw.get("stop", 1)),
        frames_per_video=count, cropping=bool(raw.get("cropping", False)), crop=edges if len(edges) == 4 else (), cutoff=float(raw.get("pcutoff", 0.6)),
        training_fractions=tuple(raw.get("TrainingFraction") or ()), videos={p: (v or {}).get("crop") for p, v in (raw.get("video_sets") or {}).items()},
    )


def check_arguments(overwrite: bool = False, reset: bool = False, exclusive: bool = False, videos: tuple[str, ...] = (), budget: int = -1, stride: int = 1) -> None:
    """Refuses options that contradict each other."""
    if overwrite and reset:
        raise ValueError("overwrite and reset exclude each other")
    if exclusive and not videos:
        raise ValueError("exclusive needs videos")
    if exclusive and reset:
        raise ValueError("exclusive and reset exclude each other")
    if budget != -1 and budget < 1:
        raise ValueError("the budget must be positive, or -1 for none")
    if stride < 1:
        raise ValueError("the stride must be at least 1")
