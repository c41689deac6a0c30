"""One-line summaries."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class OutlierSummary:
    ok: int
    not_analyzed: int
    errors: int
    written: int

    @property
    def successful(self) -> bool:
        return self.errors == 0

    def describe(self) -> str:
        return f"{self.written:,} frames of {self.ok} videos; {self.not_analyzed} not analyzed, {self.errors} failed"


@dataclass(frozen=True)
class PurgeSummary:
    directories: int
    labelled_directories: int
    frames: int
    executed: bool

    def describe(self) -> str:
        done = "deleted" if self.executed else "would delete"
        return f"{done} {self.frames:,} frames in {self.directories} folders, {self.labelled_directories} of them with labels"


@dataclass(frozen=True)
class SplitMetrics:
    split: str
    images: int
    rmse_px: float
    rmse_px_above: float

    def describe(self) -> str:
        return f"{self.split}: {self.images:,} images, {self.rmse_px:.2f} px ({self.rmse_px_above:.2f} px above the cutoff)"


def plan_lines(coverage: list, videos: int, picks: int) -> list[str]:
    """What a run is about to do: the whole, then its groups by falling gain and name."""
    lines = [f"{picks:,} frames of {videos:,} videos"]
    return lines + [f"{c['group']}: {c['existing']:,} + {c['projected'] - c['existing']:,} frames, {c['added']} videos" for c in sorted(coverage, key=lambda c: (-c["added"], c["group"]))]


def failure_lines(outcomes: list) -> list[str]:
    """One line for each video that gave no frames, by name."""
    return [f"{o['video']}: {o['status'].replace('_', ' ')}" for o in sorted(outcomes, key=lambda o: str(o["video"])) if o["status"] != "ok"]


def describe_gap(train: SplitMetrics, test: SplitMetrics) -> str:
    return f"gap {test.rmse_px - train.rmse_px:+.2f} px"
