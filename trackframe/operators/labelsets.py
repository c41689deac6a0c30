"""Set algebra over frames, human labels and machine labels. Frames are named by (video, image)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import is_finite

KEY = ["video", "image"]


def finite_labels(labels: DataFrame) -> DataFrame:
    """Frames with any finite coordinate; rows without one are placeholders."""
    return labels.where(is_finite(F.col("x")) | is_finite(F.col("y"))).select(*KEY).distinct()


def machine_label_union(machine: DataFrame) -> DataFrame:
    """Frames that any machine table names."""
    return machine.select(*KEY).distinct()


def protected_frames(human: DataFrame, machine: DataFrame) -> DataFrame:
    return finite_labels(human).unionByName(machine_label_union(machine)).distinct()


def bare_frames(disk: DataFrame, human: DataFrame, machine: DataFrame) -> DataFrame:
    """Frames on disk that neither a human label with a coordinate nor a machine label protects."""
    return disk.select(*KEY).distinct().join(protected_frames(human, machine), KEY, "left_anti")


def removable_outliers(machine: DataFrame, human: DataFrame, iteration: int, scope: DataFrame | None = None) -> DataFrame:
    """Machine-labelled frames of the iteration without a finite human label; `scope` (video) limits the directories."""
    rows = machine.where(F.col("iteration") == iteration).select(*KEY).distinct()
    rows = rows if scope is None else rows.join(scope, "video", "left_semi")
    return rows.join(finite_labels(human), KEY, "left_anti")


def cleared_outliers(machine: DataFrame, human: DataFrame, refined: DataFrame, iteration: int, scope: DataFrame | None = None) -> DataFrame:
    """(video, removed, refinement): by directory with machine labels of the iteration, how many frames a clearing removes, and whether
    it discards a refinement of them."""
    rows = machine.where(F.col("iteration") == iteration).select("video").distinct()
    rows = rows if scope is None else rows.join(scope, "video", "left_semi")
    removed = removable_outliers(machine, human, iteration, scope).groupBy("video").agg(F.count("*").alias("removed"))
    discarded = refined.select("video").distinct().withColumn("refinement", F.lit(True))
    found = rows.join(removed, "video", "left").join(discarded, "video", "left")
    return found.select("video", F.coalesce("removed", F.lit(0)).cast("long").alias("removed"), F.coalesce("refinement", F.lit(False)).alias("refinement"))


def pending_frames(machine: DataFrame, human: DataFrame, refined: DataFrame, iteration: int) -> DataFrame:
    """Machine-labelled frames of the iteration with neither a finite human nor a finite refined label."""
    done = finite_labels(human).unionByName(finite_labels(refined)).distinct()
    return machine.where(F.col("iteration") == iteration).select(*KEY).distinct().join(done, KEY, "left_anti")


def pending_refinement(machine: DataFrame, human: DataFrame, refined: DataFrame, iteration: int) -> DataFrame:
    """(video, pending) of the directories with pending frames."""
    return pending_frames(machine, human, refined, iteration).groupBy("video").agg(F.count("*").alias("pending"))


def pending_report(pending: DataFrame) -> DataFrame:
    """The directories with pending frames, by name."""
    return pending.orderBy("video")


def drop_label_rows(labels: DataFrame, removed: DataFrame) -> DataFrame:
    """Label rows but those of removed frames."""
    return labels.join(removed.select(*KEY), KEY, "left_anti")


def purge_preview(disk: DataFrame, human: DataFrame) -> DataFrame:
    """One row of what a purge would delete: directories, those with finite human labels, frames."""
    labelled = finite_labels(human).select("video").distinct().withColumn("labelled", F.lit(1))
    by = disk.groupBy("video").agg(F.countDistinct("image").alias("frames")).join(labelled, "video", "left")
    return by.agg(
        F.count("*").alias("directories"), F.count("labelled").alias("labelled_directories"), F.coalesce(F.sum("frames"), F.lit(0)).cast("long").alias("frames")
    )


def empty_directories(directories: DataFrame, frames: DataFrame) -> DataFrame:
    return directories.join(frames.select("video").distinct(), "video", "left_anti")


def real_directories(listing: DataFrame) -> DataFrame:
    """Of (name, is_dir, is_link) the directories that hold labels: no links, hidden or overlay directories."""
    return listing.where(F.col("is_dir") & ~F.col("is_link") & ~F.col("name").startswith(".") & ~F.col("name").endswith("_labeled"))


def written_frames(before: DataFrame, after: DataFrame) -> DataFrame:
    """(video, written): frames gained, never below 0."""
    b, a = before.groupBy("video").agg(F.count("*").alias("b")), after.groupBy("video").agg(F.count("*").alias("a"))
    return a.join(b, "video", "full").select("video", F.greatest(F.lit(0).cast("long"), F.coalesce("a", F.lit(0)) - F.coalesce("b", F.lit(0))).alias("written"))
