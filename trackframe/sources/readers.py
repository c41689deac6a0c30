"""Readers of tables and folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.paths import file_name, is_frame, parent, suffix

VIDEO_SUFFIXES = (".mp4", ".avi", ".mkv", ".mov", ".mpeg", ".mpg", ".mpv", ".flv", ".qt", ".yuv")


def predictions(spark: SparkSession, path: str) -> DataFrame:
    """Predictions partitioned by video: filters on video prune folders, filters on frame reach the scan."""
    return spark.read.parquet(path)


def frame_range(rows: DataFrame, video, start: int, end: int) -> DataFrame:
    return rows.where((F.col("video") == video) & (F.col("frame") >= start) & (F.col("frame") < end))


def listing(spark: SparkSession, directory: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """(path, name, folder, length) of the files of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(directory)
    p = F.col("path")
    return files.select("path", file_name(p).alias("name"), file_name(parent(p)).alias("folder"), "length")


def directory_videos(spark: SparkSession, directory: str, exclude: tuple[str, ...] = ("_labeled.", "_full.")) -> DataFrame:
    """The folder's videos by name, without subfolders; suffixes in any case."""
    found = listing(spark, directory).where(F.lower(suffix(F.col("name"))).isin(*VIDEO_SUFFIXES))
    for part in exclude:
        found = found.where(~F.col("name").contains(part))
    return found.select("path", "name").orderBy("name")


def extracted_frames(spark: SparkSession, directory: str) -> DataFrame:
    """(video, image) of the extracted frames below a folder of label folders."""
    found = listing(spark, directory, "img*.png", recursive=True).where(is_frame(F.col("name")))
    return found.select(F.col("folder").alias("video"), F.col("name").alias("image"))


def file_tail(spark: SparkSession, path: str, lines: int) -> list[str]:
    """The last lines of a text file."""
    return [r.value for r in spark.read.text(path).tail(lines)]


def with_order(df: DataFrame, *by: str) -> DataFrame:
    """Adds ord by the given columns within one folder or project, which both are small."""
    return df.withColumn("whole", F.lit(1)).withColumn("ord", F.row_number().over(W.partitionBy("whole").orderBy(*by)).cast("long") - 1).drop("whole")
