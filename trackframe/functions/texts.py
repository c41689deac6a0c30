"""Durations, versions and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def format_duration(seconds: Column) -> Column:
    """MM:SS, or H:MM:SS from an hour on; '--:--' when unknown. Fractions are cut, negative times count as none."""
    s = F.greatest(F.floor(seconds), F.lit(0).cast("long")).cast("long")
    short = F.format_string("%02d:%02d", F.floor(s / 60), s % 60)
    long = F.format_string("%d:%02d:%02d", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)
    return F.when(seconds.isNull(), F.lit("--:--")).when(s < 3600, short).otherwise(long)


def parse_version(text: Column) -> Column:
    """struct(major, minor) of '12.4' or of a tag like 'cu124', whose last digit is the minor version; null otherwise."""
    dotted = F.struct(F.regexp_extract(text, r"^(\d+)\.(\d+)", 1).try_cast("int").alias("major"), F.regexp_extract(text, r"^(\d+)\.(\d+)", 2).try_cast("int").alias("minor"))
    tagged = F.struct(F.regexp_extract(text, r"^cu(\d+)(\d)$", 1).try_cast("int").alias("major"), F.regexp_extract(text, r"^cu(\d+)(\d)$", 2).try_cast("int").alias("minor"))
    return F.when(F.rlike(text, F.lit(r"^\d+\.\d+")), dotted).when(F.rlike(text, F.lit(r"^cu\d\d+$")), tagged)


def format_version(version: Column) -> Column:
    return F.when(version.isNotNull(), F.format_string("%d.%d", version["major"], version["minor"]))


def without_marker(line: Column, marker: str) -> Column:
    """Predicate: the line doesn't hold the marker."""
    return ~line.contains(marker)


def joined_lines(chunks: DataFrame, key: str = "key", order: str = "seq", text: str = "value") -> DataFrame:
    """(key, line, value): the lines of a text that comes in chunks, which may end within a line. Lines are counted from 0; what stands
    behind the last line feed is a line if it isn't empty. A key's chunks are numbered by a running sum of their line feeds and only
    parts of lines that cross a chunk's end meet."""
    of_key = W.partitionBy(key).orderBy(order)
    feeds = F.size(F.split(text, "\n")) - 1
    counted = chunks.select(key, order, F.split(text, "\n").alias("parts"), (F.sum(feeds).over(of_key) - feeds).alias("before"))
    parts = counted.select(key, order, "before", F.posexplode("parts").alias("place", "part"))
    pieces = parts.groupBy(key, (F.col("before") + F.col("place")).cast("long").alias("line")).agg(F.array_sort(F.collect_list(F.struct(order, "part"))).alias("pieces"))
    lines = pieces.select(key, "line", F.array_join(F.transform("pieces", lambda p: p["part"]), "").alias("value"))
    return lines.withColumn("last", F.max("line").over(W.partitionBy(key))).where((F.col("line") < F.col("last")) | (F.col("value") != "")).drop("last")


def signed(value: Column, digits: int = 2) -> Column:
    return F.format_string(f"%+.{digits}f", value.cast("double"))


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def padded(value: Column, width: int) -> Column:
    return F.rpad(value.cast("string"), width, " ")
