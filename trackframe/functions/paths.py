"""Paths as strings with '/' between parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ANCHOR = "labeled-data"


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The file name without its last suffix; a leading dot starts no suffix."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def suffix(path: Column) -> Column:
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def relative_image(path: Column, anchor: str = ANCHOR) -> Column:
    """struct(video, image): from the first part named `anchor` on, with the next part as the video ('' if it is the last);
    without such a part the names of the folder and the file."""
    parts = F.split(path, "/")
    at = F.array_position(parts, anchor).cast("int")
    n = F.size(parts)
    anchored = F.struct(
        F.when(at < n, F.get(parts, at)).otherwise(F.lit("")).alias("video"), F.array_join(F.slice(parts, F.greatest(at, F.lit(1)), n), "/").alias("image")
    )
    plain = F.struct(F.coalesce(F.get(parts, n - 2), F.lit("")).alias("video"), F.get(parts, n - 1).alias("image"))
    return F.when(at > 0, anchored).otherwise(plain)


def shuffle_number(path: Column) -> Column:
    return F.regexp_extract(path, r"shuffle(\d+)", 1).try_cast("int")


def is_overlay(name: Column) -> Column:
    """Frames drawn with their labels carry this ending."""
    return stem(name).endswith("labeled")


def is_frame(name: Column) -> Column:
    return name.startswith("img") & name.endswith(".png") & ~is_overlay(name)


def parse_crop(text: Column, policy: str = "null") -> Column:
    """array<int> x1, x2, y1, y2 of a crop. Malformed text gives null (policy 'null') or an error ('error'); policy 'positive'
    also refuses crops without area."""
    parts = F.transform(F.split(text, ","), lambda p: F.trim(p).try_cast("int"))
    good = (F.size(parts) == 4) & ~F.exists(parts, lambda p: p.isNull())
    fail = lambda why: F.raise_error(F.concat(F.lit(why), text)).cast("array<int>")
    if policy == "null":
        return F.when(good, parts)
    crop = F.when(text.isNull(), F.lit(None).cast("array<int>")).when(good, parts).otherwise(fail("malformed crop: "))
    if policy == "positive":
        area = (F.get(crop, 1) > F.get(crop, 0)) & (F.get(crop, 3) > F.get(crop, 2))
        crop = F.when(crop.isNull() | area, crop).otherwise(fail("crop without area: "))
    return crop
