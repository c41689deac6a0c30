"""Missing values and numbers. NaN counts as missing everywhere but where a rule says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(value: Column) -> Column:
    """The value, or null for NaN: Spark orders NaN above every number, so it must not reach a comparison."""
    return F.when(F.isnan(value), F.lit(None)).otherwise(value)


def is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def nan_mean(value: Column) -> Column:
    """Mean without missing values; NaN when all are missing."""
    return F.coalesce(F.avg(finite(value)), F.lit(float("nan")))


def euclidean(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def window_start(n: Column, start: float) -> Column:
    """First position of a fractional window over n rows."""
    return F.greatest(F.floor(n * F.lit(float(start))), F.lit(0).cast("long"))


def window_stop(n: Column, stop: float) -> Column:
    """Position behind the last of a fractional window over n rows."""
    return F.least(F.ceil(n * F.lit(float(stop))), n.cast("long"))


def half_even(value: Column, digits: int = 0) -> Column:
    return F.bround(value, digits)


def fraction_done(done: Column, total: Column) -> Column:
    """Share done, between 0 and 1; 0 when the total is unknown."""
    return F.coalesce(F.least(F.greatest(F.try_divide(done, total), F.lit(0.0)), F.lit(1.0)), F.lit(0.0))


def remaining_seconds(done: Column, total: Column, elapsed: Column) -> Column:
    """Seconds left at the mean rate so far; null while nothing is done."""
    return F.try_divide((total - done) * elapsed, done)


def projected_frames(existing: Column, capacity: Column) -> Column:
    return existing + capacity


def clustering_total(frame_count: Column, start: float, stop: float, stride: int) -> Column:
    """Frames that a clustering pass reads: at least one."""
    span = F.ceil(frame_count * F.lit(float(stop))) - F.floor(frame_count * F.lit(float(start)))
    return F.greatest(F.lit(1).cast("long"), F.ceil(span / F.lit(stride)).cast("long"))


def downsampled(width: Column, height: Column, target: int) -> Column:
    """Size after scaling to a target width, half-even rounded; an error when that would enlarge the frame."""
    ratio = F.lit(float(target)) / width
    size = F.struct(F.rint(width * ratio).cast("int").alias("width"), F.rint(height * ratio).cast("int").alias("height"))
    return F.when(ratio > 1, F.raise_error(F.lit("the target is wider than the frame")).cast("struct<width:int,height:int>")).otherwise(size)
