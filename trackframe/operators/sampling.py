"""Budgeted sampling of videos. Candidates are (video, ord, group, existing, pinned).

Both fills are running sums: the uniform one over pins, then fresh videos, then those below the ceiling; the balanced one over the order
in which the least covered group is extended again and again. A group's coverage before its next video is a running sum of its own,
which never falls, so that order is a sort by (coverage, group) and needs no loop.

The running sum over all candidates is split: sums by blocks of the order first, then within blocks, so no task holds all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def extracted_counts(videos: DataFrame, frames: DataFrame) -> DataFrame:
    """(video, existing), 0 for videos without frames."""
    counts = frames.groupBy("video").agg(F.count("*").alias("n"))
    return videos.join(counts, "video", "left").select("video", F.coalesce("n", F.lit(0)).cast("long").alias("existing"))


def capacity(ceiling: int) -> Column:
    return F.greatest(F.lit(0), F.lit(ceiling) - F.col("existing")).cast("long")


def pick_counts(candidates: DataFrame, ceiling: int) -> DataFrame:
    """(video, picks) of the videos below the ceiling."""
    return candidates.select("video", capacity(ceiling).alias("picks")).where("picks > 0")


def budget_status(candidates: DataFrame, ceiling: int, budget: int) -> DataFrame:
    """One row: existing, target, remaining, capacity, met, unreachable, overshoot (of the pins alone)."""
    totals = candidates.agg(
        F.coalesce(F.sum("existing"), F.lit(0)).cast("long").alias("existing"), F.coalesce(F.sum(capacity(ceiling)), F.lit(0)).cast("long").alias("capacity"),
        F.coalesce(F.sum(F.when(F.col("pinned"), capacity(ceiling))), F.lit(0)).cast("long").alias("of_pins"),
    )
    remaining = F.lit(budget).cast("long") - F.col("existing")
    met = remaining <= 0
    return totals.select(
        "existing", F.lit(budget).cast("long").alias("target"), remaining.alias("remaining"), "capacity", met.alias("met"),
        (~met & (F.col("capacity") < remaining)).alias("unreachable"), (~met & (F.col("of_pins") > remaining)).alias("overshoot"),
    )


def _selected(ordered: DataFrame, key: list[str], status: DataFrame) -> DataFrame:
    """Rows of `ordered` that the budget takes. `key` orders them; equal leading columns form a bucket whose total comes before."""
    bucket, rest = key[0], key[1:]
    totals = ordered.groupBy(bucket).agg(F.sum("cap").alias("total"))
    totals = totals.withColumn("whole", F.lit(1)).withColumn("before", F.sum("total").over(W.partitionBy("whole").orderBy(bucket)) - F.col("total")).select(bucket, "before")
    within = F.sum("cap").over(W.partitionBy(bucket).orderBy(*rest).rowsBetween(W.unboundedPreceding, 0)) - F.col("cap")
    summed = ordered.withColumn("within", within).join(totals, bucket).withColumn("prior", F.col("before") + F.col("within"))
    left = status.select(F.when(F.col("met"), F.lit(0)).otherwise(F.col("remaining")).alias("left"), "met")
    return summed.crossJoin(F.broadcast(left)).where(~F.col("met") & ((F.col("tier") == 0) | (F.col("prior") < F.col("left")))).drop("within", "before", "left", "met")


def uniform_fill(candidates: DataFrame, ceiling: int, budget: int) -> DataFrame:
    """(video, cap, tier, prior) of the selected videos: pins always, then fresh ones, then those below the ceiling, in the order given,
    while the sum so far is below what the budget lacks. Nothing is selected when the budget is met already."""
    status = budget_status(candidates, ceiling, budget)
    cap = capacity(ceiling)
    tier = F.when(F.col("pinned"), 0).when(F.col("existing") == 0, 1).otherwise(2)
    rows = candidates.select("video", "ord", cap.alias("cap"), tier.alias("tier")).where((F.col("tier") == 0) | (F.col("cap") > 0))
    rows = rows.withColumn("bucket", F.col("tier").cast("long") * F.lit(2**40) + F.floor(F.col("ord") / 4096))
    return _selected(rows, ["bucket", "ord"], status).select("video", "cap", "tier", "prior")


def balanced_fill(candidates: DataFrame, ceiling: int, budget: int) -> DataFrame:
    """(video, group, cap, tier, coverage, prior) of the selected videos: pins always; then the next video of the group with the least
    projected frames, ties by group, where a group offers fresh videos before those below the ceiling and the later before the earlier."""
    status = budget_status(candidates, ceiling, budget)
    cap = capacity(ceiling)
    start = candidates.where(F.col("group").isNotNull()).groupBy("group").agg((F.sum("existing") + F.coalesce(F.sum(F.when(F.col("pinned"), cap)), F.lit(0))).alias("covered"))
    rows = candidates.select("video", "ord", "group", "existing", "pinned", cap.alias("cap"))
    pins = rows.where("pinned").select("video", "group", "cap", "ord", F.lit(0).alias("tier"), F.lit(-1).cast("long").alias("coverage"), F.lit("").alias("tie"))
    free = rows.where("not pinned and cap > 0 and group is not null").join(start, "group")
    turn = W.partitionBy("group").orderBy((F.col("existing") > 0).cast("int"), F.col("ord").desc()).rowsBetween(W.unboundedPreceding, 0)
    free = free.withColumn("coverage", (F.col("covered") + F.sum("cap").over(turn) - F.col("cap")).cast("long"))
    free = free.select("video", "group", "cap", "ord", F.lit(1).alias("tier"), "coverage", F.col("group").alias("tie"))
    return _selected(pins.unionByName(free), ["coverage", "tie", "ord"], status).select("video", "group", "cap", "tier", "coverage", "prior")


def per_group_coverage(candidates: DataFrame, selected: DataFrame, ceiling: int) -> DataFrame:
    """(group, existing, added, projected, available): frames held, videos added, frames then, videos below the ceiling."""
    cap = capacity(ceiling)
    by = candidates.where(F.col("group").isNotNull()).groupBy("group").agg(F.sum("existing").cast("long").alias("existing"), F.count(F.when(cap > 0, 1)).alias("available"))
    added = selected.groupBy("group").agg(F.count("*").alias("added"), F.sum("cap").alias("gain"))
    return by.join(added, "group", "left").select(
        "group", "existing", F.coalesce("added", F.lit(0)).cast("long").alias("added"),
        (F.col("existing") + F.coalesce("gain", F.lit(0))).cast("long").alias("projected"), "available",
    )


def with_pins(candidates: DataFrame, requested: DataFrame) -> DataFrame:
    """Candidates, pinned where their video is requested; requests that are no candidates play no part."""
    asked = requested.select("video").distinct().withColumn("asked", F.lit(True))
    return candidates.drop("pinned").join(asked, "video", "left").withColumn("pinned", F.coalesce("asked", F.lit(False))).drop("asked")


def coverage_report(coverage: DataFrame) -> DataFrame:
    """Groups by falling gain, then by name."""
    return coverage.orderBy(F.col("added").desc(), "group")


def starved_groups(coverage: DataFrame) -> DataFrame:
    """One row: groups sampled (added > 0) and starved (nothing added though videos were available)."""
    return coverage.agg(F.count(F.when(F.col("added") > 0, 1)).alias("sampled"), F.count(F.when((F.col("added") == 0) & (F.col("available") > 0), 1)).alias("starved"))
