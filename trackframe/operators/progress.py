"""Progress of work units from messages (seq, key, kind, count), in batch; streaming/progress.py has the same state over streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import fraction_done, remaining_seconds
from ..functions.texts import format_duration


def latest_counts(messages: DataFrame) -> DataFrame:
    """(key, latest, done): the count of the key's newest progress message, and whether it has reported done."""
    progress = F.col("kind") == "progress"
    return messages.groupBy("key").agg(
        F.coalesce(F.max_by(F.when(progress, F.col("count")), F.when(progress, F.col("seq"))), F.lit(0)).cast("long").alias("latest"), F.bool_or(F.col("kind") == "done").alias("done")
    )


def progress_snapshot(messages: DataFrame, total: int) -> DataFrame:
    """One row: frames done (at most the total), total, units done."""
    return latest_counts(messages).agg(
        F.least(F.coalesce(F.sum("latest"), F.lit(0)), F.lit(total)).cast("long").alias("frames"), F.lit(total).cast("long").alias("total"), F.count(F.when(F.col("done"), 1)).alias("units_done")
    )


def video_completion(units: DataFrame) -> DataFrame:
    """(video, units, remaining, complete) from work units (video, key, done)."""
    left = F.count(F.when(~F.col("done"), 1))
    return units.groupBy("video").agg(F.count("*").alias("units"), left.alias("remaining"), (left == 0).alias("complete"))


def stalled_keys(messages: DataFrame, seconds: float, now: str | None = None) -> DataFrame:
    """(key, since, silence): each silence of at least `seconds` between a key's messages, warned of once; with `now` (a timestamp as
    text) also the one that lasts still."""
    order = W.partitionBy("key").orderBy("ts", "seq")
    after = F.lead("ts").over(order)
    after = F.coalesce(after, F.lit(now).cast("timestamp_ntz")) if now else after
    seen = messages.select("key", "seq", "ts", after.alias("after"))
    gap = (F.unix_micros(F.col("after").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1e6
    return seen.select("key", F.col("ts").alias("since"), gap.alias("silence")).where(F.col("silence") >= seconds)


def throttled_updates(items: DataFrame) -> DataFrame:
    """Of each unit's items (key, item from 1 on, total) those that report: every k-th and the last, with k the hundredth part of the
    total between 1 and 250."""
    every = F.greatest(F.lit(1).cast("long"), F.least(F.floor(F.col("total") / 100), F.lit(250).cast("long")))
    return items.where((F.col("item") % every == 0) | (F.col("item") == F.col("total")))


def progress_lines(state: DataFrame) -> DataFrame:
    """(key, percent, eta, elapsed_text) from (key, done, total, elapsed)."""
    left = F.floor(remaining_seconds(F.col("done"), F.col("total"), F.col("elapsed")))
    return state.select(
        "key", F.floor(fraction_done(F.col("done"), F.col("total")) * 100).cast("int").alias("percent"), format_duration(left).alias("eta"), format_duration(F.col("elapsed")).alias("elapsed_text")
    )


def epoch_merge(messages: DataFrame) -> DataFrame:
    """(epoch, name, value): the newest value of each metric and epoch over the phases' messages (seq, epoch, name, value)."""
    return messages.groupBy("epoch", "name").agg(F.max_by("value", "seq").alias("value"))
