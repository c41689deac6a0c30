"""Progress state over a stream of messages (seq, key, kind, count, ts). The batch forms are in operators/progress.py; over the same
messages both give the same rows, since the state of a key is monotone in seq and lost messages only delay it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.progress import latest_counts
from ..runtime import ship


def latest_counts_stream(messages: DataFrame) -> DataFrame:
    """(key, latest, done) kept up to date; write in update or complete mode."""
    return latest_counts(messages)


def epoch_merge_stream(messages: DataFrame) -> DataFrame:
    return messages.groupBy("epoch", "name").agg(F.max_by("value", "seq").alias("value"))


def filtered_lines(lines: DataFrame, marker: str) -> DataFrame:
    """A stateless filter of complete lines."""
    return lines.where(~F.col("value").contains(marker))


def windowed_counts(messages: DataFrame, width: str = "10 minutes", late: str = "30 minutes") -> DataFrame:
    """Messages a key and event-time window; later than the watermark they are dropped."""
    timed = messages.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy("key", F.window("ts", width).alias("w")).agg(F.count("*").alias("n")).select("key", F.col("w.start").alias("start"), "n")


def stalls_stream(messages: DataFrame, seconds: float, late: str = "0 seconds") -> DataFrame:
    """(key, since, silence) when a key's next message comes after `seconds` or more, and once with a null silence when event time passes
    that bound with no message; a key re-arms with its next message."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        empty = pd.DataFrame({"key": pd.Series(dtype="int64"), "since": pd.Series(dtype="datetime64[ns]"), "silence": pd.Series(dtype="float64")})
        if state.hasTimedOut:
            (last, warned) = state.get
            state.update((last, True))
            yield empty if warned else pd.DataFrame({"key": [key[0]], "since": [pd.Timestamp(last, unit="us")], "silence": [None]})
            return
        times = sorted(t for b in batches for t in (b["us"].tolist()))
        last, _ = state.get if state.exists else (None, False)
        found = []
        for t in times:
            if last is not None and t - last >= seconds * 1e6:
                found.append((key[0], pd.Timestamp(last, unit="us"), (t - last) / 1e6))
            last = t if last is None else max(last, t)
        state.update((last, False))
        watermark = state.getCurrentWatermarkMs()
        state.setTimeoutTimestamp(max(int(last // 1000 + seconds * 1000), watermark + 1))
        yield pd.DataFrame(found, columns=["key", "since", "silence"]) if found else empty

    ship(messages.sparkSession)
    timed = messages.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).select("key", "ts", F.unix_micros("ts").alias("us"))
    return timed.groupBy("key").applyInPandasWithState(
        step, "key long, since timestamp, silence double", "last long, warned boolean", "append", GroupStateTimeout.EventTimeTimeout
    )


def run_to_memory(stream: DataFrame, name: str, mode: str = "complete", each: Callable | None = None):
    """Runs a stream over all input that is there now, into an in-memory table or through `each` a batch."""
    writer = stream.writeStream.outputMode(mode).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("memory").queryName(name).start()
    query.awaitTermination()
    return query
