"""Streaming extras: incremental loads and windows over an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trisieve.sources.sinks import append_new


def load_incrementally(stream: DataFrame, path: str, key: str, checkpoint: str):
    """Starts a stream that appends only rows whose key is absent from the target; safe to restart."""

    def batch(df: DataFrame, _: int) -> None:
        append_new(df, path, key)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_within(stream: DataFrame, keys: list[str], time: str, delay: str = "10 minutes") -> DataFrame:
    """The first row of each key within the watermark's delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, by: list[str], length: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Rows and sum of `value` for each window and key; rows later than the delay are dropped by the stream."""
    return stream.withWatermark(time, delay).groupBy(F.window(time, length).alias("w"), *by).agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), *by, "events", "total")


def sessions(df: DataFrame, time: str, user: str, gap: str = "30 minutes") -> DataFrame:
    """(user, session_start, session_end, events) of runs of events without a longer gap."""
    return df.groupBy(user, F.session_window(time, gap).alias("s")).agg(F.count(F.lit(1)).alias("events")).select(user, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "events")
