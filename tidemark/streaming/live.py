"""The same aggregates over a stream of events, with late rows bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timebuckets import split_intervals
from tidemark.schema import Granularity


def live_metrics(events: DataFrame, g: Granularity, lateness: str = "1 hour") -> DataFrame:
    """Counts and sums for each user, epoch bucket and key of a stream of userId, time, duration, key.

    An event that crosses buckets is cut as in batch. A bucket's row is final once the watermark has passed its end; the state
    holds the open buckets only. In append mode each row comes once.
    """
    pieces = split_intervals(events, g).withColumn("at", F.timestamp_millis("bucket")).withWatermark("at", lateness)
    length = f"{g.millis} milliseconds"
    grouped = pieces.groupBy("userId", F.window("at", length), "key").agg(F.count("*").alias("count"), F.sum("duration").alias("duration"))
    return grouped.select("userId", F.unix_millis("window.start").alias("time"), F.lit(g.code).cast("long").alias("granularity"), "key", "count", "duration")


def live_app_use(events: DataFrame, gap: str = "10 seconds", lateness: str = "1 hour") -> DataFrame:
    """Uninterrupted use of each user: sessions of events with pauses under `gap`, from a stream of userId, time, duration."""
    rows = events.withColumn("at", F.timestamp_millis("time")).withWatermark("at", lateness)
    used = rows.groupBy("userId", F.session_window("at", gap)).agg(F.count("*").alias("events"), F.sum("duration").alias("duration"))
    return used.select("userId", F.unix_millis("session_window.start").alias("time"), F.unix_millis("session_window.end").alias("end"), "events", "duration")
