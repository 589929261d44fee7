"""Time buckets as column expressions: floors, ceilings and interval splitting. Times are epoch ms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import DAILY, DAY, FIFTEEN_MIN, FIVE_MIN, HOURLY, MONTHLY, WEEKLY, YEARLY, Granularity

_UNITS = {HOURLY: "hour", DAILY: "day", WEEKLY: "week", MONTHLY: "month", YEARLY: "year"}
_STEPS = {HOURLY: "INTERVAL 1 HOUR", DAILY: "INTERVAL 1 DAY", WEEKLY: "INTERVAL 7 DAYS", MONTHLY: "INTERVAL 1 MONTH", YEARLY: "INTERVAL 1 YEAR", FIVE_MIN: "INTERVAL 5 MINUTES", FIFTEEN_MIN: "INTERVAL 15 MINUTES"}


def floor_epoch(t: Column, g: Granularity) -> Column:
    """Start of the bucket, counted from the epoch; the remainder has the sign of t."""
    return t - t % F.lit(g.millis)


def ceil_epoch(t: Column, g: Granularity) -> Column:
    """One bucket after the floor, for boundaries too."""
    return floor_epoch(t, g) + F.lit(g.millis)


def _calendar(t: Column, g: Granularity, zone: str) -> Column:
    """Local start of the calendar bucket, as a timestamp of the zone's wall clock."""
    local = F.from_utc_timestamp(F.timestamp_millis(t), zone)
    if g in (FIVE_MIN, FIFTEEN_MIN):
        n = g.millis // 60_000
        into = F.minute(local) - F.minute(local) % n
        return F.timestamp_millis(F.unix_millis(F.date_trunc("hour", local)) + into.cast("long") * 60_000)
    return F.date_trunc(_UNITS[g], local)


def floor_calendar(t: Column, g: Granularity, zone: str = "UTC") -> Column:
    """Start of the calendar bucket in a zone (weeks begin on Monday). The session's zone must be UTC."""
    return F.unix_millis(F.to_utc_timestamp(_calendar(t, g, zone), zone))


def ceil_calendar(t: Column, g: Granularity, zone: str = "UTC") -> Column:
    """Start of the next calendar bucket."""
    return F.unix_millis(F.to_utc_timestamp(_calendar(t, g, zone) + F.expr(_STEPS[g]), zone))


def floor_bucket(t: Column, g: Granularity, buckets: str = "epoch") -> Column:
    return floor_epoch(t, g) if buckets == "epoch" else floor_calendar(t, g)


def bucket_starts(start: Column, duration: Column, g: Granularity) -> Column:
    """All epoch buckets from that of the start to that of the end; the first only for a negative duration.

    An interval that ends on a boundary reaches into the bucket that begins there, with length 0.
    """
    first, last = floor_epoch(start, g), floor_epoch(start + duration, g)
    return F.when(duration < 0, F.array(first)).otherwise(F.sequence(first, F.greatest(first, last), F.lit(g.millis)))


def split_intervals(df: DataFrame, g: Granularity, start: str = "time", duration: str = "duration") -> DataFrame:
    """A row for each bucket an interval touches: columns `bucket`, and `start` and `duration` cut to it."""
    s, d = F.col(start), F.col(duration)
    out = df.withColumn("bucket", F.explode(bucket_starts(s, d, g)))
    left = F.greatest(s, F.col("bucket"))
    cut = F.when(d < 0, d).otherwise(F.least(s + d, F.col("bucket") + g.millis) - left)
    return out.withColumns({duration: cut, start: left})


def split_levels(df: DataFrame, levels: tuple[Granularity, ...]) -> DataFrame:
    """split_intervals at several levels in one pass over the rows of (time, duration): `granularity` is the level's code."""

    def touched(g: Granularity) -> Column:
        return F.transform(bucket_starts(F.col("time"), F.col("duration"), g), lambda b: F.struct(b.alias("bucket"), F.lit(g.code).alias("granularity"), F.lit(g.millis).alias("width")))

    out = df.select("*", F.inline(F.flatten(F.array(*map(touched, levels)))))
    left = F.greatest("time", "bucket")
    cut = F.when(F.col("duration") < 0, F.col("duration")).otherwise(F.least(F.col("time") + F.col("duration"), F.col("bucket") + F.col("width")) - left)
    return out.withColumns({"duration": cut, "time": left}).drop("width")


def day_start(t: Column) -> Column:
    return floor_epoch(t, DAILY)


def next_day_start(t: Column) -> Column:
    return ceil_epoch(t, DAILY)


def end_of_day(t: Column) -> Column:
    """The last millisecond of the day."""
    return ceil_epoch(t, DAILY) - 1


def days_between(a: Column, b: Column) -> Column:
    """Whole days from a to b, rounded towards zero."""
    return (((b - a) - (b - a) % F.lit(DAY)) / F.lit(DAY)).cast("long")


def time_of_day(t: Column) -> Column:
    return t % F.lit(DAY)
