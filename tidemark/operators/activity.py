"""Time without the phone, breaks, and the activity clusters between breaks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timebuckets import day_start, end_of_day, floor_epoch, split_levels
from tidemark.schema import DAILY, DAY, HOURLY, MINUTE, Granularity

INTERVALS = (0, 5, 10, 15, 20, 30, 60)  # minutes; fixed values


def positive_time(inactivity: DataFrame, *, levels: tuple[Granularity, ...] = (DAILY, HOURLY), intervals: tuple[int, ...] = INTERVALS, filter_start: int = 0) -> DataFrame:
    """userId, time, granularity, interval, millis, count for each bucket and interval (minutes).

    Pauses are cut at bucket borders; of each piece millis is what exceeds the interval and count how often the interval goes
    into it (null for interval 0). Pauses of over a day that begin before `filter_start` are left out.
    """
    rows = inactivity.filter(~((F.col("time") < filter_start) & (F.col("duration") > DAY)))
    pieces = split_levels(rows, levels)
    sums = []
    for i in intervals:
        sums.append(F.sum(F.greatest(F.lit(0).cast("long"), F.col("duration") - i * MINUTE)).alias(f"millis_{i}"))
        sums.append(F.sum(F.expr(f"duration div nullif({i * MINUTE}L, 0L)")).alias(f"count_{i}"))
    sums = pieces.groupBy("userId", "bucket", "granularity").agg(*sums)
    each = F.array(*[F.struct(F.lit(i).alias("interval"), F.col(f"millis_{i}").alias("millis"), F.col(f"count_{i}").alias("count")) for i in intervals])
    return sums.select("userId", F.col("bucket").alias("time"), "granularity", F.inline(each))


def positive_minutes(sessions: DataFrame, intervals: tuple[int, ...] = INTERVALS) -> DataFrame:
    """userId, day, interval, minutes (in ms): the older rule, from starts and stops of app sessions.

    A session is split at one midnight only. In each day, ordered by time, the first row and starts right after
    it are skipped; each later start that follows a stop adds its gap less the interval. Days
    without a gap give no rows. Equal times: stops first, then by id.
    """
    end = F.col("time") + F.col("duration")
    midnight = end_of_day(F.col("time"))
    change = lambda t, start: F.struct(t.alias("at"), F.lit(start).alias("start"))
    two = F.array(change(F.col("time"), 1), change(end, 0))
    four = F.array(change(F.col("time"), 1), change(midnight, 0), change(day_start(end), 1), change(end, 0))
    rows = sessions.select("userId", "id", F.explode(F.when(end > midnight, four).otherwise(two)).alias("c")).select("userId", "id", "c.*")
    rows = rows.withColumn("day", day_start(F.col("at")))
    w = Window.partitionBy("userId", "day").orderBy("at", "start", "id")
    rows = rows.withColumn("place", F.row_number().over(w)).withColumn("last", F.lag("at").over(w)).withColumn("last_start", F.lag("start").over(w))
    # the scan begins at the first stop after the first row; a start that follows a stop from there on has one before it
    begun = F.min(F.when((F.col("place") > 1) & (F.col("start") == 0), F.col("place"))).over(Window.partitionBy("userId", "day"))
    gaps = rows.withColumn("begun", begun).filter((F.col("start") == 1) & (F.col("last_start") == 0) & (F.col("place") > F.col("begun")))
    each = gaps.withColumn("interval", F.explode(F.array(*[F.lit(i) for i in intervals])))
    minutes = F.greatest(F.lit(0).cast("long"), F.col("at") - F.col("last") - F.col("interval").cast("long") * MINUTE)
    return each.groupBy("userId", "day", "interval").agg(F.sum(minutes).alias("minutes"))


def longest_breaks(inactivity: DataFrame, n: int = 2) -> DataFrame:
    """userId, time, duration, end, rank: the n longest pauses of each user and day of their end; ties to the earlier."""
    rows = inactivity.withColumn("end", F.col("time") + F.col("duration"))
    w = Window.partitionBy("userId", floor_epoch(F.col("end"), DAILY)).orderBy(F.col("duration").desc(), "time")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).select("userId", "time", "duration", "end", "rank")


def activity_clusters(pieces: DataFrame, inactivity: DataFrame, n: int = 2) -> DataFrame:
    """Pieces of phone sessions with the last break that began before them: userId, time, duration, app, clusterStartTime, lastInactivitySessionRank.

    clusterStartTime is the break's end. Before any break: the user's first time, rank 0. At equal times a piece comes first.
    """
    breaks = longest_breaks(inactivity, n).select("userId", "time", F.lit(None).cast("long").alias("duration"), F.lit(None).cast("string").alias("app"), F.lit(1).alias("side"), F.struct("end", "rank").alias("b"))
    rows = pieces.select("userId", "time", "duration", "app", F.lit(0).alias("side"), F.lit(None).cast("struct<end:bigint,rank:int>").alias("b"))
    w = Window.partitionBy("userId").orderBy("time", "side", F.col("b.end"), F.col("b.rank")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.unionByName(breaks).withColumn("last", F.last("b", ignorenulls=True).over(w)).withColumn("begin", F.min("time").over(w))
    return both.filter("side = 0").select(
        "userId", "time", "duration", "app", F.coalesce("last.end", "begin").alias("clusterStartTime"), F.coalesce("last.rank", F.lit(0)).alias("lastInactivitySessionRank")
    )
