"""Documents for topic models: app use of a session, day, place or cluster as lists of (app, value)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timebuckets import day_start, days_between, next_day_start


@dataclass(frozen=True)
class Template:
    """Where a document's rows come from, and what its time and cluster are."""

    source: str
    time: str
    cluster: str


#: A source of `clusters` is the table of the wanted number of breaks.
TEMPLATES = {
    "phone_session": Template("phone", "sessionStart", "0"),
    "day": Template("phone", "time - time % 86400000", "0"),
    "location_session": Template("locations", "locationChangeTime", "cast(locationCluster as int)"),
    "location": Template("locations", "0", "cast(locationCluster as int)"),
    "activity_cluster": Template("clusters", "clusterStartTime", "lastInactivitySessionRank"),
    "cluster_rank": Template("clusters", "0", "lastInactivitySessionRank"),
    "user": Template("phone", "0", "0"),
}


def user_days(users: DataFrame, sessions: DataFrame) -> DataFrame:
    """userId, startTime, endTime, days for each wanted user (`user`): from the day after the first session to the last's day.

    A null user matches sessions without one.
    """
    span = sessions.groupBy("userId").agg(next_day_start(F.min("time")).alias("startTime"), day_start(F.max("time")).alias("endTime"))
    out = span.join(users.select("user").distinct(), F.col("userId").eqNullSafe(F.col("user"))).drop("user")
    return out.withColumn("days", days_between(F.col("startTime"), F.col("endTime")))


def in_study(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of a user within the user's start and end."""
    bounds = days.select("userId", "startTime", "endTime")
    return rows.join(bounds, "userId").filter("time >= startTime and time < endTime").drop("startTime", "endTime")


def documents(rows: DataFrame, words: DataFrame, template: str, aggregate: str) -> DataFrame:
    """id, userId, documentTime, documentClusterType, document (array of key and value, by key).

    aggregate: COUNT or SUM of durations. Apps outside the dictionary are left out. Ids follow user, time and cluster, from 0.
    """
    t = TEMPLATES[template]
    measure = {"COUNT": F.count("duration"), "SUM": F.sum("duration")}[aggregate].cast("long")
    keyed = rows.join(words, "app").select("userId", F.expr(t.time).cast("long").alias("documentTime"), F.expr(t.cluster).cast("int").alias("documentClusterType"), F.col("index").cast("int").alias("key"), "duration")
    values = keyed.groupBy("userId", "documentTime", "documentClusterType", "key").agg(measure.alias("value"))
    whole = values.groupBy("userId", "documentTime", "documentClusterType").agg(F.array_sort(F.collect_list(F.struct("key", "value"))).alias("document"))
    return with_ids(whole, ["userId", "documentTime", "documentClusterType"])


def with_ids(df: DataFrame, order: list[str], block: int = 1 << 16) -> DataFrame:
    """df with a first column `id`: its place in the order, from 0. The order begins with a whole number, as a user's.

    Places add up from counts: of blocks of numbers (one row each in a window without partitions), of
    numbers in a block, and of rows of a number.
    """
    head = order[0]
    key = F.floor(F.col(head) / block)
    sizes = df.groupBy(head).agg(F.count("*").alias("_n")).withColumn("_block", key)
    whole = sizes.groupBy("_block").agg(F.sum("_n").alias("_n"))
    past = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    whole = whole.select(F.col("_block").alias("_b"), past(Window.orderBy("_block")).alias("_blocks_before"))
    starts = sizes.withColumn("_before", past(Window.partitionBy("_block").orderBy(head)))
    starts = starts.join(whole, F.col("_block").eqNullSafe(F.col("_b"))).select(F.col(head).alias("_head"), (F.col("_before") + F.col("_blocks_before")).alias("_start"))
    place = F.row_number().over(Window.partitionBy(head).orderBy(*order[1:]))
    out = df.withColumn("_place", place).join(starts, F.col(head).eqNullSafe(F.col("_head")))
    return out.select((F.col("_start") + F.col("_place") - 1).alias("id"), *df.columns)


def as_text(document: str = "document") -> Column:
    """[[key, value],[key, value]] as text."""
    return F.concat(F.lit("["), F.array_join(F.transform(document, lambda x: F.format_string("[%d, %d]", x["key"], x["value"])), ","), F.lit("]"))
