"""Which apps are installed, over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def app_changes(lists: DataFrame, installs: DataFrame, removals: DataFrame) -> DataFrame:
    """userId, time, app, present: what each list, install and removal says of an app."""
    listed = lists.select("userId", "time", F.explode(F.array_distinct("installedApps")).alias("app"), F.lit(True).alias("present"))
    put = installs.select("userId", "time", F.col("packageName").alias("app"), F.lit(True).alias("present"))
    gone = removals.select("userId", "time", F.col("packageName").alias("app"), F.lit(False).alias("present"))
    return listed.unionByName(put).unionByName(gone)


def installed_apps(changes: DataFrame, usage_days: DataFrame) -> DataFrame:
    """userId, time, apps (sorted): the state at time 0 (none), at each change, and at each day of use.

    An app is there if the last word on it was an install; at equal times a removal wins. Its stay is an interval from install
    to removal, so a state joins the few stays of its user that hold it and no user's history is folded in one row.
    """
    word = changes.groupBy("userId", "app", "time").agg(F.min("present").alias("present"))
    w = Window.partitionBy("userId", "app").orderBy("time")
    turns = word.withColumn("_was", F.lag("present").over(w)).filter(F.col("_was").isNull() | (F.col("_was") != F.col("present")))
    stays = turns.withColumn("until", F.lead("time").over(w)).filter("present").select("userId", "app", F.col("time").alias("since"), "until")
    moments = changes.select("userId", "time").unionByName(usage_days.select("userId", "time"))
    moments = moments.unionByName(moments.select("userId", F.lit(0).cast("long").alias("time"))).distinct()
    held = moments.join(stays, "userId").filter((F.col("time") > 0) & (F.col("since") <= F.col("time")) & (F.col("until").isNull() | (F.col("until") > F.col("time"))))
    lists = held.groupBy("userId", "time").agg(F.array_sort(F.collect_set("app")).alias("apps"))
    return moments.join(lists, ["userId", "time"], "left").withColumn("apps", F.coalesce("apps", F.array().cast("array<string>")))


def dictionary(apps: DataFrame) -> DataFrame:
    """index, app: distinct apps in order, from 0."""
    return apps.select("app").filter("app is not null").distinct().select((F.row_number().over(Window.orderBy("app")) - 1).cast("long").alias("index"), "app")


def encoded(states: DataFrame, words: DataFrame) -> DataFrame:
    """userId, time, indexes (sorted): the installed apps by their numbers in the dictionary."""
    rows = states.select("userId", "time", F.explode_outer("apps").alias("app")).join(words, "app", "left")
    return rows.groupBy("userId", "time").agg(F.array_sort(F.collect_list("index")).alias("indexes"))
