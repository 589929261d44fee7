"""Positions: daily radius, path length, and the place of each app session."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.geo import haversine
from tidemark.functions.timebuckets import day_start

Distance = Callable[[Column, Column, Column, Column], Column]
UNKNOWN_PLACE = 999_999


def accurate(points: DataFrame) -> DataFrame:
    return points.filter("accuracy > 0")


def path_covered(points: DataFrame, distance: Distance = haversine) -> DataFrame:
    """userId, day, points, distance: the way from each accurate point of a day to the next, by time and id."""
    rows = accurate(points).withColumn("day", day_start(F.col("time")))
    w = Window.partitionBy("userId", "day").orderBy("time", "id")
    step = distance(F.lag("latitude").over(w), F.lag("longitude").over(w), F.col("latitude"), F.col("longitude"))
    return rows.withColumn("step", step).groupBy("userId", "day").agg(F.count("*").cast("int").alias("points"), F.coalesce(F.sum("step"), F.lit(0.0)).alias("distance"))


def daily_radius(points: DataFrame, distance: Distance = haversine) -> DataFrame:
    """userId, day, lat1, lng1, lat2, lng2, dist: the two furthest accurate points of each day (one point twice if it is alone).

    distance must obey the triangle inequality. Ties: the smaller point (latitude, then longitude) first, of either end. Equal points
    are one. With r the distances from the day's mean point, no pair is longer than the sum of its two; points that cannot reach
    the length of one known pair leave before points are paired.
    """
    rows = accurate(points).select("userId", day_start(F.col("time")).alias("day"), "latitude", "longitude").distinct()
    key = ["userId", "day"]
    mean = rows.groupBy(*key).agg(F.avg("latitude").alias("mlat"), F.avg("longitude").alias("mlng"))
    rows = rows.join(mean, key).withColumn("r", distance(F.col("mlat"), F.col("mlng"), F.col("latitude"), F.col("longitude")))
    far = rows.groupBy(*key).agg(F.max("r").alias("rmax"), F.max_by(F.struct("latitude", "longitude"), F.struct("r", "latitude", "longitude")).alias("f"))
    rows = rows.join(far, key)
    known = rows.groupBy(*key).agg(F.max(distance(F.col("f.latitude"), F.col("f.longitude"), F.col("latitude"), F.col("longitude"))).alias("known"))
    rows = rows.join(known, key).filter(F.col("r") + F.col("rmax") >= F.col("known") - 1e-6)
    a = rows.select(*key, F.col("latitude").alias("lat1"), F.col("longitude").alias("lng1"))
    b = rows.select(*key, F.col("latitude").alias("lat2"), F.col("longitude").alias("lng2"))
    pairs = a.join(b, key).filter(F.struct("lat1", "lng1") <= F.struct("lat2", "lng2"))
    pairs = pairs.withColumn("dist", distance(F.col("lat1"), F.col("lng1"), F.col("lat2"), F.col("lng2")))
    best = pairs.groupBy(*key).agg(F.min(F.struct((-F.round("dist", 9)).alias("o"), "lat1", "lng1", "lat2", "lng2", "dist")).alias("p"))
    return best.select(*key, "p.lat1", "p.lng1", "p.lat2", "p.lng2", "p.dist")


def located(points: DataFrame, clusters: DataFrame) -> DataFrame:
    """Points with a non-zero accuracy and the cluster of their id."""
    return points.filter("accuracy <> 0").join(clusters.select("id", "cluster"), "id")


def location_fragments(sessions: DataFrame, places: DataFrame) -> DataFrame:
    """App sessions with the last place before them: userId, locationChangeTime, locationCluster, time, duration, app.

    Every fix of a place sets the time anew, in the same place too. Before any: place 999999, time 0. A fix at a session's
    own time comes after it.
    """
    spot = F.struct(F.col("time").alias("at"), F.col("cluster").cast("int").cast("long").alias("cluster"))
    fixes = places.select("userId", "time", "id", F.lit(None).cast("long").alias("duration"), F.lit(None).cast("string").alias("app"), F.lit(1).alias("side"), spot.alias("p"))
    rows = sessions.select("userId", "time", F.lit(0).cast("long").alias("id"), "duration", "app", F.lit(0).alias("side"), F.lit(None).cast("struct<at:bigint,cluster:bigint>").alias("p"))
    w = Window.partitionBy("userId").orderBy("time", "side", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = rows.unionByName(fixes).withColumn("last", F.last("p", ignorenulls=True).over(w)).filter("side = 0")
    return both.select(
        "userId", F.coalesce("last.at", F.lit(0).cast("long")).alias("locationChangeTime"), F.coalesce("last.cluster", F.lit(UNKNOWN_PLACE).cast("long")).alias("locationCluster"), "time", "duration", "app"
    )
