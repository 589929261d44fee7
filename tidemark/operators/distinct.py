"""Exact distinct counts that roll up: each user's keys are numbered, each day keeps a bitmap of numbers, coarser buckets unite bitmaps.

Coarser levels and later additions read the days' bitmaps (a few KB each before compression) and no events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timebuckets import floor_bucket
from tidemark.operators.aggregates import ENTRY, fragments
from tidemark.schema import DAILY, Granularity


def key_days(events: DataFrame) -> DataFrame:
    """userId, time (day), key: every key of every day that a piece of an event lies in. Null keys count nowhere."""
    return fragments(events, DAILY).filter("key is not null").select("userId", F.col("bucket").alias("time"), "key").distinct()


def number_keys(days: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """userId, key, number (from 1): a user's keys in their order; with `known` numbers those stay and new keys follow the user's last."""
    keys = days.select("userId", "key").distinct()
    w = Window.partitionBy("userId").orderBy("key")
    if known is None:
        return keys.withColumn("number", F.row_number().over(w).cast("long"))
    same = F.col("userId").eqNullSafe(F.col("_user"))
    fresh = keys.join(known.select(F.col("userId").alias("_user"), F.col("key").alias("_key")), same & (F.col("key") == F.col("_key")), "left_anti")
    last = known.groupBy(F.col("userId").alias("_user")).agg(F.max("number").alias("last"))
    fresh = fresh.join(last, same, "left").select("userId", "key", (F.row_number().over(w) + F.coalesce("last", F.lit(0))).cast("long").alias("number"))
    return known.select("userId", "key", "number").unionByName(fresh)


def daily_bitmaps(days: DataFrame, numbers: DataFrame) -> DataFrame:
    """userId, time (day), part, keys: the day's numbers as bitmaps of 32768 each."""
    named = numbers.select(F.col("userId").alias("_user"), F.col("key").alias("_key"), "number")
    rows = days.join(named, F.col("userId").eqNullSafe(F.col("_user")) & (F.col("key") == F.col("_key")))
    part = F.bitmap_bucket_number("number").alias("part")
    return rows.groupBy("userId", "time", part).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("keys"))


def unite(*bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of the same days in one, whichever table they come from."""
    out = bitmaps[0]
    for more in bitmaps[1:]:
        out = out.unionByName(more)
    return out.groupBy("userId", "time", "part").agg(F.bitmap_or_agg("keys").alias("keys"))


def distinct_keys(bitmaps: DataFrame, g: Granularity, buckets: str = "epoch") -> DataFrame:
    """Entries of the number of distinct keys in days or coarser buckets; the key of the entry is the word `key`."""
    united = bitmaps.withColumn("time", floor_bucket(F.col("time"), g, buckets)).groupBy("userId", "time", "part").agg(F.bitmap_count(F.bitmap_or_agg("keys")).alias("n"))
    return united.groupBy("userId", "time").agg(F.sum("n").alias("value")).select("userId", "time", F.lit(g.code).cast("long").alias("granularity"), F.lit("key").alias("key"), "value").select(*ENTRY)
