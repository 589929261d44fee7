"""Entries by category of their key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timebuckets import split_intervals
from tidemark.schema import Granularity


def by_category(entries: DataFrame, categories: DataFrame) -> DataFrame:
    """Sums by category of the key; keys without one are dropped.

    The lookup's size decides the join: adaptive execution broadcasts it if it is small.
    """
    joined = entries.join(categories.select("key", "category"), "key")
    return _summed(joined, F.col("category"))


def by_category_or_unknown(entries: DataFrame, categories: DataFrame) -> DataFrame:
    """As by_category, but keys without a category count as `unknown`."""
    joined = entries.join(categories.select("key", "category"), "key", "left")
    return _summed(joined, F.coalesce("category", F.lit("unknown")))


def _summed(joined: DataFrame, category: Column) -> DataFrame:
    out = joined.drop("key").withColumn("key", category).groupBy("userId", "time", "granularity", "key")
    return out.agg(F.sum("value").alias("value")).select("userId", "time", "granularity", "key", "value")


def distinct_by_category(events: DataFrame, categories: DataFrame, g: Granularity) -> DataFrame:
    """Distinct keys of events in each category, user and bucket."""
    keys = split_intervals(events, g).select("userId", F.col("bucket").alias("time"), "key").distinct()
    grouped = keys.join(categories.select("key", "category"), "key").groupBy("userId", "time", "category").agg(F.count("*").alias("value"))
    return grouped.select("userId", "time", F.lit(g.code).cast("long").alias("granularity"), F.col("category").alias("key"), "value")
