"""Wide rows for each user, bucket and granularity from the long table of metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timebuckets import floor_bucket
from tidemark.schema import SUMMARY, Granularity

KEYS = ("userId", "time", "granularity")
COLUMNS = tuple(name for name, _, _ in SUMMARY)


def _wide(entries: DataFrame) -> DataFrame:
    """Sums first by metric and key, so that distinct keys are counted over few rows."""
    inputs = sorted({m for _, _, ms in SUMMARY for m in ms})
    by_key = entries.filter(F.col("metric").isin(inputs)).groupBy(*KEYS, "key").agg(*[F.sum(F.when(F.col("metric") == m, F.col("value"))).alias(f"_{m}") for m in inputs])
    columns = []
    for name, operation, metrics in SUMMARY:
        own = [F.col(f"_{m}") for m in metrics]
        if operation == "sum":
            total = F.coalesce(F.sum(own[0]), F.lit(0))
            for c in own[1:]:
                total = total + F.coalesce(F.sum(c), F.lit(0))
            columns.append(total.alias(name))
        else:
            some = own[0].isNotNull()
            for c in own[1:]:
                some = some | c.isNotNull()
            columns.append(F.count_if(some & F.col("key").isNotNull()).alias(name))
    return by_key.groupBy(*KEYS).agg(*columns)


def summarise(entries: DataFrame) -> DataFrame:
    """A row wherever some input metric has one; missing metrics are 0. entries: metric and the entry columns."""
    return _wide(entries).select(*KEYS, *COLUMNS)


def roll_up_summary(summary: DataFrame, g: Granularity, buckets: str = "calendar") -> DataFrame:
    """Column sums in coarser buckets; distinct counts are summed too, so keys of several buckets count again."""
    out = summary.withColumn("time", floor_bucket(F.col("time"), g, buckets)).groupBy("userId", "time").agg(*[F.sum(c).alias(c) for c in COLUMNS])
    return out.select("userId", "time", F.lit(g.code).cast("long").alias("granularity"), *COLUMNS)


def summarise_at(entries: DataFrame, g: Granularity, buckets: str = "calendar") -> DataFrame:
    """The summary in coarser buckets with distinct keys counted anew."""
    moved = entries.withColumn("time", floor_bucket(F.col("time"), g, buckets)).withColumn("granularity", F.lit(g.code).cast("long"))
    return summarise(moved)
