"""Aggregates kept up to date from deltas: a new dump changes the partitions that its events fall into, and no others.

The table lies by metric, level and year (of 365 days from the epoch, as the yearly level has it). Counts and sums add up;
distinct keys are counted anew from the merged counts by key of the same buckets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import ENTRY
from tidemark.schema import SPECS, YEARLY
from tidemark.session import scratch
from tidemark.sources.tables import PARTS, exists, level_of, remove, write_aggregates, write_table

#: Metrics of distinct keys, and the counts by key that they follow from.
DISTINCT = {s.distinct: s.count for s in SPECS if s.distinct}


def _touched(delta: DataFrame) -> DataFrame:
    """The partitions of a delta, those of distinct metrics with those of their counts: a few rows, counted by what a delta spans."""
    own = delta.select("metric", "level", "year").distinct()
    of = F.create_map(*[F.lit(x) for pair in DISTINCT.items() for x in pair])
    return own.unionByName(own.filter(F.col("metric").isin(list(DISTINCT))).withColumn("metric", of[F.col("metric")])).distinct()


def merge_aggregates(delta: DataFrame, base: str) -> None:
    """Add the aggregates of new events (as aggregates.suite gives them) to the table in `base`, late ones too.

    The merged partitions are written beside the table first, then they replace the old ones; others keep their files. Without a table the
    delta becomes it. A run that ends in between leaves the old table, or may be repeated from the written partitions' folder.
    """
    spark = delta.sparkSession
    if not exists(spark, f"{base}/aggregates"):
        write_aggregates(delta, base)
        return
    folder = scratch(spark, "merge")
    try:
        write_table(delta.withColumns({"level": level_of(F.col("granularity")), "year": F.floor(F.col("time") / YEARLY.millis).cast("int")}), f"{folder}/delta")
        fresh = spark.read.parquet(f"{folder}/delta")
        parts = _touched(fresh).collect()  # metrics x levels x years of the delta
        if not parts:
            return
        pruned = reduce(lambda a, b: a | b, [(F.col("metric") == r.metric) & (F.col("level") == r.level) & (F.col("year") == r.year) for r in parts])
        write_table(_merged(spark.read.parquet(f"{base}/aggregates").filter(pruned), fresh), f"{folder}/merged")
        merged = spark.read.parquet(f"{folder}/merged").hint("rebalance", *PARTS)
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PARTS).parquet(f"{base}/aggregates")
    finally:
        remove(spark, folder)


def _merged(old: DataFrame, delta: DataFrame) -> DataFrame:
    keys = ["metric", "level", "year", *ENTRY[:4]]
    rows = old.select(*keys, "value").unionByName(delta.select(*keys, "value"))
    sums = rows.filter(~F.col("metric").isin(list(DISTINCT))).groupBy(*keys).agg(F.sum("value").alias("value"))
    named = F.create_map(*[F.lit(x) for d, c in DISTINCT.items() for x in (c, d)])
    counted = sums.filter(F.col("metric").isin(list(DISTINCT.values())))
    counts = counted.groupBy(named[F.col("metric")].alias("metric"), "level", "year", *ENTRY[:3]).agg(F.count("key").alias("value")).withColumn("key", F.lit("key"))
    return sums.unionByName(counts.select(*sums.columns))


def read_all(spark: SparkSession, base: str) -> DataFrame:
    """The aggregates as aggregates.suite gives them."""
    return spark.read.parquet(f"{base}/aggregates").select(*ENTRY, "metric")
