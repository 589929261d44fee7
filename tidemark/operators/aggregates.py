"""Counts, sums and distinct keys for each user, time bucket and key, and their roll-ups.

Entries are rows of userId, time (bucket start), granularity (code), key, value.
Input events are rows of userId, time, duration, key, value; see `events_kv`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timebuckets import floor_bucket, floor_epoch, split_intervals
from tidemark.schema import DAILY, FOREST, MONTHLY, WEEKLY, YEARLY, Granularity, MetricSpec

#: Any function from events and a granularity to entries can stand for these.
Aggregator = Callable[[DataFrame, Granularity], DataFrame]
ENTRY = ("userId", "time", "granularity", "key", "value")


def events_kv(events: DataFrame, spec: MetricSpec) -> DataFrame:
    """An event table as userId, time, duration (0 where nothing is split), key, value."""
    start = F.col(spec.start) if spec.start else F.col("time")
    value = F.col(spec.value).cast("long") if spec.value else F.lit(0).cast("long")
    duration = value if spec.start else F.lit(0).cast("long")
    return events.select("userId", start.alias("time"), duration.alias("duration"), F.expr(spec.key).alias("key"), value.alias("value"), F.lit(bool(spec.start)).alias("splits"))


def fragments(events: DataFrame, g: Granularity) -> DataFrame:
    """Events cut at bucket borders; the value of a cut event is the length of its piece."""
    out = split_intervals(events, g)
    return out.withColumn("value", F.when(F.col("splits"), F.col("duration")).otherwise(F.col("value"))) if "splits" in events.columns else out.withColumn("value", F.col("duration"))


def _entries(grouped: DataFrame, g: Granularity, key: Column, value: Column) -> DataFrame:
    return grouped.select("userId", F.col("bucket").alias("time"), F.lit(g.code).cast("long").alias("granularity"), key.alias("key"), value.cast("long").alias("value"))


def count_events(events: DataFrame, g: Granularity) -> DataFrame:
    """Pieces of events: one that crosses k borders counts k + 1 times."""
    return _entries(fragments(events, g).groupBy("userId", "bucket", "key").agg(F.count("*").alias("v")), g, F.col("key"), F.col("v"))


def sum_events(events: DataFrame, g: Granularity) -> DataFrame:
    return _entries(fragments(events, g).groupBy("userId", "bucket", "key").agg(F.sum("value").alias("v")), g, F.col("key"), F.col("v"))


def count_keys(events: DataFrame, g: Granularity) -> DataFrame:
    """Distinct keys; the key of the entry is the word `key`."""
    return _entries(fragments(events, g).groupBy("userId", "bucket").agg(F.countDistinct("key").alias("v")), g, F.lit("key"), F.col("v"))


def roll_up(entries: DataFrame, g: Granularity, *, sub: Granularity | None = None, buckets: str = "epoch") -> DataFrame:
    """Sums of finer entries (of `sub`, if given) in epoch or calendar buckets."""
    finer = entries if sub is None else entries.filter(F.col("granularity") == sub.code)
    grouped = finer.withColumn("bucket", floor_bucket(F.col("time"), g, buckets)).groupBy("userId", "bucket", "key").agg(F.sum("value").alias("v"))
    return _entries(grouped, g, F.col("key"), F.col("v"))


def all_levels(events: DataFrame, aggregator: Aggregator, *, additive: bool, buckets: str = "epoch") -> DataFrame:
    """Daily, weekly, monthly and yearly entries: additive metrics from the daily ones, others from the events."""
    daily = aggregator(events, DAILY)
    rest = (WEEKLY, MONTHLY, YEARLY)
    coarser = [roll_up(daily, g, buckets=buckets) for g in rest] if additive else [aggregator(events, g) for g in rest]
    return reduce(DataFrame.unionByName, coarser, daily)


def metrics(events: DataFrame, levels: Granularity | tuple[Granularity, ...], spec: MetricSpec) -> DataFrame:
    """All metrics of a spec at one or more granularities, with a column `metric`.

    One scan cuts each event for all levels; one shuffle by user, level, bucket and key gives counts and sums; distinct keys
    count its groups.
    """
    levels = (levels,) if isinstance(levels, Granularity) else levels
    level = F.explode(F.array(*[F.struct(F.lit(g.code).cast("long").alias("code"), F.lit(g.millis).cast("long").alias("millis")) for g in levels]))
    t, d, size = F.col("time"), F.col("duration"), F.col("level.millis")
    first, last = t - t % size, (t + d) - (t + d) % size
    starts = F.when(d < 0, F.array(first)).otherwise(F.sequence(first, F.greatest(first, last), size))
    cut = events.withColumn("level", level).withColumn("bucket", F.explode(starts))
    piece = F.when(d < 0, d).otherwise(F.least(t + d, F.col("bucket") + size) - F.greatest(t, F.col("bucket")))
    value = F.when(F.col("splits"), piece).otherwise(F.col("value"))
    cut = cut.select("userId", F.col("bucket").alias("time"), F.col("level.code").alias("granularity"), "key", value.alias("value"))
    by_key = cut.groupBy(*ENTRY[:4]).agg(F.count("*").alias("c"), F.sum("value").alias("s"))
    named = [(name, column) for name, column in ((spec.count, "c"), (spec.total, "s")) if name]
    pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), F.col(column).cast("long").alias("value")) for name, column in named]))
    out = by_key.select(*ENTRY[:4], pairs.alias("m")).select(*ENTRY[:4], "m.value", "m.metric")
    if spec.distinct:
        keys = by_key.groupBy(*ENTRY[:3]).agg(F.count("key").alias("value"))
        out = out.unionByName(keys.select(*ENTRY[:3], F.lit("key").alias("key"), "value", F.lit(spec.distinct).alias("metric")))
    return out


def suite(tables: dict[str, DataFrame], specs: tuple[MetricSpec, ...], levels: tuple[Granularity, ...]) -> DataFrame:
    """The metrics of all specs whose table is given, at all levels, straight from the events; each table is read once."""
    parts = [metrics(events_kv(tables[s.event], s), levels, s) for s in specs if s.event in tables]
    return reduce(DataFrame.unionByName, parts)


def walk(events: DataFrame, aggregator: Aggregator, buckets: str = "calendar") -> DataFrame:
    """Entries over the forest of granularities: roots from the events, each other level from its parent."""
    parts: list[DataFrame] = []

    def visit(node: tuple, parent: DataFrame | None, parent_level: Granularity | None) -> None:
        g, children = node
        own = aggregator(events, g) if parent is None else roll_up(parent, g, sub=parent_level, buckets=buckets)
        parts.append(own)
        for child in children:
            visit(child, own, g)

    for root in FOREST:
        visit(root, None, None)
    return reduce(DataFrame.unionByName, parts)


def event_maps(events: DataFrame, g: Granularity) -> DataFrame:
    """For each user and epoch bucket a map from keys to sums and one from keys to counts, in order of keys."""
    by_key = events.withColumn("bucket", floor_epoch(F.col("time"), g)).groupBy("userId", "bucket", "key").agg(F.sum("value").alias("v"), F.count("*").alias("c"))
    rows = by_key.groupBy("userId", F.col("bucket").alias("time")).agg(F.array_sort(F.collect_list(F.struct("key", "v", "c"))).alias("rows"))
    return rows.select(
        "userId",
        "time",
        F.map_from_entries(F.transform("rows", lambda r: F.struct(r["key"], r["v"]))).alias("sums"),
        F.map_from_entries(F.transform("rows", lambda r: F.struct(r["key"], r["c"]))).alias("counts"),
    )
