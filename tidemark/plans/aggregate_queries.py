"""Queries of time buckets, aggregates, roll-ups, categories and summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timebuckets as tb
from tidemark.operators import aggregates as ag
from tidemark.operators import categories as cat
from tidemark.operators import distinct
from tidemark.operators import summary as sm
from tidemark.plans import adapter as ad
from tidemark.plans.registry import query
from tidemark.schema import DAILY, FIVE_MIN, GRANULARITIES, HOURLY, MONTHLY, SPECS, SUMMARY, WEEKLY, YEARLY, Granularity
from tidemark.session import scratch
from tidemark.sources import increments

_UNIT = {"Hourly": "hour", "Daily": "day", "Weekly": "week", "Monthly": "month", "Yearly": "year"}


def split_sql(source: str, d: int) -> str:
    """Pieces of the intervals of a source: its columns, b (bucket) and piece (length)."""
    return (
        f"select *, case when duration < 0 then duration else least(time + duration, b + {d}) - greatest(time, b) end as piece from "
        f"(select *, unnest(case when duration < 0 then [time - time % {d}] else range(time - time % {d}, time + duration - (time + duration) % {d} + 1, {d}) end) as b from {source})"
    )


def calendar_sql(t: str, g: Granularity) -> str:
    if g.name in _UNIT:
        return f"epoch_us(date_trunc('{_UNIT[g.name]}', make_timestamp({t} * 1000))) // 1000"
    return f"({t} - {t} % {g.millis})"


def _with(*ctes: str) -> str:
    return "with " + ", ".join(ctes) + " "


_BASE = _with(ad.EV, ad.KV)
_DAILY_SUMS = f"daily as (select userId, b as time, key, sum(piece)::bigint as value from ({split_sql('kv', DAILY.millis)}) group by all)"


@query(_BASE + f"select userId, b as time, 2::bigint as granularity, key, sum(piece)::bigint as value from ({split_sql('kv', DAILY.millis)}) group by userId, b, key")
def daily_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.sum_events(ad.events_kv(spark, sf_dir), DAILY)


def _levels(aggregate: str, key: str) -> str:
    group = "userId, b" + (", key" if key == "key" else "")
    return _BASE + " union all ".join(
        f"select userId, b as time, {g.code}::bigint as granularity, {key} as key, {aggregate}::bigint as value from ({split_sql('kv', g.millis)}) group by {group}" for g in GRANULARITIES
    )


def _each(spark: SparkSession, sf_dir: str, aggregator: ag.Aggregator) -> DataFrame:
    kv = ad.events_kv(spark, sf_dir)
    return reduce(DataFrame.unionByName, [aggregator(kv, g) for g in GRANULARITIES])


@query(_levels("count(*)", "key"))
def count_events_all_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _each(spark, sf_dir, ag.count_events)


@query(_levels("sum(piece)", "key"))
def sum_events_all_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _each(spark, sf_dir, ag.sum_events)


@query(_levels("count(distinct key)", "'key'"))
def distinct_keys_all_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _each(spark, sf_dir, ag.count_keys)


@query(
    _with(ad.EV, ad.KV, _DAILY_SUMS)
    + "select userId, time, 2::bigint as granularity, key, value from daily union all "
    + " union all ".join(f"select userId, time - time % {g.millis} as time, {g.code}::bigint as granularity, key, sum(value)::bigint as value from daily group by 1, 2, 3, 4" for g in (WEEKLY, MONTHLY, YEARLY))
)
def roll_up_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.all_levels(ad.events_kv(spark, sf_dir), ag.sum_events, additive=True)


@query(
    _BASE
    + " union all ".join(f"select userId, b as time, {g.code}::bigint as granularity, 'key' as key, count(distinct key)::bigint as value from ({split_sql('kv', g.millis)}) group by userId, b" for g in (DAILY, WEEKLY, MONTHLY, YEARLY))
)
def roll_up_non_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.all_levels(ad.events_kv(spark, sf_dir), ag.count_keys, additive=False)


_FORESTS = " union all ".join(
    f"select userId, b as time, {g.code}::bigint as granularity, key, sum(piece)::bigint as value from ({split_sql('kv', g.millis)}) group by userId, b, key" for g in GRANULARITIES[:3]
)


@query(
    _with(ad.EV, ad.KV, _DAILY_SUMS)
    + _FORESTS
    + " union all select userId, time, 2::bigint as granularity, key, value from daily union all "
    + " union all ".join(f"select userId, {calendar_sql('time', g)} as time, {g.code}::bigint as granularity, key, sum(value)::bigint as value from daily group by 1, 2, 3, 4" for g in (WEEKLY, MONTHLY, YEARLY))
)
def forest_walk_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.walk(ad.events_kv(spark, sf_dir), ag.sum_events)


def metric_entries_sql(levels: tuple[Granularity, ...]) -> str:
    parts = []
    for kind, r, key, value, splits, count, total, distinct in ad.PARTS:
        for g in levels:
            rows = f"select userId, time, {'duration' if splits else '0::bigint as duration'}, {key} as key, {value} as v from ev where kind = '{kind}' and id % {ad.parts(kind)} = {r}"
            source = split_sql(f"({rows})", g.millis)
            head = f"select userId, b as time, {g.code}::bigint as granularity"
            parts.append(f"{head}, key, count(*)::bigint as value, '{count}' as metric from ({source}) group by userId, b, key")
            if total:
                parts.append(f"{head}, key, sum({'piece' if splits else 'v'})::bigint as value, '{total}' as metric from ({source}) group by userId, b, key")
            if distinct:
                parts.append(f"{head}, 'key' as key, count(distinct key)::bigint as value, '{distinct}' as metric from ({source}) group by userId, b")
    return " union all ".join(parts)


@query(_with(ad.EV) + metric_entries_sql((HOURLY, DAILY)))
def metric_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.suite(ad.event_tables(spark, sf_dir), SPECS, (HOURLY, DAILY))


@query(_with(ad.EV) + metric_entries_sql(GRANULARITIES))
def metric_suite_all_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metric_suite at every level that the batch job writes."""
    return ag.suite(ad.event_tables(spark, sf_dir), SPECS, GRANULARITIES)


@query(_with(ad.EV) + metric_entries_sql((HOURLY, DAILY)))
def metrics_in_two_dumps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """metric_suite as a table on disk: half of the events first, then the other half merged into the partitions it touches."""
    base = scratch(spark, "increments")
    for half in (0, 1):
        found = {name: df.filter(F.pmod(F.xxhash64("time"), F.lit(2)) == half) for name, df in ad.event_tables(spark, sf_dir).items()}
        increments.merge_aggregates(ag.suite(found, SPECS, (HOURLY, DAILY)), base)
    return increments.read_all(spark, base)


@query(
    _BASE
    + " union all ".join(f"select userId, b as time, {g.code}::bigint as granularity, 'key' as key, count(distinct key)::bigint as value from ({split_sql('kv', g.millis)}) group by userId, b" for g in (DAILY, WEEKLY, MONTHLY, YEARLY))
)
def distinct_keys_from_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys of days, weeks, months and years from one scan: days' bitmaps on disk, united for each level."""
    days = distinct.key_days(ad.events_kv(spark, sf_dir))
    path = scratch(spark, "bitmaps")
    distinct.daily_bitmaps(days, distinct.number_keys(days)).write.parquet(path)
    bitmaps = spark.read.parquet(path)
    return reduce(DataFrame.unionByName, [distinct.distinct_keys(bitmaps, g) for g in (DAILY, WEEKLY, MONTHLY, YEARLY)])


@query(
    _BASE
    + f"select userId, time - time % {DAILY.millis} as time, cast(map_from_entries(list((key, s) order by key)) as varchar) as sums, cast(map_from_entries(list((key, c) order by key)) as varchar) as counts "
    + f"from (select userId, time - time % {DAILY.millis} as time, key, sum(duration)::bigint as s, count(*)::bigint as c from kv group by 1, 2, 3) group by userId, time"
)
def event_maps_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    maps = ag.event_maps(ad.events_kv(spark, sf_dir), DAILY)

    def text(c: str):
        return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", "), F.lit("}"))

    return maps.select("userId", "time", text("sums").alias("sums"), text("counts").alias("counts"))


@query(_with(ad.EV, ad.KV, _DAILY_SUMS, ad.CATEGORIES) + "select userId, time, 2::bigint as granularity, category as key, sum(value)::bigint as value from daily join categories using (key) group by userId, time, category")
def category_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.by_category(ag.sum_events(ad.events_kv(spark, sf_dir), DAILY), ad.categories(spark, sf_dir))


@query(
    _with(ad.EV, ad.KV, _DAILY_SUMS, ad.CATEGORIES)
    + "select userId, time, 2::bigint as granularity, coalesce(category, 'unknown') as key, sum(value)::bigint as value from daily left join categories using (key) group by 1, 2, 3, 4"
)
def category_totals_with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.by_category_or_unknown(ag.sum_events(ad.events_kv(spark, sf_dir), DAILY), ad.categories(spark, sf_dir))


@query(_with(ad.EV, ad.KV, ad.CATEGORIES) + f"select userId, b as time, 3::bigint as granularity, category as key, count(distinct key)::bigint as value from ({split_sql('kv', WEEKLY.millis)}) join categories using (key) group by userId, b, category")
def category_distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.distinct_by_category(ad.events_kv(spark, sf_dir), ad.categories(spark, sf_dir), WEEKLY)


def _summary_sql(time: str, code: int) -> str:
    columns = []
    for name, operation, ms in SUMMARY:
        among = ", ".join(f"'{m}'" for m in ms)
        expr = f"sum(value) filter (metric in ({among}))" if operation == "sum" else f"count(distinct key) filter (metric in ({among}))"
        columns.append(f"coalesce({expr}, 0)::bigint as {name}")
    inputs = ", ".join(sorted({f"'{m}'" for _, _, ms in SUMMARY for m in ms}))
    return f"select userId, {time} as time, {code}::bigint as granularity, {', '.join(columns)} from entries where metric in ({inputs}) group by userId, {time}"


_ENTRIES = f"entries as ({metric_entries_sql((DAILY,))})"


@query(_with(ad.EV, _ENTRIES) + _summary_sql("time", 2))
def summary_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.summarise(ag.suite(ad.event_tables(spark, sf_dir), SPECS, (DAILY,)))


_SUMS = ", ".join(f"sum({n})::bigint as {n}" for n, _, _ in SUMMARY)


@query(_with(ad.EV, _ENTRIES, f"daily as ({_summary_sql('time', 2)})") + f"select userId, {calendar_sql('time', WEEKLY)} as time, 3::bigint as granularity, {_SUMS} from daily group by 1, 2")
def summary_weekly_summed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.roll_up_summary(summary_daily(spark, sf_dir), WEEKLY)


@query(_with(ad.EV, _ENTRIES) + _summary_sql(calendar_sql("time", MONTHLY), 4))
def summary_monthly_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.summarise_at(ag.suite(ad.event_tables(spark, sf_dir), SPECS, (DAILY,)), MONTHLY)


_STEP = {"FiveMin": "5 minutes", "FifteenMin": "15 minutes", "Hourly": "1 hour", "Daily": "1 day", "Weekly": "7 days", "Monthly": "1 month", "Yearly": "1 year"}


@query(
    _with(ad.EV)
    + "select id, time"
    + "".join(
        f", time - time % {g.millis} as floor_{g.name.lower()}, time - time % {g.millis} + {g.millis} as ceil_{g.name.lower()}, {calendar_sql('time', g)} as cal_floor_{g.name.lower()}, "
        f"epoch_us(make_timestamp(({calendar_sql('time', g)}) * 1000) + interval '{_STEP[g.name]}') // 1000 as cal_ceil_{g.name.lower()}"
        for g in GRANULARITIES
    )
    + f", time % {DAILY.millis} as time_of_day, time - time % {DAILY.millis} + {DAILY.millis - 1} as end_of_day, (time + duration * 100 - time) // {DAILY.millis} as days from ev"
)
def time_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("time")
    columns = []
    for g in GRANULARITIES:
        low = g.name.lower()
        columns += [tb.floor_epoch(t, g).alias(f"floor_{low}"), tb.ceil_epoch(t, g).alias(f"ceil_{low}"), tb.floor_calendar(t, g).alias(f"cal_floor_{low}"), tb.ceil_calendar(t, g).alias(f"cal_ceil_{low}")]
    days = tb.days_between(t, t + F.col("duration") * 100).alias("days")
    return ad.base(spark, sf_dir).select("id", "time", *columns, tb.time_of_day(t).alias("time_of_day"), tb.end_of_day(t).alias("end_of_day"), days)


@query(_BASE + f"select userId, key, time, b as bucket, greatest(time, b) as start, piece from ({split_sql('kv', HOURLY.millis)})")
def hourly_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    kv = ad.events_kv(spark, sf_dir).select("userId", "key", "time", F.col("time").alias("start"), F.col("duration").alias("piece"))
    return tb.split_intervals(kv, HOURLY, "start", "piece").select("userId", "key", "time", "bucket", "start", "piece")


@query(_BASE + f"select userId, b as time, sum(piece)::bigint as value from ({split_sql('kv', FIVE_MIN.millis)}) group by userId, b")
def five_minute_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ag.sum_events(ad.events_kv(spark, sf_dir), FIVE_MIN).groupBy("userId", "time").agg(F.sum("value").alias("value"))
