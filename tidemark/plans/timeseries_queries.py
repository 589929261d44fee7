"""Queries of the five-minute signal, medians and sleep."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.median import counted, lower_median, median_long, merged, ranked
from tidemark.operators import aggregates, moving, runs, sleep
from tidemark.operators.dealing import dealt
from tidemark.plans import adapter as ad
from tidemark.plans import session_queries as sq
from tidemark.plans.aggregate_queries import _with, split_sql
from tidemark.plans.registry import query
from tidemark.schema import DAY, FIVE_MIN

_STEP = FIVE_MIN.millis


def _runs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.usage_runs(_entries(spark, sf_dir))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    kv = ad.sessions(spark, sf_dir).select("userId", "time", "duration", F.col("app").alias("key"))
    return aggregates.sum_events(dealt(kv, "userId"), FIVE_MIN)


_USE = f"use as (select userId, b as timeWindow, sum(piece)::bigint as value from ({split_sql('sessions', _STEP)}) group by 1, 2)"
_SIGNAL = f"""
signal as (
  select userId, timeWindow, sum(value)::bigint as value from (
    select userId, timeWindow, value from use union all
    select userId, unnest(range(min(timeWindow), max(timeWindow) + 1, {_STEP})), 0 from use group by userId) group by 1, 2
)"""


def _clean(name: str, of: str) -> str:
    return f"{name} as (select userId, timeWindow, value from (select *, sum(value) over (partition by userId, timeWindow - timeWindow % {DAY}) as day from {of}) where day <> 0)"



def _runs(name: str, of: str) -> str:
    return f"""
{name} as (
  select userId, min(timeWindow) as startTime, max(timeWindow) + {_STEP} as endTime, max(timeWindow) + {_STEP} - min(timeWindow) as duration from (
    select *, timeWindow - row_number() over (partition by userId order by timeWindow) * {_STEP} as run from {of} where value = 0) group by userId, run
)"""


def _longest(name: str, of: str) -> str:
    return f"{name} as (select userId, startTime, endTime, duration from (select *, row_number() over (partition by userId, endTime - endTime % {DAY} order by duration desc, endTime desc) as n from {of}) where n = 1)"


def _profile(name: str, of: str) -> str:
    return f"{name} as (select userId, timeWindow % {DAY} as timeWindow, trunc(median(value))::bigint as medianUsage from {of} group by 1, 2)"


def _twice(name: str, of: str) -> str:
    return f"{name} as (select userId, timeWindow, medianUsage as value from {of} union all select userId, timeWindow + {DAY}, medianUsage from {of})"


_HEAD = (ad.EV, ad.SESSIONS, _USE, _SIGNAL)


@query(_with(*_HEAD) + "select * from signal")
def usage_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.all_windows(_runs_of(spark, sf_dir))


@query(_with(*_HEAD, _clean("clean", "signal")) + "select * from clean")
def clean_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.all_windows(runs.without_idle_days(_runs_of(spark, sf_dir)))


_MEDIAN = "trunc(case len(w) % 2 when 1 then w[len(w) // 2 + 1]::double else (w[len(w) // 2] + w[len(w) // 2 + 1]) / 2.0 end)::bigint"


def _smooth_sql(name: str, of: str) -> str:
    framed = f"select userId, timeWindow, list_sort(list(value) over (partition by userId order by timeWindow rows between 2 preceding and 2 following)) as w from {of}"
    return f"{name} as (select userId, timeWindow, {_MEDIAN} as value from ({framed}))"


@query(_with(*_HEAD, _smooth_sql("smooth", "signal")) + "select * from smooth")
def median_filter_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.all_windows(runs.smoothed(_runs_of(spark, sf_dir)))


@query(_with(*_HEAD, _clean("clean", "signal"), _smooth_sql("smooth", "clean")) + "select * from smooth")
def median_filter_gapped_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.all_windows(runs.smoothed(runs.without_idle_days(_runs_of(spark, sf_dir))))


@query(_with(*_HEAD, _runs("periods", "signal")) + "select * from periods")
def no_interaction_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.quiet_periods(_runs_of(spark, sf_dir))


@query(_with(*_HEAD, _runs("periods", "signal"), _longest("longest", "periods")) + "select * from longest")
def daily_sleep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sleep.daily_sleep(no_interaction_periods(spark, sf_dir))


@query(_with(*_HEAD, _clean("clean", "signal"), _profile("profile", "clean")) + "select * from profile")
def median_daily_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.daily_profile(runs.without_idle_days(_runs_of(spark, sf_dir)))


@query(_with(*_HEAD, _clean("clean", "signal"), _profile("profile", "clean"), _twice("twice", "profile"), _runs("periods", "twice"), _longest("longest", "periods")) + "select * from longest")
def median_daily_sleep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sleep.profile_sleep(median_daily_profile(spark, sf_dir))


@query(
    _with(*_HEAD, _smooth_sql("smooth", "signal"), _clean("clean", "smooth"), _profile("profile", "clean"), _twice("twice", "profile"), _runs("periods", "twice"), _longest("longest", "periods"))
    + "select * from longest"
)
def median_filter_median_daily_sleep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sleep.sleep_tables(_entries(spark, sf_dir), sq.inactivity_sessions(spark, sf_dir))["median_filter_median_daily_sleep"]


@query(_with(*_HEAD, _smooth_sql("smooth", "signal"), _runs("periods", "smooth"), _longest("longest", "periods")) + "select * from longest")
def median_filter_daily_sleep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sleep.sleep_tables(_entries(spark, sf_dir), sq.inactivity_sessions(spark, sf_dir))["median_filter_daily_sleep"]


@query(
    sq._recursive(ad.EV, ad.PHONE_EVENTS, sq._WIDE_SQL, sq._INACTIVITY, "pauses as (select userId, time as startTime, time + duration as endTime, duration from inactivity)", _longest("longest", "pauses"))
    + "select * from longest"
)
def inactivity_daily_sleep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sleep.daily_sleep(sleep.inactivity_periods(sq.inactivity_sessions(spark, sf_dir)))


@query(_with(ad.EV) + "select userId, trunc(median(duration))::bigint as middle, quantile_disc(duration, 0.5)::bigint as lower from ev group by userId")
def medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.base(spark, sf_dir).groupBy("userId").agg(median_long(F.col("duration")).alias("middle"), lower_median("duration").alias("lower"))


@query(_with(ad.EV) + "select userId, quantile_disc(duration, 0.5)::bigint as value from ev group by userId")
def medians_from_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower medians from counters of each day's durations, merged."""
    daily = counted(ad.base(spark, sf_dir).withColumn("day", F.floor(F.col("time") / DAY)), "duration", "userId", "day")
    return ranked(merged(daily, "userId"), "userId")


_WIDE = 201


@query(
    _with(ad.EV) + f"select userId, id, trunc(case len(w) % 2 when 1 then w[len(w) // 2 + 1]::double else (w[len(w) // 2] + w[len(w) // 2 + 1]) / 2.0 end)::bigint as duration from "
    f"(select userId, id, list_sort(list(duration) over (partition by userId order by time, id rows between {_WIDE // 2} preceding and {_WIDE // 2} following)) as w from ev)"
)
def wide_moving_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The median duration of the 201 events around each."""
    rows = ad.base(spark, sf_dir).select("userId", "time", "id", "duration")
    return moving.wide_median(rows, "duration", by="userId", order=["time", "id"], size=_WIDE).select("userId", "id", "duration")
