"""Sleep from a five-minute signal of phone use: over all its windows, and the tables of the pipeline over its runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.median import median_filter, median_long
from tidemark.functions.timebuckets import day_start, floor_epoch, time_of_day
from tidemark.operators import runs
from tidemark.schema import DAILY, DAY, FIVE_MIN


def usage_signal(entries: DataFrame, step: int = FIVE_MIN.millis) -> DataFrame:
    """userId, timeWindow, value: summed use in each window from a user's first to last, 0 where there is none."""
    use = entries.select("userId", F.col("time").alias("timeWindow"), "value")
    span = use.groupBy("userId").agg(F.min("timeWindow").alias("a"), F.max("timeWindow").alias("b"))
    grid = span.select("userId", F.explode(F.sequence("a", "b", F.lit(step).cast("long"))).alias("timeWindow"), F.lit(0).cast("long").alias("value"))
    return use.unionByName(grid).groupBy("userId", "timeWindow").agg(F.sum("value").alias("value"))


def drop_idle_days(signal: DataFrame) -> DataFrame:
    """The signal without days whose use is 0."""
    w = Window.partitionBy("userId", day_start(F.col("timeWindow")))
    return signal.withColumn("_day", F.sum("value").over(w)).filter("_day <> 0").drop("_day")


def daily_profile(signal: DataFrame) -> DataFrame:
    """userId, timeWindow (of the day), medianUsage."""
    return signal.groupBy("userId", time_of_day(F.col("timeWindow")).alias("timeWindow")).agg(median_long(F.col("value")).alias("medianUsage"))


def quiet_periods(signal: DataFrame, step: int = FIVE_MIN.millis) -> DataFrame:
    """userId, startTime, endTime, duration: runs of adjacent windows without use."""
    w = Window.partitionBy("userId").orderBy("timeWindow")
    rows = signal.filter("value = 0").withColumn("run", F.col("timeWindow") - F.row_number().over(w).cast("long") * step)
    runs = rows.groupBy("userId", "run").agg(F.min("timeWindow").alias("startTime"), (F.max("timeWindow") + step).alias("endTime"))
    return runs.select("userId", "startTime", "endTime", (F.col("endTime") - F.col("startTime")).alias("duration"))


def daily_sleep(periods: DataFrame) -> DataFrame:
    """The longest period of each user and day of its end; of equal ones the latest."""
    w = Window.partitionBy("userId", floor_epoch(F.col("endTime"), DAILY)).orderBy(F.col("duration").desc(), F.col("endTime").desc())
    return periods.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def inactivity_periods(inactivity: DataFrame) -> DataFrame:
    """Pauses between phone sessions as periods."""
    return inactivity.select("userId", F.col("time").alias("startTime"), (F.col("time") + F.col("duration")).alias("endTime"), "duration")


def profile_sleep(profile: DataFrame) -> DataFrame:
    """Sleep in the median day, which stands twice in a row so that a night across midnight is whole."""
    twice = profile.select("userId", F.explode(F.array(F.col("timeWindow"), F.col("timeWindow") + DAY)).alias("timeWindow"), F.col("medianUsage").alias("value"))
    return daily_sleep(quiet_periods(twice))


def filtered(signal: DataFrame) -> DataFrame:
    """Five-point moving median of the signal."""
    return median_filter(signal, "value", by="userId", order=["timeWindow"])


def _branch(of: DataFrame, prefix: str) -> Iterator[tuple[str, DataFrame]]:
    periods = runs.quiet_periods(of)
    yield f"{prefix}_no_interaction_period", periods
    yield f"{prefix}_daily_sleep", daily_sleep(periods)
    profile = runs.daily_profile(runs.without_idle_days(of))
    yield f"{prefix}_median_daily_profile", profile
    yield f"{prefix}_median_daily_sleep", profile_sleep(profile)


Keep = Callable[[str, DataFrame], DataFrame]


def _as_it_is(name: str, df: DataFrame) -> DataFrame:
    return df


def smooth_tables(of: DataFrame, keep: Keep = _as_it_is) -> dict[str, DataFrame]:
    """The tables of the median-filtered branch over the runs of a signal."""
    smooth = keep("median_filter_runs", runs.smoothed(of))
    clean = runs.without_idle_days(smooth)
    return {"median_filter_signal": runs.all_windows(smooth), "clean_median_filter_signal": runs.all_windows(clean)} | dict(_branch(smooth, "median_filter"))


def sleep_tables(entries: DataFrame, inactivity: DataFrame, *, gapped: bool = False, keep: Keep = _as_it_is) -> dict[str, DataFrame]:
    """All tables of the pipeline by name, from five-minute entries of app use and pauses between phone sessions.

    gapped: the moving median runs over the signal without idle days, so its windows cross the gaps. keep: what becomes of
    the runs that several tables are made of; a job writes them and reads them back, so none is made twice.
    """
    own = keep("no_filter_runs", runs.usage_runs(entries))
    clean = keep("clean_no_filter_runs", runs.without_idle_days(own))
    tables = {"inactivity_based_daily_sleep": daily_sleep(inactivity_periods(inactivity)), "no_filter_signal": runs.all_windows(own), "clean_no_filter_signal": runs.all_windows(clean)}
    return tables | dict(_branch(own, "no_filter")) | smooth_tables(clean if gapped else own, keep)
