"""The five-minute signal as runs: userId, timeWindow (of the first window), windows (how many), value (of each).

Most windows have no use. What reads the signal works on its runs, a row or two for each window with use; only a table of all
windows spells them out. Windows begin at multiples of the step; a user's runs don't overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.median import median_filter
from tidemark.functions.timebuckets import day_start
from tidemark.schema import DAY, FIVE_MIN

STEP = FIVE_MIN.millis


def _in_time():
    return Window.partitionBy("userId").orderBy("timeWindow")


def _run(start: Column, windows: Column, value: Column) -> Column:
    return F.struct(start.alias("timeWindow"), windows.cast("long").alias("windows"), value.alias("value"))


def _unfolded(rows: DataFrame, runs: Column) -> DataFrame:
    """Of each row the runs in an array, nulls and empty ones left out."""
    return rows.select("userId", F.explode(runs).alias("run")).select("userId", "run.*").filter("windows > 0")


def usage_runs(entries: DataFrame, step: int = STEP) -> DataFrame:
    """Summed use from a user's first window to the last: the windows with entries, and runs of 0 between them."""
    use = entries.groupBy("userId", F.col("time").alias("timeWindow")).agg(F.sum("value").alias("value"))
    gap = (F.lead("timeWindow").over(_in_time()) - F.col("timeWindow")) / step - 1
    rows = use.withColumn("gap", F.coalesce(gap, F.lit(0)))
    one = _run(F.col("timeWindow"), F.lit(1), F.col("value"))
    return _unfolded(rows, F.array(one, _run(F.col("timeWindow") + step, F.col("gap"), F.lit(0).cast("long"))))


def all_windows(runs: DataFrame, step: int = STEP) -> DataFrame:
    """userId, timeWindow, value of every window."""
    last = F.col("timeWindow") + (F.col("windows") - 1) * step
    return runs.select("userId", F.explode(F.sequence(F.col("timeWindow"), last, F.lit(step).cast("long"))).alias("timeWindow"), "value")


def quiet_periods(runs: DataFrame, step: int = STEP) -> DataFrame:
    """userId, startTime, endTime, duration: adjacent runs without use, joined."""
    before = F.coalesce(F.sum("windows").over(_in_time().rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = runs.filter("value = 0").withColumn("island", F.col("timeWindow") - before * step)
    found = rows.groupBy("userId", "island").agg(F.min("timeWindow").alias("startTime"), F.max(F.col("timeWindow") + F.col("windows") * step).alias("endTime"))
    return found.select("userId", "startTime", "endTime", (F.col("endTime") - F.col("startTime")).alias("duration"))


def by_day(runs: DataFrame, step: int = STEP) -> DataFrame:
    """Runs cut at midnight, without the days that lie whole within a run of 0; `day` is added.

    Runs of other values are cut at every midnight within them.
    """
    end = F.col("timeWindow") + F.col("windows") * step
    first, last = day_start(F.col("timeWindow")), day_start(end - step)
    days = F.when(first == last, F.array(first)).when(F.col("value") == 0, F.array(first, last)).otherwise(F.sequence(first, last, F.lit(DAY).cast("long")))
    rows = runs.withColumn("end", end).withColumn("day", F.explode(days))
    start = F.greatest("timeWindow", "day")
    return rows.select("userId", "day", start.alias("timeWindow"), ((F.least(F.col("end"), F.col("day") + DAY) - start) / step).cast("long").alias("windows"), "value")


def without_idle_days(runs: DataFrame, step: int = STEP) -> DataFrame:
    """Runs, cut at midnight, of the days whose use is not 0."""
    w = Window.partitionBy("userId", "day")
    return by_day(runs, step).withColumn("use", F.sum(F.col("value") * F.col("windows")).over(w)).filter("use <> 0").drop("use", "day")


def smoothed(runs: DataFrame, step: int = STEP) -> DataFrame:
    """Five-point moving median in the order of time.

    Two windows at either end of a run stand alone; what lies between them has the run's value around it and keeps it. Rows next
    to each other then hold the values that every window has around it.
    """
    at, n, value = F.col("timeWindow"), F.col("windows"), F.col("value")
    short = F.transform(F.sequence(F.lit(0).cast("long"), F.least(n, F.lit(4)) - 1), lambda i: _run(at + i * step, F.lit(1), value))
    long = F.array(*[_run(at + k * step, F.lit(1) if k != 2 else n - 4, value) for k in range(3)], *[_run(at + (n - k) * step, F.lit(1), value) for k in (2, 1)])
    return median_filter(_unfolded(runs, F.when(n <= 4, short).otherwise(long)), "value", by="userId", order=["timeWindow"])


def daily_profile(runs: DataFrame, step: int = STEP) -> DataFrame:
    """userId, timeWindow (of the day), medianUsage of the days that have that window.

    Windows of 0 are counted from where runs of 0 begin and end in the day, others are spelt out; both are rows of one table, so the
    runs are made once.
    """
    slot = F.col("timeWindow") - F.col("day")
    change = lambda at, n: F.struct(at.alias("slot"), F.lit(n).cast("long").alias("times"))
    edges = F.array(change(slot, 1), change(slot + F.col("windows") * step, -1))
    spelt = F.transform(F.sequence(slot, slot + (F.col("windows") - 1) * step, F.lit(step).cast("long")), lambda at: change(at, 1))
    rows = by_day(runs, step).filter("value is not null").select("userId", "value", F.inline(F.when(F.col("value") == 0, edges).otherwise(spelt)))
    rows = rows.groupBy("userId", "slot", "value").agg(F.sum("times").alias("times"))
    zero = F.col("value") == 0
    w = Window.partitionBy("userId", zero).orderBy("slot")
    levels = rows.withColumns({"next": F.lead("slot").over(w), "times": F.when(zero, F.sum("times").over(w)).otherwise(F.col("times"))}).filter("times > 0")
    slots = F.when(zero, F.sequence(F.col("slot"), F.col("next") - step, F.lit(step).cast("long"))).otherwise(F.array("slot"))
    levels = levels.select("userId", F.explode(slots).alias("timeWindow"), F.col("value").cast("long").alias("value"), "times")
    return levels.groupBy("userId", "timeWindow").agg(F.percentile("value", F.lit(0.5), F.col("times")).cast("long").alias("medianUsage"))
