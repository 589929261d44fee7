"""Medians of integers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def median_long(x: Column) -> Column:
    """Exact median as an aggregate; of an even count the mean of the middle two, cut to an integer."""
    return F.percentile(x, F.lit(0.5)).cast("long")


def lower_median(column: str) -> Column:
    """Exact lower median as an aggregate."""
    return F.expr(f"percentile_disc(0.5) within group (order by {column})").cast("long")


def array_median(values: Column) -> Column:
    """Median of an array of integers, by the rule of median_long; null of an empty one."""
    ordered, n = F.sort_array(values), F.size(values)
    low, high = F.element_at(ordered, ((n + 1) / 2).cast("int")), F.element_at(ordered, (n / 2).cast("int") + 1)
    return F.when(n > 0, ((low + high) / 2).cast("long"))


def moving(df: DataFrame, summary: Callable[[Column], Column], value: str, *, by: str, order: list[str], size: int = 5) -> DataFrame:
    """value replaced by a summary of the `size` values around it (fewer at the ends) in order, for each key.

    Nulls are left out. The values come from lags and leads over one sort, which stay in generated code.
    """
    half, w = size // 2, Window.partitionBy(by).orderBy(*order)
    around = [F.lag(value, -k).over(w) if k < 0 else F.lead(value, k).over(w) if k else F.col(value) for k in range(-half, size - half)]
    return df.withColumn("_around", F.array_compact(F.array(*around))).withColumn(value, summary(F.col("_around"))).drop("_around")


def median_filter(df: DataFrame, value: str, *, by: str, order: list[str], size: int = 5) -> DataFrame:
    """Centred moving median; the window is cut at both ends of a series, however short it is."""
    return moving(df, array_median, value, by=by, order=order, size=size)


def counted(rows: DataFrame, value: str, *by: str) -> DataFrame:
    """The counter of each key's values: the key, value, n. Null values are not counted."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("value")).agg(F.count("*").alias("n"))


def merged(counters: DataFrame, *by: str) -> DataFrame:
    """Counters of finer keys, or several in one table, as those of coarser keys."""
    return counters.groupBy(*by, "value").agg(F.sum("n").alias("n"))


def ranked(counters: DataFrame, *by: str, share: float = 0.5) -> DataFrame:
    """The least value that at least `share` of a key's values do not exceed (the lower median for a half), found by running counts.

    A counter has a row for each distinct value, and the search ends at the first row that reaches the share, so it always ends.
    """
    w = Window.partitionBy(*by).orderBy("value")
    rows = counters.withColumns({"upto": F.sum("n").over(w), "all": F.sum("n").over(Window.partitionBy(*by))})
    return rows.filter(F.col("upto") >= F.col("all") * share).groupBy(*by).agg(F.min("value").alias("value"))
