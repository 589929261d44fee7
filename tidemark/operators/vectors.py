"""Sparse vectors: arrays of (index, value) in order of their indexes, each index once.

Merges of two vectors go by their maps, in one pass over both; nothing has the length of the dictionary but a dense vector that is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KIND = "array<struct<index:bigint,value:double>>"


def _entry(index: Column, value: Column) -> Column:
    return F.struct(index.cast("bigint").alias("index"), value.cast("double").alias("value"))


def empty() -> Column:
    return F.array().cast(KIND)


def one_hot(index: Column, value: Column | float = 1.0) -> Column:
    """The vector of one place; of a null index the empty one."""
    value = value if isinstance(value, Column) else F.lit(value)
    return F.when(index.isNotNull(), F.array(_entry(index, value))).otherwise(empty())


def from_map(values: Column) -> Column:
    """A vector from a map of indexes to values; zeros and nulls are left out."""
    entries = F.transform(F.map_entries(F.map_filter(values, lambda _, v: v.isNotNull() & (v != 0))), lambda e: _entry(e["key"], e["value"]))
    return F.array_sort(entries)


def _map(v: Column) -> Column:
    return F.map_from_entries(F.coalesce(v, empty()))


def add(a: Column, b: Column, times: Column | float = 1.0) -> Column:
    """a + times * b; places that come to 0 are left out, a null vector is the empty one."""
    times = times if isinstance(times, Column) else F.lit(times)
    zero = F.lit(0.0)
    return from_map(F.map_zip_with(_map(a), _map(b), lambda _, x, y: F.coalesce(x, zero) + F.coalesce(y, zero) * times))


def dot(a: Column, b: Column) -> Column:
    """Sum of the products of the places that both have."""
    both = F.map_values(F.map_zip_with(_map(a), _map(b), lambda _, x, y: F.coalesce(x * y, F.lit(0.0))))
    return F.aggregate(both, F.lit(0.0), lambda s, x: s + x)


def lower_bound(v: Column, index: Column) -> Column:
    """How many entries stand before the first whose index is at least the given one."""
    return F.size(F.filter(v, lambda e: e["index"] < index))


def value_at(v: Column, index: Column) -> Column:
    """The value of a place; 0 where the vector has no entry."""
    return F.coalesce(F.try_element_at(_map(v), index.cast("bigint")), F.lit(0.0))


def dense(v: Column, length: Column | int) -> Column:
    """All values of the first `length` places."""
    length = length if isinstance(length, Column) else F.lit(length)
    places = F.when(length > 0, F.sequence(F.lit(0).cast("bigint"), length.cast("bigint") - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(places, lambda i: F.coalesce(F.try_element_at(_map(v), i), F.lit(0.0)))


def sparse(values: Column) -> Column:
    """The vector of a dense array."""
    entries = F.transform(values, lambda x, i: _entry(i, x))
    return F.filter(entries, lambda e: e["value"].isNotNull() & (e["value"] != 0))


def gathered(rows: DataFrame, *keys: str, index: str = "index", value: str = "value") -> DataFrame:
    """A vector for each key from rows of indexes and values; values of one place are summed."""
    sums = rows.filter(F.col(index).isNotNull()).groupBy(*keys, F.col(index).alias("_index")).agg(F.sum(value).alias("_value")).filter("_value <> 0")
    return sums.groupBy(*keys).agg(F.array_sort(F.collect_list(_entry(F.col("_index"), F.col("_value")))).alias("vector"))


def as_text(v: Column) -> Column:
    """index:value of each entry, with a blank between, values cut to integers."""
    return F.array_join(F.transform(v, lambda e: F.concat_ws(":", e["index"].cast("string"), e["value"].cast("bigint").cast("string"))), " ")
