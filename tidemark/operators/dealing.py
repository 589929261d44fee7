"""Dealing rows to tasks, so many that what a task holds does not grow with the input."""

from __future__ import annotations

from pyspark.sql import DataFrame

ROWS = 20_000  # of a task; one event may become hundreds of rows there


def tasks(rows: DataFrame, size: int | None = None) -> int:
    """How many tasks `rows` need at `size` rows each (ROWS, if not given); no fewer than there are cores. Rows are counted."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // (size or ROWS)))


def dealt(rows: DataFrame, by: str) -> DataFrame:
    """rows dealt by a column to as many tasks as they need, for what goes on in these tasks by that column and others.

    Adaptive execution sizes tasks by the bytes they read. Where rows multiply within the task, as intervals cut at bucket borders
    do, that may leave as few tasks as there are cores for any input; a given number of partitions is kept.
    """
    return rows.repartition(tasks(rows), by)
