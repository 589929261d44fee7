"""Day arithmetic as SQL functions of a session, inlined by the optimizer."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.schema import DAY


def register(spark: SparkSession) -> None:
    """day_start(ms), next_day_start(ms) and days_between(ms, ms), as temporary functions."""
    spark.sql(f"create or replace temporary function day_start(t bigint) returns bigint return t - t % {DAY}")
    spark.sql(f"create or replace temporary function next_day_start(t bigint) returns bigint return t - t % {DAY} + {DAY}")
    spark.sql(f"create or replace temporary function days_between(a bigint, b bigint) returns bigint return (b - a) div {DAY}")
