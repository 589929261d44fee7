"""Connected components by alternating large-star and small-star rounds on staged tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, staged

PARTS = 32  # of a hub's edges


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def _with_least(edges: DataFrame, key: str, other: str) -> DataFrame:
    """Edges with `m`, the least `other` of their `key`. A hub's edges are dealt over parts, so no task holds them all."""
    dealt = edges.withColumn("part", F.pmod(F.xxhash64(other), F.lit(PARTS)))
    some = dealt.groupBy(key, "part").agg(F.min(other).alias("m"))
    least = some.groupBy(key).agg(F.min("m").alias("m"))
    return dealt.join(some.select(key, "part").join(least, key), [key, "part"]).select("u", "v", "m")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node on an edge (u, v): component is the smallest node it reaches.

    Each round is two aggregations with map-side combine and joins with their results, in which a hub's edges
    are dealt over parts. Loops and repeated edges do no harm; no edges give no rows.
    """
    e = edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    e = staged(e, "edges")
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, "u", "v").filter("v > u").select(F.least("m", "u").alias("u"), "v")
        ends = F.explode(F.array(F.struct("m", F.col("u").alias("v")), F.struct("m", "v"))).alias("e")
        stars = _with_least(large, "v", "u").select(ends).select(F.col("e.m").alias("u"), "e.v").filter("u <> v").distinct()
        last, e = e, staged(stars, "stars")
        discard(last)
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(e.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct())
