"""Mixing sources to target token shares by entropy balancing, with DataFrame functions only.

Document rates w in [0, most] stay as close to 1 as the targets allow: the relative entropy of w
to 1 and of most - w to most - 1 is least subject to sum(w * size) = target in each source. The dual
has one multiplier a source and the rates are exponentially tilted by size, capped by `most`:
w = most / (1 + (most - 1) * exp(-multiplier * size / mean)). Newton steps on the dual run over
a histogram of sizes, all sources at once; a bracket keeps them safe. Rates become whole copies by
one running sum over sizes, so a source's words miss its target by about one document at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, staged

STEPS = 5  # Newton steps between two staged states
PHASES = 32  # ways to round a source's rates, of which the one nearest its target is taken
CELL = 256  # documents of one source and size that are ranked together
FEW = 50_000  # rows of a few numbers that may be broadcast: counted, as the size of a compressed file bounds no memory
SALTS = 16  # parts in which a source and size meets its documents where cells are not few


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: words (`[^\\x20\\x09-\\x0D]+`) of each whole text, null as none."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.cast("long").alias("size"))


def source_targets(histogram: DataFrame, *, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """For each source its size, documents, mean size and target in words.

    Sources by code point, null last, take `weights` in turn and share `share` of all words; a target stops at
    `most` times its source, and the excess goes to the others by weight until none is above. Ordered by
    cap / weight, a source is at its cap exactly if it is at the level that it and those after it would share.
    The windows have no partitions, but one row a source.
    """
    by_source = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    out = by_source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")))
    out = out.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    out = out.withColumn("level", left / F.sum("weight").over(after))
    out = out.withColumn("full", F.col("cap") <= F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(every)["level"]
    target = F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("weight"))
    return out.withColumn("target", target).select("source", "source_size", "n_docs", "weight", "full", "target", F.when(F.col("source_size") > 0, F.col("source_size") / F.col("n_docs")).otherwise(1.0).alias("mean"))


def _rate(most: float) -> Column:
    """The tilted rate of a document of a size, under its source's multiplier."""
    tilted = F.lit(most) / (1 + (most - 1) * F.exp(-F.least(F.greatest(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(-600.0)), F.lit(600.0))))
    return F.when(F.col("full"), F.lit(most)).otherwise(tilted)


_STATE = ("s", "mean", "full", "target", "multiplier", "lo", "hi")


def _side(table: DataFrame, rows: int) -> DataFrame:
    """A table of so many rows as the right side of a join: broadcast if they are few, else joined by a shuffle."""
    return F.broadcast(table) if rows <= FEW else table.hint("merge")


def _newton(cells: DataFrame, state: DataFrame, most: float, sources: int) -> DataFrame:
    """One step for every source; lo and hi bracket the multiplier. A state is read once, so steps chain in a line."""
    w = _rate(most)
    mass = F.col("n") * F.col("size")
    both = cells.join(_side(state.select(*_STATE), sources), F.col("source").eqNullSafe(F.col("s"))).groupBy(*_STATE).agg(
        F.sum(mass * w).alias("words"), F.sum(mass * F.col("size") / F.col("mean") * w * (1 - w / most)).alias("slope")
    )
    off = F.col("words") - F.col("target")
    lo = F.when(off < 0, F.col("multiplier")).otherwise(F.col("lo"))
    hi = F.when(off > 0, F.col("multiplier")).otherwise(F.col("hi"))
    out = both.withColumn("off", off).withColumn("lo1", lo).withColumn("hi1", hi)
    step = F.col("multiplier") - F.try_divide(F.col("off"), F.col("slope"))
    middle = (
        F.when(F.col("lo1").isNull(), F.least(F.col("hi1") * 2, F.lit(-1.0)))
        .when(F.col("hi1").isNull(), F.greatest(F.col("lo1") * 2, F.lit(1.0)))
        .otherwise((F.col("lo1") + F.col("hi1")) / 2)
    )
    inside = (F.col("slope") > 0) & (step > F.coalesce("lo1", F.lit(float("-inf")))) & (step < F.coalesce("hi1", F.lit(float("inf")))) & (F.abs(step - F.col("multiplier")) < 64)
    moved = F.when(F.col("off") == 0, F.col("multiplier")).when(inside, step).otherwise(middle)
    miss = F.when(F.col("full") | (F.col("target") <= 0), F.lit(0.0)).otherwise(F.abs("off") / F.col("target"))
    return out.select("s", "mean", "full", "target", moved.alias("multiplier"), F.col("lo1").alias("lo"), F.col("hi1").alias("hi"), miss.alias("miss"))


def mix_sources(docs: DataFrame, *, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, close: float = 1e-7, rounds: int = 12) -> DataFrame:
    """How often the mix takes each document: doc_id, source, size, source_size, target, rate, copies, taken (copies * size).

    A row for each row of docs; null texts have size 0 and are never taken beyond it (0 words); a null source
    is a source of its own, last in order; null and repeated ids are rows like others. No rows: no rows. Equal runs give
    equal results: ties within a source and size follow a hash of the id. Very long texts are counted whole; further columns
    are not looked at.
    """
    sized = staged(document_sizes(docs), "sizes")
    cells = staged(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    targets = staged(source_targets(cells, weights=weights, share=share, most=float(most)), "targets")
    state = targets.select(
        F.col("source").alias("s"), "mean", "full", "target", F.lit(0.0).alias("multiplier"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"), F.lit(1.0).alias("miss")
    )
    sources = targets.count()
    for _ in range(rounds):
        for _ in range(STEPS):
            state = _newton(cells.select("source", "size", "n"), state, float(most), sources)
        state = staged(state, "multipliers")
        worst = state.agg(F.max("miss")).first()[0]
        if worst is None or worst <= close:
            break
    rated = cells.join(_side(state.select("s", "mean", "full", "multiplier"), sources), F.col("source").eqNullSafe(F.col("s"))).withColumn("rate", _rate(float(most))).select("source", "size", "n", "rate")
    # copies of a cell: whole steps of the running sum of rates, by size; of a few phases the one nearest the target
    run = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rated = rated.withColumn("upto", F.sum(F.col("n") * F.col("rate")).over(run))
    rated = rated.withColumn("upto0", F.coalesce(F.lag("upto").over(Window.partitionBy("source").orderBy("size")), F.lit(0.0)))
    rated = staged(rated, "rates")

    def whole(phase) -> Column:
        return F.least(F.floor(F.col("upto") + phase) - F.floor(F.col("upto0") + phase), F.col("n") * most)

    phases = [(i + 0.5) / PHASES for i in range(PHASES)]
    tried = rated.groupBy("source").agg(*[F.sum(F.col("size") * whole(F.lit(p))).alias(f"t{i}") for i, p in enumerate(phases)])
    tried = tried.join(_side(targets.select(F.col("source").alias("s"), "target"), sources), F.col("source").eqNullSafe(F.col("s")))
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"t{i}") - F.col("target")).alias("miss"), F.lit(p).alias("phase")) for i, p in enumerate(phases)]))
    tried = tried.select("s", nearest["phase"].alias("phase"))
    rated = rated.join(_side(tried, sources), F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn("copies_all", whole(F.col("phase")))
    rated = staged(rated.select(F.col("source").alias("s"), F.col("size").alias("z"), "n", "rate", "copies_all", F.ceil(F.col("n") / CELL).cast("long").alias("parts")), "cells")

    # large cells are ranked in parts, whose shares add up to the cell's copies
    hashed = F.xxhash64(F.lit("mix"), "doc_id")
    own = sized.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "doc_id"), F.lit(SALTS)))
    if rated.count() <= FEW:
        met = F.broadcast(rated.withColumn("y", F.lit(None).cast("long")))
        own = own.join(met, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    else:
        met = rated.withColumn("y", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))).hint("merge")
        own = own.join(met, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("salt") == F.col("y")))
    own = own.drop("s", "z", "y", "salt").withColumn("part", F.pmod(hashed, F.col("parts")))
    split = own.filter("parts > 1").groupBy("source", "size", "part").agg(F.count("*").alias("k"), F.first("n").alias("n"), F.first("copies_all").alias("copies_all"))
    upto = F.sum("k").over(Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    split = split.withColumn("upto", upto).select(
        F.col("source").alias("s"), F.col("size").alias("z"), F.col("part").alias("p"), "k",
        F.expr("(copies_all * upto) div n - (copies_all * (upto - k)) div n").alias("copies_part"),
    )
    small = own.filter("parts = 1").withColumn("k", F.col("n")).withColumn("copies_part", F.col("copies_all"))
    large = own.filter("parts > 1").join(split.hint("merge"), F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")) & (F.col("part") == F.col("p"))).drop("s", "z", "p")
    place = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(F.xxhash64(F.lit("place"), "doc_id"), "doc_id"))
    ranked = small.unionByName(large).withColumn("place", place)
    copies = F.expr("copies_part div k + if(place <= copies_part % k, 1, 0)")
    ranked = ranked.withColumn("copies", copies).select("doc_id", "source", "size", "rate", "copies")
    back = targets.select(F.col("source").alias("s"), "source_size", "target")
    out = ranked.join(_side(back, sources), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))
