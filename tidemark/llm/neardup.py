"""Near duplicates: MinHash with tensored banding, links confirmed on full shingle sets.

Two small collections of m MinHash tuples each (t values a tuple) give m * m table
keys by pairing a tuple of one with a tuple of the other: 2 * m * t hash functions do
the work of m * m tables of 2 * t values. Two sets of similarity s meet in a table
with probability (1 - (1 - s^t)^m)^2: with m = 8, t = 2 that is 0.9999 at 0.85 and
0.9994 at 0.8.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from tidemark.llm.bytewords import BLANK_SPLIT_FOLDED, U64, mix, whole, windows, words
from tidemark.llm.common import blocks, discard, id_text, joinable, sieve, staged, without
from tidemark.llm.graph import components

#: Members of a rare shingle that one task compares with its leaders.
CROWD = 2048


def _shingles(buf: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both hashes of the shingles of a block of texts (with repeats), and where each text's begin."""
    w = words(buf, offsets, BLANK_SPLIT_FOLDED)
    n = w.counts
    first = np.concatenate([[0], np.cumsum(np.where(n >= size, n - size + 1, n > 0))])
    short = np.flatnonzero((n > 0) & (n < size))
    out = []
    for hashes in (w.hashes, w.second):
        own = np.empty(first[-1], np.uint64)
        every = windows(hashes, size)
        text = w.text[: len(every)]
        at = np.arange(len(every))
        ok = at + size <= w.first[text + 1]
        own[first[text[ok]] + at[ok] - w.first[text[ok]]] = every[ok]
        for i in short:
            own[first[i]] = whole(hashes[w.first[i] : w.first[i + 1]])
        out.append(own)
    return out[0], out[1], first


def signatures(docs: DataFrame, *, shingle: int, m: int, t: int, seed: int = 11) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, digest of the set, left and right tuples (null where the set is empty).

    The digest is taken over all 128 bits of every shingle's hash, as it stands for the set among all others.
    """
    rng = np.random.default_rng(seed)
    flips = rng.integers(0, 2**63, 2 * m * t, dtype=np.uint64)
    factors = rng.integers(0, 2**63, 2 * m * t, dtype=np.uint64) | U64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(1)):
                sh, more, first = _shingles(buf, offsets, shingle)
                n, digest = np.zeros(hi - lo, np.int64), [None] * (hi - lo)
                for i in range(hi - lo):
                    if first[i + 1] > first[i]:
                        own, at = np.unique(sh[first[i] : first[i + 1]], return_index=True)
                        n[i], digest[i] = len(own), _digest(own, more[first[i] + at])
                full = np.flatnonzero(n)
                tuples = np.zeros((hi - lo, 2 * m), np.uint64)
                if len(full):
                    for k in range(2 * m):
                        key = np.full(len(full), U64(k + 1))
                        for x in range(k * t, k * t + t):
                            h = sh ^ flips[x]
                            h *= factors[x]
                            key = mix(key * U64(0x9E3779B97F4A7C15) + np.minimum.reduceat(h, first[:-1][full]))
                        tuples[full, k] = key
                rows = tuples.view(np.int64)
                sides = [pa.array([list(r) if c else None for r, c in zip(half.tolist(), n, strict=True)], pa.list_(pa.int64())) for half in (rows[:, :m], rows[:, m:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(digest, pa.binary()), *sides], ["doc_id", "n_shingles", "digest", "left", "right"])

    return id_text(docs).mapInArrow(sign, "doc_id long, n_shingles long, digest binary, left array<long>, right array<long>")


def _digest(shingles: np.ndarray, more: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes() + more.tobytes(), digest_size=16).digest()


def shingle_sets(docs: DataFrame, shingle: int, seed: int) -> DataFrame:
    """doc_id, digest, shingles: the whole set as sorted 64-bit numbers, made of both hashes of each shingle and the seed; digest as in signatures()."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(1)):
                sh, more, first = _shingles(buf, offsets, shingle)
                digests, own = [], []
                for i in range(hi - lo):
                    x, at = np.unique(sh[first[i] : first[i + 1]], return_index=True)
                    y = more[first[i] + at]
                    digests.append(_digest(x, y))
                    own.append(np.sort(mix(mix(x ^ U64(seed)) + y)))
                ends = pa.array(np.cumsum([0, *map(len, own)], dtype=np.int32))
                column = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(own).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(digests, pa.binary()), column], ["doc_id", "digest", "shingles"])

    return id_text(docs).mapInArrow(sets, "doc_id long, digest binary, shingles array<long>")


def _alike(one: Column, other: Column, percent: int) -> Column:
    @F.arrow_udf(BooleanType())
    def alike(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros(len(a), bool)
        for i in range(len(a)):
            x, y = a[i].values.to_numpy(zero_copy_only=False), b[i].values.to_numpy(zero_copy_only=False)
            x, y = x.view(np.uint64), y.view(np.uint64)
            at = np.searchsorted(y, x)
            both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
            out[i] = 100 * both >= percent * (len(x) + len(y) - both)
        return pa.array(out)

    return alike(one, other)


def _may_link(n1: str, own1: str, n2: str, own2: str, percent: int) -> Column:
    """Necessary for the link: shingles that no other set has can't be shared, which bounds the intersection."""
    most = F.least(F.col(n1) - F.col(own1), F.col(n2) - F.col(own2))
    return most * 100 >= (F.col(n1) + F.col(n2) - most) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (lead, member) in link. A member's set meets its lead's in the last join, so a lead's set is not shuffled for each member."""
    own = sets.select(F.col("rep").alias("member"), F.col("shingles").alias("one"))
    lead = sets.select(F.col("rep").alias("lead"), F.col("shingles").alias("other"))
    return pairs.join(own, "member").join(lead, "lead").filter(_alike(F.col("one"), F.col("other"), percent)).select(F.col("lead").alias("u"), F.col("member").alias("v"))


def _classes(named: DataFrame, split: DataFrame | None) -> DataFrame:
    """A row for each distinct set: digest, rep, doc_id, n, left, right.

    doc_id: a document that has the set. rep, which stands for it in the graph, is the smallest id that has this set alone, or, where all have
    others too, a number below all ids.
    """
    alone = F.lit(True)
    if split is not None:
        named = named.join(joinable(split.select("doc_id", F.lit(True).alias("_split"))), "doc_id", "left")
        alone = F.col("_split").isNull()
    reps = named.groupBy("digest").agg(F.min(F.when(alone, F.col("doc_id"))).alias("rep"), F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("left").alias("left"), F.first("right").alias("right"))
    if split is not None:
        least = min(0, named.agg(F.min("doc_id")).first()[0] or 0)
        reps = reps.withColumn("doc_id", F.coalesce("rep", "doc_id")).withColumn("rep", F.coalesce(F.col("rep"), F.lit(least - 1) - F.monotonically_increasing_id()))
    return staged(reps, "classes")


def _one_document(named: DataFrame, reps: DataFrame, split: DataFrame) -> DataFrame:
    """Edges between the sets of one id."""
    own = named.join(joinable(split.select("doc_id")), "doc_id", "left_semi").select("doc_id", "digest").distinct().join(reps.select("digest", "rep"), "digest")
    return own.join(own.groupBy("doc_id").agg(F.min("rep").alias("u")), "doc_id").select("u", F.col("rep").alias("v"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """rep, token, place: of each set the rarest shingles that a link must share one of, and how many rarer ones stand before.

    Two sets in link share a token of both prefixes; before the first one they share neither has any of the
    other's, so what stands before it in either is missing from the intersection.
    """
    rows = sets.select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("token"))
    often = rows.groupBy("token").agg(F.count("*").alias("c"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("c", "token")) - 1
    rows = rows.join(often, "token").withColumn("place", place)
    return rows.filter((F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100)) & (F.col("c") > 1)).select("rep", "token", "place")


def near_duplicates(docs: DataFrame, *, percent: int = 80, shingle: int = 5, m: int = 8, t: int = 2) -> DataFrame:
    """Connected components of texts whose shingle sets are alike: doc_id, n_shingles, component_id, kept.

    Sets: distinct runs of `shingle` words (`[^\\x20\\x09-\\x0D]+`, A-Z folded); a shorter text is one run. Link:
    100 * intersection >= percent * union. Texts of one set are a class and link without a look at
    their number; class representatives go into the tables. Shingles that no other set in the tables
    has bound a set's intersections, so sets with many of them can link with nobody and leave. In
    each table bucket the member with the least share of such shingles is compared with all others.
    Members of buckets whose other members then still are of several components meet once more by their
    rarest shingles, one of which any link shares: some members of each group, more each round, are compared
    with those of other components, until every pair is joined, tried or excluded by the places of
    what it shares. No bucket or group is capped. Sets are told apart by 128-bit hashes of their shingles, and two are compared by
    64 bits of a shingle, made of all 128 and a number drawn for the run: texts can't be built to collide, and chance gives
    two sets of 100 000 shingles a false common one in 1 of 10^9 pairs.

    Null, empty and blank texts: n_shingles 0, linked with nothing, kept. A null doc_id: component_id
    null, kept. Rows that share a doc_id are one document, linked with whatever any of its texts is linked with; each gets
    a row with its own n_shingles. No rows: no rows.
    """
    sig = staged(signatures(docs, shingle=shingle, m=m, t=t), "signatures")
    named = sig.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    per_id = sig.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("digest").alias("a"), F.max("digest").alias("z"), F.count("*").alias("rows"), F.count("digest").alias("full"))
    repeated = staged(per_id.filter("rows > 1 and full > 0").select("doc_id", F.expr("a <> z or full < rows").alias("split")), "repeated")
    some_repeated = not repeated.isEmpty()
    split = repeated.filter("split").select("doc_id")  # ids with several texts
    some_split = some_repeated and not split.isEmpty()
    reps = _classes(named, split if some_split else None)

    # who meets nobody in any left tuple is in no table with another
    half = reps.select("rep", F.explode("left").alias("key"))
    busy = half.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    alive = half.join(busy, "key", "left_semi").select("rep").distinct()
    pairs_of = F.flatten(F.transform("left", lambda x: F.transform(F.col("right"), lambda y: F.xxhash64(x, y))))
    keyed = staged(reps.join(alive, "rep").select("rep", F.explode(pairs_of).alias("key")), "tables")

    busy = keyed.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    wanted = keyed.join(busy, "key", "left_semi").select("rep").distinct()
    wanted = staged(wanted.join(reps.select("rep", "doc_id", "digest"), "rep") if some_split else wanted.select("rep", F.col("rep").alias("doc_id")), "wanted")
    asked = wanted.select("doc_id").distinct()
    sets = shingle_sets(sieve(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", asked)[0].join(asked, "doc_id"), shingle, secrets.randbits(63))
    if some_repeated:  # rows of one id and text once; the other ids' sets stay where they are
        again = joinable(repeated.select("doc_id"))
        sets = staged(sets, "sets-of-rows")
        sets = sets.join(again, "doc_id", "left_anti").unionByName(sets.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "digest"]))
    sets = sets.join(wanted, ["doc_id", "digest"]) if some_split else sets.withColumnRenamed("doc_id", "rep")
    sets = staged(sets.select("rep", "shingles"), "sets")
    owner = sets.select("rep", F.explode("shingles").alias("x")).groupBy("x").agg(F.min("rep").alias("rep"), F.count("*").alias("c"))
    own = owner.filter("c = 1").groupBy("rep").agg(F.count("*").alias("own"))
    able = sets.select("rep", F.size("shingles").cast("long").alias("n")).join(own, "rep", "left").fillna(0, ["own"])
    able = staged(able.filter((F.col("n") - F.col("own")) * 100 >= F.col("n") * percent).select("rep", "n", "own", F.struct((F.col("own") / F.col("n")).alias("share"), "rep").alias("order")), "able")

    # leads stand in tables of their own, so that the join with a hot bucket's members can be split
    met = staged(keyed.join(joinable(able), "rep"), "members")
    first = F.min(F.struct("order", "rep", "n", "own")).alias("l")
    lead = staged(met.groupBy("key").agg(first, F.count("*").alias("size")).filter("size > 1").drop("size"), "leads")
    shared = met.join(joinable(lead), "key")
    others = shared.filter("rep <> l.rep")
    pairs = others.filter(_may_link("n", "own", "l.n", "l.own", percent)).select(F.col("l.rep").alias("lead"), F.col("rep").alias("member")).distinct()
    links = _confirmed(pairs, sets, percent)
    comp = staged(components(links.unionByName(_one_document(named, reps, split)) if some_split else links), "components")

    # the lead has been compared with all in its bucket; if the others are of several components, they meet once more, by the tokens that a link must share
    of_rep = able.select("rep", "n").join(joinable(comp).withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    others = others.select("key", "rep")
    mixed = others.join(of_rep, "rep").groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).filter("c0 <> c1")
    left_open = staged(others.join(mixed.select("key"), "key", "left_semi").select("rep").distinct().join(of_rep, "rep"), "open")
    discard(keyed, met, lead)
    # members of a group take the lead in the order of a hash, so no group is ranked; `turn` runs from 0 to the group's size
    shown = F.pmod(F.xxhash64(F.lit("turn"), "rep"), F.lit(1 << 30)) / F.lit(1 << 30)
    member = _prefixes(sets.join(left_open.select("rep"), "rep"), percent).join(left_open, "rep")
    member = staged(member.withColumn("order", F.struct(shown.alias("u"), "rep")), "prefixes")
    lo, hi, most = 0, 8, None
    while most is None or lo < most:
        # groups leave whole, so a member's turn stays the same
        mixed = member.groupBy("token").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count("*").alias("size")).filter("c0 <> c1")
        last, member = member, staged(member.drop("size").join(mixed.select("token", "size"), "token"), "unresolved")
        discard(last)
        most, rows, squares = member.agg(F.coalesce(F.max("size"), F.lit(0)), F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
        if lo >= most:
            break
        if squares <= 64 * rows and most <= CROWD:  # groups are small: the rest at once
            hi = most
        turn = F.col("order.u") * F.col("size")
        # a token of many members is dealt over parts, each of which meets all of its leaders
        parts = F.ceil(F.col("size") / CROWD).cast("int")
        dealt = member.withColumn("part", F.pmod(F.xxhash64("rep"), parts).cast("int"))
        leader = member.filter((turn >= lo) & (turn < hi)).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        leader = leader.select("token", "part", *[F.col(c).alias(f"{c}_") for c in ("rep", "n", "place", "order", "component")])
        left, left_ = F.col("n") - F.col("place"), F.col("n_") - F.col("place_")
        bound = F.least(left, left_)
        may = bound * 100 >= (F.col("n") + F.col("n_") - bound) * percent
        more = dealt.join(leader, ["token", "part"]).filter((F.col("order") > F.col("order_")) & (F.col("component") != F.col("component_")) & may)
        found = staged(_confirmed(more.select(F.col("rep_").alias("lead"), F.col("rep").alias("member")).distinct(), sets, percent), "links")
        if not found.isEmpty():
            last, comp = comp, staged(components(found.unionByName(comp.select(F.col("component").alias("u"), F.col("node").alias("v")))), "components")
            discard(last)
            moved = left_open.select("rep", F.col("component").alias("before")).join(comp.withColumnRenamed("node", "rep"), "rep", "left")
            member = member.drop("component").join(moved.select("rep", F.coalesce("component", "before").alias("component")), "rep")
        discard(found)
        lo, hi = hi, hi * 8
    discard(member, sets, able, left_open)

    of = reps.select("digest", "rep").join(joinable(comp).withColumnRenamed("node", "rep"), "rep", "left")
    of = of.select("digest", F.coalesce("component", "rep").alias("component_id"))
    linked = named.select("doc_id", "n_shingles", "digest").join(of, "digest").select("doc_id", "n_shingles", "component_id")
    alone = sig.filter(F.col("digest").isNull() | F.col("doc_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    if some_split:  # their components are named again, as their ids and the numbers below all ids are no names among the others
        linked = staged(linked, "linked")
        touched = linked.join(joinable(split), "doc_id", "left_semi").select("component_id").distinct()
        names = staged(linked.join(touched, "component_id", "left_semi").groupBy("component_id").agg(F.min("doc_id").alias("name")), "names")
        linked = linked.join(joinable(names), "component_id", "left").select("doc_id", "n_shingles", F.coalesce("name", "component_id").alias("component_id"))
        own = linked.join(joinable(split), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("name"))
        alone = alone.join(own, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("name", "component_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, *, percent: int = 80, shingle: int = 5) -> DataFrame:
    """docs without all but the smallest doc_id of each group of near duplicates; its columns stay.

    Rows of one doc_id stay or go together; a null doc_id stays.
    """
    gone = near_duplicates(docs, percent=percent, shingle=shingle).filter(~F.col("kept")).select("doc_id").distinct()
    return without(docs, "doc_id", staged(gone, "gone"))
