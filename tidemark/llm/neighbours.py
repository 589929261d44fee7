"""Nearest neighbours by cosine: a vantage-point tree in each shard.

Vectors are scaled to length one, where the squared distance is 2 - 2 * cosine, so the nearest
by distance are the nearest by cosine and the triangle inequality holds. A node splits its vectors at the
median distance from a vantage point; the far side of a query is searched only if
relax * |distance - median| is at most the distance of its k-th best so far. relax = 1 is exact,
more prunes more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import joinable, staged

LEAF = 128
SLACK = 1e-9  # of cosines that a matrix product rounds otherwise than the final score does


@dataclass
class Tree:
    """Distinct unit vectors in leaf order; nodes: vantage, median distance, children (or first and past of a leaf)."""

    vectors: np.ndarray
    nodes: list[tuple]

    @staticmethod
    def of(unit: np.ndarray, seed: int = 3) -> tuple[Tree, np.ndarray]:
        rng = np.random.default_rng(seed)
        order, nodes = np.arange(len(unit)), []

        def build(lo: int, hi: int) -> int:
            at = len(nodes)
            nodes.append(None)
            own = order[lo:hi]
            if hi - lo > LEAF:
                vantage = unit[own[rng.integers(hi - lo)]]
                d = np.sqrt(np.maximum(0.0, 2 - 2 * (unit[own] @ vantage)))
                place = np.argsort(d, kind="stable")
                order[lo:hi] = own[place]
                half = (hi - lo) // 2
                nodes[at] = (vantage, float(d[place[half - 1]]), build(lo, lo + half), build(lo + half, hi))
            else:
                nodes[at] = (None, lo, hi)
            return at

        if len(unit):
            build(0, len(unit))
        return Tree(unit[order], nodes), order

    def _walk(self, queries: np.ndarray, worst: Callable[[np.ndarray], np.ndarray], leaf: Callable[[np.ndarray, int, int], None], relax: float) -> None:
        """Show each leaf the queries that may find something in it; worst: the cosine that a query's finds must reach."""

        def visit(at: int, who: np.ndarray) -> None:
            if not len(who):
                return
            node = self.nodes[at]
            if node[0] is None:
                leaf(who, node[1], node[2])
                return
            vantage, median, inner, outer = node
            d = np.sqrt(np.maximum(0.0, 2 - 2 * (queries[who] @ vantage)))
            near = d <= median
            visit(inner, who[near])
            visit(outer, who[~near])

            def reach(some: np.ndarray) -> np.ndarray:
                least = worst(who[some])
                bound = np.where(np.isfinite(least), np.sqrt(np.maximum(0.0, 2 - 2 * (least - SLACK))), np.inf)
                return who[some][relax * np.abs(d[some] - median) <= bound]

            visit(outer, reach(near))
            visit(inner, reach(~near))

        if self.nodes:
            visit(0, np.arange(len(queries)))

    def search(self, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """For each unit query the k best cosines and places (-1: fewer found), not in order."""
        best = np.full((len(queries), k), -np.inf)
        place = np.full((len(queries), k), -1, np.int64)

        def leaf(who: np.ndarray, lo: int, hi: int) -> None:
            cosine = np.concatenate([best[who], queries[who] @ self.vectors[lo:hi].T], 1)
            where = np.concatenate([place[who], np.broadcast_to(np.arange(lo, hi), (len(who), hi - lo))], 1)
            top = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            best[who], place[who] = np.take_along_axis(cosine, top, 1), np.take_along_axis(where, top, 1)

        self._walk(queries, lambda who: best[who].min(1), leaf, relax)
        return best, place

    def within(self, queries: np.ndarray, least: np.ndarray, relax: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, place) of all vectors whose cosine reaches the query's `least`."""
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]

        def leaf(who: np.ndarray, lo: int, hi: int) -> None:
            q, v = np.nonzero(queries[who] @ self.vectors[lo:hi].T >= least[who, None])
            pairs.append((who[q], v + lo))

        self._walk(queries, lambda who: least[who], leaf, relax)
        return np.concatenate([q for q, _ in pairs]), np.concatenate([v for _, v in pairs])


def valid_vectors(table: DataFrame) -> DataFrame:
    """vec_id, embedding as doubles: no null ids, no null, empty or zero vectors, no null or non-finite components."""
    e = F.col("embedding").cast("array<double>")
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = table.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).filter("vec_id is not null and embedding is not null and size(embedding) > 0")
    return out.filter(~bad & F.exists("embedding", lambda x: x != 0))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = pa.concat_arrays(rows.chunks) if isinstance(rows, pa.ChunkedArray) else rows
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest components near one: exact, and squares neither vanish nor overflow."""
    _, exponent = np.frexp(np.abs(matrix).max(1))
    return np.ldexp(matrix, -exponent[:, None])


def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows: products and sums of each row by itself, so equal vectors score equally wherever they stand."""
    a, b = scaled(a), scaled(b)
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def _unit(matrix: np.ndarray) -> np.ndarray:
    m = scaled(matrix)
    return m / np.sqrt((m**2).sum(1))[:, None]


_DDL = "query_id long, vec_id long, score double"
_MORE = 8  # kept beyond k to see whether vectors tie with the last that counts
_QUERIES = 256  # searched at once


class _Shard:
    """The tree of one shard, and the ids of each distinct vector."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        ids, matrix = ids[order], matrix[order]
        view = np.ascontiguousarray(matrix).view([("", matrix.dtype)] * matrix.shape[1]).ravel()
        _, first, inverse = np.unique(view, return_index=True, return_inverse=True)
        self.distinct = matrix[first]
        self.ids = ids[np.argsort(inverse, kind="stable")]  # by distinct vector, ascending
        self.start = np.concatenate([[0], np.cumsum(np.bincount(inverse, minlength=len(first)))])
        self.tree, self.leaf_order = Tree.of(_unit(self.distinct))

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float) -> pa.RecordBatch:
        """The k nearest to each query, itself left out; all that tie with the last are scored before ids decide."""
        parts = [self._some(query_ids[a : a + _QUERIES], queries[a : a + _QUERIES], k, relax) for a in range(0, len(query_ids), _QUERIES)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], ["query_id", "vec_id", "score"])

    def _some(self, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float) -> tuple[np.ndarray, ...]:
        unit, n = _unit(queries), len(self.distinct)
        best, place = self.tree.search(unit, min(k + 1 + _MORE, n), relax)  # one more than k, as the query itself may be in it
        last = -np.sort(-best, axis=1)[:, min(k, n - 1)] - SLACK
        tied = (best.min(1) >= last) & (best.shape[1] < n)  # more of them may stand beyond what was kept
        q, slot = np.nonzero((place >= 0) & (best >= last[:, None]) & ~tied[:, None])
        leaf = place[q, slot]
        if tied.any():
            who = np.flatnonzero(tied)
            more, found = self.tree.within(unit[who], last[who], relax)
            q, leaf = np.concatenate([q, who[more]]), np.concatenate([leaf, found])
        vector = self.leaf_order[leaf]
        s = score(queries[q], self.distinct[vector])
        take = np.minimum(np.diff(self.start)[vector], k + 1)  # of equal vectors the smallest ids count
        rows = np.repeat(np.arange(len(q)), take)
        nth = np.arange(len(rows)) - np.repeat(np.cumsum(take) - take, take)
        found, query, s = self.ids[self.start[vector[rows]] + nth], query_ids[q[rows]], s[rows]
        keep = found != query
        found, query, s, which = found[keep], query[keep], s[keep], q[rows][keep]
        order = np.lexsort((found, -s, which))
        found, query, s, which = found[order], query[order], s[order], which[order]
        begin = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]])) if len(which) else np.zeros(0, np.int64)
        top = np.arange(len(which)) - np.repeat(begin, np.diff(np.append(begin, len(which)))) < k
        return query[top], found[top], s[top]


def _searcher(k: int, relax: float):
    """Over a partition's rows, by shard and within it vectors before queries: a shard's vectors are held, queries stream by."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ids, rows, shard = None, [], [], None
        for batch in batches:
            key = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)], 1)
            edges = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(key)], strict=True):
                if lo == hi:
                    continue
                if at != tuple(key[lo, :2]):
                    at, ids, rows, shard = tuple(key[lo, :2]), [], [], None
                own, matrix = batch.column(3)[lo:hi].to_numpy(), _matrix(batch.column(4)[lo:hi])
                if key[lo, 2] == 0:
                    ids.append(own)
                    rows.append(matrix)
                elif rows:
                    if shard is None:
                        shard = _Shard(np.concatenate(ids), np.concatenate(rows))
                    yield shard.nearest(own, matrix, k, relax)

    return search


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 5, relax: float = 4.0, shard_bytes: int = 128 << 20, least_bytes: int = 8 << 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k nearest rows of `vectors` but itself (by vec_id).

    score: cosine in double precision; equal scores by vec_id. Every valid row is indexed, in shards by a hash of the id; rows of
    another dimension than the query never meet it. A dimension has a shard for each of the session's shuffle partitions, of `least_bytes` of
    doubles or more, and further ones only beyond `shard_bytes` each (a task holds about five times that), as each query is sent to each
    shard of its dimension, where queries stream past the shard's tree; a task holds one shard and one batch of queries, nothing
    passes the driver but a row for each dimension, and the plan has one size. Fewer candidates than k: all of them. Null, empty, zero
    and non-finite vectors take no part; no rows give none. Rows that repeat an id with another vector are candidates each.
    relax: 1 is exact; more prunes more.
    """
    spark = vectors.sparkSession
    valid = staged(valid_vectors(vectors).withColumn("dim", F.size("embedding")), "vectors")
    asked = valid_vectors(queries).withColumn("dim", F.size("embedding"))
    size = F.col("n") * F.col("dim") * 8
    wide = F.least(F.ceil(size / min(least_bytes, shard_bytes)), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    shape = valid.groupBy("dim").agg(F.count("*").alias("n")).withColumn("shards", F.greatest(F.ceil(size / shard_bytes), wide).cast("int"))
    shape = staged(shape, "shape")
    total = shape.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0]
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sized = joinable(shape.select("dim", "shards"))
    columns = ("dim", "shard", "kind", "vec_id", "embedding")
    own = valid.join(sized, "dim").withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "vec_id"), F.col("shards")).cast("int")).withColumn("kind", F.lit(0))
    sent = asked.join(sized, "dim").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumn("kind", F.lit(1))
    dealt = own.select(*columns).unionByName(sent.select(*columns)).repartition(total, "dim", "shard").sortWithinPartitions("dim", "shard", "kind")
    found = dealt.mapInArrow(_searcher(k, relax), _DDL)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
