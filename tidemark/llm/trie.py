"""Prefix trie of conversations: a Cartesian tree over the common prefix lengths of the sorted conversations.

Conversations are sorted as sequences of turn digests and dealt over blocks by range. Neighbours' common prefix lengths (LCPs)
make the tree: an LCP's node is the interval between the nearest smaller LCPs on either side. A block finds these within
itself; what it leaves open is found from the minima of the other blocks, which name the block, and that block's running
minima, which name the place. Nodes of one interval are merged, the depths between a node and its parent are filled in, and
what a node says of its subtree is a difference of running sums at the interval's ends.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from tidemark.llm.common import discard, staged

DIGEST = 32  # bytes of a turn's SHA-256
BLOCK = 200_000  # conversations that a block has at most, about

_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))


def conversation_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns in order, as structs of turn, digest and chars; texts are not shuffled.

    Null roles and texts are empty, null turns come first, ties go by the digest of role and text; rows without conv_id take no part.
    A conversation is one row of 60 to 80 bytes a turn, whatever its texts hold.
    """
    digest = F.sha2(F.concat(F.octet_length(_text("role")).cast("string"), F.lit(":"), _text("role"), _text("text")), 256)
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.char_length(_text("text")).cast("long").alias("chars")).alias("t"))
    return rows.filter("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def share_heads(conversations: DataFrame, *, group: int = 100, heads: int = 6) -> DataFrame:
    """Conversations that start as the first of their group does: the first h turns of conversation c - c % group, then c's own after its first h.

    h is the CRC-32 of the decimal id modulo `heads`. Where the group's first is missing only own turns are left, if any.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    first = conversations.filter(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("lead"), F.slice("turns", 1, heads - 1).alias("head"))
    joined = conversations.withColumn("lead", F.col("conv_id") - F.col("conv_id") % group).join(first, "lead", "left")
    head = F.coalesce(F.slice("head", F.lit(1), h), F.array().cast("array<struct<turn:bigint,digest:string,chars:bigint>>"))
    return joined.select("conv_id", F.concat(head, F.slice("turns", h + 1, F.size("turns"))).alias("turns"))


def _common(a: bytes, b: bytes) -> int:
    """Turns that two keys share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // DIGEST
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))) // DIGEST


def _sorted_blocks(conversations: DataFrame) -> DataFrame:
    """Sorted conversations by block and row, with the LCP to the row before; a block's last key stands in a row of number -1."""
    key = F.unhex(F.array_join(F.col("turns.digest"), ""))
    flat = staged(conversations.select("conv_id", key.alias("key"), F.col("turns.chars").alias("chars")), "trie-keys")
    blocks = max(int(flat.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(flat.count() / BLOCK))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row, before = TaskContext.get().partitionId(), 0, None
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()]
        names = ["block", "row", "conv_id", "lcp", "chars", "key"]
        for batch in batches:
            n, keys = batch.num_rows, batch.column(1).to_pylist()
            shared = [None if before is None and i == 0 else _common(keys[i - 1] if i else before, k) for i, k in enumerate(keys)]
            first = [keys[0] if row == 0 and n else None, *[None] * (n - 1)][:n]
            chars = batch.column(2).cast(kinds[4])
            yield pa.RecordBatch.from_arrays([pa.array([block] * n, kinds[0]), pa.array(range(row, row + n), kinds[1]), batch.column(0), pa.array(shared, kinds[3]), chars, pa.array(first, kinds[5])], names)
            row, before = row + n, keys[-1] if n else before
        if before is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((block, -1, None, None, None, before), kinds, strict=True)], names)

    dealt = flat.repartitionByRange(blocks, "key", "conv_id").sortWithinPartitions("key", "conv_id")
    out = staged(dealt.mapInArrow(number, "block int, row long, conv_id long, lcp int, chars array<long>, key binary"), "trie-sorted")
    discard(flat)
    return out


class Blocks:
    """What all blocks know of each other: a few numbers a block, of blocks that have rows, in their order."""

    def __init__(self, found: DataFrame) -> None:
        own = found.filter("row >= 0").groupBy("block").agg(F.count("*").alias("n"), F.min("lcp").alias("least"), F.min("conv_id").alias("first")).orderBy("block").collect()  # a row a block
        self.number = np.array([r.block for r in own], np.int64)
        self.base = np.concatenate([[0], np.cumsum([r.n for r in own])]).astype(np.int64)
        self.first = np.array([r.first for r in own], np.int64)
        seam = self._seams(found)
        #: LCP of each block's first row to the row before; -1 before the first row and after the last
        self.seam = np.array([seam.get(b, -1) for b in self.number.tolist()] + [-1], np.int64)
        self.least = np.array([min(s, r.least if r.least is not None else s) for r, s in zip(own, self.seam, strict=False)], np.int64)

    def _seams(self, found: DataFrame) -> dict[int, int]:
        pairs = [(int(b), int(a)) for a, b in zip(self.number[:-1], self.number[1:], strict=True)]
        if not pairs:
            return {}

        @F.arrow_udf(IntegerType())
        def common(a: pa.Array, b: pa.Array) -> pa.Array:
            return pa.array([_common(x.as_py(), y.as_py()) for x, y in zip(a, b, strict=True)], pa.int32())

        before = F.broadcast(found.sparkSession.createDataFrame(pairs, "block int, before int"))  # a row a block
        first = found.filter("row = 0").select("block", F.col("key").alias("a")).join(before, "block")
        last = found.filter("row = -1").select(F.col("block").alias("before"), F.col("key").alias("b"))
        return {r.block: r.seam for r in first.join(last, "before").select("block", common("a", "b").alias("seam")).collect()}

    def smaller(self, at: int, value: int, step: int) -> int:
        """The nearest block before (step -1) or after (1) block `at` that has an LCP below `value`; -1 if none."""
        side = self.least[:at] if step < 0 else self.least[at + 1 :]
        found = np.flatnonzero(side < value)
        return -1 if len(found) == 0 else int(found[-1]) if step < 0 else at + 1 + int(found[0])


def nearest_smaller(values: list[int]) -> list[int]:
    """Place of the last smaller value before each; -1 where there is none."""
    out, open_ = [], []
    for i, v in enumerate(values):
        while open_ and values[open_[-1]] >= v:
            open_.pop()
        out.append(open_[-1] if open_ else -1)
        open_.append(i)
    return out


def range_minima(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of values[lo:hi] for each pair, all of them not empty."""
    level = np.floor(np.log2(hi - lo)).astype(np.int64)
    out, table = np.empty(len(lo), values.dtype), values
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            table = np.minimum(table[: -(1 << k - 1)], table[1 << k - 1 :])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(table[lo[at]], table[hi[at] - (1 << k)])
    return out


_ROWS = [
    ("block", pa.int32()), ("i", pa.int64()), ("conv_id", pa.int64()), ("size", pa.int64()), ("lcp", pa.int64()), ("next_lcp", pa.int64()),  # the row
    ("lo", pa.int64()), ("hi", pa.int64()), ("lo_block", pa.int32()), ("hi_block", pa.int32()), ("head", pa.int64()), ("equal", pa.int64()),  # its LCP's interval
    ("opens", pa.bool_()), ("closes", pa.bool_()), ("least_before", pa.int64()), ("least_from", pa.int64()), ("least", pa.int64()),  # minima
    ("chars_before", pa.int64()), ("new_before", pa.int64()), ("leaves_before", pa.int64()), ("chars", pa.int64()), ("new", pa.int64()), ("leaf", pa.int64()), ("upto", pa.list_(pa.int64())),
]


def _block_rows(found: DataFrame, blocks: Blocks) -> DataFrame:
    """Every conversation with its LCP's interval as far as its block tells.

    lo, hi: places of the nearest smaller LCPs, null where they lie in blocks lo_block, hi_block. head: the first row of the block
    whose LCP has the same interval, and equal how many there are. opens, closes: whether the LCP is below all before or after it
    in the block. least..: smallest ids of the block's rows before, from here on, and of the interval if it ends within the block.
    chars, new: characters of the conversation and of those turns that the row before does not share; upto: running characters.
    """
    schema = pa.schema(_ROWS)
    n_all = int(blocks.base[-1])

    def solve(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        b = int(np.searchsorted(blocks.number, table.column("block")[0].as_py()))
        m, base = table.num_rows, int(blocks.base[b])
        lcp = [int(blocks.seam[b]), *table.column("lcp").to_pylist()[1:]]
        value, after = np.array(lcp, np.int64), np.array([*lcp[1:], int(blocks.seam[b + 1])], np.int64)
        ids = table.column("conv_id").to_numpy()
        upto = [np.concatenate([[0], np.cumsum(c)]).astype(np.int64) for c in table.column("chars").to_pylist()]
        size = np.array([len(u) - 1 for u in upto], np.int64)
        chars = np.array([u[-1] for u in upto], np.int64)
        new = chars - np.array([u[max(0, v)] for u, v in zip(upto, lcp, strict=True)], np.int64)
        leaf = (after < size).astype(np.int64)
        left = np.array(nearest_smaller(lcp), np.int64)
        right = m - 1 - np.array(nearest_smaller(lcp[::-1])[::-1], np.int64)  # m where there is none
        ask_lo, ask_hi = np.full(m, -1, np.int64), np.full(m, -1, np.int64)
        for v in np.unique(value[(left < 0) | (right == m)]).tolist():
            if v >= 0:
                ask_lo[(left < 0) & (value == v)] = blocks.smaller(b, v, -1)
                ask_hi[(right == m) & (value == v)] = blocks.smaller(b, v, 1)
        hi_known = (right < m) | (ask_hi < 0)
        _, first, own, equal = np.unique(left * (int(size.max()) + 2) + value, return_index=True, return_inverse=True, return_counts=True)
        inside = (left >= 0) & (right < m)
        least = np.zeros(m, np.int64)
        least[inside] = range_minima(ids, left[inside], right[inside])
        least_from = np.minimum.accumulate(ids[::-1])[::-1]
        least_before = np.concatenate([[0], np.minimum.accumulate(ids)[:-1]])
        before = lambda x: np.concatenate([[0], np.cumsum(x)[:-1]])
        opens = np.concatenate([[True], value[1:] < np.minimum.accumulate(value)[:-1]])
        closes = np.concatenate([value[:-1] < np.minimum.accumulate(value[::-1])[::-1][1:], [True]])
        columns = [
            (np.full(m, b), None), (base + np.arange(m), None), (ids, None), (size, None), (value, None), (after, None),
            (base + left, left < 0), (np.where(right < m, base + right, n_all), ~hi_known), (ask_lo, ask_lo < 0), (ask_hi, ask_hi < 0), (base + first[own], None), (equal[own], None),
            (opens, None), (closes, None), (least_before, np.arange(m) == 0), (least_from, None), (least, ~inside),
            (before(chars), None), (before(new), None), (before(leaf), None), (chars, None), (new, None), (leaf, None),
        ]
        arrays = [pa.array(x, f.type, mask=mask) for (x, mask), f in zip(columns, schema, strict=False)]
        flat = pa.array(np.concatenate(upto), pa.int64())
        arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size + 1)]), pa.int32()), flat))
        return pa.Table.from_arrays(arrays, schema=schema)

    kinds = {pa.int32(): "int", pa.int64(): "long", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<long>"}
    rows = found.filter("row >= 0").select("block", "row", "conv_id", "lcp", "chars").groupBy("block").applyInArrow(solve, ", ".join(f"{n} {kinds[k]}" for n, k in _ROWS))
    return staged(rows, "trie-rows")


def _between_blocks(rows: DataFrame) -> DataFrame:
    """rows with lo and hi of all LCPs: what a block asks once a value, the asked block's running minima answer."""
    out = rows
    for end, ask, record, nearest in (("lo", "lo_block", "closes", F.max), ("hi", "hi_block", "opens", F.min)):
        asked = rows.filter(F.col(end).isNull() & F.col(ask).isNotNull()).select("block", "lcp", ask).distinct()
        told = rows.filter(record).select(F.col("block").alias(ask), F.col("lcp").alias("below"), "i")
        answers = asked.join(told, ask).filter("below < lcp").groupBy("block", "lcp").agg(nearest("i").alias(f"{end}_found"))
        out = out.join(answers, ["block", "lcp"], "left").withColumn(end, F.coalesce(end, f"{end}_found")).drop(f"{end}_found")
    return out


def _ends(rows: DataFrame) -> DataFrame:
    """(lo, n_ends, ends): for conversations that others equal or extend, how many are equal and the SHA-256 of their ids.

    Ids are joined a block at a time and hashed as a stream, block after block, so that memory does not grow with the group.
    """
    repeats = F.col("lcp") == F.col("size")
    own = rows.filter(repeats | (F.col("next_lcp") == F.col("size"))).select(F.when(repeats, F.col("lo")).otherwise(F.col("i")).alias("lo"), "block", "conv_id")
    pieces = own.groupBy("lo", "block").agg(F.count("*").alias("n"), F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("piece"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, n, state = None, 0, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([group], pa.int64()), pa.array([n], pa.int64()), pa.array([state.hexdigest()], pa.string())], ["lo", "n_ends", "ends"])

        for batch in batches:
            for lo, k, piece in zip(*(batch.column(c).to_pylist() for c in ("lo", "n", "piece")), strict=True):
                if lo != group:
                    if state:
                        yield done()
                    group, n, state = lo, 0, hashlib.sha256()
                elif n:
                    state.update(b",")
                n += k
                state.update(piece.encode())
        if state:
            yield done()

    return pieces.repartition("lo").sortWithinPartitions("lo", "block").mapInArrow(digest, "lo long, n_ends long, ends string")


def _middle(blocks: Blocks):
    """Least conv_id of the blocks strictly between two; null where there are none."""

    @F.arrow_udf(LongType())
    def least(a: pa.Array, b: pa.Array) -> pa.Array:
        lo, hi = a.to_numpy(zero_copy_only=False) + 1, b.to_numpy(zero_copy_only=False)
        some = hi > lo
        out = np.zeros(len(lo), np.int64)
        out[some] = range_minima(blocks.first, lo[some], hi[some])
        return pa.array(out, pa.int64(), mask=~some)

    return least


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each distinct sequence of the first d turns of any conversation, the root (d = 0) included.

    conversations: (conv_id, turns), as conversation_turns gives them, one row a conv_id. Returns conv_id (smallest member), depth,
    parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens (sum over the subtree of each
    node's n_convs - 1 times the characters of its last text) and ends_sha256 (of the ids that end there, ascending,
    comma-joined). Conversations without turns are members of the root; no conversations give no rows. Equal conversations, however many, are
    dealt over blocks by their ids.
    """
    spark = conversations.sparkSession
    found = _sorted_blocks(conversations)
    blocks = Blocks(found)
    schema = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    if len(blocks.number) == 0:
        return spark.createDataFrame([], schema)
    local = _block_rows(found, blocks)
    discard(found)
    sums = local.groupBy("block").agg(*[F.sum(c).alias(c) for c in ("chars", "new", "leaf")]).orderBy("block").collect()  # a row a block
    running = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum([[r.chars, r.new, r.leaf] for r in sums], axis=0)]).tolist()
    bases = F.broadcast(spark.createDataFrame([(r.block, *x) for r, x in zip(sums, running, strict=False)], "block int, c0 long, n0 long, l0 long"))  # a row a block
    rows = _between_blocks(local).join(bases, "block")
    rows = rows.withColumns({"chars_before": F.col("chars_before") + F.col("c0"), "new_before": F.col("new_before") + F.col("n0"), "leaves_before": F.col("leaves_before") + F.col("l0")})
    rows = staged(rows.drop("c0", "n0", "l0"), "trie-index")
    discard(local)

    # a node for each interval: blocks tell of it once each
    heads = rows.filter("i = head and i > 0").select("i", "lcp", "lo", "hi", "equal", "least")
    merged = heads.groupBy("lo", "lcp").agg(F.min("hi").alias("hi"), F.sum("equal").alias("equal"), F.min("i").alias("k"), F.min("least").alias("least"))
    at_lo = rows.select(F.col("i").alias("lo"), F.col("lcp").alias("lo_lcp"), "size", F.col("block").alias("lo_block"), "least_from", F.col("chars_before").alias("c_lo"), F.col("new_before").alias("n_lo"), F.col("leaves_before").alias("l_lo"), "chars", "new")
    at_hi = rows.select(F.col("i").alias("hi"), F.col("lcp").alias("hi_lcp"), F.col("block").alias("hi_block"), "least_before", F.col("chars_before").alias("c_hi"), F.col("new_before").alias("n_hi"), F.col("leaves_before").alias("l_hi"))
    end = [(int(blocks.base[-1]), -1, len(blocks.number), None, *running[-1])]  # after the last row
    at_hi = at_hi.unionByName(spark.createDataFrame(end, at_hi.schema))
    inner = merged.join(at_lo, "lo").join(at_hi, "hi")
    across = F.least("least_from", _middle(blocks)("lo_block", "hi_block"), "least_before")
    inner = inner.join(_ends(rows), "lo", "left").withColumn("ends_here", F.col("size") == F.col("lcp"))
    n_ends = F.when(F.col("ends_here"), F.col("n_ends")).otherwise(F.lit(0))
    inner = inner.select(
        "lo",
        F.col("lcp").alias("depth"),
        "k",
        F.coalesce("least", across).alias("conv_id"),
        (F.col("hi") - F.col("lo")).alias("n_convs"),
        (F.col("equal") + 1 - n_ends).alias("n_children"),
        (F.col("l_hi") - F.col("l_lo")).alias("n_leaves"),
        (F.col("c_hi") - F.col("c_lo") - (F.col("n_hi") - F.col("n_lo") - F.col("new")) - F.col("chars")).alias("saved"),
        F.when(F.col("ends_here"), F.col("ends")).alias("ends"),
        *_above(F.col("lo_lcp"), F.col("hi_lcp"), F.col("lo"), F.col("hi")),
    )
    inner = staged(inner, "trie-nodes")
    names = rows.select(F.col("i").alias("above"), "head").join(heads.select(F.col("i").alias("head"), "lo", F.col("lcp").alias("depth")).join(inner.select("lo", "depth", F.col("conv_id").alias("named")), ["lo", "depth"]).select("head", "named"), "head").drop("head")
    leaves = rows.select(
        "conv_id",
        F.col("size").alias("depth"),
        F.lit(1).cast("long").alias("n_convs"),
        F.lit(0).cast("long").alias("n_children"),
        F.lit(1).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved"),
        F.sha2(F.col("conv_id").cast("string"), 256).alias("ends"),
        *_above(F.col("lcp"), F.col("next_lcp"), F.col("i"), F.col("i") + 1),
        "upto",
    ).filter("depth > up")
    inner = inner.join(rows.select(F.col("i").alias("k"), "upto"), "k").drop("lo", "k")
    return _filled(inner.unionByName(leaves).join(names, "above", "left"))


def _above(before: Column, after: Column, at_before: Column, at_after: Column) -> list[Column]:
    """up: the parent's depth, which is the larger of the LCPs at the ends; above: the row that has it."""
    return [F.greatest(before, after).alias("up"), F.when(before >= after, at_before).otherwise(at_after).alias("above")]


def _filled(nodes: DataFrame) -> DataFrame:
    """All depths between each node and its parent; between them a node has one child and no ends."""
    before = F.when(F.col("up") < 0, F.concat(F.array(F.lit(0).cast("long")), F.slice("upto", F.lit(1), F.col("depth").cast("int")))).otherwise(F.slice("upto", F.col("up").cast("int") + 1, (F.col("depth") - F.col("up")).cast("int")))
    each = nodes.select("*", F.posexplode(before).alias("step", "shared")).withColumns({"deepest": F.col("depth"), "depth": F.col("up") + 1 + F.col("step")})
    last = F.col("depth") == F.col("deepest")
    return each.select(
        "conv_id",
        "depth",
        F.when(F.col("step") > 0, F.col("conv_id")).otherwise(F.when(F.col("depth") > 0, F.col("named"))).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * F.col("shared")).alias("saved_tokens"),
        F.when(last & F.col("ends").isNotNull(), F.col("ends")).otherwise(F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
