"""Substring dedup by fixed-block anchors.

Each text's non-overlapping blocks of half a window are the index; every rolling
run of as many words, in every text, probes it. A window that repeats holds a whole block of its
earlier place, so only windows around hits can repeat. These candidates are compared by a 96-bit hash of
their whole word sequence under a key drawn for the run, and runs of repeated windows are the maximal exact repeats.

Texts are dealt into chunks by a hash of their id. A chunk sends each distinct run once, as four bytes in
the row for its bucket, so what all texts share costs a bucket four bytes a chunk. Buckets and partitions are as many as
the bytes of the corpus ask for. The three passes over a chunk's texts read one and the same shuffle.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import BLANK_SPLIT, U64, windows, windows_at, words
from tidemark.llm.common import blocks

_LOW = U64(0xFFFFFFFF)


def _binary(data: np.ndarray, first: np.ndarray) -> pa.Array:
    """A binary column over one buffer: value i is data[first[i]:first[i + 1]]."""
    data = np.ascontiguousarray(data)
    ends = (first * data.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _joined(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    parts = [np.frombuffer(x.as_py(), kind) for x in column]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are among the sorted known ones."""
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    bits = np.zeros(1 << 22, bool)
    spread = U64(0x9E3779B97F4A7C15)
    bits[(known * spread) >> U64(42)] = True
    at = np.flatnonzero(bits[(values * spread) >> U64(42)])
    place = np.minimum(np.searchsorted(known, values[at]), len(known) - 1)
    out = np.zeros(len(values), bool)
    out[at[known[place] == values[at]]] = True
    return out


class _Chunk:
    """The texts of a chunk by id: hashes of all words in a row, and whose they are."""

    def __init__(self, table: pa.Table, key: int):
        table = table.take(pc.sort_indices(table, [("doc_id", "ascending")]))
        self.ids = table["doc_id"].to_numpy()
        self.body = table["body"].combine_chunks()
        self.body = self.body if isinstance(self.body, pa.Array) else pa.concat_arrays(self.body.chunks or [pa.array([], pa.binary())])
        hashes, second, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, _, buf, offsets in blocks(self.body):
            w = words(buf, offsets, BLANK_SPLIT, key=key)
            hashes.append(w.hashes)
            second.append(w.second)
            counts.append(w.counts)
        self.hashes, self.second, self.counts = np.concatenate(hashes), np.concatenate(second), np.concatenate(counts)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where `size` words of one text start, and the hashes of the words."""
        h = windows(self.hashes, size)
        at = np.flatnonzero(np.arange(len(h)) + size <= self.first[self.text[: len(h)] + 1])
        return at, h[at]


def _short(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (upper half) and 32 bits of a hash; two runs that agree in these only cost a needless candidate."""
    return ((h >> U64(33)) % U64(buckets)) << U64(32) | (h & _LOW)


def _send_runs(table: pa.Table, block: int, buckets: int, key: int) -> pa.Table:
    """A row for each bucket: the chunk's distinct runs in it, ordered by class (1: occurs again, 2: starts at a block)."""
    c = _Chunk(table, key)
    at, h = c.runs(block)
    aligned = (at - c.first[c.text[at]]) % block == 0
    v = np.sort(_short(h, buckets) << U64(1) | aligned.astype(np.uint64))
    key = v >> U64(1)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    past = np.append(start[1:], len(key))
    cls = (past - start > 1).astype(np.uint64) | (v[past - 1] & U64(1)) << U64(1) if len(start) else np.zeros(0, np.uint64)
    key = key[start]
    w = np.sort((key >> U64(32)) << U64(34) | cls << U64(32) | key & _LOW)
    bucket, first = np.unique(w >> U64(34), return_index=True)
    ends = np.append(first, len(w))
    n = [np.searchsorted(w, bucket << U64(34) | U64(k) << U64(32)) for k in range(4)] + [ends[1:]]
    chunk = table["chunk"][0].as_py()
    return pa.table(
        {"bucket": bucket.astype(np.int64), "chunk": np.full(len(bucket), chunk, np.int64), **{f"n{k}": (n[k + 1] - n[k]).astype(np.int64) for k in range(4)}, "runs": _binary((w & _LOW).astype(np.uint32), ends)}
    )


def _hit_runs(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk its runs that some text has at a block and that occur twice or more."""
    runs = _joined(table["runs"], np.uint32).astype(np.uint64)
    n = np.stack([table[f"n{k}"].to_numpy() for k in range(4)], 1)
    row = np.repeat(np.arange(len(n)), n.sum(1)).astype(np.uint64)
    cls = np.repeat(np.tile(np.arange(4), len(n)), n.ravel()).astype(np.uint64)
    v = np.sort(runs << U64(32) | row << U64(2) | cls)
    key = v >> U64(32)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    times = np.diff(np.append(start, len(key)))
    cls = np.bitwise_or.reduceat(v & U64(3), start) if len(start) else np.zeros(0, np.uint64)
    hit = np.repeat(((cls & U64(2)) > 0) & ((times > 1) | ((cls & U64(1)) > 0)), times)
    v = v[hit]
    w = np.sort((v & _LOW) >> U64(2) << U64(32) | v >> U64(32))
    rows, first = np.unique(w >> U64(32), return_index=True)
    rows = rows.astype(np.int64)
    bucket = table["bucket"].to_numpy()[rows]
    return pa.table({"chunk": table["chunk"].to_numpy()[rows], "bucket": bucket, "runs": _binary((w & _LOW).astype(np.uint32), np.append(first, len(w)))})


def _send_windows(table: pa.Table, hits: pa.Table, block: int, size: int, buckets: int, key: int) -> pa.Table:
    """A row for each bucket: the chunk's distinct windows that hold a hit run, each with the smallest id that has it."""
    if not len(table) or not len(hits):
        return _NO_WINDOWS
    c = _Chunk(table, key)
    known = np.sort(np.concatenate([np.frombuffer(r.as_py(), np.uint32).astype(np.uint64) | U64(b.as_py()) << U64(32) for b, r in zip(hits["bucket"], hits["runs"], strict=True)]))
    at, h = c.runs(block)
    hit = np.zeros(len(c.hashes) + 1, np.int32)
    hit[at[_within(_short(h, buckets), known)] + 1] = 1
    hit = np.cumsum(hit)
    at, h = c.runs(size)
    some = hit[at + size - block + 1] > hit[at]
    at, h = at[some], h[some]
    more = windows_at(c.second, size, at) & _LOW
    order = np.lexsort((more, h))  # keeps the order of texts, which stand by id, so the first has the smallest
    at, h, more = at[order], h[order], more[order]
    first = _starts(h, more)
    owner, h, more = c.ids[c.text[at[first]]], h[first], more[first]
    bucket = (h >> U64(33)) % U64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, h, more, owner = bucket[order], h[order], more[order], owner[order]
    bucket, first = np.unique(bucket, return_index=True)
    ends = np.append(first, len(h))
    chunk = table["chunk"][0].as_py()
    return pa.table(
        {"bucket": bucket.astype(np.int64), "chunk": np.full(len(bucket), chunk, np.int64), "windows": _binary(h, ends), "more": _binary(more.astype(np.uint32), ends), "owners": _binary(owner.astype(np.int64), ends)}
    )


_NO_WINDOWS = pa.table({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()), **{k: pa.array([], pa.binary()) for k in ("windows", "more", "owners")}})


def _starts(*sorted_by: np.ndarray) -> np.ndarray:
    """Where runs of equal rows begin."""
    n = len(sorted_by[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = np.any([x[1:] != x[:-1] for x in sorted_by], axis=0)
    return np.flatnonzero(new)


def _later_windows(table: pa.Table) -> pa.Table:
    """Of one bucket: for each chunk its windows that a smaller id in another chunk has."""
    h, more, owner = _joined(table["windows"], np.uint64), _joined(table["more"], np.uint32), _joined(table["owners"], np.int64)
    n = np.array([len(x.as_py()) // 8 for x in table["windows"]], np.int64)
    row = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((owner, more, h))
    again = np.ones(len(h), bool)
    again[_starts(h[order], more[order])] = False
    later = np.sort(order[again])
    rows, first = np.unique(row[later], return_index=True)
    ends = np.append(first, len(later))
    return pa.table({"chunk": table["chunk"].to_numpy()[rows], "windows": _binary(h[later], ends), "more": _binary(more[later], ends)})


def _among(h: np.ndarray, more: np.ndarray, known: np.ndarray, known_more: np.ndarray) -> np.ndarray:
    """Which (h, more) are among the known pairs."""
    n = len(h)
    one, other = np.concatenate([known, h]), np.concatenate([known_more, more])
    order = np.lexsort((other, one))
    start = _starts(one[order], other[order])
    group = np.zeros(len(one), np.int64)
    group[order] = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(one))))
    return np.isin(group[len(one) - n :], group[: len(one) - n])


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))


def _cut(table: pa.Table, later: pa.Table, size: int, key: int) -> pa.Table:
    """Each text of the chunk: its words, repeated spans, and what is left."""
    if not len(table):
        return _NO_TEXTS
    c = _Chunk(table, key)
    at, h = c.runs(size)
    again = np.zeros(len(h), bool)
    known = _joined(later["windows"], np.uint64)
    here = np.flatnonzero(_within(h, np.sort(known)))
    again[here] = _among(h[here], windows_at(c.second, size, at[here]) & _LOW, known, _joined(later["more"], np.uint32).astype(np.uint64))
    ordered = np.sort(h)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    here = np.flatnonzero(_within(h, twice))
    if len(here):  # within the chunk the smallest (id, start) keeps a window
        rank = np.unique(c.ids, return_inverse=True)[1]
        text = c.text[at[here]]
        place = rank[text] << 32 | (at[here] - c.first[text])
        more = windows_at(c.second, size, at[here])
        order = np.lexsort((more, h[here]))
        start = _starts(h[here][order], more[order])
        least = np.repeat(np.minimum.reduceat(place[order], start), np.diff(np.append(start, len(order))))
        again[here[order]] |= place[order] > least
    step = np.zeros(len(c.hashes) + 1, np.int64)
    np.add.at(step, at[again], 1)
    np.add.at(step, at[again] + size, -1)
    gone = np.cumsum(step)[:-1] > 0
    removed = np.add.reduceat(np.append(gone, False).astype(np.int64), c.first[:-1]) * (c.counts > 0) if len(c.ids) else np.zeros(0, np.int64)
    digest, spans = [], []
    for lo, hi, buf, offsets in blocks(c.body):
        raw = buf.tobytes()
        for i in range(lo, hi):
            own = raw[offsets[i - lo] : offsets[i - lo + 1]].split()
            mask = gone[c.first[i] : c.first[i + 1]]
            edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            spans.append([{"first": int(a), "past": int(b)} for a, b in edge.reshape(-1, 2)])
            if len(edge):
                own = [own[k] for k in np.flatnonzero(~mask)]
            digest.append(hashlib.sha256(b" ".join(own)).hexdigest())
    return pa.table({"doc_id": pa.array(c.ids, pa.int64()), "n_words": c.counts, "n_removed": removed, "kept_sha256": pa.array(digest, pa.string()), "removed": pa.array(spans, _SPANS)})


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that lose nothing."""
    for batch in batches:
        split = [body.as_py().split() for body in batch.column(0)]
        none = pa.array([0] * len(split), pa.int64())
        digest = pa.array([hashlib.sha256(b" ".join(own)).hexdigest() for own in split], pa.string())
        columns = [pa.nulls(len(split), pa.int64()), pa.array([len(own) for own in split], pa.int64()), none, digest, pa.array([[]] * len(split), _SPANS)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "removed"])


_NO_TEXTS = pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept_sha256": pa.array([], pa.string()), "removed": pa.array([], _SPANS)})
_DDL = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<first: long, past: long>>"


def repeated_spans(docs: DataFrame, *, window: int = 20, chunk_bytes: int = 4 << 20, bucket_bytes: int = 16 << 20) -> DataFrame:
    """What exact repeats of `window` words cover: doc_id, n_words, n_removed, kept_sha256, removed (word spans).

    A word (`[^\\x20\\x09-\\x0D]+`) goes if a window over it has a word sequence that also starts earlier: in a
    smaller doc_id, or in its own document before. Windows are judged on the input; word sequences are
    equal if their 96-bit hashes are: these are keyed by a number drawn for the run, so texts can't be built to agree, and that any two of
    10^13 unequal ones agree by chance is below 0.001. removed: maximal repeats, in words from 0, ends exclusive. kept_sha256: of the words
    left, joined by blanks.

    Chunks hold about `chunk_bytes` of text and a bucket gets the runs of about `bucket_bytes`; partitions are as many as
    these need, so a task's memory stays as the corpus grows. Null and empty texts have no words. Texts with a null doc_id have no
    order: they lose nothing, are no earlier place, and are not shuffled. Rows that share a doc_id are one document's: equal
    starts of theirs don't remove each other. Repeated rows each give a row; no rows give none; further columns are not looked at.
    """
    block, key = (window + 1) // 2, secrets.randbits(63)
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n, buckets, parts = 1 + total // chunk_bytes, 1 + total // bucket_bytes, 1 + total // (4 * chunk_bytes)
    doc_id = F.col("doc_id").cast("long")
    dealt = docs.filter(doc_id.isNotNull()).select(F.pmod(F.xxhash64(doc_id), F.lit(n)).alias("chunk"), doc_id.alias("doc_id"), body).repartition(parts, "chunk")

    runs = dealt.groupBy("chunk").applyInArrow(lambda t: _send_runs(t, block, buckets, key), "bucket long, chunk long, n0 long, n1 long, n2 long, n3 long, runs binary")
    hits = runs.repartition(1 + buckets // 2, "bucket").groupBy("bucket").applyInArrow(_hit_runs, "chunk long, bucket long, runs binary")
    found = dealt.groupBy("chunk").cogroup(hits.groupBy("chunk")).applyInArrow(lambda a, b: _send_windows(a, b, block, window, buckets, key), "bucket long, chunk long, windows binary, more binary, owners binary")
    later = found.groupBy("bucket").applyInArrow(_later_windows, "chunk long, windows binary, more binary")
    named = dealt.groupBy("chunk").cogroup(later.groupBy("chunk")).applyInArrow(lambda a, b: _cut(a, b, window, key), _DDL)
    return named.unionByName(docs.filter(doc_id.isNull()).select(body).mapInArrow(_whole, _DDL))
