"""Importance resampling towards a target: hashed n-gram counts of corpus and target weigh documents, Gumbel keys draw them.

Each task hands its texts to a DuckDB of its own, which cuts them into words, hashes these with a registered zlib CRC-32 and joins
the hashes of neighbours, found by window functions, to those of n-grams (the CRC of a join follows from those of its parts); the counts
go to Parquet. Spark merges them, scores documents and ranks the drawn.
"""

from __future__ import annotations

import functools
import itertools
import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import blocks, discard, id_text, staged

BUCKETS = 10_000
BLOCK = 1 << 19  # bytes of text that DuckDB takes at once
_LONG = 255  # bytes that a CRC is shifted by at once
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

_COUNTS = r"""
with part as materialized (
  select n, piece, regexp_extract_all(core, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as own, regexp_extract_all(tail, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as more from texts
), word as (
  select n, piece, own, i, crc32(encode(w)) as c, octet_length(encode(w)) as l
  from (select n, piece, len(own) as own, unnest(list_concat(own, more)) as w, unnest(range(1, len(own) + len(more) + 1)) as i from part)
), gram as (
  select n, own, i, c, lead(c, 1) over seq as c2, lead(l, 1) over seq as l2, lead(c, 2) over seq as c3, lead(l, 2) over seq as l3 from word window seq as (partition by n, piece order by i)
), two as (
  select n, c, crc32_join(c, c2, l2) as cc, c3, l3 from gram where i <= own
), feature as (
  select n, unnest([c, cc, crc32_join(cc, c3, l3)]) as f from two
), bucket as (
  select n, f % $buckets as b, count(*) as c from feature where f is not null group by all
)
select n, n_words, sum(c)::bigint as n_features, list(b::smallint) as buckets, list(c::int) as counts
from bucket join (select n, sum(len(own))::bigint as n_words from part group by n) using (n) group by n, n_words order by n
"""


def _parts(body: bytes, most: int) -> Iterator[tuple[int, bytes, bytes]]:
    """A text in parts of about `most` bytes that end between words: (place, part, the two words that follow)."""
    at = 0
    while True:
        gap = _GAP.search(body, at + most) if len(body) - at > most else None
        end = gap.start() if gap else len(body)
        yield at, body[at:end], b" ".join(m.group() for m in itertools.islice(_WORD.finditer(body, end), 2))
        at = end
        if at == len(body):
            return


@functools.cache
def _connection():
    """This worker's DuckDB: one thread, nothing on disk. A block needs some 100 MB."""
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "512MB", "temp_directory": ""})

    def crc32(words: pa.Array) -> pa.Array:
        return pa.array(list(map(zlib.crc32, words.to_numpy(zero_copy_only=False))), pa.int64())

    def crc32_join(a: pa.Array, b: pa.Array, size: pa.Array) -> pa.Array:
        none = b.is_null() if a.null_count == 0 else pc.or_(a.is_null(), b.is_null())
        x, y, n = (c.fill_null(0).to_numpy(zero_copy_only=False) for c in (a, b, size))
        return pa.array(joined(x, y, n), pa.int64(), mask=none.to_numpy(zero_copy_only=False))

    con.create_function("crc32", crc32, ["BLOB"], "BIGINT", type="arrow")
    con.create_function("crc32_join", crc32_join, ["BIGINT", "BIGINT", "BIGINT"], "BIGINT", type="arrow", null_handling="special")
    return con


@functools.cache
def _shifts() -> np.ndarray:
    """What zero bytes make of a CRC: by their number, and by place and value of each of the CRC's bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    at = np.arange(256, dtype=np.uint32)[None] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    out = np.empty((_LONG + 1, 4, 256), np.uint32)
    for n in range(_LONG + 1):
        out[n] = at
        at = step[at & 255] ^ (at >> 8)
    return out


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    table, out = _shifts(), crc.astype(np.uint32)
    while True:
        now = np.minimum(n, _LONG)
        out = table[now, 0, out & 255] ^ table[now, 1, out >> 8 & 255] ^ table[now, 2, out >> 16 & 255] ^ table[now, 3, out >> 24]
        n = n - now
        if not n.any():
            return out


def joined(a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of A, a blank and B from the CRCs of A and B and the bytes of B."""
    blank = np.full(len(a), zlib.crc32(b" "), np.uint32)
    return (_shifted(a, size + 1) ^ _shifted(blank, size) ^ b.astype(np.uint32)).astype(np.int64)


_SPILL = pa.schema([("n", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("buckets", pa.list_(pa.int16())), ("counts", pa.list_(pa.int32()))])


def bucket_counts(texts: DataFrame, *, buckets: int = BUCKETS, block: int = BLOCK) -> DataFrame:
    """The n-gram counts of each text by bucket, staged as Parquet: (n, doc_id, n_words, n_features, buckets, counts).

    n numbers rows; each task adds rows with n null, which hold the sums of all its texts. Features are runs of one to three words.
    Null and empty texts have none; texts longer than a block are counted in parts that share no word, with the n-grams over their seams.
    """
    if not 0 < buckets <= 1 << 15:
        raise ValueError("buckets are numbered in 15 bits")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con, row, total = _connection(), TaskContext.get().partitionId() << 40, np.zeros(buckets, np.int64)
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, buf, offsets in blocks(batch.column(1), block):
                folded = buf.tobytes().translate(_FOLD)
                parts = [(k, *p) for k in range(hi - lo) for p in _parts(folded[offsets[k] : offsets[k + 1]], block)]
                n, piece, core, tail = zip(*parts, strict=True)
                texts = pa.table({"n": pa.array(n, pa.int64()), "piece": pa.array(piece, pa.int64()), "core": pa.array(core, pa.binary()).cast(pa.string()), "tail": pa.array(tail, pa.binary()).cast(pa.string())})
                con.register("texts", texts)
                found = con.sql(_COUNTS, params={"buckets": buckets}).to_arrow_table().combine_chunks()
                con.unregister("texts")
                own = found.column("n").to_numpy()
                place = np.full(hi - lo, -1, np.int64)
                place[own] = np.arange(len(own))
                take = pa.array(place, pa.int64(), mask=place < 0)
                numbers = [found.column(c).combine_chunks().take(take).fill_null(0) for c in ("n_words", "n_features")]
                lists = [found.column(c).combine_chunks().take(take).cast(f.type).fill_null(pa.scalar([], f.type)) for c, f in (("buckets", _SPILL.field("buckets")), ("counts", _SPILL.field("counts")))]
                total += np.bincount(lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy(), buckets).astype(np.int64)  # exact: far below 2^53
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + hi - lo)), ids.slice(lo, hi - lo), *numbers, *lists], schema=_SPILL)
                row += hi - lo
            pa.default_memory_pool().release_unused()
        while total.any():  # sums that pass 31 bits take several rows
            now = np.minimum(total, (1 << 31) - 1)
            some = np.flatnonzero(now)
            columns = [[None], [None], [None], [int(now.sum())], [some.astype(np.int16)], [now[some].astype(np.int32)]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SPILL, strict=True)], schema=_SPILL)
            total -= now

    return staged(id_text(texts).mapInArrow(count, "n long, doc_id long, n_words long, n_features long, buckets array<short>, counts array<int>"), "bucket-counts", group_bytes=16 << 20)


def merged(spilled: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Counts of all buckets over all texts; `buckets` rows come to the driver."""
    sums = spilled.filter("n is null").select(F.explode(F.arrays_zip("buckets", "counts")).alias("x")).groupBy(F.col("x.buckets").alias("b")).agg(F.sum("x.counts").alias("c")).collect()
    out = np.zeros(buckets, np.int64)
    for r in sums:
        out[r.b] = r.c
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of a bucket's smoothed share in the target and in the corpus, rounded down."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def score_documents(spilled: DataFrame, gain: np.ndarray, *, seed: int = 42) -> DataFrame:
    """(n, doc_id, n_words, n_features, weight, score): the sum of gains over a document's features, and with a Gumbel key of its id.

    The key makes the highest scores a draw without replacement in proportion to exp(weight / 1000). A null id has the key of an empty one.
    """

    def add_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = [math.floor(-1000 * math.log(-math.log((x + 0.5) / 4294967296))) for x in batch.column("h").to_pylist()]
            score = pc.add(batch.column("weight"), pa.array(key, pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], score], [*batch.schema.names[:-1], "score"])

    # the lists of a row are weighed where they are read: Arrow batches of 10 000 rows of them would be held there and again in Python
    by_bucket = F.from_json(F.lit(json.dumps(gain.tolist())), "array<bigint>")
    weight = F.aggregate(F.zip_with("buckets", "counts", lambda b, c: F.get(by_bucket, b.cast("int")) * c), F.lit(0).cast("long"), lambda a, x: a + x)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    rows = spilled.filter("n is not null").select("n", "doc_id", "n_words", "n_features", weight.alias("weight"), h.alias("h"))
    return rows.mapInArrow(add_key, "n long, doc_id long, n_words long, n_features long, weight long, score long")


def draw(scored: DataFrame, *, percent: int = 5, least_words: int = 20) -> DataFrame:
    """scored with rank: the place of the floor(percent * N / 100) highest scores among N documents of enough words; null for the rest.

    Ties go to the smaller doc_id, null last, then to the row's number. Rows are sorted by range, each task numbers its own, and the
    counts of the tasks before are added: no task sees all.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n")]
    enough = scored.filter(F.col("n_words") >= least_words)
    partitions = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([block] * n, pa.int32()), pa.array(np.arange(row + 1, row + n + 1))], [*batch.schema.names, "block", "row"])
            row += n

    dealt = enough.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    rows = staged(dealt.mapInArrow(number, f"{', '.join(f'{c} long' for c in scored.columns)}, block int, row long"), "ranked")
    counts = {r.block: r.n for r in rows.groupBy("block").agg(F.count("*").alias("n")).collect()}  # a row a task
    most = sum(counts.values()) * percent // 100
    before = dict(zip(sorted(counts), np.cumsum([0, *[counts[b] for b in sorted(counts)]]).tolist(), strict=False))
    bases = F.broadcast(scored.sparkSession.createDataFrame(list(before.items()), "block int, before long"))  # a row a task
    rank = F.col("before") + F.col("row")
    ranked = rows.join(bases, "block").select(*scored.columns, F.when(rank <= most, rank).alias("rank"))
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS) -> DataFrame:
    """Every document with n_features, weight, score and, if drawn, its rank: (n, doc_id, n_words, n_features, weight, score, rank).

    docs: doc_id, text; target: text. Null and empty texts have no features and weight 0; null and repeated ids and repeated rows are
    documents each; long texts count whole; an empty target has no counts, which is a uniform one; no documents give no rows;
    further columns are not looked at.
    """
    wanted = bucket_counts(target.select(F.lit(None).alias("doc_id"), "text"), buckets=buckets)
    spilled = bucket_counts(docs, buckets=buckets)
    gain = gains(merged(spilled, buckets), merged(wanted, buckets))
    scored = staged(score_documents(spilled, gain, seed=seed), "scored")
    discard(spilled, wanted)
    return draw(scored, percent=percent, least_words=least_words)
