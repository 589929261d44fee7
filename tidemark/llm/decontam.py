"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window is `window` consecutive words of an item (a shorter item is one window). Its
tokens are its 3-word shingles (all its words, where it has fewer). A document that holds
the window holds every token, so the necessary prefix in order of rarity is the one
rarest token: only that is joined. Its place in the window gives the start (positional
bound), the document's ends bound the length, and what is left is compared word by word.

Windows, their tokens, counts and anchors are tables. Documents are read three times: to count the tokens
that items have, to find the anchors, and for the words at the starts that the anchors name. What goes to every task is a
bitmap with as many bits as the counted tokens ask for, within a bound; what it lets through is joined by a shuffle, as a token and its place.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytewords import ALNUM_FOLDED, Words, windows, words
from tidemark.llm.common import blocks, discard, fresh, joinable, row_key, sieve, staged, without

TOKEN = 3
LEAST_BITS, MOST_BITS = 20, 27  # of a token's hash: a bitmap of 128 KB to 16 MB
_BUCKET = 32768  # bits of one bitmap of Spark's
HOT = 1000  # a token with more than a 1/HOT of all places of anchors is joined in parts; there are fewer than HOT of them
PARTS = 32
_WINDOWS = "item_id string, words string, size int, tokens array<long>"
_ROWS = 20_000  # windows in a batch


def item_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, words, size, tokens) of every window of every item; null ids and texts take no part."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.int64())]
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for lo, hi, buf, offsets in blocks(batch.column(1)):
                w, raw = words(buf, offsets, ALNUM_FOLDED), ALNUM_FOLDED.folded[buf].tobytes()
                for i in range(lo, hi):
                    a, b = w.first[i - lo], w.first[i - lo + 1]
                    if a == b:
                        continue
                    own = [raw[s:e].decode() for s, e in zip(w.start[a:b], w.end[a:b], strict=True)]
                    n = min(window, len(own))
                    t = min(n, TOKEN)
                    tokens = windows(w.hashes[a:b], t).view(np.int64).tolist()
                    for k in range(len(own) - n + 1):
                        rows.append((ids[i], " ".join(own[k : k + n]), n, tokens[k : k + n - t + 1]))
                        if len(rows) == _ROWS:
                            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], ["item_id", "words", "size", "tokens"])
                            rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], ["item_id", "words", "size", "tokens"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").cast("binary").alias("body")).dropna().distinct()
    return items.mapInArrow(cut, _WINDOWS)


class Bitmap(NamedTuple):
    """One bit for each value of a token's first `bits` bits, packed."""

    bits: int
    held: np.ndarray


def _bitmap(tokens: DataFrame) -> Bitmap:
    """Of 16 bits a counted token, within the bounds; made on the executors in pieces of 4 KB."""
    n = tokens.select("token").distinct().count()
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * n - 1).bit_length()))
    rows = tokens.select((F.shiftrightunsigned("token", 64 - bits) + 1).alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("bucket"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows.agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")).collect():  # at most 2^MOST_BITS / _BUCKET rows
        out[(r["bucket"] - 1) * _BUCKET // 8 : r["bucket"] * _BUCKET // 8] = np.frombuffer(r["bits"], np.uint8)
    return Bitmap(bits, out)


def _places(w: Words, size: int, bitmap: Bitmap) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the block) of tokens of `size` words that the bitmap lets through, and the tokens."""
    h = windows(w.hashes, size)
    bit = h >> np.uint64(64 - bitmap.bits)
    at = np.flatnonzero(bitmap.held[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8) & np.uint8(1))
    at = at[at + size <= w.first[w.text[at] + 1]]
    return at, h[at]


def _token_counts(docs: DataFrame, sizes: list[int], bitmap) -> DataFrame:
    """(token, n): places in all documents of what the bitmap lets through."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, buf, offsets in blocks(batch.column(0)):
                w = words(buf, offsets, ALNUM_FOLDED)
                for size in sizes:
                    token, n = np.unique(_places(w, size, bitmap.value)[1], return_counts=True)
                    if len(token):
                        yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n)], ["token", "n"])

    body = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("body"))
    return body.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


_SCAN = "key binary, doc_id long, n_words long, tokens array<long>, places array<long>"


def _keyed(docs: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(row_key(docs).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))


def _scan(docs: DataFrame, sizes: list[int], bitmap) -> DataFrame:
    """Each document's words, counted, and its possible anchors: tokens and their places."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offsets in blocks(batch.column(2)):
                w = words(buf, offsets, ALNUM_FOLDED)
                at, token = (np.concatenate(x) for x in zip(*[_places(w, size, bitmap.value) for size in sizes], strict=True)) if sizes else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
                order = np.argsort(at, kind="stable")
                at, token = at[order], token[order]
                ends = pa.array(np.searchsorted(at, w.first).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (token.view(np.int64), at - w.first[w.text[at]])]
                yield pa.RecordBatch.from_arrays([*[c.slice(lo, hi - lo) for c in batch.columns[:2]], pa.array(w.counts, pa.int64()), *lists], ["key", "doc_id", "n_words", "tokens", "places"])

    return _keyed(docs).mapInArrow(probe, _SCAN)


def _words_at(texts: DataFrame) -> DataFrame:
    """(key, start, size, words) of texts (key, body, starts): the words at each start of a text."""
    kinds = [pa.binary(), pa.int64(), pa.int32(), pa.string()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts = batch.column(0), batch.column(2)
            for lo, hi, buf, offsets in blocks(batch.column(1)):
                w, raw, rows = words(buf, offsets, ALNUM_FOLDED, hashed=False), ALNUM_FOLDED.folded[buf].tobytes(), []
                for i in range(lo, hi):
                    key, first = keys[i].as_py(), int(w.first[i - lo])
                    for x in starts[i].as_py():
                        a, b = first + x["start"], first + x["start"] + x["size"]
                        own = b" ".join([raw[s:e] for s, e in zip(w.start[a:b].tolist(), w.end[a:b].tolist(), strict=True)])
                        rows.append((key, x["start"], x["size"], own.decode()))
                    if rows and (len(rows) >= _ROWS or i == hi - 1):
                        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "start", "size", "words"])
                        rows = []

    return texts.mapInArrow(cut, "key binary, start long, size int, words string")


def _starts(scan: DataFrame, anchors: DataFrame) -> DataFrame:
    """(key, starts): where in each document an anchor and the ends of the text allow a window."""
    places = anchors.groupBy("token").agg(F.first("n").alias("n"))
    every = places.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(places.filter(F.col("n") * HOT > every).select("token", F.lit(True).alias("hot")))  # fewer than HOT rows
    probes = scan.select("key", "n_words", F.explode(F.arrays_zip("tokens", "places")).alias("p")).select("key", "n_words", F.col("p.tokens").alias("token"), F.col("p.places").alias("at"))
    probes = probes.join(hot, "token", "left").withColumn("part", F.when(F.col("hot"), F.pmod(F.xxhash64("key", "at"), F.lit(PARTS))).otherwise(F.lit(0)))
    dealt = anchors.select("token", "place", "size").distinct().join(hot, "token", "left").withColumn("part", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(PARTS - 1))).otherwise(F.array(F.lit(0)))))
    met = probes.join(dealt.select("token", "part", "place", "size").hint("merge"), ["token", "part"]).withColumn("start", F.col("at") - F.col("place"))
    met = met.filter((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
    return met.select("key", "start", "size").distinct().groupBy("key").agg(F.collect_list(F.struct("start", "size")).alias("starts"))


def _found(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """key, doc_id, n_words, hits, items for every row of docs."""
    spark = docs.sparkSession
    owned = staged(item_windows(benchmark, window), "windows")
    sizes = sorted({min(r["size"], TOKEN) for r in owned.select("size").distinct().collect()})  # at most `window` rows
    tokens = staged(owned.select("words", "size", F.size("tokens").alias("n_tokens"), F.posexplode("tokens").alias("place", "token")).distinct(), "tokens")
    named = spark.sparkContext.broadcast(_bitmap(tokens))
    counts = _token_counts(docs, sizes, named)
    # a window with a token that no document holds is in none
    rarest = tokens.join(counts, "token").groupBy("words", "size", "n_tokens").agg(F.min(F.struct("n", "place", "token")).alias("a"), F.count("*").alias("met")).filter("met = n_tokens")
    anchors = staged(rarest.select("words", "size", "a.place", "a.token", "a.n"), "anchors")
    wanted = spark.sparkContext.broadcast(_bitmap(anchors))
    scan = staged(_scan(docs, sizes, wanted), "scan")
    named.destroy()
    wanted.destroy()
    starts = staged(_starts(scan, anchors), "starts")
    texts = sieve(_keyed(docs).select("key", "body"), "key", starts.select("key"))[0].join(joinable(starts, 10_000, otherwise="shuffle_hash"), "key")
    cut = staged(_words_at(texts), "candidates")
    discard(starts, tokens)

    known = owned.select("words", "size", "item_id").distinct()
    same = cut.join(joinable(staged(known.select("words", "size").distinct(), "known")), ["words", "size"], "left_semi")
    spans = same.groupBy("key").agg(F.array_sort(F.collect_set(F.struct(F.col("start").alias("first"), (F.col("start") + F.col("size")).alias("past")))).alias("hits"))
    items = same.select("key", "words", "size").distinct().join(known, ["words", "size"]).select("key", "item_id").distinct()
    items = items.groupBy("key").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    hits = staged(spans.join(items, "key"), "hits")
    discard(owned, anchors, cut)
    out = scan.select("key", "doc_id", "n_words").join(joinable(hits, 10_000), "key", "left")
    none = F.array().cast("array<struct<first: long, past: long>>")
    return out.select("key", "doc_id", "n_words", F.coalesce("hits", none).alias("hits"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """doc_id, n_words, hits (word spans of the windows that occur, sorted, ends exclusive) and items (their ids as strings, sorted).

    A row for each row of docs: null and empty texts have no words; null and repeated ids are rows like others; further
    columns are not looked at. An item without words or with a null id takes no part; equal ids are one item;
    items of equal text are all reported. Any size of benchmark takes three passes over docs; only texts with an anchor are
    shuffled, and only if there are many. No rows: no rows.
    """
    return _found(docs, benchmark, window).drop("key")


def covered(hits: str) -> Column:
    """Words in the union of an array of (first, past) spans sorted by first."""
    return F.expr(
        f"aggregate({hits}, named_struct('n', 0L, 'reach', 0L), "
        "(a, h) -> named_struct('n', a.n + greatest(0L, h.past - greatest(h.first, a.reach)), 'reach', greatest(a.reach, h.past)), a -> a.n)"
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = 10) -> DataFrame:
    """docs without those that hold a window of an item; rows (null, empty and repeated ones too) and columns of the others as they were."""
    gone = staged(_found(docs, benchmark, window).filter(F.size("hits") > 0).select("key").distinct(), "contaminated")
    key = fresh(docs, "_row")
    return without(docs.withColumn(key, row_key(docs)), key, gone).drop(key)
