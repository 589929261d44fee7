"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import discard, staged

T = TypeVar("T")


def fold(column: str, folds: int):
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % F.lit(folds)


Sample = dict[int, tuple[list[bytes], int]]


def _chosen(docs: DataFrame, labels: DataFrame, label: str, most: dict[int, int], most_bytes: int) -> tuple[DataFrame, dict[int, int]]:
    """The sampled rows (at, doc_id, digest, mark, text), and how many rows carry each class."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("mark")).dropna()
    marks = marks.filter(F.col("mark").isin(list(most)))
    totals = {r["mark"]: r["n"] for r in marks.groupBy("mark").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null and octet_length(text) > 0")
    texts = texts.withColumn("digest", F.xxhash64("text"))
    sized = texts.select("doc_id", "digest", F.octet_length("text").alias("size")).join(marks, "doc_id").groupBy("mark", "doc_id", "digest").agg(F.min("size").alias("size"))
    order = [F.xxhash64(F.lit("sample"), "doc_id"), F.col("doc_id"), F.col("digest")]
    sized = staged(sized, "labelled")
    chosen = None
    for k, n in most.items():
        own = sized.filter(F.col("mark") == k).orderBy(*order).limit(n)
        before = F.sum("size").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))  # n rows at most
        own = own.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < most_bytes).select("mark", "doc_id", "digest")
        chosen = own if chosen is None else chosen.unionByName(own)
    chosen = staged(chosen, "chosen")
    discard(sized)
    rows = texts.join(F.broadcast(chosen), ["doc_id", "digest"]).groupBy("mark", "doc_id", "digest").agg(F.first("text").alias("text"))  # the chosen ids bound the rows
    return rows.select(order[0].alias("at"), "doc_id", "digest", "mark", F.col("text").cast("binary").alias("text")), totals


def train(docs: DataFrame, labels: DataFrame, label: str, fit: Callable[[Sample], T], *, most: dict[int, int], most_bytes: int = 64 << 20) -> T:
    """What `fit` makes of a bounded sample: for each class some whole texts, and how many rows carry the class.

    At most most[class] distinct texts a class are taken, and no more once those taken have `most_bytes` together; a
    text's length does not decide whether it is. Which are taken follows a hash of the id, so reruns agree. Null
    labels, ids and texts, empty texts and labels outside `most` take no part; rows that repeat an id and its text count
    once. The sample is read and the model made in one task of an executor; only the model comes to the driver.
    """
    rows, totals = _chosen(docs, labels, label, most, most_bytes)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[tuple[int, int, int, bytes]]] = {k: [] for k in most}
        for batch in batches:
            for at, doc_id, digest, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got[mark].append((at, doc_id, digest, text))
        model = fit({k: ([t for *_, t in sorted(got[k])], totals.get(k, 0)) for k in most})
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = rows.repartition(1).mapInArrow(make, "model binary").first()
    return pickle.loads(made["model"]) if made else fit({k: ([], totals.get(k, 0)) for k in most})  # pickled above


def sample(docs: DataFrame, labels: DataFrame, label: str, *, most: dict[int, int], most_bytes: int = 64 << 20) -> Sample:
    """The sample that train() fits on."""
    return train(docs, labels, label, dict, most=most, most_bytes=most_bytes)
