"""Toxicity: subword-bag embeddings, averaged, into a linear softmax; trained jointly in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.llm.labelled import Sample, train

BITS = 17
SIZES = (3, 4, 5)
BLOCK = 1 << 20
_SPACE = 32
_FOLD = np.array([b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else _SPACE for b in range(256)], np.uint8)
_FACTOR = np.array([0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1], np.uint32)


@dataclass(frozen=True)
class ToxicityModel:
    """value: each n-gram bucket's embedding times the difference of the two softmax rows; offset: of their biases."""

    value: np.ndarray
    offset: float


def grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n-gram length: the bucket of every n-gram, and where each text's begin (one more at the end).

    Letters are folded, all but letters, digits and non-ASCII bytes are blanks; an n-gram lies in one word
    and may take the blank on either side.
    """
    ends = np.cumsum([len(t) + 1 for t in texts])
    c = _FOLD[np.frombuffer(b" ".join([b"", *texts, b"    "]), np.uint8)]  # text i begins at ends[i - 1] + 1
    blanks = np.cumsum(c == _SPACE, dtype=np.int32)
    wide = c.astype(np.uint32) + np.uint32(1)
    n = int(ends[-1]) + 1
    h = wide[:n] * _FACTOR[0]
    h += (wide[1 : n + 1] ^ (h >> np.uint32(15))) * _FACTOR[1]
    for size in range(3, max(SIZES) + 1):
        h = (h ^ (h >> np.uint32(13))) * _FACTOR[size - 1] + wide[size - 1 : n + size - 1]
        if size not in SIZES:
            continue
        inner = blanks[size - 2 : n + size - 2] - blanks[:n]  # blanks strictly inside the n-gram
        at = np.flatnonzero(inner == 0)
        g = h[at]
        g *= np.uint32(0x9E3779B1)
        yield g >> np.uint32(32 - BITS), np.searchsorted(at, np.concatenate([[0], ends]))


def averages(texts: list[bytes], value: np.ndarray) -> np.ndarray:
    """Mean of `value` over the n-grams of each text; 0 where there is none."""
    total, count = np.zeros(len(texts)), np.zeros(len(texts))
    for bucket, first in grams(texts):
        run = np.concatenate([[0.0], np.cumsum(value[bucket], dtype=np.float64)])
        total += run[first[1:]] - run[first[:-1]]
        count += np.diff(first)
    return total / np.maximum(count, 1)


def _bags(texts: list[bytes], together: int = 64) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text and their shares. Texts share large arrays, which go back to the system when freed."""
    bags = []
    for lo in range(0, len(texts), together):
        own = [np.unique(np.concatenate([b for b, _ in grams([t])]), return_counts=True) for t in texts[lo : lo + together]]
        ids = np.concatenate([i for i, _ in own]).astype(np.int32)
        share = np.concatenate([n / max(1, n.sum()) for _, n in own]).astype(np.float32)
        ends = np.cumsum([0, *[len(i) for i, _ in own]])
        bags += [(ids[a:b], share[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return bags


def fit(texts: list[bytes], y: np.ndarray, weight: np.ndarray, *, dim: int = 8, epochs: int = 16, batch: int = 32, rate: float = 1.5, doubt: float = 32.0, decay: float = 3e-4, seed: int = 5) -> ToxicityModel:
    """Adagrad over bags of n-grams: embeddings and softmax rows move together.

    Every bucket of the texts is learnt. It weighs d / (d + doubt), where d is the squared difference of its shares of the two
    classes' texts over that difference's variance: what both classes hold alike hardly moves the mean of a long text, however
    frequent, and what one class holds counts by how sure that is. Each step also shrinks the embeddings it moves by `decay`.
    """
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.1, (1 << BITS, dim)).astype(np.float32)
    out, bias = rng.normal(0, 1.0, (2, dim)).astype(np.float32), np.zeros(2, np.float32)
    g_emb, g_out, g_bias = np.full(1 << BITS, 1e-8, np.float32), np.full_like(out, 1e-8), np.full_like(bias, 1e-8)
    bags = _bags(texts)
    n, p = [], []
    for k in (0, 1):
        own = [ids for (ids, _), mark in zip(bags, y, strict=True) if mark == k]
        held = np.bincount(np.concatenate(own), minlength=1 << BITS) if own else np.zeros(1 << BITS)
        n.append(max(1, len(own)))
        p.append((held + 0.5) / (len(own) + 1))
    sure = (p[1] - p[0]) ** 2 / (p[0] * (1 - p[0]) / n[0] + p[1] * (1 - p[1]) / n[1])
    weigh = (sure / (sure + doubt)).astype(np.float32)
    bags = [(ids, share * weigh[ids]) for ids, share in bags]
    target = np.stack([1 - y, y], 1).astype(np.float32)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            pick = [i for i in order[lo : lo + batch] if len(bags[i][0])]
            if not pick:
                continue
            ids = np.concatenate([bags[i][0] for i in pick])
            share = np.concatenate([bags[i][1] for i in pick])
            first = np.concatenate([[0], np.cumsum([len(bags[i][0]) for i in pick])[:-1]])
            mean = np.add.reduceat(emb[ids] * share[:, None], first, axis=0)
            logit = mean @ out.T + bias
            logit -= logit.max(1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(1, keepdims=True)
            err = (p - target[pick]) * weight[pick][:, None].astype(np.float32) / len(pick)
            d_mean = err @ out
            d_out, d_bias = err.T @ mean, err.sum(0)
            owner = np.repeat(np.arange(len(pick)), np.diff(np.append(first, len(ids))))
            step = d_mean[owner] * share[:, None]
            uniq, inverse = np.unique(ids, return_inverse=True)
            grad = np.stack([np.bincount(inverse, step[:, k], len(uniq)) for k in range(dim)], 1).astype(np.float32)
            g_emb[uniq] += (grad**2).mean(1)
            emb[uniq] = (1 - decay) * (emb[uniq] - rate * grad / np.sqrt(g_emb[uniq])[:, None])
            g_out += d_out**2
            out -= rate * 0.25 * d_out / np.sqrt(g_out)
            g_bias += d_bias**2
            bias -= rate * 0.25 * d_bias / np.sqrt(g_bias)
    value = weigh * (emb @ (out[1] - out[0]))
    return ToxicityModel(value.astype(np.float32), float(bias[1] - bias[0]))


def _fit_sample(got: Sample) -> ToxicityModel:
    (clean, n_clean), (toxic, n_toxic) = got[0], got[1]
    if not clean or not toxic:
        share = (n_toxic + 0.5) / (n_toxic + n_clean + 1)
        return ToxicityModel(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    y = np.array([0.0] * len(clean) + [1.0] * len(toxic))
    weight = np.where(y == 1, n_toxic / len(toxic), n_clean / len(clean))
    return fit(clean + toxic, y, weight / weight.mean())


def train_toxicity(docs: DataFrame, labels: DataFrame, *, most: int = 1500, most_bytes: int = 64 << 20) -> ToxicityModel:
    """Fit on whole texts: at most `most` toxic and 1.5 times as many clean ones, each class of about `most_bytes`, weighted to the labels' shares.

    With one class or none among the labels, or with empty tables, the score is constant. Rows without id, text or
    label teach nothing; repeated rows teach once; further columns are not looked at.
    """
    return train(docs, labels, "toxic", _fit_sample, most={0: most * 3 // 2, 1: most}, most_bytes=most_bytes)


def scores(texts: list[bytes], model: ToxicityModel) -> np.ndarray:
    out, lo, size = np.empty(len(texts)), 0, 0
    for i, t in enumerate(texts):  # blocks of about BLOCK bytes bound the memory
        size += len(t)
        if size >= BLOCK or i == len(texts) - 1:
            out[lo : i + 1] = averages(texts[lo : i + 1], model.value) + model.offset
            lo, size = i + 1, 0
    return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def toxicity_score(model: ToxicityModel, text: Column) -> Column:
    """Probability that a whole text is toxic; null counts as empty, equal texts score equally, and a text's length is not bounded."""

    @F.arrow_udf(DoubleType())
    def score(bodies: pa.Array) -> pa.Array:
        return pa.array(scores([b.as_py() or b"" for b in bodies], model), pa.float64())

    return score(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def score_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "toxicity_score") -> DataFrame:
    """docs with one more column, the score of each whole text."""
    return docs.withColumn(column, toxicity_score(model, F.col("text")))
