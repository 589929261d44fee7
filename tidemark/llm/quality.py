"""Quality: zstandard dictionaries of good and bad text, their sizes compared and calibrated."""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.llm.labelled import Sample, train

PIECE = 1024  # bytes compressed at once, so that a dictionary counts in all of a long text


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    raw: bool  # the dictionaries are plain text, as there was too little to train on
    slope: float
    offset: float
    level: int = 3

    def compressors(self) -> tuple[zstandard.ZstdCompressor, ...]:
        kind = zstandard.DICT_TYPE_RAWCONTENT if self.raw else zstandard.DICT_TYPE_FULLDICT
        made = []
        for data in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(data, dict_type=kind)
            d.precompute_compress(level=self.level)
            made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return tuple(made)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * x + self.offset, -40, 40)))


def difference(texts: list[bytes], good: zstandard.ZstdCompressor, bad: zstandard.ZstdCompressor) -> np.ndarray:
    """(size with the bad dictionary - size with the good one) / bytes; 0 for an empty text."""
    out = np.zeros(len(texts))
    for i, t in enumerate(texts):
        d = 0
        for at in range(0, len(t), PIECE):
            piece = t[at : at + PIECE]
            d += len(bad.compress(piece)) - len(good.compress(piece))
        if t:
            out[i] = d / len(t)
    return out


def _platt(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic fit by Newton's method, with a slight ridge."""
    scale = float(x.std()) or 1.0
    z, w = np.stack([x / scale, np.ones_like(x)], 1), np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        grad = z.T @ (weight * (p - y)) + 1e-3 * w
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _dictionary(texts: list[bytes], size: int) -> tuple[bytes, bool]:
    pieces = [t[a : a + PIECE] for t in texts for a in range(0, len(t), PIECE)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes(), False
    except zstandard.ZstdError:  # too few or too short samples
        return b"".join(pieces)[-size:], True


def _pair(good: list[bytes], bad: list[bytes], size: int) -> QualityModel:
    """An uncalibrated model of both classes' texts."""
    (dg, raw_g), (db, raw_b) = _dictionary(good, size), _dictionary(bad, size)
    if raw_g != raw_b:  # compare like with like
        dg, db = b"".join(good)[-size:], b"".join(bad)[-size:]
    return QualityModel(dg, db, raw_g or raw_b, 0.0, 0.0)


def _fit_sample(got: Sample, size: int) -> QualityModel:
    (bad, n_bad), (good, n_good) = got[0], got[1]
    if not good or not bad:
        share = n_good / (n_good + n_bad) if n_good + n_bad else 0.5
        return QualityModel(b"", b"", True, 0.0, float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))))
    model = _pair(good, bad, size)
    x_good, x_bad = np.zeros(len(good)), np.zeros(len(bad))
    for half in (0, 1):  # each half is measured by dictionaries that have not seen it, where there are two texts
        other = _pair(good[1 - half :: 2] or good, bad[1 - half :: 2] or bad, size).compressors()
        x_good[half::2] = difference(good[half::2], *other)
        x_bad[half::2] = difference(bad[half::2], *other)
    y = np.repeat([1.0, 0.0], [len(good), len(bad)])
    weight = np.where(y == 1, n_good / len(good), n_bad / len(bad))
    slope, offset = _platt(np.concatenate([x_good, x_bad]), y, weight / weight.mean())
    return replace(model, slope=slope, offset=offset)


def train_quality(docs: DataFrame, labels: DataFrame, *, most: int = 3000, most_bytes: int = 64 << 20, size: int = 1 << 18) -> QualityModel:
    """Dictionaries from the sampled texts of each label; the calibration measures each half by dictionaries of the other.

    At most `most` whole texts a class are fetched, of about `most_bytes` together; a class with none (or empty tables) gives a
    constant score. Rows without id, text or label teach nothing; repeated rows teach once; further columns are not looked at.
    """
    return train(docs, labels, "quality", lambda got: _fit_sample(got, size), most={0: most, 1: most}, most_bytes=most_bytes)


def quality_score(model: QualityModel, text: Column) -> Column:
    """Score (0 to 1) of whole texts; null counts as empty, equal texts score equally, and a text's length is not bounded."""
    kept: list = []

    @F.arrow_udf(DoubleType())
    def score(bodies: pa.Array) -> pa.Array:
        if not model.good and not model.bad:
            return pa.array(model.score(np.zeros(len(bodies))))
        if not kept:
            kept.append(model.compressors())
        return pa.array(model.score(difference([b.as_py() or b"" for b in bodies], *kept[0])))

    return score(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))


def score_quality(docs: DataFrame, model: QualityModel, column: str = "quality_score") -> DataFrame:
    """docs with one more column, the score of each whole text (null and empty texts: that of a zero difference)."""
    return docs.withColumn(column, quality_score(model, F.col("text")))
