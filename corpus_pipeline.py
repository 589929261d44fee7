"""From raw documents to a mix: five stages, each written and read again before the next.

The stages are operators of tidemark.llm with their production parameters. In all of them null and repeated ids
and repeated rows are rows like others, very long texts are read whole, no rows give no rows, and columns keep their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, mixing, neardup, secrets, toxicity
from tidemark.llm.common import discard, read_table, staged
from tidemark.session import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below one half. The model learns from the labelled rows of `docs`.

    Null and empty texts have the score of the model's offset, as if no word spoke either way; without labels of both classes all have one score.
    """
    model = toxicity.train_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity_score(model, F.col("text")) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8 or more.

    Of a group the smallest id stays; null and empty texts and null ids stay; rows of one id stay or go together.
    """
    return neardup.drop_near_duplicates(docs, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item. Null and empty texts stay."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in the place of each secret; null and empty texts stay as they are."""
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many copies of each document the mix takes; null and empty texts have size 0, a null source is one of its own."""
    return mixing.mix_sources(docs)


def _shipped(stage: Stage) -> Stage:
    """The stage, once the executors have this package."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", _shipped(drop_toxic)),
    ("near_duplicates", _shipped(drop_near_duplicates)),
    ("decontamination", _shipped(drop_contaminated)),
    ("secrets", _shipped(redact_secrets)),
    ("mixing", _shipped(mix)),
]

#: A trained classifier decides the first stage, which SQL cannot express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, staged(stage(spark, docs, sf_dir), name)
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
