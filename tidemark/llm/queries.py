"""The registered queries opN_<name>: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, importance, licenses, mixing, neardup, neighbours, packing, quality, secrets, substrings, tokencount, toxicity, trie
from tidemark.llm.common import read_table
from tidemark.llm.labelled import fold
from tidemark.llm.sql import ORACLES

Query = Callable[[SparkSession, str], DataFrame]


def _scored(docs: DataFrame, score, held_out) -> DataFrame:
    out = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by two dictionaries learnt from the labels that are not held out.

    Null and empty texts get the score of no difference; a null id is never held out; rows that repeat an id or a text each get a
    row and equal texts equal scores; long texts count whole; empty tables give no rows; further columns are not looked at.
    """
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.train_quality(docs, labels.filter(fold("doc_id", 3) != 1))
    return _scored(docs, quality.quality_score(model, F.col("text")), fold("doc_id", 3) == 1)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length histogram of all documents with its suffix sums, a row for each length that occurs.

    Null and empty texts have 0 tokens; ids are not looked at, so repeated rows count each; long texts count whole; no rows give none.
    """
    with open(tokencount.VOCABULARY, "rb") as f:  # a fixed file of the driver's
        vocabulary = f.read()
    return tokencount.suffix_sums(tokencount.length_histogram(read_table(spark, sf_dir, "documents"), vocabulary))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and detections of every document.

    Null and empty texts have no words, no places, empty labels and score 0; null and repeated ids and repeated rows each give a
    row; long texts are read whole; no rows give none; further columns are not looked at.
    """
    return licenses.license_report(licenses.scan_licenses(read_table(spark, sf_dir, "documents")))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near duplicates at 85%.

    Null, empty and blank texts are linked with nothing and kept; a null id has a null component and is kept; rows of one id are one
    document, each with a row; of a group the smallest id stays; long texts count whole; no rows give none.
    """
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of each whose id is divisible by 50.

    Null ids and null, empty, zero or non-finite vectors take no part; ties go by id; rows that repeat an id with another
    vector are candidates each; no rows give none; further columns are not looked at.
    """
    vectors = read_table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the windows of 20 words that start earlier too.

    Null and empty texts have no words; a null id loses nothing and is no earlier place; rows of one id are one document; ties go
    by id and start; long texts count whole; no rows give none; further columns are not looked at.
    """
    return substrings.repeated_spans(read_table(spark, sf_dir, "documents"), window=20).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document.

    Null and empty texts have none; null and repeated ids and repeated rows each give a row; spans of one start go by the order of
    kinds; long texts are read whole; no rows give none; further columns are not looked at.
    """
    return secrets.secret_report(read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model learnt from the labels that are not held out.

    Null and empty texts get the model's offset; a null id is never held out; repeated rows each get a row and equal texts equal
    scores; long texts count whole; empty tables give no rows; further columns are not looked at.
    """
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.train_toxicity(docs, labels.filter(fold("doc_id", 5) != 0))
    return _scored(docs, toxicity.toxicity_score(model, F.col("text")), fold("doc_id", 5) == 0)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of every document that stand in windows of benchmark items.

    Null and empty texts have no words; items without words or id take no part; null and repeated ids and repeated rows each give a
    row; long texts count whole; no rows give none; further columns are not looked at.
    """
    found = decontam.find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), window=10)
    n_hit = decontam.covered("hits")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes.

    Null and empty texts have size 0; a null source is one of its own; null and repeated ids and repeated rows are rows like others,
    ties between them go by a hash of the id; no rows give none; further columns are not looked at.
    """
    return mixing.mix_sources(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rate", "copies")


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens and 64 segments; all ids bear loss, so that limit is 2048 too.

    Null and empty texts are the end id alone; null and repeated ids and repeated rows are documents each; long texts are cut, not
    shortened; no rows give none; further columns are not looked at.
    """
    with open(tokencount.VOCABULARY, "rb") as f:  # a fixed file of the driver's
        vocabulary = f.read()
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), vocabulary, payload="crc32")
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five percent of the documents of at least 20 words, drawn towards the benchmark's n-grams.

    Null and empty texts have no features and weight 0; null and repeated ids and repeated rows are documents each, null ids rank last
    among ties; long texts count whole; no rows give none; further columns are not looked at.
    """
    drawn = importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), percent=5, least_words=20)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each rebuilt on the first turns of its hundred's first conversation.

    Null roles and texts are empty; null turns come first, ties go by a digest of role and text; rows without conv_id take no part;
    long texts count whole, repeated rows are turns each; no rows give none; further columns are not looked at.
    """
    return trie.prefix_trie(trie.share_heads(trie.conversation_turns(read_table(spark, sf_dir, "conversations"))))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_token_counts,
        op3_license_scan,
        op4_minhash_near_dedup,
        op5_nearest_neighbours,
        op6_substring_dedup,
        op7_secret_scan,
        op8_toxicity,
        op9_decontamination,
        op10_source_mixing,
        op11_vector_packing,
        op12_importance_resampling,
        op13_prefix_trie,
    )
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
