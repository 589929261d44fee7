"""Token counts: an exact histogram of encoded lengths answers every context limit."""

from __future__ import annotations

import base64
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: GPT-2's published splitting rule; fixed value.
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


#: White space as the splitting rule means it; fixed value.
_BLANK = "[\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
LONG = 100_000  # blanks in a row that the splitter can't take at once


def count_tokens(encoding, text: str, long: int = LONG) -> int:
    """Tokens of a text. Very long runs of blanks are cut where the splitting rule cuts them, as the splitter's stack is bounded.

    The rule takes a run up to its last blank, which goes on with the next word; at the text's end it takes all.
    """
    if len(text) < long:
        return len(encoding.encode_ordinary(text))
    n, at = 0, 0
    for m in re.finditer(f"{_BLANK}{{{long},}}", text):
        a, b = m.span()
        b -= b < len(text)
        n += len(encoding.encode_ordinary(text[at:a])) + len(encoding._encode_single_piece(text[a:b]))
        at = b
    return n + len(encoding.encode_ordinary(text[at:]))


def token_length(text: Column, vocabulary: bytes) -> Column:
    """Tokens of whole texts under a byte-pair vocabulary (lines of base64 and rank); null counts as empty.

    The vocabulary travels with the function, so executors need no file. Strings that
    look like special tokens are ordinary text.
    """
    kept: list = []

    @F.arrow_udf(LongType())
    def count(texts: pa.Array) -> pa.Array:
        import tiktoken

        if not kept:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in vocabulary.splitlines() if x)}
            kept.append(tiktoken.Encoding("histogram", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}))
        return pa.array([count_tokens(kept[0], t.as_py() or "") for t in texts], pa.int64())

    return count(F.coalesce(text.cast("string"), F.lit("")))


def length_histogram(docs: DataFrame, vocabulary: bytes) -> DataFrame:
    """(n_tokens, n_docs): how many documents encode to each length. Null and empty texts have 0 tokens."""
    lengths = docs.select(token_length(F.col("text"), vocabulary).alias("n_tokens"))
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """What every context limit n (each length that occurs) needs, from running sums over the histogram.

    docs_longer and tokens_longer: documents of more than n tokens and their tokens; tokens_truncated:
    tokens left when all are cut to n; tokens_dropped: the rest; quantile: share of documents of at most
    n tokens. The window has no partitions, but only one row for each distinct length.
    """
    up = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mass = F.col("n_tokens") * F.col("n_docs")
    docs_to, tokens_to = F.sum("n_docs").over(up), F.sum(mass).over(up)
    docs_all, tokens_all = F.sum("n_docs").over(every), F.sum(mass).over(every)
    longer, tokens_longer = docs_all - docs_to, tokens_all - tokens_to
    cut = tokens_to + longer * F.col("n_tokens")
    return histogram.select(
        "n_tokens",
        "n_docs",
        longer.alias("docs_longer"),
        tokens_longer.alias("tokens_longer"),
        cut.alias("tokens_truncated"),
        (tokens_all - cut).alias("tokens_dropped"),
        (docs_to / docs_all).alias("quantile"),
    )


def truncated_total(histogram: DataFrame, limit: int) -> DataFrame:
    """One row: documents, tokens, and tokens left when every document is cut to `limit` (zeros for an empty table)."""
    n, mass = F.col("n_docs"), F.col("n_tokens")
    return histogram.agg(
        F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
        F.coalesce(F.sum(n * mass), F.lit(0)).alias("tokens"),
        F.coalesce(F.sum(n * F.least(mass, F.lit(limit))), F.lit(0)).alias("tokens_truncated"),
    )


def length_quantile(histogram: DataFrame, share: float) -> DataFrame:
    """The least length that at least `share` of the documents do not exceed; no row for an empty table."""
    return suffix_sums(histogram).filter(F.col("quantile") >= share).agg(F.min("n_tokens").alias("n_tokens")).dropna()
