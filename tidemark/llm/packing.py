"""Vector bin packing of token sequences: tokens, segments and loss-bearing tokens are limited at once.

Examples are placed by the dot-product heuristic: of those that fit, the one whose demands point most where the open
sequence has room left. Each task packs its own rows from a pool of bounded size, so nothing is shuffled, and a task
that is run again makes the same sequences.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tokencount import _BLANK, LONG, SPLIT

#: Sequences a task may number.
PER_TASK = 1 << 40


@dataclass(frozen=True)
class Limits:
    """What a sequence holds at most: tokens, segments (pieces of examples), and tokens that bear loss."""

    tokens: int = 2048
    segments: int = 64
    loss: int = 2048


@dataclass
class Example:
    """ids: of the whole example; bears: which of them bear loss, None if all do."""

    key: object
    ids: np.ndarray
    bears: np.ndarray | None = None


@dataclass
class Piece:
    key: object
    start: int
    total: int
    ids: np.ndarray
    bears: np.ndarray | None

    @property
    def loss(self) -> int:
        return len(self.ids) if self.bears is None else int(self.bears.sum())

    def prefix(self, tokens: int, loss: int) -> int:
        """The most ids from the start within both bounds."""
        if self.bears is None:
            return min(tokens, loss, len(self.ids))
        return int(np.searchsorted(np.cumsum(self.bears[:tokens]), loss, side="right"))

    def cut(self, at: int) -> tuple[Piece, Piece]:
        bears = (None, None) if self.bears is None else (self.bears[:at], self.bears[at:])
        return Piece(self.key, self.start, self.total, self.ids[:at], bears[0]), Piece(self.key, self.start + at, self.total, self.ids[at:], bears[1])


class Packer:
    """Packs a stream of examples; sequences come as lists of pieces in their order.

    pool: pieces that wait for a place, which bounds memory. cut: whether a piece may be cut to fill a sequence that no
    whole piece fits; then a sequence that can't be filled is cut back to a power of two of tokens, which needs no
    padding, and at most `least` - 1 tokens of padding stay where a cut would be shorter than that. Without it only
    pieces that break the limits alone are cut, and sequences end as full as whole pieces make them.
    """

    def __init__(self, limits: Limits, *, pool: int = 1024, cut: bool = True, least: int = 8) -> None:
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("a sequence needs room for a token, a segment and a loss-bearing token")
        self.limits, self.most, self.may_cut, self.least = limits, pool, cut, least
        self.held: list[Piece] = []
        self.size = np.zeros(2 * pool + limits.segments + 2, np.int64)  # tokens of the pieces held
        self.loss = np.zeros_like(self.size)
        self.demand = np.zeros(2)  # tokens and loss of all pieces that were held, for the weights
        self.seen = 0

    def hold(self, piece: Piece) -> None:
        n = len(self.held)
        if n == len(self.size):
            self.size, self.loss = np.resize(self.size, 2 * n), np.resize(self.loss, 2 * n)
        self.held.append(piece)
        self.size[n], self.loss[n] = len(piece.ids), piece.loss

    def take(self, i: int) -> Piece:
        piece, last = self.held[i], self.held.pop()
        n = len(self.held)
        if i < n:
            self.held[i], self.size[i], self.loss[i] = last, self.size[n], self.loss[n]
        return piece

    def add(self, example: Example) -> Iterator[list[Piece]]:
        lim = self.limits
        rest = Piece(example.key, 0, len(example.ids), example.ids, example.bears)
        while len(rest.ids):
            own, rest = rest.cut(rest.prefix(lim.tokens, lim.loss))
            if len(own.ids) == lim.tokens:
                yield [own]
                continue
            own.ids = own.ids.copy()  # not a view that keeps a long example
            self.demand += len(own.ids), own.loss
            self.seen += 1
            self.hold(own)
        while len(self.held) > self.most:
            yield self.fill()

    def finish(self) -> Iterator[list[Piece]]:
        while self.held:
            yield self.fill()

    def fill(self) -> list[Piece]:
        """One sequence from the pieces held."""
        lim, out = self.limits, []
        tokens, segments, loss = lim.tokens, lim.segments, lim.loss
        weight = self.demand / max(1, self.seen) / (lim.tokens**2, lim.loss**2)  # mean demand, of demands and room as shares of the limits
        while tokens and segments and self.held:
            n = len(self.held)
            size, bears = self.size[:n], self.loss[:n]
            # every piece is one segment: that term is the same for all and decides nothing
            score = size * (weight[0] * tokens) + bears * (weight[1] * loss) + 1e-9 * size
            score[(size > tokens) | (bears > loss)] = -1.0
            best = int(np.argmax(score))
            if score[best] >= 0:
                piece = self.take(best)
            else:
                longest = int(np.argmax(size)) if self.may_cut else -1
                at = self.held[longest].prefix(tokens, loss) if self.may_cut and tokens >= self.least else 0
                if at < min(self.least, tokens):
                    break
                piece, rest = self.take(longest).cut(at)
                self.hold(rest)
            out.append(piece)
            tokens, segments, loss = tokens - len(piece.ids), segments - 1, loss - piece.loss
        return self.trim(out, lim.tokens - tokens) if self.may_cut and tokens >= self.least else out

    def trim(self, pieces: list[Piece], filled: int) -> list[Piece]:
        """Cut back to a power of two; what is cut off waits again."""
        over = filled - (1 << filled.bit_length() - 1)
        while over:
            piece = pieces.pop()
            if len(piece.ids) > over:
                keep, piece = piece.cut(len(piece.ids) - over)
                pieces.append(keep)
            over -= len(piece.ids)
            self.hold(piece)
        return pieces


Reader = Callable[[pa.RecordBatch], Iterator[Example]]


def _pack(rows: DataFrame, read: Reader, key: str, limits: Limits, payload: str, pool: int, cut: bool, least: int) -> DataFrame:
    kinds = {"ids": ("ids array<int>", pa.list_(pa.int32())), "crc32": ("ids_crc32 long", pa.int64())}
    schema = pa.schema([("key", pa.int64() if key == "long" else pa.string()), *[(c, pa.int64()) for c in ("start", "length", "n_loss", "total", "sequence_id", "offset")], (kinds[payload][0].split()[0], kinds[payload][1])])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base, out = Packer(limits, pool=pool, cut=cut, least=least), TaskContext.get().partitionId() * PER_TASK, []

        def sequences() -> Iterator[list[Piece]]:
            for batch in batches:
                for example in read(batch):
                    yield from packer.add(example)
            yield from packer.finish()

        def flush() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for n, pieces in enumerate(sequences()):
            at = 0
            for p in pieces:
                body = p.ids.astype(np.int32) if payload == "ids" else zlib.crc32(p.ids.astype("<u4").tobytes())
                out.append((p.key, p.start, len(p.ids), p.loss, p.total, base + n, at, body))
                at += len(p.ids)
            if len(out) >= 4096:
                yield flush()
                out.clear()
        if out:
            yield flush()

    return rows.mapInArrow(pack, f"key {key}, start long, length long, n_loss long, total long, sequence_id long, offset long, {kinds[payload][0]}")


def token_ids(encoding, text: str, long: int = LONG) -> np.ndarray:
    """Ids of a whole text. Very long runs of blanks are cut where the splitting rule cuts them, as in tokencount.count_tokens."""
    if len(text) < long:
        return encoding.encode_to_numpy(text, disallowed_special=())
    found, at = [], 0
    for m in re.finditer(f"{_BLANK}{{{long},}}", text):
        a, b = m.span()
        b -= b < len(text)
        found += [encoding.encode_to_numpy(text[at:a], disallowed_special=()), np.array(encoding._encode_single_piece(text[a:b]), np.uint32)]
        at = b
    return np.concatenate([*found, encoding.encode_to_numpy(text[at:], disallowed_special=())])


def pack_documents(docs: DataFrame, vocabulary: bytes, *, end_id: int = 1, limits: Limits = Limits(), payload: str = "ids", pool: int = 1024, cut: bool = True, least: int = 8) -> DataFrame:  # noqa: B008
    """Pieces of all documents: each document's ids, then end_id, cut and packed; every id bears loss.

    vocabulary: lines of base64 and rank, as in tokencount; strings that look like special tokens are ordinary text. Returns
    doc_id, start, length, n_loss, doc_tokens, sequence_id, offset, and ids, or with payload "crc32" their ids_crc32.
    A null or empty text is end_id alone; null and repeated ids and repeated rows are documents each; long texts are read
    whole; no rows give none; further columns are not looked at. Sequence ids have gaps between tasks.
    """

    def read(batch: pa.RecordBatch, kept: list = []) -> Iterator[Example]:  # noqa: B006  one encoding a worker
        import tiktoken

        if not kept:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in vocabulary.splitlines() if x)}
            kept.append(tiktoken.Encoding("packing", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}))
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            yield Example(doc_id.as_py(), np.append(token_ids(kept[0], text.as_py()), np.uint32(end_id)))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return _pack(rows, read, "long", limits, payload, pool, cut, least).withColumnsRenamed({"key": "doc_id", "total": "doc_tokens"})


def pack_examples(examples: DataFrame, *, key: str = "example_id", ids: str = "ids", bears: str | None = "bears", limits: Limits = Limits(), payload: str = "ids", pool: int = 1024, cut: bool = False, least: int = 8) -> DataFrame:  # noqa: B008
    """Pieces of examples that are tokenised already, as instruction data is: ids array<int>, bears array<boolean>.

    A place bears loss where `bears` is true; null, missing or short lists bear none there; bears=None: all bear. Returns example_id
    as a string, start, length, n_loss, example_tokens, sequence_id, offset and ids (or ids_crc32). Null and empty id lists
    have no pieces; null ids within a list are left out of it with their marks; null and repeated keys are examples each.
    """

    def read(batch: pa.RecordBatch) -> Iterator[Example]:
        for k, found, marks in zip(*batch.columns, strict=True):
            own = found.as_py() or []
            mark = (marks.as_py() or []) if bears else [True] * len(own)
            both = [(i, bool(m)) for i, m in zip(own, [*mark, *[False] * max(0, len(own) - len(mark))], strict=False) if i is not None]
            if both:
                yield Example(k.as_py(), np.array([i for i, _ in both], np.uint32), np.array([m for _, m in both], bool))

    marks: Column = F.col(bears) if bears else F.lit(None).cast("array<boolean>")
    rows = examples.select(F.col(key).cast("string").alias("k"), F.col(ids).cast("array<int>").alias("i"), marks.cast("array<boolean>").alias("b"))
    return _pack(rows, read, "string", limits, payload, pool, cut, least).withColumnsRenamed({"key": "example_id", "total": "example_tokens"})


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, segments): whole sequences for a trainer; segments has each id's segment, from 1. A sequence bounds its group."""
    order = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    out = pieces.groupBy("sequence_id").agg(order.alias("own"))
    segment = F.flatten(F.transform("own", lambda p, i: F.array_repeat(i + 1, F.size(p["ids"]))))
    return out.select("sequence_id", F.flatten(F.col("own.ids")).alias("ids"), segment.alias("segments"))
