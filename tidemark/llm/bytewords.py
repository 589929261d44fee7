"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a maximal run of word bytes. Every byte of a non-ASCII character is a
word byte in both alphabets below, so byte runs and character runs are the same.

A word's hash is two independent 64-bit numbers. Each takes the word eight bytes at a step through
a bijective, non-linear mix, so words of one length of up to eight bytes never collide, and no pattern
of letters makes longer ones collide; words over 256 bytes are hashed by BLAKE2b.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
_MIX = U64(0xD6E8FEB86659FD93)
#: start and factor of either hash
_LANES = ((U64(0x243F6A8885A308D3), U64(0x9FB21C651E98DF25)), (U64(0x13198A2E03707344), U64(0xC2B2AE3D27D4EB4F)))
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # the first k bytes of eight
_LONG = 256  # bytes


@dataclass(frozen=True)
class Alphabet:
    """is_word: of 256 bytes; folded: each byte as it counts, or None where all count as they are."""

    is_word: np.ndarray
    folded: np.ndarray | None


def _alphabet(separators: list[int], fold: bool) -> Alphabet:
    word = np.ones(256, bool)
    word[separators] = False
    folded = np.arange(256, dtype=np.uint8)
    folded[65:91] += 32
    return Alphabet(word, folded if fold else None)


_BLANKS = [0x20, *range(0x09, 0x0E)]
#: Runs of anything but ASCII blanks.
BLANK_SPLIT = _alphabet(_BLANKS, fold=False)
BLANK_SPLIT_FOLDED = _alphabet(_BLANKS, fold=True)
#: Runs of digits, letters and all non-ASCII characters; A-Z count as a-z.
ALNUM_FOLDED = _alphabet([b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)], fold=True)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = x ^ (x >> U64(32))
    x *= _MIX
    x ^= x >> U64(29)
    return x


def _lanes(key: int) -> list[tuple[np.uint64, np.uint64]]:
    """Start and factor of either hash under a key."""
    if not key:
        return list(_LANES)
    return [(mix(np.array([seed ^ U64(key)], np.uint64))[0], factor) for seed, factor in _LANES]


def _hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, key: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of every byte run."""
    size, lanes = end - start, _lanes(key)
    out = [mix(size.astype(np.uint64) * factor + seed) for seed, factor in lanes]
    eight = np.ndarray(len(buf) + 1, "<u8", np.concatenate([buf, np.zeros(8, np.uint8)]), strides=(1,))  # the eight bytes from each place on
    live, step = np.flatnonzero(size <= _LONG), 0
    while len(live):
        x = eight[start[live] + step] & _KEEP[np.minimum(size[live] - step, 8)]
        for h, (seed, factor) in zip(out, lanes, strict=True):
            h[live] = mix((h[live] ^ mix(x ^ seed)) * factor)
        step += 8
        live = live[size[live] > step]
    for i in np.flatnonzero(size > _LONG):
        digest = hashlib.blake2b(buf[start[i] : end[i]].tobytes(), digest_size=16, key=key.to_bytes(8, "little") if key else b"").digest()
        out[0][i], out[1][i] = np.frombuffer(digest, np.uint64)
    return out[0], out[1]


@dataclass
class Words:
    start: np.ndarray  # byte offsets in the block
    end: np.ndarray
    first: np.ndarray  # for each text its first word's number; one more at the end
    hashes: np.ndarray | None
    second: np.ndarray | None = None  # the other 64 bits of the hashes

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(buf: np.ndarray, offsets: np.ndarray, kind: Alphabet, hashed: bool = True, key: int = 0) -> Words:
    """All words of a block of texts (bytes and offsets, from 0). key: of the hashes, so that words can't be built to share them."""
    n = len(buf)
    inside = np.zeros(n + 1, bool)
    inside[:n] = kind.is_word[buf]
    edge = np.empty(n + 1, bool)
    edge[0] = inside[0]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:])
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    joined = np.unique(cut[inside[cut] & inside[cut - 1]])  # two texts meet within a run of word bytes
    at = np.flatnonzero(edge)
    if len(joined):
        at = np.sort(np.concatenate([at, joined, joined]), kind="stable")
    start, end = at[0::2], at[1::2]
    first = np.searchsorted(start, offsets, side="left")
    first[-1] = len(start)
    if not hashed:
        return Words(start, end, first, None)
    return Words(start, end, first, *_hashes(buf if kind.folded is None else kind.folded[buf], start, end, key))


def places(n: int) -> np.ndarray:
    """The factor of each place in a sequence of n words."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * U64(_GOLDEN)) | U64(1)


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every `size` consecutive words of the block; those across two texts are for the caller to skip.

    One of the words' two hashes gives 64 bits of the window, the other 64 more.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factor = places(size)
    out = hashes[:n] * factor[0]
    for k in range(1, size):
        out += hashes[k : k + n] * factor[k]
    return mix(out)


def windows_at(hashes: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """As windows(), of those that start at the given words alone."""
    factor = places(size)
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        out += hashes[at + k] * factor[k]
    return mix(out)


def whole(hashes: np.ndarray) -> np.uint64:
    """Hash of a sequence of fewer words than a window has."""
    n = len(hashes)
    return mix(np.array([np.sum(hashes * places(n), dtype=np.uint64) + U64(n)], np.uint64))[0]
