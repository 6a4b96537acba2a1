"""Words and their n-grams over whole Arrow batches, as hashes, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from .common import mix64, string_buffers

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes of a word that are hashed in vector steps; longer words are hashed one by one.
_SHORT = 32
_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + _rng.integers(0, 2, 256, np.uint64)
_KEYS = _rng.integers(0, 1 << 63, _SHORT // 8 + 1, np.uint64) * np.uint64(2) + np.uint64(1)
_FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
_STEPS = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        m = max(n, 1 << 20)
        for k, base in enumerate((_BASE, _INVERSE)):
            x = np.full(m, base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def prefix_hashes(b: np.ndarray) -> np.ndarray:
    """Sums whose differences hash substrings: hash of [s, e) = (p[e] - p[s]) * inverse^s. Good enough to choose minimizers by, not to tell texts apart."""
    pw, _ = powers(len(b) + 1)
    p = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_TABLE[b] * pw[: len(b)], out=p[1:])
    return p


def word_hashes(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: eight bytes at a time go through a keyed scrambler, so no structure of the bytes makes words collide."""
    size = end - start
    padded = np.concatenate([b, np.zeros(8, np.uint8)])
    at_byte = np.ndarray((len(b) + 1,), "<u8", padded.data, strides=(1,))
    acc = mix64(size.astype(np.uint64) * _KEYS[-1] + _BASE)
    live = np.flatnonzero(size <= _SHORT)
    for j in range(_SHORT // 8):
        live = live[size[live] > 8 * j]
        if not len(live):
            break
        chunk = at_byte[start[live] + 8 * j] & _FIRST_BYTES[np.minimum(size[live] - 8 * j, 8)]
        acc[live] = mix64((acc[live] ^ mix64(chunk + _KEYS[j])) + _KEYS[j + 1])
    long = np.flatnonzero(size > _SHORT)
    if len(long):
        raw = b.tobytes()
        acc[long] = [xxhash.xxh3_64_intdigest(raw[s:e], 977) for s, e in zip(start[long].tolist(), end[long].tolist())]
    return acc


class Words:
    """The words of a batch of texts: start and end bytes, document index, hash; first[i] to first[i + 1] are those of document i."""

    def __init__(self, col: pa.Array, lower: bool = False) -> None:
        self.off, self.bytes = string_buffers(col)
        b, off = (_LOWER[self.bytes] if lower else self.bytes), self.off
        n = len(b)
        solid = ~_SPACE[b]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        left = edge[:n].copy()
        left[1:] |= ~solid[:-1]
        right = edge[1:].copy()
        right[:-1] |= ~solid[1:]
        self.start = np.flatnonzero(solid & left)
        self.end = np.flatnonzero(solid & right) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)
        self.hash = word_hashes(b, self.start, self.end)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of every window of k words that lies in one document."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        acc = np.full(n, _STEPS[k], np.uint64)
        for j in range(k):
            acc += self.hash[j : j + n] * _STEPS[j]
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, mix64(acc[at])

    def whole(self, below: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, hash of the whole word sequence) of documents with 1 to below - 1 words."""
        docs = np.flatnonzero((self.count > 0) & (self.count < below))
        acc = _STEPS[self.count[docs]].copy()
        for j in range(below - 1):
            has = self.count[docs] > j
            acc[has] += self.hash[self.first[docs[has]] + j] * _STEPS[j]
        return docs, mix64(acc)


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash), sorted by both and distinct: the set of k-word shingles, or the whole sequence where there are fewer words."""
    at, h = w.grams(k)
    docs, short = w.whole(k)
    d, h = np.concatenate([w.doc[at], docs]), np.concatenate([h, short])
    order = np.lexsort((h, d))
    d, h = d[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (h[1:] != h[:-1])
    return d[new], h[new]
