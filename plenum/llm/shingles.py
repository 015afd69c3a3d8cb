"""Vectorised word shingles of a slice of texts (numpy, inside one task).

All texts of a slice are laid end to end in one byte buffer. Prefix sums of a
polynomial in the buffer position give a 64-bit hash of every word, then of
every run of ``size`` words, without a Python loop over words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .common import WORD_BYTES

_TABLE = np.frombuffer(WORD_BYTES, np.uint8)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    with np.errstate(over="ignore"):
        up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _ODD)]))
        down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, _INV)]))
    return up, down


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the multiplier and of its inverse modulo 2**64."""
    return _powers(max(20, int(n).bit_length()))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, first word of each text; one more entry than texts)."""
    # One separator byte ends each text, so words never run across texts.
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    buf = _TABLE[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)] if texts else np.empty(0, np.uint8)
    if not len(buf):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = buf != 0x20
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[0::2], edge[1::2]
    up, down = powers(len(buf) + 1)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(mix_byte(buf) * up[:len(buf)], out=acc[1:])
        h = mix((acc[end] - acc[start]) * down[start] + (end - start).astype(np.uint64))
    first = np.concatenate([np.zeros(1, np.int64), np.searchsorted(start, ends)])
    return h, first


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


def mix_byte(buf: np.ndarray) -> np.ndarray:
    return _BYTE[buf]


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (hashes sorted within a text, their
    counts, start of each text's part; one more entry than texts). A text of
    fewer than ``size`` words, but not none, is one shingle."""
    h, first = word_hashes(texts)
    n_words = np.diff(first)
    n_sh = np.where(n_words == 0, 0, np.maximum(1, n_words - size + 1))
    total = int(n_sh.sum())
    if not total:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    doc = np.repeat(np.arange(len(texts)), n_sh)
    off = np.concatenate([np.zeros(1, np.int64), np.cumsum(n_sh)])
    at = np.arange(total) - off[doc] + first[doc]
    length = np.minimum(size, n_words)[doc]
    up, down = powers(len(h) + 1)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(h * up[:len(h)], out=acc[1:])
        s = mix((acc[at + length] - acc[at]) * down[at] + length.astype(np.uint64))
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    new = np.ones(total, bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    begin = np.flatnonzero(new)
    counts = np.diff(np.append(begin, total))
    return s[begin], counts, np.searchsorted(doc[begin], np.arange(len(texts) + 1))
