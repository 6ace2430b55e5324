"""Vectorised word and shingle hashes over a slice of texts.

A word is a maximal run of bytes other than space and \\t..\\r, after A-Z are
lower-cased. The hash of a word is a polynomial over its bytes (modulo 2**64,
each byte mapped to a fixed random 64-bit value), finished by an avalanche
step; prefix sums give all words of a slice at once.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_MASK = (1 << 64) - 1
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
BASE = 0x9E3779B97F4A7C15
_INV = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_pow = np.ones(1, U64)
_inv = np.ones(1, U64)


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, U64(base))
    p[0] = 1
    return np.multiply.accumulate(p)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64 (grown on demand)."""
    global _pow, _inv
    if len(_pow) < n:
        _pow, _inv = _powers(BASE, n + n // 4), _powers(_INV, n + n // 4)
    return _pow, _inv


def forget(most: int = 1 << 21) -> None:
    """Drop the powers if a long text made them many."""
    global _pow, _inv
    if len(_pow) > most:
        _pow, _inv = np.ones(1, U64), np.ones(1, U64)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit avalanche (two multiply-xorshift rounds)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of byte value * BASE**i; entry i covers data[:i]."""
    p, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTE[data] * p[:len(data)], out=out[1:])
    return out


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; words end at row borders."""
    n = len(data)
    if n == 0:
        e = np.empty(0, np.int64)
        return e, e, e
    word = ~SPACE[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | first[1:n]
    end = word.copy()
    end[:-1] &= ~word[1:] | first[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets, s, "right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """(hash, row, start, end) of every word of the slice."""
    if lower:
        data = LOWER[data]
    s, e, row = word_bounds(data, offsets)
    cum = prefix_hash(data)
    _, inv = powers(len(data) + 1)
    return mix((cum[e] - cum[s]) * inv[s]), row, s, e


def row_counts(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n).astype(np.int64)


def shingles(words: np.ndarray, row: np.ndarray, n_rows: int, k: int,
             short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every k-word shingle, in order.

    With ``short``, a row of 1 to k-1 words gives one shingle, its whole
    word sequence; otherwise it gives none.
    """
    n = len(words)
    c = mix(np.arange(1, k + 1, dtype=U64)) | U64(1)
    if n >= k:
        ok = row[:n - k + 1] == row[k - 1:]
        h = np.zeros(n - k + 1, U64)
        for i in range(k):
            h += words[i:n - k + 1 + i] * c[i]
        h, r = mix(h)[ok], row[:n - k + 1][ok]
    else:
        h, r = np.empty(0, U64), np.empty(0, np.int64)
    if not short:
        return h, r
    cnt = row_counts(row, n_rows)
    few = np.flatnonzero((cnt > 0) & (cnt < k))
    if len(few):
        first = np.cumsum(cnt) - cnt
        extra = np.zeros(len(few), U64)
        for i in range(k - 1):
            has = cnt[few] > i
            extra[has] += words[first[few[has]] + i] * c[i]
        extra = mix(extra + cnt[few].astype(U64) * U64(0x9FB21C651E98DF25))
        h, r = np.concatenate([h, extra]), np.concatenate([r, few])
        o = np.argsort(r, kind="stable")
        h, r = h[o], r[o]
    return h, r
