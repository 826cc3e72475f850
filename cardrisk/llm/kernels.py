"""numpy kernels over the bytes of many texts at once.

Hashes are prefix sums modulo 2**64, so the hash of any span costs two
lookups; each is finished with a mixing function.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BYTE_BASE, WORD_BASE = 0xD6E8FEB86659FD93, 0xA0761D6478BD642F  # odd, so invertible modulo 2**64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        row = np.full(max(n, 1 << 20), base, U)
        row[0] = 1
        have = np.cumprod(row, dtype=U)
        if n <= 1 << 24:
            _POWERS[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> U(30))) * U(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> U(27))) * U(0x94D049BB133111EB)
    return z ^ (z >> U(31))


def prefix(values: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of ``values[i] * base**i`` (first entry 0)."""
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def span_hash(pre: np.ndarray, a: np.ndarray, b: np.ndarray, base: int) -> np.ndarray:
    """Hash of the values in ``[a, b)``, wherever they stand."""
    inv = powers(inverse(base), len(pre))
    return mix((pre[b] - pre[a]) * inv[a] + (b - a).astype(U) * U(0x9E3779B97F4A7C15))


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and each document's first word."""
    ink = ~SPACE[buf]
    before = np.zeros(len(buf), bool)
    before[1:] = ink[:-1]
    after = np.zeros(len(buf), bool)
    after[:-1] = ink[1:]
    edges = offs[1:-1]
    before[edges[edges < len(buf)]] = False
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(ink & ~before)
    return starts, np.flatnonzero(ink & ~after) + 1, np.searchsorted(starts, offs)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix(buf.astype(U) + U(1), BYTE_BASE), starts, ends, BYTE_BASE)


def row_of(first: np.ndarray) -> np.ndarray:
    """Document index of every word, from each document's first word."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word shingles and each document's first shingle.

    A document of fewer words (but one at least) has one shingle, its whole sequence.
    """
    pre = prefix(words, WORD_BASE)
    counts = np.diff(first)
    n = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    a = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], n)
    b = a + np.repeat(np.minimum(counts, k), n)
    return span_hash(pre, a, b, WORD_BASE), begin


def rightmost_minimum(h: np.ndarray, window: int) -> np.ndarray:
    """Index of the minimum of every ``window`` consecutive values, the rightmost of equals."""
    at, span = np.arange(len(h)), 1

    def merged(at: np.ndarray, step: int) -> np.ndarray:
        a, b = at[: len(at) - step], at[step:]
        return np.where(h[b] <= h[a], b, a)

    while span * 2 <= window:
        at, span = merged(at, span), span * 2
    return merged(at, window - span) if span < window else at
