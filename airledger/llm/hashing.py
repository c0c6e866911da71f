"""Polynomial fingerprints of byte and word windows, computed with numpy inside tasks.

Words of more than ``SHORT_WORD`` bytes are named by XXH3 instead: modulo 2**64, long words can be
written whose polynomials agree whatever the multiplier. A window ``x[0..w)`` has the fingerprint ``sum(V[x[j]] * M**j) mod 2**64`` after a final mix.
Values and multiplier follow from a seed by a rule, so all tasks agree on them. Windows of
one array come from differences of prefix sums, one addition and two products each.
"""

from __future__ import annotations

import numpy as np
import xxhash

SHORT_WORD = 16
_GOLDEN = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """The usual xor-shift-multiply finaliser of 64-bit hashes; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN))
_M = int(BYTE_VALUES[77]) | 1
_WORD_SEED = int(BYTE_VALUES[211])
_M_INVERSE = pow(_M, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16) + (n >> 2)
        known = np.full(size, base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        _powers[base] = known
    return known[:n]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    sums = np.empty(len(values) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * _powers_of(_M, len(values)), out=sums[1:])
    return sums


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the spans ``[start, end)`` of the array that ``sums`` belongs to."""
    inverse = _powers_of(_M_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64))


def combine(*parts: np.ndarray) -> np.ndarray:
    """One hash of several, order counting."""
    out = np.uint64(0)
    for part in parts:
        out = mix((out ^ np.asarray(part, np.uint64)) + np.uint64(_GOLDEN))
    return out


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def words(
    data: np.ndarray, bounds: np.ndarray, space: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs without white space; documents, cut by ``bounds``, part them."""
    inside = ~(is_space(data) if space is None else space)
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    cut[1:] |= ~np.append(inside, False)[:-1]
    starts = np.flatnonzero(inside & cut[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[bounds] = True
    after[:-1] |= ~inside
    return starts, np.flatnonzero(inside & after[1:]) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words, some hundred thousand at a time."""
    out = np.empty(len(starts), np.uint64)
    for lo in range(0, len(starts), 1 << 18):
        s, e = starts[lo : lo + (1 << 18)], ends[lo : lo + (1 << 18)]
        sums = prefix_sums(BYTE_VALUES[data[s[0] : e[-1]]])
        out[lo : lo + len(s)] = spans(sums, s - s[0], e - s[0])
    for i in np.flatnonzero(ends - starts > SHORT_WORD):
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]], _WORD_SEED)
    return out


def window_hashes(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the byte windows at sorted ``starts``, a megabyte of text at a time."""
    out = np.empty(len(starts), np.uint64)
    for a in range(0, len(data), 1 << 20):
        lo, hi = np.searchsorted(starts, (a, a + (1 << 20)))
        if lo < hi:
            first, last = starts[lo], starts[hi - 1] + width
            s = starts[lo:hi] - first
            out[lo:hi] = spans(prefix_sums(BYTE_VALUES[data[first:last]]), s, s + width)
    return out


ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32
