"""Suffix ranks by a difference cover of period 3, on numpy arrays.

Suffixes at places 1 and 2 modulo 3 are the sample. Their triples of symbols are sorted and named; while names repeat, the string of
names is ranked in the same way. Then the remaining suffixes are ordered by their first symbol and the rank of the sample behind it, and
merged: how many of the others are smaller is counted by binary search over keys that decide each pair of kinds.
"""

from __future__ import annotations

import numpy as np

#: Symbols and ranks of one call fit in so many bits.
BITS = 21
MOST = (1 << BITS) - 8


def suffix_ranks(text: np.ndarray, depth: int | None = None) -> np.ndarray:
    """For each suffix how many suffixes are smaller, plus 1.

    With a `depth`, suffixes that share so many symbols may have ranks in any order or equal ones, but none of another suffix lies between
    theirs. Symbols are 1 or more; the end counts as the smallest symbol.
    """
    n = len(text)
    if n > MOST:
        raise ValueError("text too long for one call")
    if depth is not None and depth <= 1:
        return np.searchsorted(np.sort(text), text) + 1
    if n <= 2:
        return _few(text)
    s = np.zeros(n + 4, np.int64)
    s[:n] = text
    extra = int(n % 3 == 1)  # then the end itself joins the sample, so each half of the names stops at an end symbol
    one, two, rest = np.arange(1, n + extra, 3), np.arange(2, n, 3), np.arange(0, n, 3)
    sample = np.concatenate([one, two])
    triple = (s[sample] << (2 * BITS)) | (s[sample + 1] << BITS) | s[sample + 2]
    names, name = np.unique(triple, return_inverse=True)
    if len(names) < len(sample) and (depth is None or depth > 3):
        name = suffix_ranks(name + 1, None if depth is None else -(-depth // 3)) - 1
    rank = np.zeros(n + 4, np.int64)  # of the sample; 0 past the end
    rank[sample] = name + 1
    less = np.zeros(n + 1, np.int64)
    below = np.cumsum(np.bincount(rank[sample]))
    less[sample] = below[rank[sample] - 1]
    for part, key in ((one, (s[one] << BITS) | rank[one + 1]), (two, (s[two] << (2 * BITS)) | (s[two + 1] << BITS) | rank[two + 2])):
        own = (s[rest] << BITS) | rank[rest + 1]
        if part is two:
            own = (s[rest] << (2 * BITS)) | (s[rest + 1] << BITS) | rank[rest + 2]
        by_key, by_own = np.argsort(key), np.argsort(own)
        key, own = key[by_key], own[by_own]  # in order, so that the searches run through memory once
        less[part[by_key]] += np.searchsorted(own, key)
        less[rest[by_own]] += np.searchsorted(key, own)
        if part is one:
            less[rest[by_own]] += np.searchsorted(own, own)
    return less[:n] + 1 - extra


def _few(text: np.ndarray) -> np.ndarray:
    tails = [tuple(text[i:]) for i in range(len(text))]
    return np.array([sum(t < x for t in tails) + 1 for x in tails], np.int64)
