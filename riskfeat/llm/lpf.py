"""Previous factors of a fixed length from suffix order.

Prefix doubling ranks all suffixes by their first 8, 16, ... bytes, up to
``length``; the ranks give the suffix order.  For every position the previous
and the next smaller position in suffix order are its best earlier matches: its
longest previous factor reaches ``length`` exactly when one of the two shares
its rank.
"""

from __future__ import annotations

import numpy as np


def ranks(data: np.ndarray, length: int) -> np.ndarray:
    """Rank of every position by its next ``length`` (8 or more) bytes, zeros after the end."""
    n = len(data)
    wide = np.zeros(n + 8, np.uint64)
    wide[:n] = data
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = key << np.uint64(8) | wide[k : k + n]
    r = np.unique(key, return_inverse=True)[1].astype(np.int64) + 1
    have = 8
    while have < length:
        step = min(have, length - have)
        later = np.zeros(n, np.int64)
        later[: max(0, n - step)] = r[step:]
        r = np.unique(r * (n + 2) + later, return_inverse=True)[1].astype(np.int64) + 1
        have += step
    return r


def previous_smaller(a: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value to the left of each value (-1: none)."""
    out = np.arange(len(a)) - 1
    todo = np.flatnonzero(out >= 0)
    while len(todo):
        todo = todo[a[out[todo]] > a[todo]]
        # all between a larger left value and its own pointer is larger still
        out[todo] = out[out[todo]]
        todo = todo[out[todo] >= 0]
    return out


def previous_factor(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start (rising), an earlier start with the same ``length`` bytes, or -1."""
    r = ranks(data, length)[starts]
    order = np.argsort(r, kind="stable")
    place, rank = starts[order], r[order]
    n = len(order)
    left = previous_smaller(place)
    right = n - 1 - previous_smaller(place[::-1])[::-1]
    out = np.full(n, -1, np.int64)
    for near in (left, right):
        ok = (near >= 0) & (near < n)
        ok[ok] = rank[near[ok]] == rank[ok]
        out[order[ok]] = place[near[ok]]
    return out
