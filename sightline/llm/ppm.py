"""Prediction by partial matching with frozen counts: byte contexts, escape method D, symbol exclusion.

A gram packs ``order`` context symbols and the coded symbol, nine bits each.  Symbols are the 256
bytes and END; START fills the contexts at the beginning of a text and is never coded.  Counts of
lower orders are sums over the longest contexts, so what a context has seen is a subset of what
its suffix has seen.  Excluding the symbols of the longer contexts is then a subtraction.
"""

from __future__ import annotations

import numpy as np

from .common import U64, Lookup

END, START, BITS = 256, 257, 9

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def gram_mask(length: int) -> np.uint64:
    return U64((1 << (BITS * length)) - 1)


def grams(data: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram of every byte and of the END of every row; the n + 1 offsets of the rows in it."""
    rows, step = len(off) - 1, order + 1
    symbols = np.full(len(data) + rows * step, START, U64)
    at = np.arange(rows) * step + order
    symbols[np.arange(len(data)) + np.repeat(at, np.diff(off))] = data
    symbols[off[1:] + at] = END
    keys = symbols.copy()
    for i in range(1, order + 1):
        keys[i:] |= symbols[:-i] << U64(BITS * i)
    keep = symbols != START
    return keys[keep], off + np.arange(rows + 1)


def counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    if not len(keys):
        return keys.astype(U64), counts.astype(np.int64)
    place = np.argsort(keys)
    keys = keys[place]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[place].astype(np.int64), first)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and how often each occurs."""
    keys = np.sort(keys)
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


class Level:
    """The trie's nodes at one context length: total, distinct symbols, and ``below``: what the
    suffix context counts for the symbols seen here."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, suffix: "Level | None", length: int):
        self.grams, self.counts = Lookup(keys), counts
        context = keys >> U64(BITS)
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(keys) else np.zeros(0, np.int64)
        self.contexts = Lookup(context[first])
        self.total = np.add.reduceat(counts, first) if len(keys) else counts
        self.kinds = np.diff(np.append(first, len(keys)))
        if suffix is not None and len(keys):
            self.below = np.add.reduceat(suffix.counts[suffix.grams.find(keys & gram_mask(length))], first)
        else:
            self.below = np.zeros(len(first), np.int64)


class Model:
    """Frozen counts of all orders up to ``order``; a trie held as one sorted table per order."""

    def __init__(self, order: int, keys: np.ndarray, counts: np.ndarray):
        self.order = order
        tables = [counted(keys, counts)]
        for length in range(order, 0, -1):
            k, n = tables[-1]
            tables.append(counted(k & gram_mask(length), n))
        self.levels: list[Level] = []
        for length, (k, n) in enumerate(reversed(tables)):
            self.levels.append(Level(k, n, self.levels[-1] if self.levels else None, length))

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """The code length of each gram's symbol after its context."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        less, fewer = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        for length in range(self.order, -1, -1):
            level = self.levels[length]
            gram = keys[left] & gram_mask(length + 1)
            node = level.contexts.find(gram >> U64(BITS))
            known = node >= 0
            node = np.where(known, node, 0)
            if not len(level.total):
                continue
            total = np.where(known, level.total[node] - less, 0).astype(float)
            kinds = np.where(known, level.kinds[node] - fewer, 0).astype(float)
            hit = level.grams.find(gram)
            found = hit >= 0
            out[left[found]] += np.log2(2 * total[found] / (2 * level.counts[hit[found]] - 1))
            escape = ~found & (kinds > 0)
            out[left[escape]] += np.log2(2 * total[escape] / kinds[escape])
            less = np.where(known, level.below[node], 0)[~found]
            fewer = np.where(known, level.kinds[node], 0)[~found]
            left = left[~found]
        if len(left):
            seen = int(self.levels[0].kinds.sum())
            out[left] += np.log2(max(1, END + 1 - seen))
        return out
