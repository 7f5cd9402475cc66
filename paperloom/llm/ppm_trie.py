"""Prediction by partial matching over bytes: the part of the trie that one slice of contexts holds, in numpy.

A context of order five and the byte after it make a 48-bit key, the most recent byte first:
``c1 c2 c3 c4 c5 s``. Shorter contexts of the same position are prefixes of it, so keys that agree in c1 and c2 hold
all counts of the orders 5 to 2 below that pair, and orders 1 and 0 come from a table of 256 x 256 byte pairs. Below a
frequent pair the keys are cut by c3 as well, below a frequent c1 c2 c3 by c4, and so on; what has been counted after these
frequent contexts, a bounded number of them, comes from a table too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ORDER, LOW = 5, 2
END = 10  # the byte that ends a document and stands before it; white space inside it is one blank
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def stream(text: bytes) -> bytes:
    """A-Z lower-cased words with one blank between them and the end byte."""
    return b" ".join(text.translate(LOWER_BYTES).split()) + b"\n"


def keys_of(bodies: list[bytes], before: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The key of every byte of the bodies, in order, and the number of bytes of each; ``before`` are the ORDER bytes
    that stand before each."""
    raw = np.frombuffer(b"".join(x for pair in zip(before, bodies, strict=True) for x in pair), np.uint8)
    sizes = np.array([len(b) for b in bodies], np.int64)
    inside = np.ones(raw.size, bool)
    first = np.cumsum(sizes + ORDER) - sizes - ORDER
    inside[(first[:, None] + np.arange(ORDER)).ravel()] = False
    at = np.flatnonzero(inside)
    wide = raw.astype(np.int64)
    key = wide[at]
    for back in range(1, ORDER + 1):
        key |= wide[at - back] << (8 * (ORDER + 1 - back))
    return key, sizes


def pairs_of(keys: np.ndarray) -> np.ndarray:
    """Counts of (most recent byte, byte) as one number each."""
    return np.bincount(((keys >> 40) << 8) | (keys & 255), minlength=1 << 16)


class Frequent:
    """Contexts of the orders LOW to ORDER that are too frequent for one slice; those of each order extend those of the one before."""

    def __init__(self, contexts: dict[int, np.ndarray] | None = None):
        self.contexts: dict[int, np.ndarray] = {}
        self.steps: dict[int, np.ndarray] = {}  # (number of the context one shorter) x 256 bytes -> number of the context, or -1
        before = np.zeros(1, np.int64)
        for j in range(LOW, ORDER + 1):
            mine = np.unique(np.asarray((contexts or {}).get(j, ()), np.int64))
            width = 8 * LOW if j == LOW else 8
            parent = np.minimum(np.searchsorted(before, mine >> width), max(0, before.size - 1))
            known = before[parent] == mine >> width if before.size else np.zeros(mine.size, bool)
            mine, parent = mine[known], parent[known]
            step = np.full(before.size << width, -1, np.int32)
            step[(parent << width) + (mine & ((1 << width) - 1))] = np.arange(mine.size)
            self.contexts[j], self.steps[j], before = mine, step, mine

    def walk(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each order: (order, places of the keys whose context of that order is frequent, its number)."""
        at, node = np.arange(keys.size), np.zeros(keys.size, np.int64)
        for j in range(LOW, ORDER + 1):
            width = 8 * LOW if j == LOW else 8
            if not self.contexts[j].size:
                return
            node = self.steps[j][(node << width) + ((keys[at] >> (8 * (ORDER + 1 - j))) & ((1 << width) - 1))].astype(np.int64)
            at, node = at[node >= 0], node[node >= 0]
            yield j, at, node

    def depths(self, keys: np.ndarray) -> np.ndarray:
        """How many leading bytes decide a key's slice: one more than its longest frequent context has, LOW at the least."""
        out = np.full(keys.size, LOW, np.int64)
        for j, at, _ in self.walk(keys):
            out[at] = j + 1
        return out

    def counts(self, keys: np.ndarray) -> dict[int, np.ndarray]:
        """How often each byte follows each frequent context: for each order an array (contexts x 256)."""
        return {j: np.bincount((node << 8) | (keys[at] & 255), minlength=self.contexts[j].size << 8) for j, at, node in self.walk(keys)}


def slice_of(keys: np.ndarray, slices: int, frequent: Frequent) -> np.ndarray:
    """Which slice holds a key: decided by its leading bytes alone, two or as many as ``frequent`` asks for."""
    depth = frequent.depths(keys)
    lead = (keys >> (8 * (ORDER + 1 - depth))).astype(np.uint64) + (depth.astype(np.uint64) << np.uint64(48))
    return ((lead * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % slices


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if keys.size else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(counts, new) if keys.size else counts


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    new = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if keys.size else np.zeros(0, np.int64)
    return keys[new], np.diff(new, append=keys.size)


class _Level:
    """Counts of one order: of grams (context and byte) and of contexts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, order: int, depth: np.ndarray, frequent: Frequent, followed: dict[int, np.ndarray]):
        seen = (counts > 0) & (depth <= order)
        self.shift = 8 * (ORDER - order)
        grams, sums = self.gram(keys[seen]), counts[seen]
        if order in followed:  # the slice has only a part of what follows these contexts
            wanted = np.unique(keys[depth > order] >> (8 + self.shift))
            number = np.searchsorted(frequent.contexts[order], wanted)
            table = followed[order].reshape(-1, 256)[number]
            row, byte = np.nonzero(table)
            grams, sums = np.concatenate((grams, (wanted[row] << 8) | byte)), np.concatenate((sums, table[row, byte]))
        self.grams, self.gram_counts = summed(grams, sums)
        contexts = self.grams >> 8
        new = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if contexts.size else np.zeros(0, np.int64)
        self.contexts, self.distinct = contexts[new], np.diff(new, append=contexts.size)
        self.totals = np.add.reduceat(self.gram_counts, new) if contexts.size else new
        self.starts = new
        self.lower = np.zeros(new.size, np.int64)

    def gram(self, keys: np.ndarray) -> np.ndarray:
        return ((keys >> (8 + self.shift)) << 8) | (keys & 255)

    @staticmethod
    def find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Places in a sorted table, -1 where a value is missing."""
        if not table.size:
            return np.full(values.size, -1, np.int64)
        at = np.minimum(np.searchsorted(table, values), table.size - 1)
        return np.where(table[at] == values, at, -1)

    def sum_below(self, counts: np.ndarray) -> None:
        """lower: over the bytes seen in each context, the sum of their counts in the context one shorter."""
        self.lower = np.add.reduceat(counts, self.starts) if self.starts.size else self.starts


def log10_probabilities(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, frequent: Frequent, followed: dict[int, np.ndarray]) -> np.ndarray:
    """log10 of the probability of each key's byte after its context. ``keys`` distinct and sorted, with training counts.

    ``pairs[c1, s]`` are the training counts of byte pairs, ``followed`` those of ``frequent`` contexts. Of twice the times
    that a context has been followed, each byte gets twice its own times less one, and the escape gets those ones. Bytes
    seen in a longer context are excluded from the shorter ones; bytes never seen share the rest evenly.
    """
    depth = frequent.depths(keys)
    levels = {j: _Level(keys, counts, j, depth, frequent, followed) for j in range(ORDER, LOW - 1, -1)}
    for j in range(ORDER, LOW, -1):
        below = levels[j - 1]
        levels[j].sum_below(below.gram_counts[_Level.find(below.grams, ((levels[j].grams >> 16) << 8) | (levels[j].grams & 255))])
    low = levels[LOW]
    low.sum_below(pairs[(low.grams >> 16) & 255 if LOW == 2 else 0, low.grams & 255])
    out = np.zeros(keys.size)
    open_ = np.arange(keys.size)
    out_n, out_d = np.zeros(keys.size, np.int64), np.zeros(keys.size, np.int64)  # excluded: counts and bytes
    for j in range(ORDER, LOW - 1, -1):
        level = levels[j]
        k = keys[open_]
        context = _Level.find(level.contexts, k >> (8 + level.shift))
        gram = _Level.find(level.grams, level.gram(k))
        open_, out_n, out_d = _step(
            out, open_, out_n, out_d, context >= 0, level.totals[context] if level.totals.size else context, level.distinct[context] if level.distinct.size else context,
            np.where(gram >= 0, level.gram_counts[gram] if level.grams.size else 0, 0), level.lower[context] if level.lower.size else context,
        )
    singles = pairs.sum(0)
    k = keys[open_]
    recent, byte = k >> 40, k & 255
    totals, kinds = pairs.sum(1), (pairs > 0).sum(1)
    lower = ((pairs > 0) * singles).sum(1)
    open_, out_n, out_d = _step(out, open_, out_n, out_d, totals[recent] > 0, totals[recent], kinds[recent], pairs[recent, byte], lower[recent])
    byte = keys[open_] & 255
    all_, seen = singles.sum(), (singles > 0).sum()
    open_, _, _ = _step(out, open_, out_n, out_d, np.full(open_.size, all_ > 0), np.full(open_.size, all_), np.full(open_.size, seen), singles[byte], np.zeros(open_.size, np.int64))
    out[open_] -= np.log10(max(1, 256 - seen))
    return out


def _step(out, open_, out_n, out_d, exists, total, kinds, count, lower):
    """One order: settle the bytes that it has seen, charge the others the escape. Returns who is left and what is excluded for them."""
    n, d = np.where(exists, total - out_n, 0), np.where(exists, kinds - out_d, 0)
    some = exists & (d > 0)
    found = some & (count > 0)
    weight = np.where(found, 2 * count - 1, np.where(some, d, 1))
    out[open_] += np.log10(weight) - np.log10(np.where(some, 2 * n, 1))
    rest = ~found
    return open_[rest], np.where(exists, lower, 0)[rest], np.where(exists, kinds, 0)[rest]
