"""Word shingles as sorted 64-bit hashes, MinHash values, and the comparisons on them, in numpy."""

from __future__ import annotations

import math

import numpy as np

from paperloom.llm.text_stats import SPACE, Spans, mixed

WORDS = 5
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and how many each text has.

    Words are A-Z lower-cased runs of bytes other than 20 and 09-0D. A text of one to four words has one shingle, all
    its words; a text without words has none.
    """
    n = len(texts)
    edges = np.cumsum([0, *(len(t) + 1 for t in texts)])
    raw = LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    space = SPACE[raw]
    starts = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(~space & np.concatenate((space[1:], [True]))) + 1
    h = Spans(raw).hash(starts, ends)
    first = np.searchsorted(starts, edges)
    per = np.diff(first)
    document = np.repeat(np.arange(n), per)
    behind = first[1:][document] - np.arange(h.size)  # words from here to the end of the text
    width = np.minimum(per[document], words)
    at = np.flatnonzero(behind >= width)
    width = width[at]
    value = np.zeros(at.size, np.uint64)
    for k in range(words):
        here = width > k
        value[here] = mixed(value[here] + h[at[here] + k] + np.uint64(k))
    document = document[at]
    order = np.lexsort((value, document))
    value, document = value[order], document[order]
    new = np.ones(value.size, bool)
    new[1:] = (value[1:] != value[:-1]) | (document[1:] != document[:-1])
    return value[new], np.bincount(document[new], minlength=n)


def set_keys(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One 64-bit key for each set: equal sets, equal keys. Empty sets get 0."""
    out = np.zeros(sizes.size, np.int64)
    full = np.flatnonzero(sizes)
    if full.size:
        starts = (np.cumsum(sizes) - sizes)[full]
        sums = np.add.reduceat(mixed(values ^ np.uint64(0x5851F42D4C957F2D)), starts)
        out[full] = mixed(sums + sizes[full].astype(np.uint64)).astype(np.int64)
    return out


def minhashes(values: np.ndarray, sizes: np.ndarray, how_many: int, seed: int = 7) -> np.ndarray:
    """(sets x how_many) 64-bit MinHash values of the non-empty sets; rows of empty sets are 0."""
    r = np.random.default_rng(seed)
    xors, factors = r.integers(0, 1 << 63, how_many, dtype=np.uint64), r.integers(0, 1 << 63, how_many, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.zeros((sizes.size, how_many), np.uint64)
    full = np.flatnonzero(sizes)
    if full.size:
        starts = (np.cumsum(sizes) - sizes)[full]
        low = np.empty_like(values)
        for k in range(how_many):
            np.bitwise_xor(values, xors[k], out=low)
            np.multiply(low, factors[k], out=low)
            out[full, k] = np.minimum.reduceat(low, starts)
    return out


def least_matches(threshold: float, tolerance: float, steps: range) -> list[tuple[int, int]]:
    """(n, m): after n MinHash values a pair is dropped if fewer than m agree.

    With a uniform prior the similarity's posterior after m of n agreements is Beta(m + 1, n - m + 1); it reaches the
    threshold with the probability that n + 1 throws of a coin of that weight show heads at most m times.
    """
    table = []
    for n in steps:
        chance, m = 0.0, 0
        while True:
            chance += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if chance >= tolerance:
                break
            m += 1
        table.append((n, m))
    return table


def survivors(left: np.ndarray, right: np.ndarray, table: list[tuple[int, int]]) -> np.ndarray:
    """Which pairs of rows (8-bit MinHash values) survive all steps; each step looks only at the pairs still alive."""
    alive = np.arange(len(left))
    agree = np.zeros(len(left), np.int64)
    done = 0
    for n, least in table:
        agree = agree + (left[alive, done:n] == right[alive, done:n]).sum(1)
        keep = agree >= least
        alive, agree, done = alive[keep], agree[keep], n
        if not alive.size:
            break
    return alive


class Forest:
    """Union of numbered items."""

    def __init__(self, n: int):
        self.of = list(range(n))

    def find(self, x: int) -> int:
        while self.of[x] != x:
            self.of[x] = self.of[self.of[x]]
            x = self.of[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.of[max(a, b)] = min(a, b)

    def join_all(self, left: np.ndarray, right: np.ndarray) -> None:
        """Join left[i] and right[i]; only pairs of different trees are walked one by one."""
        root, n = self.roots(), len(self.of)
        x, y = root[left], root[right]
        for pair in np.unique((x * n + y)[x != y]).tolist():
            self.join(pair // n, pair % n)

    def roots(self) -> np.ndarray:
        return np.array([self.find(k) for k in range(len(self.of))], np.int64)


def surviving_groups(signatures: np.ndarray, table: list[tuple[int, int]]) -> np.ndarray:
    """Root of each row in the graph of surviving pairs; pairs that one group already holds need not be looked at.

    Each row in turn is compared with all rows that are not yet in its group, so no surviving pair between two groups
    is missed, while a group of copies costs one comparison per row.
    """
    n = len(signatures)
    forest = Forest(n)
    root = np.arange(n)
    for k in range(n):
        others = np.flatnonzero(root != root[k])
        others = others[others > k] if others.size else others
        if not others.size:
            continue
        hit = others[survivors(np.broadcast_to(signatures[k], (others.size, signatures.shape[1])), signatures[others], table)]
        if hit.size:
            groups = np.unique(root[hit])
            for g in groups.tolist():
                forest.join(int(root[k]), g)
            root[np.isin(root, np.append(groups, root[k]))] = forest.find(int(root[k]))
    return root


class Intersections:
    """Exact sizes of the intersections of sets, by bits over the shingles that two sets or more hold.

    The bits are held whole where they fit ``most`` words; otherwise they are built anew for each call, some shingles at a time.
    """

    def __init__(self, values: np.ndarray, sizes: np.ndarray, most: int = 1 << 22):
        _, code, counts = np.unique(values, return_inverse=True, return_counts=True)
        shared = counts >= 2
        held = shared[code]
        at = (np.cumsum(shared) - 1)[code[held]]
        order = np.argsort(at, kind="stable")
        self.at, self.owner = at[order], np.repeat(np.arange(sizes.size), sizes)[held][order]
        self.rows, self.most = sizes.size, most
        self.width = max(1, -(-int(shared.sum()) // 64))
        self.strip = min(self.width, max(1, most // max(1, sizes.size)))
        self.whole = self._bits(0) if self.strip == self.width else None

    def _bits(self, word: int) -> np.ndarray:
        """Words ``word`` to ``word + strip`` of every set."""
        a, b = np.searchsorted(self.at, (word * 64, (word + self.strip) * 64))
        bits = np.zeros((self.rows, self.strip), np.uint64)
        at = self.at[a:b] - word * 64
        np.bitwise_or.at(bits, (self.owner[a:b], at >> 6), np.uint64(1) << (at & 63).astype(np.uint64))
        return bits

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """How many shingles the sets left[i] and right[i] share."""
        out = np.zeros(left.size, np.int64)
        step = max(1, self.most // self.strip)
        for word in range(0, self.width, self.strip):
            bits = self._bits(word) if self.whole is None else self.whole
            for a in range(0, left.size, step):
                out[a : a + step] += np.bitwise_count(bits[left[a : a + step]] & bits[right[a : a + step]]).sum(1, dtype=np.int64)
        return out
