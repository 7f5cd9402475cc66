"""Word, line and repetition statistics of a batch of UTF-8 texts, vectorised over its bytes."""

from __future__ import annotations

import numpy as np

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_upper", "n_lower", "n_digits", "n_marks", "n_punct", "n_wordless", "n_same_next", "n_distinct", "n_wide")
_table = lambda chars: np.isin(np.arange(256), np.frombuffer(chars, np.uint8))
SPACE, SYMBOL = _table(b"\x20\x09\x0a\x0b\x0c\x0d"), _table(b"#*$%&|<>")
UPPER, LOWER, DIGIT = _table(bytes(range(65, 91))), _table(bytes(range(97, 123))), _table(bytes(range(48, 58)))
MARK, PUNCT = _table(b"!"), _table(b".,;:?!-'\"()")
BASE, OTHER_BASE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Spans:
    """Hashes of any spans of one byte array, by powers of an odd base."""

    def __init__(self, raw: np.ndarray, base: np.uint64 = BASE):
        self.sums = np.zeros(raw.size + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(base, raw.size), dtype=np.uint64, out=self.sums[1:])
        self.inverse = powers(np.uint64(pow(int(base), -1, 1 << 64)), raw.size + 1)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))


def _per_doc(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.zeros(flags.size + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[edges[1:]] - sums[edges[:-1]]


def _first_and_again(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it stand at its first place, and does it occur twice or more."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    new = np.ones(k.size, bool)
    new[1:] = k[1:] != k[:-1]
    last = np.ones(k.size, bool)
    last[:-1] = new[1:]
    first, again = np.empty(k.size, bool), np.empty(k.size, bool)
    first[order], again[order] = new, ~(new & last)
    return first, again


def batch_stats(texts: list[bytes]) -> dict[str, np.ndarray]:
    """The statistics STATS and MORE, an int64 array each, with one number per text.

    Words are runs of bytes other than 20 and 09-0D; word_chars counts their code points; n_dup_lines counts lines with
    a word that equal an earlier line of the text; n_repeat_words counts the words inside three-word windows that occur
    twice or more in the text, the first occurrence included.
    """
    n = len(texts)
    edges = np.zeros(n + 1, np.int64)
    np.cumsum([len(x) + 1 for x in texts], out=edges[1:])  # each text ends with a line end of its own
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    space = SPACE[raw]
    doc = np.repeat(np.arange(n, dtype=np.uint64), np.diff(edges))
    spans = Spans(raw)
    out: dict[str, np.ndarray] = {}
    word = ~space
    starts = np.flatnonzero(word & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(word & np.concatenate((space[1:], [True]))) + 1
    word_edges = np.searchsorted(starts, edges)
    out["n_words"] = np.diff(word_edges)
    out["word_chars"] = _per_doc(word & ((raw & 0xC0) != 0x80), edges)
    for name, table in (("n_symbols", SYMBOL), ("n_upper", UPPER), ("n_lower", LOWER), ("n_digits", DIGIT), ("n_marks", MARK), ("n_punct", PUNCT)):
        out[name] = _per_doc(table[raw], edges)
    out["n_wide"] = _per_doc(raw >= 0xC0, edges)
    # lines
    line_ends = np.flatnonzero(raw == 10)
    line_starts = np.concatenate(([0], line_ends[:-1] + 1)) if line_ends.size else line_ends
    words_before = np.zeros(raw.size + 1, np.int64)
    np.cumsum(word, out=words_before[1:])
    has_word = words_before[line_ends] > words_before[line_starts]
    line_doc = doc[line_ends] if line_ends.size else doc[:0]
    first, _ = _first_and_again(mixed(spans.hash(line_starts, line_ends) + mixed(line_doc)))
    line_edges = np.searchsorted(line_ends, edges)
    out["n_lines"] = np.diff(line_edges)
    out["n_dup_lines"] = _per_doc(has_word & ~first, line_edges)
    # words and windows of three
    h = spans.hash(starts, ends)
    word_doc = doc[starts] if starts.size else doc[:0]
    first, _ = _first_and_again(mixed(h + mixed(word_doc)))
    out["n_distinct"] = _per_doc(first, word_edges)
    letters = np.zeros(raw.size + 1, np.int64)
    np.cumsum((UPPER | LOWER)[raw] | (raw >= 0x80), out=letters[1:])
    out["n_wordless"] = _per_doc(letters[ends] == letters[starts], word_edges)
    same = np.zeros(starts.size, bool)
    same[1:] = (h[1:] == h[:-1]) & (word_doc[1:] == word_doc[:-1])
    out["n_same_next"] = _per_doc(same, word_edges)
    covered = np.zeros(starts.size, bool)
    if starts.size >= 3:
        inside = word_doc[2:] == word_doc[:-2]
        at = np.flatnonzero(inside)
        window = mixed(h[at] * np.uint64(3) + mixed(h[at + 1] * np.uint64(5) + mixed(h[at + 2] * np.uint64(7) + mixed(word_doc[at]))))
        _, again = _first_and_again(window)
        at = at[again]
        covered[at] = covered[at + 1] = covered[at + 2] = True
    out["n_repeat_words"] = _per_doc(covered, word_edges)
    return out
