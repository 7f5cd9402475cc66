"""SentencePiece BPE encoding by a prefix table, and decoding.

For every prefix of a text there is exactly one piece that its encoding ends with. The table of these last pieces is
filled from left to right: an automaton gives the pieces that end at a position, and a piece is the last one if it is
compatible with the last piece of the prefix before it, that is if the two encode their own concatenation. The ids are
then read backwards from the end of the table. Work is linear in the text and needs no queue of merges.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import small_batches, text_or_empty

SPACE = "\u2581"
#: Units (a run of characters with the blanks before it) whose encodings a task remembers, and the longest that it remembers.
MOST_UNITS, LONGEST_UNIT = 200_000, 48


class PrefixTable:
    """Encoder and decoder of one BPE model file with byte fallback and no normalisation."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)  # only its vocabulary is read here
        size = model.get_piece_size()
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
        special = set(self.byte_ids.values())
        normal = [i for i in range(size) if i not in special and not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {i: model.id_to_piece(i).replace(SPACE, " ") for i in normal}
        self.ids = {p: i for i, p in self.pieces.items()}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.chars = {c for p in self.ids for c in p}
        if any(re.search(r"[^ ] ", p) for p in self.ids) or not all(c in self.ids for c in self.chars):
            raise ValueError("pieces may hold blanks only at their start, and every character of a piece must be a piece")
        self.matches = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.matches.add_word(p, (i, len(p)))
        self.matches.make_automaton()
        self.histories: dict[int, tuple] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.bytes_of = {i: p.encode() for i, p in self.pieces.items()} | {i: bytes((b,)) for b, i in self.byte_ids.items()}
        self.unit = re.compile(f" *(?:{self._runs()}.)| +", re.DOTALL)

    def _runs(self) -> str:
        """Alternatives of a pattern, one for each set of characters that stand side by side in some piece. No piece
        reaches from one set into another, so runs of a set encode independently."""
        of = {c: c for c in self.chars if c != " "}

        def root(c: str) -> str:
            while of[c] != c:
                of[c] = c = of[of[c]]
            return c

        for p in self.ids:
            for a, b in zip(p, p[1:], strict=False):
                if a != " ":
                    of[root(a)] = root(b)
        sets: dict[str, list[str]] = {}
        for c in sorted(of):
            sets.setdefault(root(c), []).append(c)
        # characters that stand alone are left to the dot, one by one
        return "".join(f"[{''.join(map(re.escape, x))}]+|" for x in sorted(sets.values(), key=len, reverse=True) if len(x) > 1)

    def _history(self, piece: int) -> tuple[list[float], list[str], list[str], bool]:
        """How a piece's own characters merge, best score first and leftmost of equals: the scores in order, the first and
        the last part before each merge and at the end, and whether one part is left."""
        found = self.histories.get(piece)
        if found is None:
            parts = list(self.pieces[piece])
            scores, firsts, lasts = [], [parts[0]], [parts[-1]]
            while True:
                best = max(((self.scores[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.scores), default=None)
                if best is None:
                    break
                k = -best[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                scores.append(best[0])
                firsts.append(parts[0])
                lasts.append(parts[-1])
            found = self.histories[piece] = (scores, firsts, lasts, len(parts) == 1)
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Do two pieces encode their own concatenation? Their own merges interleave by score; the pair falls apart as soon
        as the two parts at the border would merge before the next of these."""
        found = self.pairs.get((left, right))
        if found is None:
            found = self.pairs[left, right] = self._never_merge(left, right)
        return found

    def _never_merge(self, left: int, right: int) -> bool:
        ours, _, lasts, whole = self._history(left)
        theirs, firsts, _, whole_too = self._history(right)
        if not (whole and whole_too):
            return False
        i = j = 0
        n, m, scores = len(ours), len(theirs), self.scores
        while True:
            border = scores.get(lasts[i] + firsts[j])
            if border is not None and (i == n or border > ours[i]) and (j == m or border >= theirs[j]):
                return False
            if i < n and (j == m or ours[i] >= theirs[j]):
                i += 1
            elif j < m:
                j += 1
            else:
                return True

    def _stands_alone(self, piece: int) -> bool:
        return self._history(piece)[3]

    def _known(self, text: str) -> list[int]:
        """Ids of a text whose characters are all in the vocabulary."""
        last = [-1] * (len(text) + 1)
        pairs, pieces = self.pairs, self.pieces
        done = 0
        for end, (piece, length) in self.matches.iter(text):
            end += 1
            if end == done:
                continue
            start = end - length
            if start == 0:
                fits = self._stands_alone(piece)
            else:
                before = last[start]
                fits = pairs.get((before, piece))
                if fits is None:
                    fits = self.compatible(before, piece)
            if fits:
                last[end] = piece
                done = end
        out, end = [], len(text)
        while end:
            piece = last[end]
            out.append(piece)
            end -= len(pieces[piece])
        out.reverse()
        return out

    def encode_unit(self, text: str) -> list[int]:
        """Ids of a text without the blank that begins a whole text; characters outside the vocabulary become bytes."""
        if self.chars.issuperset(text):
            return self._known(text)
        out: list[int] = []
        known = ""
        for c in text:
            if c in self.chars:
                known += c
                continue
            out += self._known(known) if known else []
            known = ""
            out += [self.byte_ids[b] for b in c.encode()]
        return out + (self._known(known) if known else [])

    def units(self, text: str) -> list[str]:
        """Parts of a text that encode independently: blanks and the run of related characters behind them."""
        return self.unit.findall(" " + text.replace(SPACE, " ")) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units(text) for i in self.encode_unit(unit)]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode(errors="replace")[1:]


class _Remembered(dict):
    """unit -> its ids as little-endian 32-bit numbers. Holds the units met since ``MOST_UNITS`` ago, and those met before
    that are looked up among the older ones first."""

    def __init__(self, table: PrefixTable):
        super().__init__()
        self.table, self.older = table, {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.older.get(unit)
        if ids is None:
            ids = np.array(self.table.encode_unit(unit), "<i4").tobytes()
        if len(unit) <= LONGEST_UNIT:
            self[unit] = ids
        return ids

    def age(self) -> None:
        if len(self) > MOST_UNITS:
            self.older = dict(self)
            self.clear()


def _columns(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id and ids (array<int>) of the whole text.

    Null and empty texts have no ids, null ids are kept, texts may have any length. Rows that repeat give equal rows,
    other columns are ignored, an empty table gives an empty result. A task remembers at most about twice MOST_UNITS short
    units' encodings, whatever the size of its input.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Remembered(PrefixTable(model_path))
        for batch in batches:
            ends, parts = [0], []
            for text in batch.column(1).to_pylist():
                parts.append(b"".join(map(known.__getitem__, known.table.units(text))))
                ends.append(ends[-1] + len(parts[-1]) // 4)
                known.age()
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["_id", "ids"])

    source = docs.select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text"))
    return source.mapInArrow(run, f"{_columns(source.select('_id'))}ids array<int>").withColumnRenamed("_id", id_col)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids in a column ``to``, which replaces one of that name.

    Null ids and no ids are the empty text; bytes that make no character become U+FFFD; an id outside the model is an error.
    """
    kept = [c for c in encoded.columns if c != to]
    place = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PrefixTable(model_path)
        pieces = pa.array([table.bytes_of.get(i) for i in range(max(table.bytes_of) + 1)], pa.binary())
        for batch in batches:
            column = batch.column(place)
            ids = column.flatten()
            found = pieces.take(ids)
            if found.null_count:
                raise ValueError("ids without a piece")
            starts = np.frombuffer(found.buffers()[1], np.int32)[found.offset :] if len(found) else np.zeros(1, np.int32)
            joined = memoryview(found.buffers()[2] or b"") if len(found) else memoryview(b"")
            edges = np.concatenate(([0], np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False))))
            at = starts[edges].tolist()
            texts = [bytes(joined[a:b]).decode(errors="replace") for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([t[1:] if t.startswith(" ") else t for t in texts], pa.string())], names=[*kept, to])

    return encoded.select(*kept).mapInArrow(run, f"{_columns(encoded.select(*kept))}`{to}` string")


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 of each row's ids and their decoding."""
    both = decode(encode(docs, model_path, id_col, text_col), model_path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return both.select(id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
