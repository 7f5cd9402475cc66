"""Best-fit packing of tokenised documents into sequences of a fixed length.

Pieces of one length are interchangeable, so the packing is found for the histogram of lengths (at most ``capacity``
numbers, however large the corpus): lengths above a third of the capacity are matched greedily, at most two to a
sequence, then the smaller ones go, longest first, where the least room is left over. The plan is a list of runs; each
piece finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.llm.common import small_batches, text_or_empty, written

CAPACITY, END_ID = 2048, 0
#: Ranks of a length are counted in parts of about so many pieces.
PART_ROWS = 1024
#: Bytes of ids that leave a task at once.
BATCH_BYTES = 16 << 20

#: Signs that the engines of two libraries may class differently.
ODD = re.compile("[\x1c-\x1f]|[^\x00-\u024f]")
#: How byte-level BPE cuts a text before merging. Fixed value.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a byte-level BPE file as bytes, without its special tokens; ids are in the order of the merges."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    special = {t["content"] for t in found["added_tokens"]}
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow 255
    signs = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    return {bytes(map(signs.__getitem__, token)): i for token, i in found["model"]["vocab"].items() if token not in special}


class Encoder:
    """Texts to little-endian ids, of 16 bits where the vocabulary allows, else 32, as the tokenizer of a file gives them for
    the whole text.

    Texts of plain signs go through the faster engine, over the tokens of the same file; the others, and those in which
    a special token may stand, through the tokenizer itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.engine = tiktoken.Encoding(path, pat_str=CUTS, mergeable_ranks=byte_ranks(path), special_tokens={})

    def encode(self, text: str) -> bytes:
        if "<|" in text or ODD.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.engine.encode_ordinary(text)
        return np.array(ids, f"<u{self.width}").tobytes()


@F.pandas_udf(T.LongType())
def wide_crc32(ids: pd.Series, length: pd.Series) -> pd.Series:
    """CRC-32 of pieces' ids as 32-bit numbers; ``length`` says how many there are."""
    return pd.Series([zlib.crc32(np.frombuffer(x, f"<u{len(x) // n}").astype("<u4")) for x, n in zip(ids, length, strict=True)], dtype="int64")


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids: each text's ids and one end id, cut into pieces only where they exceed the capacity.

    ids are little-endian numbers of 16 bits, or 32 where the vocabulary has more than 65,536 entries. The first piece of a cut document takes the remainder, the others are full. Null
    and empty texts are one end id, null ids are kept, very long texts leave in batches of pieces, rows that repeat give
    equal pieces, other columns are ignored, an empty table gives an empty result.
    """
    docs = docs.select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text"))
    small_batches(docs.sparkSession)

    def table(names: pa.Array, which: list[int], rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else ((), (), (), ())
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([names.take(pa.array(which, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=["_id", "piece", "start", "length", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        for batch in batches:
            which, rows, held = [], [], 0
            for k, packed in enumerate(map(encoder.encode, batch.column(1).to_pylist())):
                width = encoder.width
                packed += END_ID.to_bytes(width, "little")
                n = len(packed) // width
                start, piece = 0, 0
                while start < n:
                    length = (n % capacity or capacity) if start == 0 else capacity
                    which.append(k)
                    rows.append((piece, start, length, packed[width * start : width * (start + length)]))
                    start, piece, held = start + length, piece + 1, held + width * length
                    if held >= BATCH_BYTES:
                        yield table(batch.column(0), which, rows)
                        which, rows, held = [], [], 0
            yield table(batch.column(0), which, rows)

    return docs.mapInArrow(run, f"_id {docs.schema[0].dataType.simpleString()}, piece int, start long, length long, ids binary").withColumnRenamed("_id", id_col)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Runs (length, first rank, first sequence, pieces of this length per sequence, offset), sorted, and the number of sequences.

    Ranks of a length fill ``pieces per sequence`` places of each sequence from the run's first on, side by side.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = {}  # room left -> runs of sequences (first, how many)
    sizes: list[int] = []  # the rooms, ascending
    total = 0

    def put(length: int, first: int, how_many: int, per: int, offset: int) -> None:
        runs.append((length, used[length], first, per, offset))
        used[length] += how_many
        left[length] -= how_many

    def room(size: int, first: int, how_many: int) -> None:
        if size and how_many:
            if size not in rooms:
                rooms[size] = []
                bisect.insort(sizes, size)
            rooms[size].append((first, how_many))

    large = [n for n in sorted(left) if 3 * n > capacity]
    for a in reversed(large):
        while left[a]:
            k = bisect.bisect_right(large, capacity - a) - 1
            while k >= 0 and (left[large[k]] == 0 or large[k] == a and left[a] < 2):
                k -= 1
            if k < 0:
                n = left[a]
                put(a, total, n, 1, 0)
                room(capacity - a, total, n)
            else:
                b = large[k]
                n = left[a] // 2 if a == b else min(left[a], left[b])
                put(a, total, n, 1, 0)
                put(b, total, n, 1, a)
                room(capacity - a - b, total, n)
            total += n
    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s]:
            k = bisect.bisect_left(sizes, s)
            if k == len(sizes):
                per = capacity // s
                n = -(-left[s] // per)
                room(capacity, total, n)
                total += n
                continue
            size = sizes[k]
            first, n = rooms[size].pop()
            if not rooms[size]:
                del rooms[size], sizes[k]
            per = size // s
            whole = min(n, left[s] // per)
            if whole:
                put(s, first, whole * per, per, capacity - size)
                room(size - per * s, first, whole)
            first, n = first + whole, n - whole
            if n and left[s]:  # fewer than ``per`` are left
                some = left[s]
                put(s, first, some, some, capacity - size)
                room(size - some * s, first, 1)
                first, n = first + 1, n - 1
            room(size, first, n)
    return np.array(sorted(runs), np.int64).reshape(-1, 5), total


def pack(pieces: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` (id, piece, start, length, ids, more) with sequence_id and offset.

    ``pieces`` is read more than once and must not change in between (a written table). Rows that repeat are packed each
    for itself, pieces of one length in order of id, piece and ids; further columns travel along, and those named
    sequence_id or offset are replaced. An empty table gives an empty result.
    """
    pieces = pieces.select(*(c for c in pieces.columns if c not in ("sequence_id", "offset")))
    sizes = pieces.groupBy("length").count()
    counts = {r[0]: r[1] for r in sizes.collect()}  # at most ``capacity`` rows
    runs, _ = plan(counts, capacity)
    starts = (runs[:, 0] << 40) + runs[:, 1]

    def place(length: pd.Series, rank: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        length, rank = length.to_numpy(np.int64), rank.to_numpy(np.int64)
        run = runs[np.searchsorted(starts, (length << 40) + rank, side="right") - 1]
        behind = rank - run[:, 1]
        return run[:, 2] + behind // run[:, 3], run[:, 4] + behind % run[:, 3] * length

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("sequence_id", "offset"), place(length, rank), strict=True)))

    parts = sizes.select("length", F.ceil(F.col("count") / PART_ROWS).alias("_parts"))
    parted = pieces.join(F.broadcast(parts), "length").withColumn("_part", F.pmod(F.xxhash64(id_col, "piece"), F.col("_parts")).cast("long")).drop("_parts")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = parted.groupBy("length", "_part").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy("length", "_part").orderBy(F.col(id_col), F.col("piece"), F.col("ids"))
    ranked = parted.withColumn("_row", F.row_number().over(within) - 1).join(sums, ["length", "_part"])
    out = ranked.withColumn("_place", placed("length", F.col("_before") + F.col("_row")))
    return out.select(*pieces.columns, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack whole documents: id, piece, start, length, ids_crc32, sequence_id, offset, ids.

    Nulls, long texts, repeated rows, other columns and empty tables are as in ``token_pieces``; lengths that tie are
    packed alike. The pieces with their ids are written once to the shared folder; ids_crc32 is the CRC-32 of the ids
    that were placed, as 32-bit numbers.
    """
    placed = pack(written(token_pieces(docs, tokenizer_path, capacity, id_col, text_col), "pieces"), capacity, id_col)
    return placed.select(id_col, "piece", "start", "length", wide_crc32("ids", "length").alias("ids_crc32"), "sequence_id", "offset", "ids")


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, length, ids: the packed sequences themselves, ``placed`` pieces' ids side by side in order of offset.

    A group is one sequence, hence at most ``capacity`` ids. Pieces that repeat have places of their own; null ids of
    documents do not matter; other columns are ignored; an empty table gives an empty result.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("ids").alias("hex"))))
    joined = F.unhex(F.array_join(F.transform(parts, lambda x: x["hex"]), ""))
    return placed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))
