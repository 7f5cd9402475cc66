"""Removal of repeated passages by a difference cover of sampled suffixes.

Two suffixes that share their first ``length`` bytes share a sampled position at the same distance: samples are the
local minima of a hash of a block of bytes over windows of positions, so they depend on the bytes alone (a difference
cover chosen by content; one of fixed residues would sample many times as many positions). Names recurse over triples:
a block has a name, three names in a row make the name of three blocks, three of those the name of nine. Names are
64-bit hashes and not ranks, as only their equality is asked for: a sample with a name of its own, and all suffixes that
lead to it, repeats nowhere. The suffixes left over, less than a window before their sample, are merged inside their
name: sorted by distance and by the hash of their first ``length`` bytes, whereupon neighbours that look equal are compared byte by byte.

Places of one name whose surroundings all have the same two 64-bit hashes (of unlike bases, 128 bits in all) are taken
for equal. The suffixes of a name with more than MOST_SPANS different surroundings are met by two such hashes too, first
by stretches of neighbours, so that those which nothing else resembles leave early.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.arrow_groups import text_runs, whole_groups
from paperloom.llm.common import discard, hot_join, small_batches, text_or_empty, written
from paperloom.llm.text_stats import OTHER_BASE, Spans, mixed

#: Bytes of the strings that may stand only once.
LENGTH = 400
CHUNK_BYTES = 1 << 20
#: Texts are sampled in pieces of so many bytes.
PIECE_BYTES = 1 << 20
#: Names with more different surroundings than this are compared by rows of hashes, not in one group.
MOST_SPANS = 2048


@dataclass(frozen=True)
class Cover:
    """Bytes of a string, of a block, of a name (nine blocks) and positions in a window: every string has a sample whose name it holds."""

    length: int

    def __post_init__(self):
        if not 9 <= self.length < 1 << 15:
            raise ValueError("a passage has 9 to 32767 bytes")

    @property
    def block(self) -> int:
        return max(1, self.length // 30)

    @property
    def window(self) -> int:
        return self.length - 9 * self.block + 1

    @property
    def stretch(self) -> int:
        """So many neighbouring suffixes are looked at together, by the bytes that all of them hold, before each is."""
        return max(1, math.isqrt(self.window))


def _suffixes(raw: np.ndarray, spans: Spans, starts: np.ndarray, cover: Cover) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For runs of neighbouring ``starts`` that lead to the same sample: (sample, first start, last start)."""
    if not starts.size:
        return starts, starts, starts
    block, window = cover.block, cover.window
    n = raw.size - block + 1
    at = np.arange(n)
    # the hash's upper bits, then the place: the minimum is the leftmost of equal hashes
    order = ((spans.hash(at, at + block) >> np.uint64(29)).astype(np.int64) << 28) | at
    rows = -(-n // window)
    padded = np.full(rows * window, np.iinfo(np.int64).max)
    padded[:n] = order
    padded = padded.reshape(rows, window)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    sample = np.minimum(back[starts], ahead[starts + window - 1]) & ((1 << 28) - 1)
    new = np.flatnonzero(np.concatenate(([True], (sample[1:] != sample[:-1]) | (starts[1:] != starts[:-1] + 1))))
    return sample[new], starts[new], starts[np.append(new[1:], starts.size) - 1]


def _names(spans: Spans, at: np.ndarray, cover: Cover) -> np.ndarray:
    """Names of the nine blocks at each place: triples of names of triples of blocks."""
    names = [spans.hash(at + cover.block * k, at + cover.block * (k + 1)) for k in range(9)]
    while len(names) > 1:
        names = [mixed(a + mixed(b + mixed(c + np.uint64(len(names))))) for a, b, c in zip(names[::3], names[1::3], names[2::3], strict=True)]
    return names[0].astype(np.int64)


def _starts(sizes: np.ndarray, length: int) -> np.ndarray:
    """Places in the joined texts at which ``length`` bytes of one text start."""
    first = np.cumsum(sizes) - sizes
    per = np.maximum(0, sizes - length + 1)
    return np.repeat(first - (np.cumsum(per) - per), per) + np.arange(per.sum())


def _pieces(texts: list[bytes], most: int, length: int) -> Iterator[tuple[int, int, bytes]]:
    """(number of the text, offset, bytes): long texts in pieces that share length - 1 bytes, so each string starts in one."""
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), most):
            yield k, at, text[at : at + most + length - 1]


def _samples(batches: Iterator[pa.RecordBatch], most: int, cover: Cover) -> Iterator[pa.RecordBatch]:
    """(_id, _k, text) to (_id, _k, at, back, ahead, name, span, check): each sample with the suffixes that lead to it,
    ``back`` to ``ahead`` bytes before it, the name at it, and two hashes of all the bytes of those suffixes' first ``length``.

    Where a piece ends among the suffixes of a sample, the sample comes twice, each time with its part of them.
    """
    for batch in batches:
        pieces = list(_pieces(batch.column(2).cast(pa.binary()).to_pylist(), most, cover.length))
        done = 0
        for texts in text_runs([x for _, _, x in pieces], CHUNK_BYTES):
            sizes = np.array([len(t) for t in texts], np.int64)
            which, offset = (np.array([p[i] for p in pieces[done : done + len(texts)]], np.int64) for i in (0, 1))
            done += len(texts)
            spans = Spans(raw := np.frombuffer(b"".join(texts), np.uint8))
            sample, low, high = _suffixes(raw, spans, _starts(sizes, cover.length), cover)
            piece = np.searchsorted(np.cumsum(sizes), sample, side="right")
            rows = pa.array(which[piece])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array((sample - (np.cumsum(sizes) - sizes)[piece] + offset[piece]).astype(np.int32)),
                    pa.array((sample - low).astype(np.int16)),
                    pa.array((sample - high).astype(np.int16)),
                    pa.array(_names(spans, sample, cover)),
                    pa.array(spans.hash(low, high + cover.length).astype(np.int64)),
                    pa.array(Spans(raw, OTHER_BASE).hash(low, high + cover.length).astype(np.int64)),
                ],
                names=["_id", "_k", "at", "back", "ahead", "name", "span", "check"],
            )


def _flagged_runs(flags: np.ndarray, rows: np.ndarray, offsets: np.ndarray, length: int) -> dict[int, list[dict]]:
    """Runs of neighbouring flagged suffixes of each row as bytes relative to the sample: from -offset to ``length`` behind the last."""
    at = np.flatnonzero(flags)
    out: dict[int, list[dict]] = {}
    if at.size:
        new = np.flatnonzero(np.concatenate(([True], (rows[at[1:]] != rows[at[:-1]]) | (at[1:] != at[:-1] + 1))))
        ends = at[np.append(new[1:], at.size) - 1]
        for a, b in zip(at[new].tolist(), ends.tolist(), strict=True):
            out.setdefault(int(rows[a]), []).append({"a": -int(offsets[a]), "b": length - int(offsets[b])})
    return out


RUNS = "array<struct<a: int, b: int>>"
RUNS_TYPE = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
PLACE = ("name", "span", "check")


class _Suffixes:
    """All suffixes of rows with back, ahead, bytes: row, distance to the sample, place in the joined bytes."""

    def __init__(self, found, length: int):
        self.length = length
        back, ahead = (found.column(c).to_numpy().astype(np.int64) for c in ("back", "ahead"))
        texts = found.column("bytes").to_pylist()
        self.joined = b"".join(texts)
        self.raw = np.frombuffer(self.joined, np.uint8)
        self.starts = _starts(np.array([len(t) for t in texts], np.int64), length)
        self.rows = np.repeat(np.arange(len(texts)), back - ahead + 1)
        first = np.cumsum(back - ahead + 1) - (back - ahead + 1)
        self.offsets = back[self.rows] - (np.arange(self.rows.size) - first[self.rows])

    def hashes(self, *base) -> np.ndarray:
        return Spans(self.raw, *base).hash(self.starts, self.starts + self.length)

    def repeated(self) -> np.ndarray:
        """Which suffixes have another one with the same first bytes: neighbours in the order of hashes, compared on the bytes."""
        values = self.hashes()
        order = np.argsort(values, kind="stable")
        same = values[order][1:] == values[order][:-1]
        if not self._equal(order[:-1][same], order[1:][same]):
            return self._by_bytes(values, order, same)
        near = np.zeros(order.size + 1, bool)
        near[1:-1] = same
        flags = np.empty(order.size, bool)
        flags[order] = near[1:] | near[:-1]
        return flags

    def _equal(self, left: np.ndarray, right: np.ndarray) -> bool:
        """Do all pairs agree in their bytes? Pairs of the same two rows that stand side by side are compared as one stretch."""
        order = np.lexsort((self.starts[left], self.rows[right], self.rows[left]))
        left, right = left[order], right[order]
        a, b = self.starts[left], self.starts[right]
        new = np.ones(left.size, bool)
        new[1:] = (self.rows[left[1:]] != self.rows[left[:-1]]) | (self.rows[right[1:]] != self.rows[right[:-1]]) | (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)
        first = np.flatnonzero(new)
        sizes = np.diff(first, append=left.size) + self.length - 1
        joined = memoryview(self.joined)
        return all(joined[x : x + n] == joined[y : y + n] for x, y, n in zip(a[first].tolist(), b[first].tolist(), sizes.tolist(), strict=True))

    def _by_bytes(self, values: np.ndarray, order: np.ndarray, same: np.ndarray) -> np.ndarray:
        """The same where unlike strings share a hash: the strings of each such hash are counted."""
        flags = np.zeros(order.size, bool)
        edges = np.append(np.flatnonzero(np.concatenate(([True], ~same))), order.size)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a > 1:
                texts = [self.joined[x : x + self.length] for x in self.starts[order[a:b]].tolist()]
                times = Counter(texts)
                flags[order[a:b]] = [times[t] > 1 for t in texts]
        return flags


def _compared(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(name, span, check, copies, back, ahead, bytes), whole names together, to (name, span, check, runs)."""
    for found in whole_groups(batches, 1):
        suffixes = _Suffixes(found, length)
        copies = found.column("copies").to_numpy()
        runs = _flagged_runs(suffixes.repeated() | (copies[suffixes.rows] > 1), suffixes.rows, suffixes.offsets, length)
        some = pa.array(list(runs), pa.int64())
        yield pa.RecordBatch.from_arrays([*(found.column(c).take(some).combine_chunks() for c in PLACE), pa.array(list(runs.values()), RUNS_TYPE)], names=[*PLACE, "runs"])


KIND = ("value", "other", "stretch", "low", "high", "whole", "whole2")


def _stretches(batches: Iterator[pa.RecordBatch], cover: Cover) -> Iterator[pa.RecordBatch]:
    """(name, span, check, copies, back, ahead, bytes) to a row (name, span, check, copies, KIND) for every stretch of
    suffixes: number k has those k * stretch and more bytes before the sample, here from ``high`` down to ``low``; value and
    other are hashes of what all suffixes of such a stretch hold, whole and whole2 of what any of these hold."""
    for batch in batches:
        back, ahead = (batch.column(c).to_numpy().astype(np.int64) for c in ("back", "ahead"))
        texts = batch.column("bytes").to_pylist()
        sizes = np.array([len(t) for t in texts], np.int64)
        raw = np.frombuffer(b"".join(texts), np.uint8)
        per = back // cover.stretch - ahead // cover.stretch + 1
        rows = np.repeat(np.arange(len(texts)), per)
        number = (ahead // cover.stretch)[rows] + np.arange(rows.size) - (np.cumsum(per) - per)[rows]
        low, high = np.maximum(ahead[rows], number * cover.stretch), np.minimum(back[rows], (number + 1) * cover.stretch - 1)
        sample = (np.cumsum(sizes) - sizes + back)[rows]
        core = sample - number * cover.stretch
        both = [Spans(raw, *base) for base in ((), (OTHER_BASE,))]
        cores = (x.hash(core, core + cover.length - cover.stretch + 1).astype(np.int64) for x in both)
        wholes = (x.hash(sample - high, sample - low + cover.length).astype(np.int64) for x in both)
        which = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(which) for c in (*PLACE, "copies")), *map(pa.array, cores), *(pa.array(x.astype(np.int32)) for x in (number, low, high)), *map(pa.array, wholes)],
            names=[*PLACE, "copies", *KIND],
        )


def _exploded(batches: Iterator[pa.RecordBatch], cover: Cover) -> Iterator[pa.RecordBatch]:
    """(name, span, check, back, ahead, bytes, stretches, times) to a row (name, span, check, copies, offset, value, other)
    for every suffix in the stretches, each of which stands for so many places."""
    for batch in batches:
        suffixes = _Suffixes(batch, cover.length)
        times = np.zeros((batch.num_rows, cover.window // cover.stretch + 2), np.int64)
        lists = batch.column("stretches")
        times[np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy()), lists.flatten().to_numpy()] = batch.column("times").flatten().to_numpy()
        copies = times[suffixes.rows, suffixes.offsets // cover.stretch]
        some = np.flatnonzero(copies)
        which = pa.array(suffixes.rows[some])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c).take(which) for c in PLACE), pa.array(copies[some]), pa.array(suffixes.offsets[some].astype(np.int32)), *(pa.array(suffixes.hashes(*base)[some].astype(np.int64)) for base in ((), (OTHER_BASE,)))],
            names=[*PLACE, "copies", "offset", "value", "other"],
        )


def _hot_runs(many: DataFrame, cover: Cover) -> DataFrame:
    """(name, span, check, runs) of the pieces (name, span, check, copies, back, ahead, bytes) of names with very many of them.

    Stretches of one kind are one: if the kind has two places, all its suffixes repeat. Only kinds that share a part with
    other kinds are looked at suffix by suffix, one piece for each kind.
    """
    place = "name long, span long, check long"
    rows = written(many.mapInArrow(lambda batches: _stretches(batches, cover), f"{place}, copies long, value long, other long, stretch int, low int, high int, whole long, whole2 long"), "stretches")
    kinds = rows.groupBy(*KIND).agg(F.sum("copies").alias("times"), F.count(F.lit(1)).alias("rows"), F.min(F.struct(*PLACE)).alias("one"))
    cores = kinds.groupBy("value", "other").agg(F.sum("times").alias("_times"), F.count(F.lit(1)).alias("_kinds")).where("_times > 1").withColumnRenamed("other", "_other")
    alive = written(hot_join(kinds, cores, "value", "_kinds", "whole").where("other = _other").drop("_other", "_times"), "kinds")
    asked = alive.where("_kinds > 1").groupBy("one").agg(F.collect_list(F.struct("stretch", "times")).alias("x")).select("one.*", F.col("x.stretch").alias("stretches"), F.col("x.times").alias("times"))
    suffixes = many.drop("copies").join(asked, [*PLACE]).mapInArrow(lambda batches: _exploded(batches, cover), f"{place}, copies long, offset int, value long, other long")
    values = suffixes.groupBy("value", "other").agg(F.sum("copies").alias("_times"), F.count(F.lit(1)).alias("_rows")).where("_times > 1").withColumnRenamed("other", "_other")
    met = hot_join(suffixes, values, "value", "_rows", "span").where("other = _other")
    single = F.struct((-F.col("offset")).alias("a"), (F.lit(cover.length) - F.col("offset")).alias("b"))
    partly = met.groupBy(F.struct(*PLACE).alias("one"), F.expr(f"offset div {cover.stretch}").cast("int").alias("stretch")).agg(F.collect_list(single).alias("partly"))
    all_of = F.array(F.struct((-F.col("high")).alias("a"), (F.lit(cover.length) - F.col("low")).alias("b")))
    found = alive.join(partly, ["one", "stretch"], "left").withColumn("runs", F.when(F.col("times") > 1, all_of).otherwise(F.col("partly"))).where("runs is not null")
    found = found.select(F.xxhash64(*KIND).alias("kind"), *(F.col(c).alias(f"_{c}") for c in KIND), F.col("rows").alias("_rows"), "runs")
    joined = hot_join(rows.withColumn("kind", F.xxhash64(*KIND)), found, "kind", "_rows", "span").where(" and ".join(f"{c} = _{c}" for c in KIND))
    return joined.groupBy(*PLACE).agg(F.flatten(F.collect_list("runs")).alias("runs"))


def _bytes_of(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(text, wanted) to the wanted pieces' bytes."""
    names = [*PLACE, "copies", "spans", "back", "ahead"]
    kinds = [pa.int64()] * 5 + [pa.int16()] * 2
    for batch in batches:
        rows, pieces = [], []
        for text, wanted in zip(batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for w in wanted:
                rows.append([w[c] for c in names])
                pieces.append(text[w["at"] - w["back"] : w["at"] - w["ahead"] + length])
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, kinds, strict=True)), pa.array(pieces, pa.binary())], names=[*names, "bytes"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _k, runs): for each text with repeated passages the byte ranges [a, b) that they cover, not yet merged.

    _k is a hash of the text, so that texts under one id are told apart.
    """
    small_batches(docs.sparkSession)
    cover, most, most_spans = Cover(length), PIECE_BYTES, MOST_SPANS
    source = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_or_empty(F.col(text_col))).alias("_k"), text_or_empty(F.col(text_col)).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    long = source.where(F.octet_length("text") >= length)
    place = "name long, span long, check long"
    samples = written(long.mapInArrow(lambda batches: _samples(batches, most, cover), f"_id {kind}, _k long, at int, back short, ahead short, {place}"), "samples")
    unlike = (F.min("span") != F.max("span")) | (F.min("check") != F.max("check"))
    names = samples.groupBy("name").agg(F.count(F.lit(1)).alias("places"), unlike.alias("mixed")).where("places > 1")
    shared = written(hot_join(samples, names, "name", "places", "_id").drop("places"), "shared")
    discard(samples)
    whole = shared.where("not mixed").select("_id", "_k", F.array(F.struct((F.col("at") - F.col("back")).alias("a"), (F.col("at") - F.col("ahead") + length).alias("b"))).alias("runs"))
    mixed_ = shared.where("mixed")
    # one place stands for all with the same surroundings
    kinds = mixed_.groupBy(*PLACE).agg(F.count(F.lit(1)).alias("copies"), F.min_by(F.struct("_id", "_k", "at", "back", "ahead"), F.struct("_id", "_k", "at")).alias("one"))
    spans = kinds.groupBy("name").agg(F.count(F.lit(1)).alias("spans"))
    wanted = (
        hot_join(kinds, spans, "name", "spans", "span")
        .select("one._id", "one._k", F.struct(*PLACE, "copies", "spans", "one.at", "one.back", "one.ahead").alias("w"))
        .groupBy("_id", "_k").agg(F.collect_list("w").alias("wanted"))
    )
    one_each = source.alias("s").join(wanted.alias("w"), F.col("s._id").eqNullSafe(F.col("w._id")) & (F.col("s._k") == F.col("w._k")))
    pieces = written(
        one_each.select("text", "wanted").mapInArrow(lambda batches: _bytes_of(batches, length), f"{place}, copies long, spans long, back short, ahead short, bytes binary").dropDuplicates([*PLACE]), "pieces"
    )
    few = pieces.where(F.col("spans") <= most_spans).drop("spans").repartition("name").sortWithinPartitions("name").mapInArrow(lambda batches: _compared(batches, length), f"{place}, runs {RUNS}")
    many = pieces.where(F.col("spans") > most_spans).drop("spans")
    if many.limit(1).count():
        few = few.unionByName(_hot_runs(many, cover))
    flagged = few.withColumn("all", F.xxhash64(*PLACE)).join(kinds.select(*PLACE, "copies"), [*PLACE]).select("all", *PLACE, "runs", "copies")
    placed = mixed_.withColumn("all", F.xxhash64(*PLACE)).withColumnsRenamed({c: f"_{c}" for c in PLACE})
    partly = hot_join(placed, flagged, "all", "copies", "_id").where(" and ".join(f"{c} = _{c}" for c in PLACE)).select(
        "_id", "_k", F.transform("runs", lambda r: F.struct((r["a"] + F.col("at")).alias("a"), (r["b"] + F.col("at")).alias("b"))).alias("runs")
    )
    runs = written(whole.unionByName(partly).groupBy("_id", "_k").agg(F.flatten(F.collect_list("runs")).alias("runs")), "runs")
    discard(shared, pieces)
    return runs


def _merged(runs: list[dict] | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((r["a"], r["b"]) for r in runs or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _kept(text: bytes, runs: list[dict] | None) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The parts of a text around its runs, and the merged runs."""
    cut = _merged(runs)
    edges = [0, *(x for run in cut for x in run), len(text)]
    return [text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)], cut


def _with_runs(docs: DataFrame, length: int, carry: list[str], id_col: str, text_col: str) -> DataFrame:
    runs = repeated_spans(docs, length, id_col, text_col)
    keyed = docs.select(*(F.col(c).alias(f"c{k}") for k, c in enumerate(carry)), F.col(id_col).alias("_i"), F.xxhash64(text_or_empty(F.col(text_col))).alias("_h"), text_or_empty(F.col(text_col)).alias("_text"))
    joined = keyed.join(runs, F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_k")), "left")
    return joined.select(*(f"c{k}" for k in range(len(carry))), "_text", "runs")


def removal_report(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte is removed that a string of ``length`` bytes covers which starts at another place too, in this or another
    row. Null texts count as empty; shorter texts lose nothing; very long ones are sampled in pieces; null ids are ids
    like others; rows that repeat lose all if they are long enough; other columns are ignored; an empty table gives an
    empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, runs in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), strict=True):
                parts, cut = _kept(text, runs)
                rows.append((len(text), sum(b - a for a, b in cut), len(cut), hashlib.sha256(b"".join(parts)).hexdigest()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    source = _with_runs(docs, length, [id_col], id_col, text_col)
    return source.mapInArrow(run, f"`{id_col}` {source.schema[0].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their repeated passages cut out, all copies of a passage alike.

    A character that loses some of its bytes goes as a whole: what is left of it on either side of a cut is dropped before
    the parts are joined. Other columns stay as they are, whatever their names; null texts become empty; null ids, rows
    that repeat, very long texts and empty tables are as in ``removal_report``.
    """
    columns = docs.columns
    place = columns.index(text_col)
    source = _with_runs(docs, length, columns, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = zip(batch.column(len(columns)).cast(pa.binary()).to_pylist(), batch.column(len(columns) + 1).to_pylist(), strict=True)
            arrays = list(batch.columns[: len(columns)])
            arrays[place] = pa.array(["".join(part.decode(errors="ignore") for part in _kept(text, runs)[0]) for text, runs in texts], pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    schema = ", ".join(f"`{f.name}` {'string' if f.name == text_col else f.dataType.simpleString()}" for f in docs.schema.fields)
    return source.mapInArrow(run, schema)
