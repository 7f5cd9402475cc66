"""Alignment of two tokenizers over the same texts: groups between shared cuts, and how often two tokens are linked.

A text's two token sequences are cut where both have a token's end. The cuts are found by divide and conquer: an interval
looks for a common end near its middle, bisecting in one list of ends for the other's next one, and both halves go on; an
interval without a common end is a group. All intervals of a block of texts take their step together, as arrays.

Tokens of unlike sides whose bytes overlap are linked. A block keeps its distinct pairs with their counts and each text its
links as numbers of these pairs; Spark adds up the counts of all blocks and sends each block the totals of its pairs.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import small_batches, text_or_empty, written
from paperloom.llm.packing import CUTS, ODD, byte_ranks
from paperloom.llm.piece_codec import SPACE

#: UTF-8 bytes of text in a block.
BLOCK_BYTES = 4 << 20
#: A pair of ids as one number: the first id times SIDE plus the second.
SIDE = 1 << 32


class TwoTokenizers:
    """Ids and token bytes of texts by a byte-level BPE file (first side) and a SentencePiece model (second side)."""

    def __init__(self, bpe_path: str, model_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(bpe_path)
        self.tokenizer.encode_special_tokens = True  # strings of special tokens are ordinary text
        ranks = byte_ranks(bpe_path)
        self.engine = tiktoken.Encoding(bpe_path, pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        of = {i: token for token, i in ranks.items()}
        first = [of.get(i, b"") for i in range(max(of) + 1)]
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        second = [bytes((int(p[3:5], 16),)) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.bytes = tuple(pa.array(side, pa.binary()) for side in (first, second))
        self.sizes = tuple(np.array([len(t) for t in side]) for side in (first, second))
        marks = [f"{i}{end}" for count, ends in ((len(first), ",|"), (len(second), ",;")) for i in range(count) for end in ends]
        self.marks = pa.array([m.encode() for m in marks], pa.binary())

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        spaced = [" " + t for t in texts]
        # the engines of the two libraries may class odd signs differently
        first = [self.tokenizer.encode(t, add_special_tokens=False).ids if ODD.search(t) else self.engine.encode_ordinary(t) for t in spaced]
        return first, self.model.encode(texts, num_threads=1)

    def spelled(self, side: int, ids: np.ndarray) -> tuple[np.ndarray, memoryview]:
        """Ends of the tokens' bytes, and the bytes side by side."""
        return joined(self.bytes[side], ids)


def joined(table: pa.Array, at: np.ndarray) -> tuple[np.ndarray, memoryview]:
    """Ends and bytes of the table's entries ``at``, side by side."""
    found = table.take(pa.array(at))
    ends = np.frombuffer(found.buffers()[1], np.int32)[found.offset + 1 : found.offset + len(found) + 1] if len(found) else np.zeros(0, np.int32)
    return ends.astype(np.int64), memoryview(found.buffers()[2] or b"") if len(found) else memoryview(b"")


def _seek(first: np.ndarray, second: np.ndarray, at: np.ndarray, bound: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the first value alike that is met going up (step 1) or down (-1) from first[at], -1 where
    ``bound`` is reached before. The lists look each other up in turn by bisection."""
    found = np.full((2, len(at)), -1, np.int64)
    todo, mine, value = np.arange(len(at)), at, first[at]
    for turn in itertools.cycle((0, 1)):
        alive = value < bound[todo] if step > 0 else value > bound[todo]
        if not alive.all():
            todo, mine, value = todo[alive], mine[alive], value[alive]
        if not len(todo):
            return found[0], found[1]
        ends = (second, first)[turn]
        place = np.searchsorted(ends, value) if step > 0 else np.searchsorted(ends, value, "right") - 1
        seen = np.where(place >= 0, ends[place], -1)
        same = seen == value
        found[turn, todo[same]], found[1 - turn, todo[same]] = mine[same], place[same]
        todo, mine, value = todo[~same], place[~same], seen[~same]


def groups(first: np.ndarray, second: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Byte ends, ascending, of the groups between cuts that both lists of token ends share.

    Intervals (starts, ends) are the texts, in order; both lists hold every interval's end. Cutless intervals are groups.
    An interval is its tokens' places in both lists; it stays in order of place, so look-ups run along the lists.
    """
    edges = [np.searchsorted(x, ends) + 1 for x in (first, second)]
    spans = np.stack([np.append(0, edges[0][:-1]), edges[0], np.append(0, edges[1][:-1]), edges[1], starts, ends])
    done = []
    while spans.shape[1]:
        a, b, c, d, low, high = spans
        several = (b - a > 1) & (d - c > 1)  # a side with one token leaves no room for a cut
        done.append(high[~several])
        if not several.all():
            a, b, c, d, low, high = spans = spans[:, several]
        middle = (a + b - 1) // 2
        i, j = _seek(first, second, middle, high, 1)
        missed = np.flatnonzero((i < 0) & (middle > a))
        i[missed], j[missed] = _seek(first, second, middle[missed] - 1, low[missed], -1)
        cut = i >= 0
        done.append(high[~cut])
        if not cut.all():
            a, b, c, d, low, high = spans[:, cut]
            i, j = i[cut], j[cut]
        at = first[i]
        halves = [(a, i + 1), (i + 1, b), (c, j + 1), (j + 1, d), (low, at), (at, high)]
        spans = np.stack([np.stack(pair, 1).ravel() for pair in halves])
    return np.sort(np.concatenate(done)) if done else np.zeros(0, np.int64)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Ascending numbers as their differences, compressed."""
    return zlib.compress(np.diff(numbers, prepend=0).astype("<u4").tobytes(), 1)


def unpack_numbers(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), "<u4"), dtype=np.int64)


class AlignedBlock:
    """Alignment of a block of texts: per text the numbers of tokens, groups and links, the digest of the groups and the
    packed links; for the block its distinct pairs and how often each is linked."""

    def __init__(self, tokenizers: TwoTokenizers, texts: list[str]):
        count = len(texts)
        self.n_first, self.n_second, self.n_groups, self.n_links = (np.zeros(count, np.int64) for _ in range(4))
        self.digests, self.links = [""] * count, [b""] * count
        self.pairs = self.counts = np.zeros(0, np.int64)
        tokens = tokenizers.encode(texts)
        raw = [t.encode() for t in texts]
        per = [np.array([len(x) for x in side], np.int64) for side in tokens]
        ids = [np.fromiter(itertools.chain.from_iterable(side), np.int64, int(n.sum())) for side, n in zip(tokens, per, strict=True)]
        del tokens
        good = np.array([len(r) > 0 for r in raw])
        for side in (0, 1):
            ends, spelled = tokenizers.spelled(side, ids[side])
            at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per[side])])].tolist()
            good &= np.fromiter((a < b and bytes(spelled[a:b]) == b" " + r for a, b, r in zip(at[:-1], at[1:], raw, strict=True)), bool, count)
        if not good.any():
            return
        for side in (0, 1):
            ids[side] = ids[side][np.repeat(good, per[side])]
            per[side] = per[side] * good
        self.n_first, self.n_second = per
        which = np.flatnonzero(good)
        text_ends = np.cumsum([len(raw[k]) + 1 for k in which])
        text_starts = np.concatenate([[0], text_ends[:-1]])
        ends = [np.cumsum(tokenizers.sizes[side][ids[side]]) for side in (0, 1)]
        cuts = groups(*ends, text_starts, text_ends)
        self.n_groups[which] = np.diff(np.searchsorted(cuts, text_ends, "right"), prepend=0)
        self._spell_groups(tokenizers, ids, ends, cuts, which)
        self._link(ids, ends, text_ends, which)

    def _spell_groups(self, tokenizers, ids, ends, cuts, which) -> None:
        """Digest of `a1,a2|b1;a3|b2,b3`: within a group the first side's ids, then the second's."""
        group = [np.searchsorted(cuts, e) for e in ends]
        last = [np.append(g[1:] != g[:-1], True) for g in group]
        before = np.concatenate([[0], np.cumsum(np.bincount(group[1], minlength=len(cuts)))[:-1]])  # second side's tokens in earlier groups
        upto = np.cumsum(np.bincount(group[0], minlength=len(cuts)))
        order = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        order[np.arange(len(ids[0])) + before[group[0]]] = 2 * ids[0] + last[0]
        order[np.arange(len(ids[1])) + upto[group[1]]] = 2 * (len(tokenizers.sizes[0]) + ids[1]) + last[1]
        at, spelled = joined(tokenizers.marks, order)
        rows = np.cumsum((self.n_first + self.n_second)[which])
        start = 0
        for k, end in zip(which.tolist(), at[rows - 1].tolist(), strict=True):
            self.digests[k] = hashlib.sha256(spelled[start : end - 1]).hexdigest()  # without the last semicolon
            start = end

    def _link(self, ids, ends, text_ends, which) -> None:
        """A link ends wherever either side's token ends; it joins the tokens that cover the bytes before."""
        borders = np.sort(np.concatenate(ends), kind="stable")
        borders = borders[np.append(borders[1:] != borders[:-1], True)]
        pairs = ids[0][np.searchsorted(ends[0], borders)] * SIDE + ids[1][np.searchsorted(ends[1], borders)]
        self.pairs, numbers, self.counts = np.unique(pairs, return_inverse=True, return_counts=True)
        edges = np.searchsorted(borders, text_ends, "right")
        self.n_links[which] = np.diff(edges, prepend=0)
        start = 0
        for k, end in zip(which.tolist(), edges.tolist(), strict=True):
            self.links[k] = pack_numbers(np.sort(numbers[start:end]))
            start = end


BLOCK_SCHEMA = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, block long, pairs array<long>, counts array<long>"
NAMES = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
OUT = ["_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _lists(values: np.ndarray, rows: int) -> pa.Array:
    """``rows`` nulls, then one list."""
    return pa.concat_arrays([pa.nulls(rows, pa.list_(pa.int64())), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))])


def aligned_blocks(docs: DataFrame, bpe_path: str, model_path: str, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document and, told by its ``pairs``, one for each block of documents. ``links`` are the numbers of a
    document's links in its block's pairs. Memory of a task follows the block, or the longest text."""
    source = docs.select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text"))
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = TwoTokenizers(bpe_path, model_path)
        first, number = TaskContext.get().partitionId() << 33, 0
        held: list[tuple[pa.Array, list[str]]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            block = AlignedBlock(tokenizers, [t for _, texts in held for t in texts])
            n = len(block.digests)
            counts = (pa.array(np.append(x, 0), pa.int64(), mask=np.append(np.zeros(n, bool), True)) for x in (block.n_first, block.n_second, block.n_groups, block.n_links))
            names = pa.concat_arrays([*(i for i, _ in held), pa.nulls(1, held[0][0].type)])
            return pa.RecordBatch.from_arrays(
                [names, *counts, pa.array([*block.digests, None], pa.string()), pa.array([*block.links, None], pa.binary()), pa.array(np.full(n + 1, first + number)), _lists(block.pairs, n), _lists(block.counts, n)],
                names=["_id", *NAMES],
            )

        for batch in batches:
            texts = batch.column(1).to_pylist()
            start = 0
            for k, text in enumerate(texts):
                size += len(text)
                if size >= block_bytes:
                    held.append((batch.column(0).slice(start, k + 1 - start), texts[start : k + 1]))
                    yield flush()
                    held, size, start, number = [], 0, k + 1, number + 1
            if start < len(texts):
                held.append((batch.column(0).slice(start), texts[start:]))
        if held:
            yield flush()

    return source.mapInArrow(run, f"_id {source.schema[0].dataType.simpleString()}, {BLOCK_SCHEMA}")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, top): how many links of the corpus hold each pair of ids, and whether no pair of its second id has more."""
    each = blocks.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
    totals = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("count")).withColumn("_second", F.col("pair") % SIDE)
    most = totals.groupBy("_second").agg(F.max("count").alias("_most"))
    return totals.join(most, "_second").select("pair", "count", (F.col("count") == F.col("_most")).alias("top"))


def align(docs: DataFrame, bpe_path: str, model_path: str, block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Null and empty texts, and those whose tokens of either side do not spell the text behind a blank, have no tokens: zeros
    and an empty digest. Null ids stay, rows that repeat are counted each, pairs that tie for the highest count are all
    best, other columns are ignored, an empty table gives an empty result. The blocks are written once to the shared
    folder; each sends its distinct pairs and gets their totals, so a frequent pair has one row for each block.
    """
    blocks = written(aligned_blocks(docs, bpe_path, model_path, block_bytes, id_col, text_col), "aligned")
    asked = blocks.where("pairs is not null").select("block", F.explode("pairs").alias("pair"))
    answers = asked.join(written(pair_counts(blocks), "pairs"), "pair").select("block", "pair", "count", "top")
    kind = blocks.schema["_id"].dataType.simpleString()
    columns = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"]
    rows = blocks.where("pairs is null").select("block", F.lit(None).cast("long").alias("pair"), F.lit(None).cast("long").alias("count"), F.lit(None).cast("boolean").alias("top"), "_id", *columns)
    told = answers.select("*", *(F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in ["_id", *columns]))
    sorted_rows = told.unionByName(rows).repartition("block").sortWithinPartitions("block", F.col("links").isNotNull(), "pair")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's totals come in order of its pairs, then its documents."""
        block, held = None, []
        totals = tops = None
        for batch in batches:
            numbers = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                if start == end:
                    continue
                if numbers[start] != block:
                    block, held, totals = numbers[start], [], None
                part = batch.slice(start, end - start)
                answers_here = part.num_rows - part.column(1).null_count
                if answers_here:
                    held.append((part.column(2).slice(0, answers_here).to_numpy(), part.column(3).slice(0, answers_here).to_numpy(zero_copy_only=False)))
                documents = part.slice(answers_here)
                if not documents.num_rows:
                    continue
                if totals is None:
                    totals, tops = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (np.zeros(0, np.int64), np.zeros(0, bool))
                    held = []
                links = [unpack_numbers(x) if x else np.zeros(0, np.int64) for x in documents.column("links").to_pylist()]
                best = pa.array([int(tops[x].sum()) for x in links], pa.int64())
                sums = pa.array([int(totals[x].sum()) for x in links], pa.int64())
                told = [documents.column(c) for c in ("_id", "n_a", "n_b", "n_groups", "n_links")]
                yield pa.RecordBatch.from_arrays([*told, best, sums, documents.column("groups_sha256")], names=OUT)

    schema = f"_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return sorted_rows.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
