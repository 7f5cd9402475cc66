"""Language-model scoring: prediction by partial matching, trained on a part of the corpus, for every document.

Neither the trie nor the vocabulary is ever in one place. Contexts so frequent that they would make a slice too large are
found on a part of the text, and what follows them is counted over all of it. Documents are dealt to blocks of bounded
size; a block sends the distinct keys of its bytes (with its training counts) and of its words to the slices that hold them; slices add up
the counts of all blocks, work out each distinct key's probability once and send it back; a block then adds up its
documents' scores. The text is shuffled once, all else as packed arrays of distinct keys.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import discard, small_batches, text_or_empty, written
from paperloom.llm.ppm_trie import END, LOW, ORDER, Frequent, distinct, keys_of, log10_probabilities, pairs_of, slice_of, stream, summed
from paperloom.llm.text_stats import Spans

#: UTF-8 bytes of text in a block, and bytes that are worked on at once.
BLOCK_BYTES, CHUNK_BYTES = 8 << 20, 1 << 20
GRAMS, WORDS = 0, 1
#: Stands for the end token among the hashes of words.
END_WORD = -1
#: Contexts of an order that are split at most: those with more than a share of 1 / MOST_FREQUENT of the text, or of a
#: quarter of a slice where there are few slices. They are looked for in every SAMPLED-th chunk of each task.
MOST_FREQUENT, SAMPLED = 1024, 8


def _chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, list[bytes], list[bytes]]]:
    """(numbers of the texts, streams, the bytes before them) with about ``most`` bytes at a time; long streams come in
    pieces that end behind a blank."""
    rows: list[tuple[int, bytes, bytes]] = []
    size = 0
    for k, text in enumerate(texts):
        body = bytes([END]) * ORDER + stream(text)
        at = ORDER
        while at < len(body):
            end = len(body)
            if end - at > most:
                end = (body.rfind(b" ", at, at + most) + 1) or (body.find(b" ", at + most) + 1) or end
            rows.append((k, body[at:end], body[at - ORDER : at]))
            size += end - at
            at = end
            if size >= most:
                yield _columns(rows)
                rows, size = [], 0
    if rows:
        yield _columns(rows)


def _columns(rows: list[tuple[int, bytes, bytes]]) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    numbers, bodies, before = zip(*rows, strict=True)
    return np.array(numbers, np.int64), list(bodies), list(before)


def _word_hashes(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every token of the pieces (END_WORD where a piece has the end) and the number of tokens of each."""
    raw = np.frombuffer(b"".join(bodies), np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == END))
    starts = np.concatenate(([0], ends[:-1] + 1)) if ends.size else ends
    hashes = (Spans(raw).hash(starts, ends) >> np.uint64(1)).astype(np.int64)
    word = ends > starts  # not so where a stream is the end byte alone
    piece = np.searchsorted(np.cumsum([len(b) for b in bodies]), ends, side="right")
    closed = np.array([b.endswith(b"\n") for b in bodies], np.int64)
    per = np.bincount(piece[word], minlength=len(bodies)) + closed
    out = np.empty(int(per.sum()), np.int64)
    out[(np.cumsum(word) - 1 + (np.cumsum(closed) - closed)[piece])[word]] = hashes[word]
    out[(np.cumsum(per) - 1)[closed > 0]] = END_WORD
    return out, per


def _training(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The keys of the texts (column 0) that are learned from (column 1), chunk by chunk."""
    texts, train = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
    for _, bodies, before in _chunks([t for t, learn in zip(texts, train, strict=True) if learn]):
        yield keys_of(bodies, before)[0]


def _counts_table(kinds: list[np.ndarray], values: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (kinds, values, counts)], names=["kind", "value", "count"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kind, value, count): training counts of byte pairs (kind 0), the bytes of all texts (kind 1), and counts of
    contexts of the orders LOW to ORDER (kind = order) in a part of the chunks, the most frequent ones of the task."""
    counts, size, chunk = np.zeros(1 << 16, np.int64), 0, 0
    sampled: dict[int, dict[int, int]] = {j: {} for j in range(LOW, ORDER + 1)}
    for batch in batches:
        size += batch.column(0).cast(pa.binary()).nbytes
        for keys in _training(batch):
            counts += pairs_of(keys)
            chunk += 1
            if chunk % SAMPLED != 1:
                continue
            for j, found in sampled.items():
                contexts, times = distinct(keys >> (8 * (ORDER + 1 - j)))
                most = np.argsort(-times, kind="stable")[: 2 * MOST_FREQUENT]
                for c, n in zip(contexts[most].tolist(), times[most].tolist(), strict=True):
                    found[c] = found.get(c, 0) + n
                if len(found) > 16 * MOST_FREQUENT:
                    sampled[j] = dict(sorted(found.items(), key=lambda x: -x[1])[: 8 * MOST_FREQUENT])
    pairs = np.flatnonzero(counts)
    kinds, values, sums = [np.zeros(pairs.size), np.ones(1)], [pairs, np.zeros(1)], [counts[pairs], np.array([size])]
    for j, found in sampled.items():
        most = sorted(found.items(), key=lambda x: -x[1])[: 2 * MOST_FREQUENT]
        kinds.append(np.full(len(most), j))
        values.append(np.array([c for c, _ in most], np.int64))
        sums.append(np.array([n for _, n in most], np.int64))
    yield _counts_table(kinds, values, sums)


def _frequent(found: dict[int, tuple[np.ndarray, np.ndarray]], parts: int) -> Frequent:
    """The contexts to split: of each order those with more than their share of the sampled positions."""
    if parts == 1:
        return Frequent()
    out = {}
    for j in range(LOW, ORDER + 1):
        contexts, counts = found.get(j, (np.zeros(0, np.int64),) * 2)
        large = counts * min(MOST_FREQUENT, 4 * parts) > found[LOW][1].sum() if LOW in found else counts > 0
        most = np.argsort(-counts[large], kind="stable")[:MOST_FREQUENT]
        out[j] = contexts[large][most]
    return Frequent(out)


def _followed(batches: Iterator[pa.RecordBatch], frequent: Frequent) -> Iterator[pa.RecordBatch]:
    """Rows (kind, value, count): how often a byte follows a frequent context; value is 256 times its number plus the byte."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for keys in _training(batch):
            for j, counts in frequent.counts(keys).items():
                sums[j] = sums[j] + counts if j in sums else counts
    for j, counts in sums.items():
        some = np.flatnonzero(counts)
        yield _counts_table([np.full(some.size, j)], [some], [counts[some]])


def _summed_up(rows: DataFrame, most: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(kind, value, count) rows added up by Spark, as arrays (value, count) for each kind; of contexts the
    ``most`` largest counts of each kind."""
    sums = written(rows.groupBy("kind", "value").agg(F.sum("count").alias("count")), "counts")
    found = sums.where(F.col("kind") < LOW)
    for j in range(LOW, ORDER + 1):
        found = found.unionByName(sums.where(F.col("kind") == j).orderBy(F.desc("count"), "value").limit(most))
    table = found.toArrow()
    discard(sums)
    kinds, values, counts = (table.column(c).to_numpy() for c in ("kind", "value", "count"))
    return {int(k): (values[kinds == k], counts[kinds == k]) for k in np.unique(kinds)}


def _packed(rows: list[tuple]) -> pa.Table:
    names = ["slice", "block", "kind", "keys", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def score_documents(docs: DataFrame, held_out: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``held_out`` is an SQL condition; the other rows are learned from. Tokens are A-Z lower-cased words and one end;
    base_score is their add-half unigram log10 probability and score the byte model's log10 probability of the words
    with single blanks and the end, so both are about the same thing; bits_per_byte is the model's code length of these
    bytes over their number. Null texts count as empty (one token, the end),
    a null condition as held out, rows that repeat count and score as rows, other columns are ignored; an empty table
    gives an empty result, and without training rows every byte has the probability 1/256. Null ids are ids like others.
    Rows that repeat both id and text fall into one block.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.expr(held_out), F.lit(True)).alias("_out"), text_or_empty(F.col(text_col)).alias("_text"))
    counted = source.select("_text", ~F.col("_out"))
    # At most 65,537 rows and MOST_FREQUENT for each order, whatever the corpus.
    found = _summed_up(counted.mapInArrow(_pairs, "kind long, value long, count long"), MOST_FREQUENT)
    pairs = np.zeros(1 << 16, np.int64)
    pairs[found[0][0] if 0 in found else []] = found[0][1] if 0 in found else []
    pairs = pairs.reshape(256, 256)
    parts = max(1, math.ceil((found[1][1].sum() if 1 in found else 0) / block_bytes))
    frequent = _frequent(found, parts)
    followed = {}
    if frequent.contexts[LOW].size:
        # At most MOST_FREQUENT * 256 rows for each order.
        for j, (value, count) in _summed_up(counted.mapInArrow(lambda batches: _followed(batches, frequent), "kind long, value long, count long"), MOST_FREQUENT << 8).items():
            followed[j] = np.bincount(value, count, frequent.contexts[j].size << 8).astype(np.int64)
    blocks = source.withColumn("block", F.pmod(F.xxhash64("_id", "_text"), F.lit(parts)))

    def requests(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        texts = table.column("_text").cast(pa.binary()).to_pylist()
        train = ~table.column("_out").to_numpy()
        found: dict[int, list] = {GRAMS: [], WORDS: []}
        for numbers, bodies, before in _chunks(texts):
            learn = train[numbers]
            for kind, (keys, sizes) in ((GRAMS, keys_of(bodies, before)), (WORDS, _word_hashes(bodies))):
                learned = np.repeat(learn, sizes)
                found[kind].append(distinct(keys[learned]))
                rest, _ = distinct(keys[~learned])
                found[kind].append((rest, np.zeros(rest.size, np.int64)))
        rows = []
        for kind, arrays in found.items():
            keys, counts = summed(np.concatenate([a for a, _ in arrays]), np.concatenate([c for _, c in arrays]))
            part = slice_of(keys, parts, frequent) if kind == GRAMS else keys % parts
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            keys, counts = keys[order], counts[order]
            for s in range(parts):  # an empty request too: each block hears every slice's totals
                a, b = edges[s], edges[s + 1]
                if kind == WORDS or b > a:
                    rows.append((2 * s + kind, block, kind, keys[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes()))
        return _packed(rows)

    def answers(key: tuple, table: pa.Table) -> pa.Table:
        kind = table.column("kind")[0].as_py()
        keys = [np.frombuffer(x, np.int64) for x in table.column("keys").to_pylist()]
        counts = [np.frombuffer(x, np.uint32).astype(np.int64) for x in table.column("counts").to_pylist()]
        all_keys, sums = summed(np.concatenate(keys), np.concatenate(counts))
        values = log10_probabilities(all_keys, sums, pairs, frequent, followed) if kind == GRAMS else sums.astype(float)
        back = [values[np.searchsorted(all_keys, k)].astype(np.float32 if kind == GRAMS else np.float64).tobytes() for k in keys]
        n = table.num_rows
        totals = (int(sums.sum()), int((sums > 0).sum())) if kind == WORDS else (0, 0)
        return pa.Table.from_arrays(
            [table.column("block"), table.column("kind"), table.column("keys"), pa.array(back, pa.binary()), pa.array([totals[0]] * n, pa.int64()), pa.array([totals[1]] * n, pa.int64())],
            names=["block", "kind", "keys", "back", "tokens", "kinds"],
        )

    def scores(key: tuple, texts: pa.Table, found: pa.Table) -> pa.Table:
        tables = {}
        for kind, width in ((GRAMS, np.float32), (WORDS, np.float64)):
            mine = found.filter(pa.compute.equal(found.column("kind"), kind))
            keys = np.frombuffer(b"".join(mine.column("keys").to_pylist()), np.int64)
            tables[kind] = pd.Index(keys), np.frombuffer(b"".join(mine.column("back").to_pylist()), width).astype(float)
        tokens, kinds = (pa.compute.sum(found.column(c)).as_py() or 0 for c in ("tokens", "kinds"))
        rest = math.log10(tokens + 0.5 * (kinds + 1))
        n = texts.num_rows
        n_tokens, n_known, n_bytes, base, score = (np.zeros(n, kind) for kind in (np.int64, np.int64, np.int64, float, float))

        def add(to: np.ndarray, numbers: np.ndarray, values: np.ndarray, sizes: np.ndarray) -> None:
            some = sizes > 0  # a piece may have no token
            np.add.at(to, numbers[some], np.add.reduceat(values, (np.cumsum(sizes) - sizes)[some]) if some.any() else values)

        for numbers, bodies, before in _chunks(texts.column("_text").cast(pa.binary()).to_pylist()):
            keys, sizes = keys_of(bodies, before)
            index, values = tables[GRAMS]
            add(score, numbers, values[index.get_indexer(keys)], sizes)
            np.add.at(n_bytes, numbers, sizes)
            words, sizes = _word_hashes(bodies)
            index, counts = tables[WORDS]
            c = counts[index.get_indexer(words)]
            np.add.at(n_tokens, numbers, sizes)
            add(n_known, numbers, (c > 0).astype(np.int64), sizes)
            add(base, numbers, np.log10(c + 0.5), sizes)
        base -= n_tokens * rest
        return pa.Table.from_arrays(
            [texts.column("_id"), texts.column("_out"), pa.array(n_tokens, pa.int64()), pa.array(n_known, pa.int64()), pa.array([tokens] * n, pa.int64()), pa.array(base), pa.array(score), pa.array(-score * math.log2(10) / n_bytes)],
            names=[id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
        )

    asked = blocks.groupBy("block").applyInArrow(requests, "slice long, block long, kind int, keys binary, counts binary")
    told = asked.groupBy("slice").applyInArrow(answers, "block long, kind int, keys binary, back binary, tokens long, kinds long")
    kind = source.schema["_id"].dataType.simpleString()
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        scores, f"`{id_col}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    )
