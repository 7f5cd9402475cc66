"""Token and language-model operators against the libraries and against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("paperloom.llm")
import public_tokenizers  # noqa: E402

from paperloom.llm import lm_score, packing, piece_codec  # noqa: E402

rng = random.Random(5)
WORDS = ["the", "then", "Zu", "über", "naïve", "re-do", "x", "don't", "it's,", "12,5", "foo.\nbar", "…", "中文字", "🙂", "\t", "a▁b", "<s>", "the", "thethethe", "", "  ", "\x00", "\x1c", "é", " q"]
TEXTS = ["", " ", "  ", "\n", "\n\n a", "▁", "a", None, *(" ".join(rng.choices(WORDS, k=rng.randint(1, 30))) for _ in range(60)), " the  end", "x" * 3000, "nospace中文" * 300]


def table(spark, texts=TEXTS, extra=""):
    return spark.createDataFrame([(k, t, "e") for k, t in enumerate(texts)], "doc_id long, text string, piece string").repartition(3)


def test_piece_codec_equals_the_library(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    rows = {r.doc_id: r for r in piece_codec.digests(table(spark), path).collect()}
    assert len(rows) == len(TEXTS)
    for k, text in enumerate(TEXTS):
        ids = model.encode(text or "")
        assert rows[k].n_tokens == len(ids), (text, ids)
        assert rows[k].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), (text, ids)
        assert rows[k].decoded_sha256 == hashlib.sha256(model.decode(ids).encode()).hexdigest(), text


def test_ids_come_out_and_decode(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    df = table(spark).withColumnRenamed("piece", "ids")
    encoded = piece_codec.encode(df, path)
    assert encoded.columns == ["doc_id", "ids"]
    rows = {r.doc_id: r for r in piece_codec.decode(encoded, path).collect()}
    for k, text in enumerate(TEXTS):
        assert rows[k].ids == model.encode(text or "") and rows[k].decoded == model.decode(rows[k].ids), text
    broken = [model.encode("é中"), None, [], model.encode("a"), [3 + 0xE4, 3 + 0xB8], model.encode("b c")[1:]]
    df = spark.createDataFrame([(k, x, "old") for k, x in enumerate(broken)], "k int, ids array<int>, decoded string").coalesce(1)
    got = [r.decoded for r in piece_codec.decode(df, path).orderBy("k").collect()]
    assert got[:4] == ["é中", "", "", "a"] and "\ufffd" in got[4] and got[5] == model.decode(broken[5])


def test_piece_codec_on_words_without_end(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    own = piece_codec.PrefixTable(path)
    letters = "abcdehinorstuTHE.,éüß▁ \n"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randint(1, 40)))
        assert own.encode(text) == model.encode(text), text
        assert own.decode(own.encode(text)) == model.decode(model.encode(text)), text


def packed(rows):
    """Every sequence is gapless from 0 and not too long; returns how many there are."""
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return len(by)


def test_packing_pieces_and_places(spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    long = " ".join(rng.choices(WORDS, k=9000))
    texts = [*TEXTS, long, "a b", "a b", "<|endoftext|> x"]
    rows = packing.pack_documents(table(spark, texts), path).collect()
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for k, text in enumerate(texts):
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % packing.CAPACITY or packing.CAPACITY
        edges = [0, *range(first, len(ids) + 1, packing.CAPACITY)]
        want = [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))]
        assert sorted(got[k]) == want, text
    assert packed(rows) <= 1.1 * sum(r.length for r in rows) / packing.CAPACITY + 2


def test_packing_of_odd_tables(spark):
    """Null ids, repeated rows, ties, columns with the names of the new ones, and a length in many parts."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(None, "a b"), (None, None), (1, "a b"), (1, "a b"), (1, "a b"), (2, ("c d " * 3000).strip()), *((k, "e f") for k in range(10, 60))]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, ids string, sequence_id int").repartition(3)
    pieces = packing.written(packing.token_pieces(df, path).withColumns({"offset": packing.F.lit("old"), "more": packing.F.lit(1)}), "test-pieces")
    placed = packing.pack(pieces)
    assert placed.columns == ["doc_id", "piece", "start", "length", "ids", "more", "sequence_id", "offset"]
    found = placed.collect()
    assert len(found) == pieces.count() and packed(found) <= sum(r.length for r in found) / packing.CAPACITY + 2
    assert len({(r.sequence_id, r.offset) for r in found}) == len(found)
    assert Counter(r.doc_id for r in found if r.doc_id in (1, None)) == {1: 3, None: 2}
    assert sum(r.length for r in found if r.doc_id == 2) == 6001


def test_packing_ranks_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "PART_ROWS", 7)
    test_packing_of_odd_tables(spark)


def test_packed_sequences_hold_the_ids(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "BATCH_BYTES", 100)
    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    texts = [*TEXTS, " ".join(rng.choices(WORDS, k=3000))]
    placed = packing.written(packing.pack_documents(table(spark, texts), path, 64), "test-placed")
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u2") for r in packing.sequences(placed).collect()}
    by = defaultdict(list)
    for r in placed.collect():
        by[r.doc_id].append((r.start, whole[r.sequence_id][r.offset : r.offset + r.length].tolist()))
        assert by[r.doc_id][-1][1] == np.frombuffer(r.ids, "<u2").tolist()
    assert max(map(len, whole.values())) <= 64 and sum(map(len, whole.values())) == sum(r.length for r in placed.collect())
    for k, text in enumerate(texts):
        assert [i for _, ids in sorted(by[k]) for i in ids] == [*model.encode(text or "", add_special_tokens=False).ids, 0]


def test_packing_plan_is_close_to_the_bound():
    for seed in range(20):
        r = np.random.default_rng(seed)
        sizes = np.clip(r.lognormal(5.5, 1.3, 5000).astype(int), 1, packing.CAPACITY) if seed % 2 else r.integers(1, packing.CAPACITY + 1, 3000)
        counts = Counter(sizes.tolist())
        runs, total = packing.plan(counts)
        large = sum(c for n, c in counts.items() if 2 * n > packing.CAPACITY)
        assert max(large, math.ceil(sizes.sum() / packing.CAPACITY)) <= total <= 1.02 * max(large, sizes.sum() / packing.CAPACITY) + 2
        used = defaultdict(int)
        firsts = defaultdict(list)
        for length, rank, first, per, offset in runs.tolist():
            firsts[length].append((rank, first, per, offset))
        for length, c in counts.items():
            for rank in range(c):
                start, first, per, offset = [x for x in firsts[length] if x[0] <= rank][-1]
                used[first + (rank - start) // per, offset + (rank - start) % per * length] = length
        by = defaultdict(list)
        for (s, o), n in used.items():
            by[s].append((o, n))
        assert sum(map(len, by.values())) == len(sizes) and len(by) == total
        for places in by.values():
            at = 0
            for o, n in sorted(places):
                assert o == at
                at += n
            assert at <= packing.CAPACITY


class Plain:
    """The same model with dictionaries, one byte at a time."""

    def __init__(self, streams, order=5):
        self.order, self.next = order, defaultdict(Counter)
        for s in streams:
            padded = b"\n" * order + s
            for k in range(order, len(padded)):
                for j in range(order + 1):
                    self.next[padded[k - j : k]][padded[k]] += 1

    def log10(self, context, byte):
        out, excluded = 0.0, set()
        for j in range(self.order, -1, -1):
            seen = self.next.get(context[len(context) - j :])
            if not seen:
                continue
            rest = {s: c for s, c in seen.items() if s not in excluded}
            if not rest:
                continue
            n, d = sum(rest.values()), len(rest)
            if byte in rest:
                return out + math.log10((2 * rest[byte] - 1) / (2 * n))
            out += math.log10(d / (2 * n))
            excluded = set(seen)
        return out - math.log10(256 - len(self.next.get(b"", {})))

    def score(self, s):
        padded = b"\n" * self.order + s
        return sum(self.log10(padded[k - self.order : k], padded[k]) for k in range(self.order, len(padded)))


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()


@pytest.mark.parametrize("block", [lm_score.BLOCK_BYTES, 400])
def test_lm_score_equals_plain_dictionaries(spark, block):
    texts = [*TEXTS[:40], "the cat sat on the mat " * 20, "The CAT sat", "zzzz qqqq", "the cat"]
    rows = {r.doc_id: r for r in lm_score.score_documents(table(spark, texts), "crc32(cast(doc_id as string)) % 5 = 1", block_bytes=block).collect()}
    assert len(rows) == len(texts)
    out = {k: zlib.crc32(str(k).encode()) % 5 == 1 for k in range(len(texts))}
    tokens = {k: [*lower(t).split(), None] for k, t in enumerate(texts)}
    counts = Counter(x for k, t in tokens.items() if not out[k] for x in t)
    total, kinds = sum(counts.values()), len(counts)
    model = Plain([b" ".join(tokens[k][:-1]) + b"\n" for k in tokens if not out[k]])
    for k, t in tokens.items():
        r = rows[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[k], len(t), sum(counts[x] > 0 for x in t), total)
        assert r.base_score == pytest.approx(sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in t), rel=1e-9)
        whole = b" ".join(t[:-1]) + b"\n"
        assert r.score == pytest.approx(model.score(whole), rel=1e-5)
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / len(whole), rel=1e-9)


def test_lm_score_of_null_ids_repeats_and_clashing_columns(spark):
    rows = [(None, "the cat sat on the mat"), (1, "the cat sat"), (1, "the cat sat"), (2, None), (2, "zz"), (3, "the mat")] * 2
    df = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], "doc_id long, text string, block string, _text string, score int")
    got = lm_score.score_documents(df, "doc_id = 3", block_bytes=10).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens) for r in got) == {(None, True, 7): 2, (1, False, 4): 4, (2, False, 1): 2, (2, False, 2): 2, (3, True, 3): 2}
    plain = {(r.doc_id, r.n_tokens): r.score for r in got}
    assert all(r.score == plain[r.doc_id, r.n_tokens] for r in got) and {r.train_tokens for r in got} == {22}


def test_long_streams_come_in_pieces():
    texts = [" ".join(rng.choices(["a", "bc", "def", "x" * 30], k=rng.randint(0, 60))).encode() for _ in range(30)]
    whole = [(n, b, c) for numbers, bodies, before in lm_score._chunks(texts) for n, b, c in zip(numbers, bodies, before, strict=True)]
    for most in (1, 20, 100):
        keys, words, bodies = defaultdict(list), defaultdict(list), defaultdict(bytes)
        for numbers, pieces, before in lm_score._chunks(texts, most):
            for k, p, b in zip(numbers.tolist(), pieces, before, strict=True):
                bodies[k] += p
                keys[k] += lm_score.keys_of([p], [b])[0].tolist()
                words[k] += lm_score._word_hashes([p])[0].tolist()
        for k, body, before in whole:
            assert bodies[k] == body
            assert keys[k] == lm_score.keys_of([body], [before])[0].tolist()
            assert words[k] == lm_score._word_hashes([body])[0].tolist()


def test_empty_tables(spark):
    none = table(spark, [])
    assert piece_codec.digests(none, public_tokenizers.path("piece_bpe_32k.model")).count() == 0
    assert packing.pack_documents(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    assert lm_score.score_documents(none, "doc_id % 2 = 0").count() == 0
    assert len(lm_score.score_documents(table(spark, ["a", None]), "true").collect()) == 2
