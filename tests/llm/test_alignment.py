"""Cross-tokenizer alignment against a plain walk over both tokenizers' own output."""

import base64
import bisect
import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from paperloom.llm import queries, token_alignment

try:
    import public_tokenizers
except ImportError:
    public_tokenizers = None
pytestmark = pytest.mark.skipif(public_tokenizers is None, reason="the vocabulary files are not here")
FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
SCHEMA = "doc_id long, text string, pair string, block int"


def brute(texts):
    """The contract's numbers of each text, from the tokenizers' own encodings, one text at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    bpe.encode_special_tokens = True
    ranks = (line.split() for line in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))
    spelled = {int(i): base64.b64decode(t) for t, i in ranks}
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def piece(i):
        return bytes((int(model.id_to_piece(i)[3:5], 16),)) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()

    out, counts = [], Counter()
    for text in texts:
        a = [(i, spelled[i]) for i in bpe.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in model.encode(text or "")]
        if not text or any(b"".join(t for _, t in x) != (" " + text).encode() for x in (a, b)):
            out.append((0, 0, [], []))
            continue
        spans = []
        for side in (a, b):
            at, found = 0, []
            for i, t in side:
                found.append((i, at, at + len(t)))
                at += len(t)
            spans.append(found)
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [([], []) for _ in cuts]
        for k, side in enumerate(spans):
            for i, _, e in side:
                groups[bisect.bisect_left(cuts, e)][k].append(i)
        links, k = [], 0
        for i, s, e in spans[0]:
            while spans[1][k][2] <= s:
                k += 1
            m = k
            while m < len(spans[1]) and spans[1][m][1] < e:
                links.append((i, spans[1][m][0]))
                m += 1
        counts.update(links)
        out.append((len(a), len(b), groups, links))
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    rows = []
    for n_a, n_b, groups, links in out:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if links else ""
        rows.append((n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return rows


def align(df, **more):
    return token_alignment.align(df, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), **more)


def check(got, ids, texts):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    rows = [(i, *r) for i, r in zip(ids, brute(texts), strict=True)]
    assert sorted(((r.doc_id, *(r[f] for f in FIELDS)) for r in got.collect()), key=key) == sorted(rows, key=key)


def test_query_equals_brute_force(spark):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("test tables are not here")
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    check(queries.op12_token_alignment(spark, data), [r[0] for r in rows], [r[1] for r in rows])


def odd_texts():
    rng = random.Random(4)
    signs = ["a", "the ", " ", "  ", "\n", "\t", "é", "ß", "日本", "▁", "🙂", "\0", "\x1c", "<|endoftext|>", "</s>", "<0x41>", "01", "'s", " ", "́", "\r\n", "ﬁ", "한국어", "<s>"]
    return ["".join(rng.choices(signs, k=rng.randint(1, 40))) for _ in range(300)]


@pytest.mark.parametrize("block_bytes", [1, 500, 1 << 20])
def test_odd_texts(spark, block_bytes):
    texts = [None, "", " ", "a", *odd_texts(), "same text here", "same text here", "ab " * 40000, "🙂" * 3000]
    ids = [None, *range(1, len(texts))]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(3)
    check(align(df, block_bytes=block_bytes), ids, texts)


def test_empty_table(spark):
    assert align(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cuts_by_halves():
    rng = np.random.default_rng(2)
    for _ in range(300):
        size = int(rng.integers(1, 60))
        text_ends = np.unique(np.append(rng.integers(1, size + 1, 3), size))
        ends = [np.unique(np.concatenate([rng.integers(1, size + 1, rng.integers(0, 40)), text_ends])) for _ in range(2)]
        starts = np.concatenate([[0], text_ends[:-1]])
        assert token_alignment.groups(*ends, starts, text_ends).tolist() == sorted(set(ends[0].tolist()) & set(ends[1].tolist()))


def test_packed_numbers():
    for numbers in ([], [0], [0, 0, 5, 5, 70000, 1 << 31]):
        assert token_alignment.unpack_numbers(token_alignment.pack_numbers(np.array(numbers, np.int64))).tolist() == numbers
