"""Passage removal against brute force over all 400-byte strings."""

import hashlib
import random
from collections import Counter

import pytest

pytest.importorskip("paperloom.llm")
from paperloom.llm import suffix_dedup  # noqa: E402

rng = random.Random(3)


def noise(n, letters="abcdefgh é\n"):
    return "".join(rng.choices(letters, k=n))


def brute(texts, length=400):
    raw = [(t or "").encode() for t in texts]
    counts = Counter(r[k : k + length] for r in raw for k in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for k in range(len(r) - length + 1):
            if counts[r[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(r)))
        kept = bytes(b for b, g in zip(r, gone, strict=True) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def cases():
    passage, other, base = noise(500), noise(405), noise(3000)
    edited = base[:700] + "#" + base[701:1500] + "##" + base[1500:]
    texts = [noise(900), noise(200) + passage + noise(300), noise(10) + passage, passage + noise(5) + passage, noise(50) + other + noise(50), other, base, edited, base[200:], base]
    texts += ["a" * 2000, "a" * 399, "ab" * 700, "", None, "x", noise(399), noise(400), noise(350) + "same tail" * 5, noise(1500, "ab"), noise(800, "é中")]
    texts += [noise(300) + passage[30:460] + noise(300) for _ in range(30)]
    texts += [base[: 400 + k] + noise(40) for k in range(5)]
    return texts


@pytest.mark.parametrize(("most", "piece", "length"), [(2048, 1 << 20, 400), (3, 1 << 20, 400), (2048, 333, 400), (2048, 1 << 20, 250), (3, 333, 37)])
def test_removal_equals_brute_force(spark, monkeypatch, most, piece, length):
    monkeypatch.setattr(suffix_dedup, "MOST_SPANS", most)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", piece)
    texts = cases()
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, 5, 1) for k, t in rows], "doc_id long, text string, at int, name int").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removal_report(df, length).collect()}
    want = brute(texts, length)
    assert len(got) == len(texts)
    for k, _ in rows:
        assert got[k] == want[k], (k, (texts[k] or "")[:60])


def test_unlike_strings_of_one_hash_are_told_apart():
    """With a hash of two values nearly all neighbours are unlike: the bytes decide."""
    import numpy as np
    import pyarrow as pa

    length = 40
    name = noise(60, "xyz").encode()
    pieces = [noise(30, "ab").encode() + name + noise(30, "ab").encode() for _ in range(40)]
    pieces += [pieces[0][:10] + pieces[1][10:], pieces[2][20:] + pieces[3][-20:]]
    table = pa.table({"back": pa.array([30] * 42, pa.int16()), "ahead": pa.array([len(p) - 2 * length + 1 - (len(p) - 2 * length + 1) for p in pieces], pa.int16()), "bytes": [p[: 30 + length] for p in pieces]})
    found = suffix_dedup._Suffixes(table, length)
    texts = [found.joined[a : a + length] for a in found.starts.tolist()]
    times = Counter(texts)
    want = [times[t] > 1 for t in texts]
    assert any(want) and not all(want) and found.repeated().tolist() == want
    found.hashes = lambda: (np.arange(found.starts.size) % 2).astype(np.uint64)
    by_hash = [len({k % 2 for k, x in enumerate(texts) if x == t}) for t in texts]
    assert [f or n > 1 for f, n in zip(found.repeated().tolist(), by_hash, strict=True)] == [w or n > 1 for w, n in zip(want, by_hash, strict=True)]
    found.hashes = lambda: np.zeros(found.starts.size, np.uint64)
    assert found.repeated().tolist() == want


def test_cut_characters_do_not_join(spark):
    """The run is the byte A0 of the first character, x and the byte C3 of the last: C4 and AA are left, which would make another one."""
    x = noise(500, "xyz")
    df = spark.createDataFrame([(1, "a\u0120" + x + "\u00eab"), (2, "\u00e0" + x + "\u00e9"), (3, None), (4, "\u00e9" * 500), (5, "\u00e9" * 500 + "!")], "doc_id long, text string")
    kept = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(df).collect()}
    assert kept == {1: "ab", 2: "", 3: "", 4: "", 5: "!"}


def test_repeated_rows_ids_and_empty_tables(spark):
    a, b = noise(600), noise(700)
    rows = [(1, a), (1, b), (2, b + "x"), (None, "short"), (3, None), (4, a), (4, a)]
    df = spark.createDataFrame([(*r, 7, "z") for r in rows], "doc_id long, text string, runs int, _text string")
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in suffix_dedup.removal_report(df).collect())
    want = sorted((d or -1, w[0], w[1]) for (d, _), w in zip(rows, brute([t for _, t in rows]), strict=True))
    assert got == want
    assert suffix_dedup.removal_report(df.limit(0)).count() == 0
    kept = suffix_dedup.remove_repeats(df)
    assert kept.dtypes == df.dtypes and kept.where("runs = 7 and _text = 'z'").count() == len(rows)
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [(-1, "short"), (1, ""), (1, ""), (2, "x"), (3, ""), (4, ""), (4, "")]
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.removal_report(df, 8)
