"""The near-duplicate join and its components against brute force."""

import random

import pytest
from pyspark.sql.functions import lit as df_lit

pytest.importorskip("paperloom.llm")
from paperloom.llm import jaccard_join, shingles  # noqa: E402
from paperloom.llm.components import components  # noqa: E402

rng = random.Random(11)


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode()


def shingle_set(text):
    w = lower(text).split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def families():
    vocabulary = [f"w{k}" for k in range(400)]
    texts = []
    for size in (1, 1, 1, 2, 2, 3, 5, 25, 60):
        base = rng.choices(vocabulary, k=rng.randint(60, 400))
        for _ in range(size):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 60))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    passage = " ".join(rng.choices(vocabulary, k=80))
    texts += [f"{' '.join(rng.choices(vocabulary, k=60))} {passage}" for _ in range(40)]
    texts += [texts[3], texts[3].upper(), texts[-1], "", None, "  ", "a b", "a B", "a b c", "one", "one two three four five", "one two three four five six"]
    return texts


def expected(rows):
    sets = [shingle_set(t) for _, t in rows]
    n = len(rows)
    links, forest = [0] * n, shingles.Forest(n)
    for i in range(n):
        for j in range(i + 1, n):
            both = len(sets[i] & sets[j])
            if both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                links[i] += 1
                links[j] += 1
                forest.join(i, j)
    roots = forest.roots().tolist()
    smallest = {}
    for k, (doc, _) in enumerate(rows):
        smallest[roots[k]] = min(smallest.get(roots[k], doc), doc)
    return sorted((doc, smallest[roots[k]], links[k], len(sets[k])) for k, (doc, _) in enumerate(rows))


@pytest.mark.parametrize("blocks", [None, (7, 900)])
def test_join_equals_brute_force(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(jaccard_join, "BUCKET_ROWS", blocks[0])
        monkeypatch.setattr(jaccard_join, "FAMILY_SHINGLES", blocks[1])
        monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    texts = families()
    rows = [(100 + k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n long, key string").repartition(4)
    got = sorted((r.doc_id, r.class_id, r.n_links, r.n_shingles) for r in jaccard_join.near_duplicates(df).collect())
    assert got == expected(rows)


@pytest.mark.parametrize("sides", [1, 2])
def test_memory_of_a_block_is_linear_in_its_rows(spark, monkeypatch, sides):
    """2,000 different near copies are 2M (or 1M) pairs of a block: they must not be held at once."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    class Dealt:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(jaccard_join, "_dealt", lambda *args: Dealt())
    run = jaccard_join.verified_links(None, shingles.least_matches(0.8, 1e-6, jaccard_join.STEPS), 0.8)
    base = [f"w{k}" for k in range(104)]
    texts = [" ".join([*base[: k % 104], f"new{k}", *base[k % 104 + 1 :]]) for k in range(2000)]
    values, sizes = shingles.shingle_sets([t.encode() for t in texts])
    sigs = ((shingles.minhashes(values, sizes, jaccard_join.HASHES) >> np.uint64(13)) & np.uint64(255)).astype(np.uint8)
    n = len(texts)
    columns = [[1] * n, [0] * n, [sides - 1] * n, shingles.set_keys(values, sizes), [k % sides for k in range(n)], [1] * n, [x.tobytes() for x in sigs], texts]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["family", "a", "b", "key", "_mine", "copies", "sig", "text"])
    tracemalloc.start()
    (out,) = run(iter([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    sets = [shingle_set(t) for t in texts[:300]]
    links = dict(zip(out.column("u").to_pylist(), out.column("links").to_pylist(), strict=True))
    assert len(links) == n and len(set(out.column("v").to_pylist())) == 1
    # all share 91 of 100 shingles or more with the base, hence 90 with each other at the least where changes lie apart
    assert min(links.values()) >= 1 and min(len(a & b) for a in sets[:20] for b in sets) >= 90
    near = [[len(a & b) >= 0.8 * len(a | b) for b in sets] for a in sets[:20]]
    assert all(map(all, near)) and set(links.values()) == {n - 1 if sides == 1 else n // 2}
    assert peak < 60 << 20, peak


@pytest.mark.parametrize("most", [1, 100, 1 << 22])
def test_intersections_in_strips(most):
    sets = [set(rng.sample(range(500), rng.randint(0, 200))) for _ in range(30)]
    values = shingles.np.array([v for s in sets for v in sorted(s)], shingles.np.uint64)
    left, right = (shingles.np.array(x) for x in zip(*((i, j) for i in range(30) for j in range(i)), strict=True))
    found = shingles.Intersections(values, shingles.np.array([len(s) for s in sets]), most).of(left, right)
    assert found.tolist() == [len(sets[i] & sets[j]) for i, j in zip(left, right, strict=True)]


def test_large_families_are_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FAMILY_ROWS", 9)
    rows = list(enumerate(families()))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((r.doc_id, r.class_id, r.n_links, r.n_shingles) for r in jaccard_join.near_duplicates(df).collect()) == expected(rows)


def test_vast_buckets_lose_no_link_and_deal_the_rest_only(spark, monkeypatch):
    """A family of near copies hangs on one pivot: hardly a row is dealt, however many blocks it would fill."""
    monkeypatch.setattr(jaccard_join, "BUCKET_ROWS", 32)
    dealt = []
    divided = jaccard_join._divided

    def counted(large, table):
        edges, pairs = divided(large, table)
        dealt.append((large.count(), pairs.count()))
        return edges, pairs

    monkeypatch.setattr(jaccard_join, "_divided", counted)
    words = [f"w{k}" for k in range(150)]
    texts = [" ".join([*words[: k % 150], f"x{k}", *words[k % 150 + 1 :]]) for k in range(300)]
    texts += families()
    rows = [(k, t) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((r.doc_id, r.class_id, r.n_links, r.n_shingles) for r in jaccard_join.near_duplicates(df).collect()) == expected(rows)
    ((large, pairs),) = dealt
    assert large > 1000 and pairs < large // 2


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d e f g"), (1, "a b c d e f g"), (1, "other words in here now then"), (None, "a b c d e f g"), (5, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.class_id, r.n_links) for r in jaccard_join.near_duplicates(df).collect())
    assert got == [(-1, 1, 2), (1, 1, 0), (1, 1, 2), (1, 1, 2), (5, 5, 0)]
    assert jaccard_join.near_duplicates(df.limit(0)).count() == 0
    assert sorted((r.doc_id, r.text) for r in jaccard_join.drop_near_duplicates(df.where("doc_id is not null and text like 'a b%' or doc_id = 5")).collect()) == [(1, "a b c d e f g"), (5, None)]


def test_one_of_each_class_stays(spark):
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "one two three four five six"), (1, "quite other words are in this one"), (5, "quite other words are in this one"), (2, "stands all alone here it does"), (2, "stands all alone here it does"), (None, "x y z"), (7, None)]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, class_id int")
    kept = jaccard_join.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id or 0, r.text or "") for r in kept.collect())) == [(0, "x y z"), (1, "a b c d e f g"), (1, "quite other words are in this one"), (2, "stands all alone here it does"), (3, "one two three four five six"), (7, "")]


def test_very_long_text_null_texts_and_empty_tables(spark):
    long = " ".join(f"w{k % 5000}x{k}" for k in range(30_000))
    df = spark.createDataFrame([(1, long), (2, long + " one more"), (3, None), (4, " "), (None, None)], "doc_id long, text string").withColumn("_h", df_lit("z"))
    got = {r.doc_id: (r.class_id, r.n_links, r.n_shingles) for r in jaccard_join.near_duplicates(df).collect()}
    assert got == {1: (1, 1, 29_996), 2: (1, 1, 29_998), 3: (3, 0, 0), 4: (4, 0, 0), None: (None, 0, 0)}
    kept = jaccard_join.drop_near_duplicates(df)
    assert kept.dtypes == df.dtypes and sorted((r.doc_id or 0, r._h) for r in kept.collect()) == [(k, "z") for k in (0, 1, 3, 4)]
    assert jaccard_join.drop_near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_hub(spark, monkeypatch):
    """A node with most of the edges is dealt over many shares."""
    from paperloom.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 20)
    edges = [(0, k) for k in range(1, 900)] + [(899, 1000), (1000, 1001), (2000, 2001)] + [(5000, k) for k in range(3000, 3100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long").repartition(4)).collect()}
    assert got == {**dict.fromkeys([*range(900), 1000, 1001], 0), 2000: 2000, 2001: 2000, **dict.fromkeys([5000, *range(3000, 3100)], 3000)}


def test_components_leave_nulls_out(spark):
    edges = spark.createDataFrame([(1, 2), (None, 3), (4, None), (None, None), (2, 1)], "u long, v long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {(1, 1), (2, 1)}
    assert components(edges.limit(0)).count() == components(edges.where("u is null")).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(7, 9), (9, 8), (3, 3), (500, 1), (500, 2), (500, 3)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 100 for k in range(100, 141)}, 7: 7, 8: 7, 9: 7, 500: 1, 1: 1, 2: 1, 3: 1}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
