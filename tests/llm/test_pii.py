"""Personal data: sure spans against the plain patterns, and the bootstrapped ones on texts with known contexts."""

import hashlib
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.llm import pii, queries

KINDS = ("email", "ip", "card", "phone")
PLAIN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
SCHEMA = "doc_id long, text string, base string, instance int"


def fits(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == 1:
        return all(int(x) <= 255 for x in value.split("."))
    if kind == 2:
        doubled = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and doubled % 10 == 0
    return kind == 0 or 9 <= len(digits) <= 15


def base(text):
    return [(k, m.start(), m.end()) for k, p in enumerate(PLAIN) for m in re.finditer(p, text or "") if fits(k, m.group())]


def named(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def expected(text):
    spans = base(text)
    return (*(sum(k == kind for k, _, _ in spans) for kind in range(4)), hashlib.sha256(named(spans).encode()).hexdigest())


def check_base(got, ids, texts):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    rows = got.collect()
    assert sorted((tuple(r[:6]) for r in rows), key=key) == sorted(((i, *expected(t)) for i, t in zip(ids, texts, strict=True)), key=key)
    by_id = dict(zip(ids, texts, strict=True))
    for r in rows:
        spans = [(KINDS.index(k), int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]
        assert spans == sorted(spans) and set(base(by_id[r.doc_id])) <= set(spans)
    return rows


def test_query_equals_plain_patterns(spark):
    data = "/root/testdata/sf0.01"
    if not os.path.isdir(data):
        pytest.skip("test tables are not here")
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    check_base(queries.op13_pii(spark, data), [r[0] for r in rows], [r[1] for r in rows])


def odd_texts(count=400):
    rng = random.Random(6)
    parts = ["a@b.c", "@", ".", "_", "+1", "x", " ", "-", "1", "22", "255", "256", "0", "4111 1111 1111 1111", "4111111111111111", "(", ")", "é", "日", "\n", "🙂", "%", "+49 30 123456", ".5.6", "5500-0000-0000-0004", " (at) ", "b.c", "::1", "fe80:0:1", "<", "#", "00000000000000000000000000000007"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(count)]


def test_odd_texts(spark):
    texts = [None, "", "a@b.c_x@y.z", "1.2.3.4.5.6.7.8.9", "1.2.3.4 0300.1.1.1", "+1+123456789+12 345 678 9", "a@b.c.@d.e", *odd_texts(), "9" * 50_000, "a" * 50_000 + "@b.c", "1.1.1." * 20_000, "+123456789 " * 3000]
    ids = [None, *range(1, len(texts))]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, texts, strict=True)], SCHEMA).repartition(4)
    check_base(pii.find_pii(df), ids, texts)


def test_empty_table(spark):
    assert pii.find_pii(spark.createDataFrame([], SCHEMA)).collect() == []


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, "mail a@b.cd", "", 0)] * 3 + [(1, "other", "", 0), (None, "mail a@b.cd", "", 0)] * 2, SCHEMA)
    rows = pii.find_pii(df).groupBy("doc_id", "n_email", "spans").count().collect()
    assert sorted((r[0] or 0, r[1], r[2], r[3]) for r in rows) == [(0, 1, "email:5:11", 2), (1, 0, "", 2), (1, 1, "email:5:11", 3)]


def context_rows():
    """Seeds behind fixed words, unseen identifiers behind the same words, and look-alikes behind others."""
    rng = random.Random(9)
    rows, unseen, clean = [], {}, set()
    fill = lambda: " ".join(rng.choices(["the", "of", "lorem", "stone", "river", "blue"], k=rng.randint(2, 6)))
    number = lambda: f"{rng.randint(100, 999)}-{rng.randint(1000, 9999)}"
    for k in range(40):
        rows.append((k, f"{fill()} call me: +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} {fill()}"))
        rows.append((100 + k, f"{fill()} write to: user{k}@mail{k}.example.com {fill()}"))
        rows.append((200 + k, f"{fill()} order no. {number()} {fill()}"))
        clean.add(200 + k)
        rows.append((300 + k, f"{fill()} from {number()} to {number()} {fill()}"))
        clean.add(300 + k)
    for k in range(5):
        value = number()
        text = f"{fill()} call me: {value} {fill()}"
        rows.append((400 + k, text))
        unseen[400 + k] = [(3, text.index(value), text.index(value) + len(value))]
        value = f"user{k} (at) host{k} (dot) org"
        text = f"{fill()} write to: {value} {fill()}"
        rows.append((500 + k, text))
        unseen[500 + k] = [(0, text.index(value), text.index(value) + len(value))]
    return rows, unseen, clean


def test_contexts_discover_unseen_identifiers(spark):
    rows, unseen, clean = context_rows()
    df = spark.createDataFrame([(i, t, "", 0) for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in pii.find_pii(df).collect()}
    for i, spans in unseen.items():
        assert got[i].spans == named(spans) and got[i].n_phone == got[i].n_email == 0
    assert all(got[i].spans == "" for i in clean)
    learned = {r.pattern: r for r in pii.learned_patterns(df).collect()}
    assert learned["me: _"].phone > 0.8 and learned["no. _"].phone == 0


def brute_accepted(rows):
    """The rounds of scoring in plain Python over the edges."""
    edges = {(r.instance, r.seed, tuple(r.may), p) for r in rows for p in r.patterns}
    degree, seeds, of = {}, {}, {}
    for i, s, may, p in edges:
        degree[p] = degree.get(p, 0) + 1
        if s is not None:
            seeds.setdefault(p, [0.0] * 4)[s] += 1
        elif may:
            of.setdefault((i, may), []).append(p)
    of = {i: [p for p in ps if degree[p] > 1] for i, ps in of.items()}
    scores = {i: [0.0] * 4 for i in of}
    top = {}
    for _ in range(pii.ROUNDS):
        extra = {}
        for i, ps in of.items():
            for p in ps:
                e = extra.setdefault(p, [0.0] * 4)
                for k in range(4):
                    e[k] += scores[i][k]
        conf = {p: [(seeds.get(p, [0.0] * 4)[k] + extra[p][k]) / (degree[p] + pii.PRIOR) for k in range(4)] for p in extra}
        weight = {p: (degree[p] - 1) / (degree[p] - 1 + pii.PRIOR) for p in extra}
        for (i, may), ps in of.items():
            if ps:
                scores[i, may] = [sum(conf[p][k] * weight[p] for p in ps) / sum(weight[p] for p in ps) if k in may else 0.0 for k in range(4)]
                top[i, may] = [max(conf[p][k] for p in ps) if k in may else 0.0 for k in range(4)]
    out = {}
    for (i, may), t in top.items():
        sure = [(scores[i, may][k], -k) for k in range(4) if t[k] >= pii.SURE_PATTERN and scores[i, may][k] >= pii.SURE_INSTANCE]
        if sure:
            out[i] = -max(sure)[1]
    return out


@pytest.mark.parametrize("hot", [1, 1000])
def test_scores_equal_brute_force(spark, monkeypatch, hot):
    from paperloom.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", hot)
    rows, _, _ = context_rows()
    df = spark.createDataFrame([(i, t, "", 0) for i, t in rows] + [(900 + k, t, "", 0) for k, t in enumerate(odd_texts(100))], SCHEMA)
    seen = pii.occurrences(pii.scan(df, "doc_id", "text"))
    assert {r.instance: r.kind for r in pii.score_graph(seen)[1].collect()} == brute_accepted(seen.collect())


def test_sums_before(spark):
    df = spark.createDataFrame([(list(range(n)),) for n in (1, 2, 5, 16, 99)], "a array<int>")
    for r in df.select("a", pii.sums_before(F.col("a")).alias("s")).collect():
        assert r.s == [sum(r.a[:k]) for k in range(len(r.a))]
