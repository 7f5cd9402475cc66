"""Whitening: the eigen solver against numpy's, the fitted numbers against exact integers, and odd tables."""

import math
import os

import numpy as np
import pytest

from paperloom.llm import queries, spectrum, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, deviation string, _x string"


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["full", "rank", "equal", "close", "zero"])
def test_leading_pairs(size, kind):
    rng = np.random.default_rng(size)
    a = rng.standard_normal((3 * size, size))
    if kind == "rank":
        a[:, size // 2 :] = 0
    v = np.cov(a.T, bias=True).reshape(size, size)
    if kind == "equal":
        v = np.diag([5.0] + [2.0] * (size - 1))
    if kind == "close":
        q, _ = np.linalg.qr(rng.standard_normal((size, size)))
        v = q @ np.diag(1 + 1e-9 * np.arange(size)) @ q.T
        v = (v + v.T) / 2
    if kind == "zero":
        v = np.zeros((size, size))
    values, vectors = spectrum.leading(v, 16)
    expected = np.linalg.eigvalsh(v)[::-1][:16]
    expected = expected[expected > 4 * size * spectrum.EPS * np.abs(v).sum(1).max()]
    assert len(values) == len(expected)
    assert np.allclose(values, expected, rtol=1e-12, atol=0)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max(initial=0) < 1e-12
    assert np.abs(v @ vectors.T - vectors.T * values).max(initial=0) < 1e-12


def test_inertia_of_an_indefinite_matrix():
    a = np.random.default_rng(3).standard_normal((30, 30))
    a = a + a.T
    for shift in np.linspace(-12, 12, 49):
        assert spectrum.count_above(a, shift) == (np.linalg.eigvalsh(a) > shift).sum()
    assert spectrum.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1


def test_products_beyond_doubles():
    rng = np.random.default_rng(1)
    for top in (10, 1 << 30, 1 << 60):
        a, b = rng.integers(-top, top, (7, 3)), rng.integers(-top, top, (7, 2))
        assert (whitening.exact_product(a, b) == a.astype(object).T @ b.astype(object)).all()


def brute(rows, most=16):
    """vec_id -> list of (component, n, deviation, whitened, explained), from exact sums and numpy's solver."""
    kept = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    if not kept:
        return [], None
    distinct = sorted({x for _, x in kept})
    n = len(distinct)
    sums = [sum(c) for c in zip(*distinct, strict=True)]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, sums, strict=True)] for x in distinct])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u.T[::-1][:most]
    out = []
    for i, x in kept:
        z = np.array([(n * a - s) / n for a, s in zip(x, sums, strict=True)])
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        out += [(i, k + 1, n, deviation, abs(z @ u[k]) / e[k] ** 0.5, e[k] / np.trace(v)) for k in range(len(e)) if e[k] > 1e-9 * e[0] > 0]
    return out, len(e)


def check(df, rows):
    got = sorted((r.vec_id if r.vec_id is not None else -1, r.component, r.n, r.deviation, abs(r.whitened), r.explained, r.identity_error) for r in df.collect())
    expected = sorted(((-1 if i is None else i), *rest) for i, *rest in brute(rows)[0])
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[4] == pytest.approx(e[4], rel=1e-6, abs=1e-7) and g[5] == pytest.approx(e[5], rel=1e-6) and g[6] < 1e-9


def test_query_equals_brute_force(spark):
    data = "/root/testdata/sf0.001"
    if not os.path.isdir(data):
        pytest.skip("test tables are not here")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{data}/embeddings.parquet").collect()]
    check(queries.op11_whitening(spark, data), rows)


def test_nulls_repeats_copies_and_clashing_columns(spark):
    rng = np.random.default_rng(5)
    rows = [(k % 37, [float(np.float32(c)) for c in rng.standard_normal(5) * [9, 5, 3, 1, 0.5]]) for k in range(60)]
    rows += [rows[0]] * 40 + [(None, rows[1][1]), (7, None), (8, [1.0, None, 0.0, 0.0, 0.0]), (9, [1.0, math.nan, 0.0, 0.0, 0.0]), (10, [math.inf] + [0.0] * 4), (111, [1e12, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x", "y") for i, v in rows], SCHEMA)
    small = [r for r in rows if r[0] != 111]
    check(whitening.report(df.where("vec_id is null or vec_id != 111")), small)
    with pytest.raises(Exception, match="(?i)overflow|cast"):
        whitening.report(df).collect()  # the deviation needs more than a long
    exact = {r.vec_id: int(r.deviation) for r in whitening.transform(df, whitening.fit(df)).collect()}
    assert exact[111] == next(d for i, _, _, d, *_ in brute(rows)[0] if i == 111) > 1 << 63


def test_nothing_to_fit(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.report(empty).collect() == []
    same = spark.createDataFrame([(k, [1.0, 2.0], 0, "", "") for k in range(5)], SCHEMA)
    assert whitening.report(same).collect() == []
    assert whitening.transform(same, whitening.fit(same)).count() == 5
    line = spark.createDataFrame([(k, [float(k), float(k)], 0, "", "") for k in range(5)], SCHEMA)
    assert {r.component for r in whitening.report(line).collect()} == {1}
    with pytest.raises(ValueError, match="entries"):
        whitening.report(spark.createDataFrame([(1, [1.0], 0, "", ""), (2, [1.0, 2.0], 0, "", "")], SCHEMA))
