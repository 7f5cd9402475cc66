"""Every registered archive query against its SQL in DuckDB on the smallest tables."""

import os

import pytest

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")

from paperloom.plans import registry  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    text = lambda v: "" if v is None or v != v else repr(round(v, 9)) if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[k]) for k in order) for r in values)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in registry.ORACLES:
        assert got or name == "l11_revalidate"
        return
    result = duck.sql(registry.ORACLES[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert got == rows(result.columns, result.fetchall())


def test_every_sql_has_a_query():
    assert set(registry.ORACLES) <= set(registry.QUERIES)
