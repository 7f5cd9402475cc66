"""Sketched anti-joins and the bucketed cache: exact results, and plans and folders that show what was spared."""

import datetime

import pytest
from pyspark.sql import functions as F

from paperloom.operators import absence, runlog
from paperloom.sources import cache_store

AT = datetime.datetime(2026, 8, 1)
ROWS = "key string, content string, finish_reason string, written_at timestamp_ntz"


@pytest.mark.parametrize("most", [absence.MOST_BYTES, 0])
def test_anti_join_is_exact(spark, most):
    left = spark.createDataFrame([(f"k{n % 3000}", n) for n in range(4000)] + [(None, -1), ("", -2)], "key string, n int")
    right = spark.createDataFrame([(f"k{n}",) for n in range(0, 3000, 7)] + [(None,), ("k0",)], "key string")
    for r in (right, right.limit(0), right.where("key is null")):
        got = absence.anti_join(left, r, "key", most)
        assert got.columns == left.columns
        assert sorted(x.n for x in got.collect()) == sorted(x.n for x in left.join(r, "key", "left_anti").collect())
    assert absence.anti_join(left.limit(0), right, "key", most).count() == 0


def test_few_rows_pass_the_sketch(spark):
    left = spark.range(100_000).select(F.concat(F.lit("k"), F.col("id")).alias("key"))
    right = spark.range(500_000, 520_000).select(F.concat(F.lit("k"), F.col("id")).alias("key")).unionByName(left.where("key like 'k1234%'"))
    bits = absence.BITMAP * -(-right.count() * absence.BITS_PER_KEY // absence.BITMAP)
    told = absence._maybe(left, absence.sketch(right, "key", bits), "key", bits)
    partners = left.join(right, "key", "left_semi").count()
    shuffled = told.where("_maybe").count()
    assert partners <= shuffled < partners + 500 and told.count() == 100_000


def test_cache_in_buckets(spark, tmp_path):
    path = str(tmp_path / "cache")
    row = lambda k, text, day: (f"k{k}", text, "stop", AT + datetime.timedelta(days=day))
    first = [row(k, f"a{k}", 0) for k in range(200)]
    cache = cache_store.open_cache(spark, "cache_one", path, parts=4, buckets=4)
    assert cache.count() == 0
    assert cache_store.upsert_cache(spark, "cache_one", path, spark.createDataFrame(first, ROWS)) == [0, 1, 2, 3]
    files = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "cache").glob("part=*/*.parquet")}
    touched = cache_store.upsert_cache(spark, "cache_one", path, spark.createDataFrame([row(3, "new", 1), row(3, "old", -1), row(3, "newer", 1)], ROWS))
    assert len(touched) == 1
    left = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "cache").glob("part=*/*.parquet") if p.parent.name != f"part={touched[0]}"}
    assert left and all(files[name] == at for name, at in left.items())
    assert cache_store.upsert_cache(spark, "cache_one", path, spark.createDataFrame([], ROWS)) == []
    spark.sql("drop table cache_one")
    again = cache_store.open_cache(spark, "cache_two", path)  # another name, the numbers of the manifest
    assert {r.key: r.content for r in again.collect()} == {**{k: c for k, c, _, _ in first}, "k3": "newer"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        work = spark.createDataFrame([("k3",), ("k9",), ("no",), ("k3",)], "key string")
        hits = runlog.lookup(work, again)
        assert {r.key for r in hits.collect()} == {"k3", "k9"}
        plan = hits._jdf.queryExecution().executedPlan().toString()
        scan = plan.split("Final Plan")[-1].split("Initial Plan")[0]
        cache_side = scan.split("FileScan parquet")[0].rsplit("LeftSemi", 1)[-1].split("\n")
        above = [line for line in cache_side if "Exchange" in line]
        assert "Bucketed: true" in plan and not above, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table cache_two")


def test_pages_come_all_or_none(spark, tmp_path):
    from paperloom.sources import page_files

    root = tmp_path / "site"
    root.mkdir()
    rows = [(f"nlp/p{k}.md", f"page {k}") for k in range(40)] + [("ml/deep/x.md", None), ("top.md", "글")]
    df = spark.createDataFrame(rows, "page_path string, page string").repartition(4)
    page_files.write_committed(df, str(root))
    files = {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file()}
    assert files == {n: t or "" for n, t in rows} and not (root / "_staging").exists()
    bad = df.withColumn("page", F.concat("page", F.lit("!"))).unionByName(spark.createDataFrame([(None, "x")], df.schema))
    with pytest.raises(Exception, match="without a path"):
        page_files.write_committed(bad, str(root))
    assert {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file()} == files
    page_files.write_committed(spark.createDataFrame([("top.md", "new")], df.schema), str(root))
    page_files.write_committed(df.limit(0), str(root))
    assert (root / "top.md").read_text() == "new" and (root / "nlp/p3.md").read_text() == "page 3"
