"""Daily counters in any order of files, corrections, and upkeep of an archive with odd categories."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from paperloom.streaming import jobs

LOG = "ts timestamp, run_id string, call_kind string, cache_hit boolean, validation_fail_reason string"
START = datetime.datetime(2026, 8, 1, 6)


def log_rows():
    rng = random.Random(8)
    rows = [(START + datetime.timedelta(hours=rng.randrange(24 * 12)), f"r{rng.randrange(3)}", rng.choice(["batch", "single", "summary"]), rng.random() < 0.4, rng.choice([None, "untranslated"])) for _ in range(200)]
    return [*rows, (None, "r1", "batch", True, None), (START, None, "batch", True, None), rows[0], rows[0]]


def drained(query):
    query.awaitTermination()
    assert query.exception() is None
    return query.lastProgress["batchId"]


@pytest.mark.parametrize("order", ["time", "backwards", "mixed"])
def test_daily_counters_in_any_order_of_files(spark, tmp_path, order):
    rows = log_rows()
    rows.sort(key=lambda r: r[0] or START, reverse=order == "backwards")
    if order == "mixed":
        random.Random(3).shuffle(rows)
    source, root, epoch = str(tmp_path / "in"), str(tmp_path / "out"), None
    for k in range(0, len(rows), 30):  # one file a batch, so there are folds and deletions between them
        spark.createDataFrame(rows[k : k + 30], LOG).coalesce(1).write.mode("append").parquet(source)
        epoch = drained(jobs.daily_counters(jobs.read_stream(spark, spark.createDataFrame([], LOG).schema, source, 10), root, str(tmp_path / "state"), fold=2))
    assert epoch == 6
    df = spark.createDataFrame(rows, LOG).where("call_kind != 'summary'")
    expected = df.groupBy(F.to_date("ts").alias("day"), "run_id", "validation_fail_reason").agg(F.count("*").alias("calls"), F.count_if("cache_hit").alias("hits"))
    key = lambda r: tuple(str(x) for x in r)
    got = jobs.read_daily(spark, root, epoch, fold=2)
    assert sorted(map(key, got.collect())) == sorted(map(key, expected.collect()))
    late = jobs.corrections(spark, root, epoch, fold=2).count()
    assert late == 0 if order == "time" else late >= 0
    assert len(list((tmp_path / "out" / "entries").iterdir())) <= 5


def test_corrections_are_entries_of_closed_days(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    for day in (5, 1, 6):
        spark.createDataFrame([(START + datetime.timedelta(days=day), "r", "batch", False, None)], LOG).coalesce(1).write.mode("append").parquet(source)
        epoch = drained(jobs.daily_counters(jobs.read_stream(spark, spark.createDataFrame([], LOG).schema, source, 10), root, str(tmp_path / "state")))
    assert [(str(r.day), r.epoch, r.calls) for r in jobs.corrections(spark, root, epoch).collect()] == [("2026-08-02", 1, 1)]
    assert jobs.read_daily(spark, root, epoch).count() == 3


PAGES = "arxiv_id string, category string, translated date, edition long, page string"


def test_upkeep_with_odd_categories(spark, tmp_path):
    names = [None, "a:b", "c%d", "e/f g", "", "x=y", "__HIVE_DEFAULT_PARTITION__", "글"]
    day = START.date()
    for e in range(3):
        rows = [(f"p{k}", c, day, e, f"page {k} of {e}") for k, c in enumerate(names)] + [(None, "a:b", day, e, f"no id {e}")]
        spark.createDataFrame(rows, PAGES).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{e}"))
        epoch = drained(jobs.upkeep(jobs.read_stream(spark, spark.createDataFrame([], PAGES).schema, str(tmp_path / "in" / "*"), 10), str(tmp_path / "out"), str(tmp_path / "state"), parts=2))
    got = jobs.read_archive(spark, str(tmp_path / "out"), epoch).collect()
    assert {(r.arxiv_id, r.category, r.page) for r in got} == {*((f"p{k}", c, f"page {k} of 2") for k, c in enumerate(names)), (None, "a:b", "no id 2")}


def test_empty_archive(spark, tmp_path):
    (tmp_path / "in").mkdir()
    drained_query = jobs.upkeep(jobs.read_stream(spark, spark.createDataFrame([], PAGES).schema, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
    drained_query.awaitTermination()
    assert jobs.read_archive(spark, str(tmp_path / "out"), 0).count() == 0
