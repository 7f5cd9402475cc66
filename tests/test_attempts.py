"""Votes as of a date by blocks, the attempt ledger, and plans that keep long texts out of aggregates."""

import datetime
import random

from paperloom.operators import pair_quality, runlog, selection

DAY = datetime.date(2026, 8, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_votes_by_blocks_equal_a_plain_walk(spark):
    rng = random.Random(7)
    votes = [(rng.choice(["a", "b", "c", "", None]), DAY + datetime.timedelta(days=rng.randrange(-40, 60)), rng.choice([None, -3, 0, 4, 9])) for _ in range(300)]
    runs = [DAY + datetime.timedelta(days=k) for k in (*range(-30, 30), 30, 45, 400)]
    v = spark.createDataFrame(votes, "id string, snapshot_date date, upvotes long")
    r = spark.createDataFrame([(x,) for x in runs], "as_of date")
    for days in (0, 1, 7):
        expected = {}
        for i, day, n in votes:
            for run in runs:
                if i and run - datetime.timedelta(days=days) <= day <= run:
                    expected[run, i] = max(expected.get((run, i), 0), n or 0)
        got = {(x.as_of, x.id): x.upvotes for x in selection.upvotes_asof(v, r, days).collect()}
        assert got == expected
    assert selection.upvotes_asof(v, r.limit(0)).count() == 0


def test_backfill_of_daily_runs_uses_many_tasks(spark):
    """Every day wants the same few papers: the rounds give what the walk through time gives."""
    rng = random.Random(11)
    start = datetime.datetime(2026, 8, 1, 12)
    rows = list({(c, f"p{k}"): (c, f"p{k}", start + datetime.timedelta(days=rng.randrange(40)), 10) for k in range(150) for c in rng.sample(["c0", "c1", "c2"], rng.randint(1, 3))}.values())
    votes = [(f"p{k}", DAY + datetime.timedelta(days=rng.randrange(40)), rng.randrange(5)) for k in range(0, 150, 2)]
    runs = [DAY + datetime.timedelta(days=k) for k in range(45)]
    frames = (
        spark.createDataFrame([(x,) for x in runs], "as_of date"), spark.createDataFrame(rows, "category string, id string, published timestamp_ntz, num_pages int"),
        spark.createDataFrame(votes, "id string, snapshot_date date, upvotes long"), spark.createDataFrame([("p3",)], "arxiv_id string"),
    )
    names = ["c0", "c1", "c2"]
    barred, expected = {"p3"}, []
    for run in runs:
        end = datetime.datetime.combine(run, datetime.time(23, 59, 59))
        up = {}
        for i, day, n in votes:
            if run - datetime.timedelta(days=7) <= day <= run:
                up[i] = max(up.get(i, 0), n)
        for c in names:
            pool = [x for x in rows if x[0] == c and end - datetime.timedelta(days=7) <= x[2] <= end and x[1] not in barred]
            if pool:
                best = min(pool, key=lambda x: (x[1] not in up, -up.get(x[1], 0), -x[2].timestamp(), x[1]))
                barred.add(best[1])
                expected.append((run, c, best[1]))
    got = selection.backfill(*frames, names)
    assert sorted((x.as_of, x.category, x.id) for x in got.collect()) == sorted(expected)
    assert len(expected) > 80 and "FlatMapGroups" not in plan_of(got)


def test_ledger_over_runs(spark, tmp_path):
    schema = "key string, fail_code string, cache_hit boolean"
    root = str(tmp_path / "ledger")
    first = [("a", "untranslated", False)] * 3 + [("a", "untranslated", True), ("b", None, False), ("c", "exception:X", None)]
    runlog.enter_attempts(spark.createDataFrame(first, schema), root, "r1")
    runlog.enter_attempts(spark.createDataFrame([("a", "untranslated", False)] * 2 + [("c", "exception:X", False)] * 11, schema), root, "r2")
    runlog.enter_attempts(spark.createDataFrame([("a", "untranslated", False), ("c", "exception:X", False)], schema), root, "r2")  # the run is entered again
    got = {r.key: (r.tries, r.bad) for r in runlog.read_ledger(spark, root).collect()}
    assert got == {"a": (4, 4), "b": (1, 0), "c": (2, 0)}


def test_refused_hits_rejoin_the_work_list(spark):
    work = [("miss", ["x"]), ("good", ["짧다"]), ("cut", ["a", "b"]), ("bad", ["짧다 $"]), ("spent", ["짧다 $"]), ("tired", ["y"]), ("batch", ["a", "짧다 $"]), ("cut", ["a", "b"])]
    cache = [("good", "좋다", "stop"), ("cut", "one", "length"), ("bad", "짧다", "stop"), ("spent", "짧다", "stop"), ("batch", "x <<<P>>> y", "stop"), ("other", "z", "stop")]
    ledger = [("bad", 2, 2), ("spent", 6, 5), ("tired", 12, 0), ("other", 1, 1)]
    out = runlog.requeue(
        spark.createDataFrame(work, "key string, items array<string>"), spark.createDataFrame(cache, "key string, content string, finish_reason string"), spark.createDataFrame(ledger, "key string, tries long, bad long")
    )
    assert {(r.key, r.reason, r.attempts_left) for r in out.collect()} == {("miss", "miss", 5), ("cut", "refused:length_truncated", 5), ("bad", "refused:dollar_mismatch", 3)}
    assert out.count() == 3


def test_planned_work_with_a_ledger(spark):
    from paperloom.plans import workflows

    papers = spark.createDataFrame([(1, "Some text\n\nMore")], "doc_id long, md string")
    none = spark.createDataFrame([], "key string, content string, finish_reason string")
    ledger = spark.createDataFrame([], "key string, tries long, bad long")
    first = workflows.plan_work(papers, none, "ph", "m", "0.1", ledger=ledger).first()
    assert (first.reason, first.attempts_left) == ("miss", 5)
    cut = spark.createDataFrame([(first.key, "하나", "stop")], none.schema)
    again = workflows.plan_work(papers, cut, "ph", "m", "0.1", ledger=spark.createDataFrame([(first.key, 1, 1)], ledger.schema)).first()
    assert (again.key, again.reason, again.attempts_left) == (first.key, "refused:item_count_mismatch", 4)


def test_long_texts_stay_out_of_aggregates(spark):
    attempts = spark.createDataFrame([(1, 0, 1, "r", "untranslated", "s"), (1, 0, 1, "r", "untranslated", "s")], "doc_id long, item_index long, attempt long, response string, fail_code string, source string")
    out = pair_quality.resolve_attempts(attempts)
    assert not any(c in line for line in plan_of(out).splitlines() if "Aggregate" in line for c in ("response#", "source#")) and [(r.text, r.outcome) for r in out.collect()] == [("r", "last_bad")]
    log = spark.createDataFrame([("x", "batch", "untranslated"), ("x", "batch", "untranslated"), (None, "single", "untranslated")], "input string, call_kind string, validation_fail_reason string")
    out = runlog.unseedable(log)
    assert "SortAggregate" not in plan_of(out) and sorted(str(r.input) for r in out.collect()) == ["None", "x"]
