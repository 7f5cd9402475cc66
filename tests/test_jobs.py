"""Selection against plain greedy loops, attempts, readers and writers on real files."""

import datetime
import json
import random

from pyspark.sql import functions as F

from paperloom.functions.strings import cache_key
from paperloom.operators import archive, pair_quality, runlog, selection
from paperloom.sources import readers, writers

rng = random.Random(2)
DAY = datetime.date(2026, 8, 1)
AT = datetime.datetime(2026, 8, 1, 12)


def replay(spark, weeks):
    """Candidates of three categories over some weeks, with ties, cross-listing and few pages."""
    days = 7 * weeks + 10
    rows = [(f"c{rng.randrange(3)}", f"p{rng.randrange(25)}", AT + datetime.timedelta(days=rng.randrange(days), hours=rng.randrange(3)), rng.randrange(50, 64)) for _ in range(120)]
    rows = list({(c, i): (c, i, p, n) for c, i, p, n in rows}.values())
    votes = [(f"p{rng.randrange(25)}", DAY + datetime.timedelta(days=rng.randrange(days)), rng.choice([None, 0, 1, 5, 9])) for _ in range(40)]
    runs = [DAY + datetime.timedelta(days=7 * k + 7) for k in range(weeks)]
    frames = (
        spark.createDataFrame([(r,) for r in runs], "as_of date"),
        spark.createDataFrame(rows, "category string, id string, published timestamp_ntz, num_pages int"),
        spark.createDataFrame(votes, "id string, snapshot_date date, upvotes long"),
        spark.createDataFrame([("p3",), ("p4",)], "arxiv_id string"),
    )
    return runs, rows, votes, frames


def greedy(runs, rows, votes, remember):
    out, ever = [], {"p3", "p4"}
    for run in runs:
        barred = ever if remember else set(ever)
        end = datetime.datetime.combine(run, datetime.time(23, 59, 59))
        up = {}
        for i, day, n in votes:
            if run - datetime.timedelta(days=7) <= day <= run:
                up[i] = max(up.get(i, 0), n or 0)
        for c in ("c0", "c1", "c2"):
            pool = [r for r in rows if r[0] == c and end - datetime.timedelta(days=7) <= r[2] <= end and r[1] not in barred and r[3] <= 60]
            if pool:
                best = min(pool, key=lambda r: (r[1] not in up, -up.get(r[1], 0), -r[2].timestamp(), r[1]))
                barred.add(best[1])
                out.append((run, c, best[1], f"hf_daily_papers_upvotes={up[best[1]]}" if best[1] in up else "fallback_most_recent"))
    return sorted(out)


def test_selection_equals_plain_greedy(spark):
    for _ in range(2):
        runs, rows, votes, frames = replay(spark, 5)
        names = ["c0", "c1", "c2"]
        for remember, picked in ((False, selection.select_all(selection.top_candidates(*frames, most=3), names)), (True, selection.backfill(*frames, names))):
            got = picked.collect()
            assert sorted((r.as_of, r.category, r.id, r.selection_reason) for r in got) == greedy(runs, rows, votes, remember)


def test_backfill_of_daily_runs(spark):
    """Eight windows overlap at each date: picks are as deep as that, and all dates claim at once."""
    runs, rows, votes, frames = replay(spark, 3)
    runs = [DAY + datetime.timedelta(days=k) for k in (*range(6, 26), 400, 401)]
    frames = (spark.createDataFrame([(r,) for r in runs], "as_of date"), *frames[1:])
    assert selection.backfill_depth(frames[0], 3) == 24
    got = selection.backfill(*frames, ["c0", "c1", "c2"]).collect()
    assert sorted((r.as_of, r.category, r.id, r.selection_reason) for r in got) == greedy(runs, rows, votes, True)
    assert selection.backfill(frames[0].limit(0), *frames[1:], ["c0"]).count() == 0


def test_window_ends_are_included(spark):
    ref = datetime.datetime(2026, 8, 8, 23, 59, 59)
    times = [ref, ref - datetime.timedelta(days=7), ref - datetime.timedelta(days=7, seconds=1), ref + datetime.timedelta(seconds=1)]
    df = spark.createDataFrame([(t,) for t in times], "published timestamp_ntz")
    assert {r.published for r in selection.in_window(df, selection.as_of_instant(F.lit("2026-08-08"))).collect()} == set(times[:2])
    runs = spark.createDataFrame([(ref.date(),)], "as_of date")
    assert {r.published for r in selection.replay_window(runs, df).collect()} == set(times[:2])


def test_attempts(spark):
    d, u = "dollar_mismatch", "untranslated"
    cases = {
        1: ([u, None, d], "r2", "passed"), 2: ([u, d, u], "src", "source_kept"), 3: ([u, u], "r2", "last_bad"), 4: (["exception:Timeout"] * 3, None, "error"),
        5: ([u] * 5 + [None], "r5", "last_bad"), 6: (["exception:X", u, "exception:X", None], "r4", "passed"), 7: (["exception:X"] * 12 + [None], None, "error"),
    }
    rows = [(k, 0, n, None if (c or "").startswith("exception") else f"r{n}", c, "src") for k, (codes, _, _) in cases.items() for n, c in enumerate(codes, 1)]
    df = spark.createDataFrame(rows, "doc_id long, item_index long, attempt long, response string, fail_code string, source string")
    got = {r.doc_id: (r.text, r.outcome) for r in pair_quality.resolve_attempts(df).collect()}
    assert got == {k: (text, outcome) for k, (_, text, outcome) in cases.items()}


def test_cache_keys_are_digests(spark):
    import hashlib

    x = spark.range(1).select(cache_key(F.lit("글"), F.lit("ph"), F.lit("m"), F.lit("0.1")).alias("k"), cache_key(F.lit(None).cast("string"), F.lit("ph"), F.lit("m"), F.lit("0.1")).alias("n")).first()
    assert x.k == hashlib.sha256("글\0ph\0m\x000.1".encode()).hexdigest() and x.n is None


def test_feed_and_snapshots_from_files(spark, tmp_path):
    feed = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x.org/abs/2608.1v2</id><published>2026-08-01T06:00:00Z</published><title>A
  title</title><summary>s  t</summary><link title="pdf" href="one"/><link title="pdf" href="two"/></entry>
<entry><id>http://x.org/abs/2608.2</id><published>2026-08-02T06:00:00Z</published><title>B</title><summary>s</summary><link href="z"/></entry></feed>"""
    (tmp_path / "feed.xml").write_text(feed)
    rows = {r.id: r for r in readers.read_atom(spark, str(tmp_path / "feed.xml")).collect()}
    assert rows["2608.1"].pdf_url == "two" and rows["2608.1"].title == "A title" and rows["2608.2"].pdf_url.endswith("/pdf/2608.2")
    (tmp_path / "snaps").mkdir()
    (tmp_path / "snaps" / "2026-08-01.json").write_text(json.dumps([{"paper": {"id": "a", "upvotes": 3}}, {"paper": {"id": "b"}}, {"paper": {}}, {"paper": {"id": ""}}, {}]))
    assert sorted((str(r.snapshot_date), r.id, r.upvotes) for r in readers.read_upvotes(spark, str(tmp_path / "snaps")).collect()) == [("2026-08-01", "a", 3), ("2026-08-01", "b", 0)]


def test_pages_from_files(spark, tmp_path):
    row = ("2608.7", "cs.CL", 'A "b" title', "u", "v", "2026-08-01T00:00:00+00:00", DAY, "why", "# 새 제목\nbody")
    df = spark.createDataFrame([row], "id string, category string, title string, abs_url string, pdf_url string, published string, translated date, selection_reason string, body string")
    pages = archive.build_page(df).withColumn("page_path", archive.page_path(F.col("translated"), F.col("category"), F.col("id"), F.col("title")))
    sizes = writers.write_page_files(pages, str(tmp_path)).collect()
    name = "nlp/2026-08-01-2608.7-a-b-title.md"
    assert [r.page_path for r in sizes] == [name] and (tmp_path / name).stat().st_size == sizes[0].bytes
    (tmp_path / "index.md").write_text("# Home\n---\nno id")
    (tmp_path / "loose.md").write_text("x\narxiv_id:  77 \n")
    (tmp_path / "late.md").write_text("---\ntitle: t\n---\narxiv_id: 88\n")
    assert sorted(r.arxiv_id for r in readers.read_published_ids(spark, str(tmp_path)).collect()) == ["2608.7", "77"]
    page = next(r for r in readers.read_pages(spark, str(tmp_path)).collect() if r.arxiv_id)
    assert (page.title, page.category, page.translated) == ("새 제목", "cs.CL", "2026-08-01") and page.body.startswith("# 새 제목\n\n- 원제: A")


def test_revalidation(spark):
    rows = [(1, ["a", "b"], "x", "stop"), (2, ["a"], "좋다", "length"), (3, ["짧다 $"], "짧다", "stop"), (4, ["짧다"], "좋다", "stop"), (5, ["a", "b"], "x <<<P>>> y", "stop")]
    df = spark.createDataFrame(rows, "doc_id long, items array<string>, response string, finish_reason string")
    assert sorted((r.doc_id, r.fail_reason) for r in runlog.revalidate(df).collect()) == [(1, "item_count_mismatch"), (2, "length_truncated"), (3, "dollar_mismatch")]


def test_workflow_from_papers_to_pages(spark):
    from paperloom.plans import workflows

    papers = spark.createDataFrame([(1, "# 1 Intro\n\nSome text\n\n| a | 1 |\n|---|---|\n| b | 2 |\n\nMore"), (2, "Some text\n\nMore")], "doc_id long, md string")
    rows = {(r.doc_id, r.batch_index): (r["items"], r.rows, r.cols) for r in workflows.batches(papers).collect()}
    assert rows == {(1, 0): (["## 1 Intro", "Some text"], None, None), (1, 1): (["a", "b"], [0, 1], [0, 0]), (1, 2): (["More"], None, None), (2, 0): (["Some text", "More"], None, None)}
    empty = spark.createDataFrame([], "key string")
    work = workflows.plan_work(papers, empty, "ph", "m", "0.1")
    assert work.count() == 4
    answered = work.where("input = 'More'").select("key")
    assert {r.input for r in workflows.plan_work(papers, answered, "ph", "m", "0.1").collect()} == {"## 1 Intro\n\n<<<P>>>\n\nSome text", "a\n\n<<<P>>>\n\nb", "Some text\n\n<<<P>>>\n\nMore"}
    sent = spark.createDataFrame([(1, 0, "0", ["가", "$x$"], "나 <<<P>>> x", "stop"), (2, 0, "0", ["a", "b", "c"], "하나", "stop")], "doc_id long, batch_index int, path string, items array<string>, response string, finish_reason string")
    judged, halves = workflows.judge_answers(sent)
    assert sorted((r.item_index, r.fail_code) for r in judged.collect()) == [(0, None), (1, "dollar_mismatch")]
    assert sorted((r.path, r["items"]) for r in halves.collect()) == [("0.L", ["a"]), ("0.R", ["b", "c"])]
    attempts = spark.createDataFrame(
        [(1, 0, 0, 1, "# 제목", None, "# T"), (1, 0, 1, 1, "bad", "dollar_mismatch", "$y$"), (1, 1, 0, 1, "둘\\n셋", None, "two")],
        "doc_id long, batch_index int, item_index int, attempt int, response string, fail_code string, source string",
    )
    meta = spark.createDataFrame([(1, "2608.9", "cs.RO", "T", "u", "v", "2026-08-01", DAY, "why", 1)], "doc_id long, id string, category string, title string, abs_url string, pdf_url string, published string, translated date, selection_reason string, edition long")
    before = spark.createDataFrame([("2608.9", "cs.RO", DAY - datetime.timedelta(days=3), 0, "old"), ("2608.8", "cs.RO", DAY, 0, "kept")], "arxiv_id string, category string, translated date, edition long, page string")
    pages = {r.arxiv_id: r for r in workflows.publish(attempts, meta, before).collect()}
    assert pages["2608.8"].page == "kept" and pages["2608.9"].category_dir == "robotics"
    assert pages["2608.9"].page.endswith("# 제목\n\n$y$\n\n둘\n셋\n\n") and pages["2608.9"].page.startswith('---\ntitle: "제목"')


def test_upkeep_rewrites_only_what_a_batch_touches(spark, tmp_path):
    """Three batches, the last one applied twice; parts that a batch does not touch keep their files."""
    from paperloom.streaming import jobs

    schema = "arxiv_id string, category string, translated date, edition long, page string"
    rows = [[(f"p{k}", "cs.CL", DAY, e, f"page {k} of {e}") for k in some] for e, some in enumerate((range(40), (3, 50), (3,)))]
    for e, some in enumerate(rows):
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{e}"))
        query = jobs.upkeep(jobs.read_stream(spark, spark.createDataFrame([], schema).schema, str(tmp_path / "in" / "*"), 10), str(tmp_path / "out"), str(tmp_path / "state"), parts=8)
        query.awaitTermination()
        assert query.exception() is None
    got = {r.arxiv_id: r.page for r in jobs.read_archive(spark, str(tmp_path / "out"), 2).collect()}
    assert got == {**{f"p{k}": f"page {k} of 0" for k in range(40)}, "p50": "page 50 of 1", "p3": "page 3 of 2"}
    versions = {key: at for key, at in jobs._manifest(spark, str(tmp_path / "out"), 2).items()}
    assert set(versions.values()) == {0, 1, 2} or set(versions.values()) == {0, 2}
    assert sum(at == 0 for at in versions.values()) >= 5
    # what the first batch wrote of a part that the second replaced is gone once the third has begun
    kept = {(int(p.parent.parent.name[6:]), int(p.name[5:])) for p in (tmp_path / "out" / "pages").glob("epoch=*/folder=*/part=*")}
    assert {(at, part) for (_, part), at in versions.items()} <= kept
    assert not (tmp_path / "out" / "manifest" / "0").exists()


def test_last_rows(spark):
    from paperloom.operators.latest import last_rows

    rows = [("a", 1, "x"), ("a", 2, "b"), ("a", 2, "c"), ("a", 2, "c"), ("b", None, "n"), (None, 1, "k"), (None, None, "z")]
    df = spark.createDataFrame(rows, "key string, at int, content string")
    assert sorted(((r.key or "", r.at or 0, r.content) for r in last_rows(df, ["key"], ["at", "content"]).collect())) == [("", 1, "k"), ("a", 2, "c"), ("b", 0, "n")]
    plan = last_rows(df, ["key"], ["at", "content"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
