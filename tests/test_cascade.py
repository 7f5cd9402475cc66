"""The re-split cascade against a recursive walk, and a workflow whose batch is split three deep."""

import datetime
import random

from pyspark.sql import functions as F

from paperloom.operators import cascade, chunking
from paperloom.plans import workflows

ANSWERS = "doc_id long, batch_index int, path string, attempt int, response string, finish_reason string"
BATCHES = "doc_id long, batch_index int, items array<string>"
MARK = "\n\n<<<P>>>\n\n"


def walk(items, path, start, answers, out):
    """Nodes in plain Python: the recursion that the rounds stand for."""
    found = answers.get(path)
    n = len(items)
    if found is None:
        out.append((path, start, n, "asked"))
        return
    response, finish = found
    parts = [p.strip() for p in response.split("<<<P>>>") if p.strip()]
    if n == 1:
        out.append((path, start, n, "error" if finish == "length" else "fits"))
    elif finish == "length" or len(parts) != n:
        out.append((path, start, n, "split"))
        walk(items[: n // 2], path + ".L", start, answers, out)
        walk(items[n // 2 :], path + ".R", start + n // 2, answers, out)
    else:
        out.append((path, start, n, "fits"))


def every_path(path, n):
    yield path, n
    if n > 1:
        yield from every_path(path + ".L", n // 2)
        yield from every_path(path + ".R", n - n // 2)


def test_cascade_equals_the_recursion(spark):
    rng = random.Random(5)
    batches, answers, expected = [], [], []
    for doc in range(40):
        for b in range(2):
            items = [f"{doc}.{b}.{k}" for k in range(rng.randint(0, 12))]
            batches.append((doc, b, items))
            found = {}
            for path, n in every_path(str(b), len(items)) if items else []:
                if rng.random() < 0.9:
                    count = n if rng.random() < 0.4 else max(0, n - 1)
                    found[path] = (MARK.join(["x"] * count), "length" if rng.random() < 0.1 else "stop")
                    answers.append((doc, b, path, 2, *found[path]))
                    answers.append((doc, b, path, 1, "earlier", "length"))
                    answers.append((doc, b, path, 3, None, None))
            if items:
                out = []
                walk(items, str(b), 0, found, out)
                expected += [(doc, b, *row) for row in out]
    b, a = spark.createDataFrame(batches, BATCHES), spark.createDataFrame(answers, ANSWERS)
    nodes = cascade.cascade(b, a)
    assert sorted((r.doc_id, r.batch_index, r.path, r.start, r.n, r.state) for r in nodes.collect()) == sorted(expected)
    work = {(r.doc_id, r.batch_index, r.path): r["items"] for r in cascade.cascade_work(b, nodes).collect()}
    of = {(d, k): items for d, k, items in batches}
    assert work == {(d, k, p): of[d, k][s : s + n] for d, k, p, s, n, state in expected if state == "asked"}


def test_no_batches(spark):
    nodes = cascade.cascade(spark.createDataFrame([], BATCHES), spark.createDataFrame([], ANSWERS))
    assert nodes.count() == 0


def test_split_three_deep_comes_back_in_order(spark):
    """Nine items: the answers fit at depth three at the left, two in the middle and one at the right."""
    items = [f"source {k} text" for k in range(9)]
    sizes = {"0": 9, "0.L": 4, "0.R": 5, "0.L.L": 2, "0.L.R": 2, "0.L.L.L": 1, "0.L.L.R": 1}
    starts = {"0.R": 4, "0.L.R": 2, "0.L.L.L": 0, "0.L.L.R": 1}
    rows = [(1, 0, p, 1, MARK.join(f"번역 {starts[p] + k}" for k in range(n)) if p in starts else "하나", "stop") for p, n in sizes.items()]
    table = "| key | 1 |\n|---|---|\n| word | 2 |\n| 3 | last |"
    batches = spark.createDataFrame([(1, 0, items), (1, 1, ["key", "word", "last"])], BATCHES)
    rows.append((1, 1, "1", 1, MARK.join(["키", "단어"]), "stop"))
    rows += [(1, 1, "1.L", 1, "키", "stop"), (1, 1, "1.R", 1, MARK.join(["단어", "끝"]), "stop")]
    attempts, nodes = workflows.attempts_of(batches, spark.createDataFrame(rows, ANSWERS))
    assert nodes.where("state in ('asked', 'error')").count() == 0
    again = spark.createDataFrame([(1, 0, 0, 1, "다시 0", "source 0 text")], "doc_id long, batch_index int, item_index int, attempt int, response string, source string")
    meta = spark.createDataFrame([(1, "2608.9", "cs.RO", "T", "u", "v", "2026-08-01", datetime.date(2026, 8, 1), "why", 1)], "doc_id long, id string, category string, title string, abs_url string, pdf_url string, published string, translated date, selection_reason string, edition long")
    before = spark.createDataFrame([], "arxiv_id string, category string, translated date, edition long, page string")
    tables = spark.createDataFrame([(1, 1, table)], "doc_id long, batch_index int, md string")
    end = "\n\n".join(f"번역 {k}" for k in range(9)) + "\n\n| 키 | 1 |\n|---|---|\n| 단어 | 2 |\n| 3 | 끝 |\n\n"
    page = workflows.publish(attempts, meta, before, tables).first().page
    assert page.endswith(end)
    bad = attempts.withColumn("fail_code", F.when((F.col("batch_index") == 0) & (F.col("item_index") == 0), "untranslated").otherwise(F.col("fail_code")))
    both = bad.unionByName(again.withColumn("fail_code", F.lit(None).cast("string")).select(*bad.columns))
    assert workflows.publish(both, meta, before, tables).first().page.endswith(end.replace("번역 0", "다시 0"))


def test_halves_keep_their_batch_and_place(spark):
    df = spark.createDataFrame([(1, 7, "7.R", 5, ["a", "b", "c"])], "doc_id long, batch_index int, path string, start int, items array<string>")
    assert sorted((r.batch_index, r.path, r.start, r["items"]) for r in chunking.bisect(df).collect()) == [(7, "7.R.L", 5, ["a"]), (7, "7.R.R", 6, ["b", "c"])]


def test_fences_keep_nul_signs(spark):
    text = "a\0b\n\n```\nx\0\n\n\0b\n```\n\n\0\n\ntail\0n"
    got = spark.createDataFrame([(text,)], "md string").select(chunking.fenced_paragraphs(F.col("md")).alias("p")).first().p
    assert got == ["a\0b", "```\nx\0\n\n\0b\n```", "\0", "tail\0n"]
