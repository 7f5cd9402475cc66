"""What grows with the input: bytes that go to Python, files in a task, readings of a table."""

import os

import pytest
from pyspark.sql import functions as F

from paperloom.functions import vectorized
from paperloom.plans import registry

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def operators(plan):
    """All operators of a physical plan."""
    yield plan
    children = plan.children()
    for k in range(children.size()):
        yield from operators(children.apply(k))


def sent_to_python(df):
    """Bytes that the Arrow functions of a query without exchanges are sent."""
    df.collect()
    found = [p.metrics().apply("pythonDataSent").value() for p in operators(df._jdf.queryExecution().executedPlan()) if p.nodeName() == "ArrowEvalPython"]
    assert found
    return sum(found)


@needs_data
@pytest.mark.parametrize("name", ["c9_clean_tame", "c9_clean_markdown", "c3_sanitize_tame"])
def test_texts_without_long_math_do_not_go_to_python(spark, name):
    df = registry.QUERIES[name](spark, DATA)
    text = df.agg(F.sum(F.octet_length("md"))).first()[0]
    assert sent_to_python(df) < text / 10


def test_spans_among_texts_and_nulls(spark):
    run, line = "$" + "M_r \\" * 20 + "$", "$" + "---" * 20 + "$"
    texts = [None, "", "no math", f"a $x$ b {run} c $\\begin{{a}}$ $$y$$", line, "$x$ " + "$ab" * 20, f"$k$ {run} $k$ {line}", "$" + "x" * 44]
    hole = vectorized.PLACEHOLDER
    expected = [None, "", "no math", f"a $x$ b {hole} c {hole} $$y$$", line, "$x$ " + "$ab" * 20, f"$k$ {hole} $k$ {line}", "$" + "x" * 44]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    got = df.select("k", vectorized.sanitize_math("t").alias("s"), vectorized.runaway("t").alias("r")).orderBy("k").collect()
    assert [r.s for r in got] == expected
    assert [r.r for r in got] == [vectorized.has_runaway(t) for t in texts]


def read_by_tasks(name, spark):
    """A query's plan has no scan whose files the driver lists one by one."""
    return "FileScan text" not in registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()


@needs_data
@pytest.mark.parametrize("name", ["io7_committed_pages", "io7_page_files"])
def test_page_files_are_read_by_tasks(spark, name):
    assert read_by_tasks(name, spark)


def test_moves_of_a_written_job(spark, tmp_path):
    from paperloom.sources import page_files

    rows = [(f"nlp/p{k}.md", f"page {k}") for k in range(40)] + [("ml/deep/x.md", None), ("top.md", "글"), ("_odd/y.md", "y"), ("a.txt", "no page")]
    df = spark.createDataFrame(rows, "page_path string, page string").repartition(4)
    root = str(tmp_path)
    spark.dataSource.register(page_files.PageFiles)
    df.write.format(page_files.FORMAT).option("path", root).option("job", "j").mode("append").save()
    assert {p.name for p in tmp_path.iterdir()} == {"_staging"} and page_files.scan_pages(spark, root).count() == 0
    first = (tmp_path / "_staging/j" / page_files.ATTEMPTS).read_text().split("\n")[0]
    files, at = page_files._opened(root)
    assert page_files._move(files, at, first) > 0 and page_files._move(files, at, first) == 0  # as if a move had been cut off
    page_files.move_committed(spark, root, "j")
    page_files.move_committed(spark, root, "j")
    assert not (tmp_path / "_staging").exists() and (tmp_path / "a.txt").read_text() == "no page"
    assert sorted(tuple(r) for r in page_files.scan_pages(spark, root).collect()) == sorted((n, t or "") for n, t in rows if n.endswith(".md"))


def scans(df):
    """How often a query's plan reads a file."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")


@needs_data
def test_answers_are_made_from_one_reading(spark, tmp_path):
    from paperloom.plans.q_chunking import node_answers
    from paperloom.plans.views import spark_view

    odd = spark.createDataFrame([(k, t) for k, t in enumerate([None, "", "\n", "a", "a\n\nb\n", " \n" * 9, "x\n<<<P>>>\ny"] * 5)], "doc_id long, text string")
    odd.write.parquet(str(tmp_path / "documents.parquet"))
    for d in (DATA, str(tmp_path)):
        got, view = node_answers(spark, d), spark_view(spark, d, "node_answers")
        assert got.columns == view.columns and scans(got) == 1 < scans(view)
        assert got.count() == view.count() > 0 and got.exceptAll(view).isEmpty() and view.exceptAll(got).isEmpty()


def test_documents_are_put_together_from_one_reading_of_their_items(spark, tmp_path):
    from paperloom.operators import cascade

    rows = [(1, 0, 1, "b"), (1, 0, 0, "a"), (1, 1, 0, "c"), (2, 0, 0, "x"), (3, 0, 0, "y")]
    spark.createDataFrame(rows, "doc_id long, batch_index int, item_index int, text string").write.parquet(str(tmp_path / "items"))
    batches = spark.createDataFrame([(1, 0, ["A", "B"]), (1, 1, ["C"]), (2, 0, ["X", "gap"]), (3, 0, ["Y"]), (3, 1, []), (4, 0, ["none"])], "doc_id long, batch_index int, items array<string>")
    got = cascade.reassemble(batches, spark.read.parquet(str(tmp_path / "items")))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\n\nb\n\nc"), (3, "y")]
    assert scans(got) == 1


def test_parts_are_counted_as_they_are_cut(spark):
    from paperloom.operators import chunking

    texts = ["", " ", "a", "<<<P>>>", "a<<<P>>> \n<<<P>>>b", "　<<<P>>> x <<<P>>>", None, "a\n\n<<<P>>>\n\nb\n\n<<<P>>>\n\n\t", "\0<<<P>>>​"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~chunking.count_parts(F.col("t")).eqNullSafe(F.size(chunking.answer_parts(F.col("t"))))).count() == 0


@needs_data
@pytest.mark.parametrize("query", ["waiting", "nodes"])
def test_cascade_queries_judge_answers_from_one_reading(spark, query, monkeypatch):
    from paperloom.operators import cascade
    from paperloom.plans import q_chunking

    seen, plain = [], cascade.verdicts
    monkeypatch.setattr(cascade, "verdicts", lambda answers: (seen.append(scans(answers)), plain(answers))[1])
    getattr(q_chunking, query)(spark, DATA)
    assert seen == [1]


@needs_data
@pytest.mark.parametrize("name", ["c9_clean_markdown", "c3_sanitize_tame"])
def test_math_is_looked_for_once_before_python(spark, name):
    plan = registry.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan()
    asked = [p.udfs().mkString(" ") for p in operators(plan) if p.nodeName() == "ArrowEvalPython"]
    assert [a.count("regexp_extract_all") for a in asked] == [1]
