"""The three jobs that the operators make up: weekly selection, planning of model work, and publishing of answers.

    python -m paperloom.plans.workflows plan PAPERS CACHE OUT --prompt-hash H --model M --temperature 0.1
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions.glosses import dedup_glosses
from paperloom.functions.markdown import clean_markdown, fix_newlines
from paperloom.functions.parallel import fail_code
from paperloom.operators import archive, cascade, chunking, pair_quality, runlog, selection
from paperloom.sources.tables import written


def weekly_selection(runs: DataFrame, candidates: DataFrame, snapshots: DataFrame, published: DataFrame, categories: list[str]) -> DataFrame:
    """One paper per date and category; what an earlier category of the date picked is out for the later ones."""
    return selection.select_all(selection.top_candidates(runs, candidates, snapshots, published, most=len(categories)), categories)


def batches(papers: DataFrame, most: int = chunking.MOST_CHARS) -> DataFrame:
    """(doc_id, md) to the batches that go to the model: (doc_id, batch_index, is_table, items, rows, cols).

    A table's items are its cells with letters, with their places; other batches' places are null.
    """
    items = chunking.chunk(clean_markdown(papers.select("doc_id", "md")), most)
    texts = items.where("not is_table").groupBy("doc_id", "batch_index").agg(F.array_sort(F.collect_list(F.struct("item_index", "text"))).alias("x"))
    texts = texts.select("doc_id", "batch_index", F.lit(False).alias("is_table"), F.col("x.text").alias("items"), F.lit(None).cast("array<int>").alias("rows"), F.lit(None).cast("array<int>").alias("cols"))
    cells = chunking.explode_cells(items.where("is_table").select("doc_id", "batch_index", F.col("text").alias("md"))).where("is_work")
    cells = cells.groupBy("doc_id", "batch_index").agg(F.array_sort(F.collect_list(F.struct("row", "col", "cell"))).alias("x"))
    cells = cells.select("doc_id", "batch_index", F.lit(True).alias("is_table"), F.col("x.cell").alias("items"), F.col("x.row").alias("rows"), F.col("x.col").alias("cols"))
    return texts.unionByName(cells)


def plan_work(papers: DataFrame, cache: DataFrame, prompt_hash: str, model: str, temperature: str, most: int = chunking.MOST_CHARS, ledger: DataFrame | None = None) -> DataFrame:
    """The distinct model calls that the cache cannot answer: (key, input).

    With ``ledger`` (key, tries, bad) cached answers (key, content, finish_reason) are judged again: refused ones rejoin the
    list without using an attempt, keys without attempts left are given up; then also reason and attempts_left.
    """
    work = batches(papers, most).select(
        "items", chunking.batch_input(F.col("items")).alias("input"), F.lit(prompt_hash).alias("prompt_hash"), F.lit(model).alias("model"), F.lit(temperature).alias("temperature")
    )
    keyed = runlog.with_key(work)
    if ledger is None:
        return runlog.misses(keyed, cache).select("key", "input")
    return runlog.requeue(keyed.select("key", "input", "items"), cache, ledger).drop("items")


def judge_answers(work: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, batch_index, path, items, response, finish_reason) to (judged items, batches to be halved).

    ``start``, the place of the first item in the whole batch, is 0 where the column is missing; judged items are numbered
    by their place in the whole batch, halves carry the start that their own answers are to be judged with.
    """
    work = work if "start" in work.columns else work.withColumn("start", F.lit(0))
    aligned = chunking.align_response(work)
    halves = chunking.bisect(aligned.where("fail_reason is not null").select("doc_id", "batch_index", "path", "start", "items"))
    rows = aligned.where("fail_reason is null").select("doc_id", "batch_index", "path", "start", F.posexplode(F.arrays_zip("items", "parts")).alias("k", "x"))
    rows = rows.select("doc_id", "batch_index", "path", (F.col("start") + F.col("k")).alias("item_index"), F.col("x.items").alias("source"), F.col("x.parts").alias("response"))
    return rows.withColumn("fail_code", fail_code(F.col("source"), F.col("response"))), halves


def attempts_of(batches: DataFrame, answers: DataFrame, singles: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(attempts for ``publish``, nodes) from the answers logged for a document's batches, however often these were split.

    answers: (doc_id, batch_index, path, attempt, response, finish_reason); singles: attempts (doc_id, batch_index,
    item_index, attempt, response, source) at items that were asked for again, which follow the batch's own answer.
    """
    nodes = written(cascade.cascade(batches, answers), "nodes")
    first = cascade.cascade_items(batches, answers, nodes).select("doc_id", "batch_index", "item_index", F.lit(0).alias("attempt"), "response", "source")
    rows = first if singles is None else first.unionByName(singles.select(*first.columns))
    return rows.withColumn("fail_code", fail_code(F.col("source"), F.col("response"))), nodes


def publish(attempts: DataFrame, papers: DataFrame, existing: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """Resolve attempts (doc_id, batch_index, item_index, attempt, response, fail_code, source), put documents together,
    and bring their pages into the archive.

    item_index is the place in the whole batch, whatever halves its answers came in. papers: doc_id and the columns of
    ``archive.build_page`` but ``body``, with ``edition``; existing: an earlier result; tables: (doc_id, batch_index, md) of
    the batches that are tables, whose items are their cells with letters in order: they are put back into their rows.
    """
    key = ["doc_id", "batch_index"]
    items = pair_quality.resolve_attempts(attempts, (*key, "item_index"))
    if tables is not None:
        cells = chunking.explode_cells(tables)
        place = F.row_number().over(Window.partitionBy(*key).orderBy("row", "col")) - 1
        answered = cells.where("is_work").withColumn("item_index", place).join(items, [*key, "item_index"]).select(*key, "row", "col", "text")
        filled = chunking.assemble_tables(tables, cells, answered).select(*key, F.col("md").alias("text"))
        items = items.join(tables.select(*key), key, "left_anti")
    ordered = F.array_sort(F.collect_list(F.struct("item_index", "text")))
    texts = items.groupBy(*key).agg(ordered.alias("x")).select(*key, F.array_join("x.text", "\n\n").alias("text"))
    texts = texts if tables is None else texts.unionByName(filled)
    bodies = chunking.assemble_docs(texts.select(*key, fix_newlines(F.col("text"))["text"].alias("text")))
    bodies = bodies.select("doc_id", dedup_glosses(F.col("md")).alias("body"))
    pages = archive.build_page(papers.join(bodies, "doc_id")).select(F.col("id").alias("arxiv_id"), "category", "translated", "edition", "page")
    return archive.upsert_archive(existing, pages)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=["plan"])
    for name in ("papers", "cache", "out"):
        parser.add_argument(name)
    for name in ("--prompt-hash", "--model", "--temperature"):
        parser.add_argument(name, required=True)
    args = parser.parse_args()
    spark = SparkSession.builder.getOrCreate()
    plan_work(spark.read.parquet(args.papers), spark.read.parquet(args.cache), args.prompt_hash, args.model, args.temperature).write.parquet(args.out)


if __name__ == "__main__":
    main()
