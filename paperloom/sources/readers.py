"""Readers of feeds, snapshots, pages and logs, with explicit schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions.strings import strip
from paperloom.operators.selection import candidate_urls

ENTRY = "id string, published string, title string, summary string, link array<struct<_href: string, _title: string, _rel: string>>"
SNAPSHOT = "array<struct<paper: struct<id: string, upvotes: bigint>>>"
CALL = (
    "ts double, run_id string, paper string, call_kind string, batch_index int, path string, item_index int, attempt int, model string, prompt_hash string, temperature string, elapsed_s double, "
    "input string, raw_response string, finish_reason string, items_in int, items_out int, validation_fail_reason string, cache_hit boolean"
)
SUMMARY = "batches int, model_calls int, cache_hits int, validation_failures map<string, bigint>, escaped_newline_fixes int, dedup_ops array<struct<term: string, occurrences: int, removed: int>>, git_sha string, output_path string, seeded_from string"
FRONT_KEYS = ("title", "arxiv_id", "category", "published", "translated", "selection_reason")


def entry_columns(entry: Column) -> list[Column]:
    """Raw columns of an Atom entry; the last link titled ``pdf`` counts."""
    pdf = F.try_element_at(F.filter(entry["link"], lambda x: x["_title"] == "pdf"), F.lit(-1))["_href"]
    return [entry["id"].alias("id"), entry["published"].alias("published"), entry["title"].alias("title"), entry["summary"].alias("summary"), pdf.alias("pdf_url")]


def read_atom(spark: SparkSession, path: str, site: str = "https://arxiv.org") -> DataFrame:
    rows = spark.read.format("xml").option("rowTag", "entry").schema(ENTRY).load(path)
    return candidate_urls(rows.select(F.struct("*").alias("e")).select(*entry_columns(F.col("e"))), site)


def parse_atom(df: DataFrame, column: str, keep: tuple[str, ...], site: str = "https://arxiv.org") -> DataFrame:
    """The same for entries that come as texts in a column."""
    return candidate_urls(df.select(*keep, F.from_xml(column, ENTRY).alias("e")).select(*keep, *entry_columns(F.col("e"))), site)


def explode_snapshots(df: DataFrame) -> DataFrame:
    """(snapshot_date, payload) to (snapshot_date, id, upvotes); rows without an id go, missing votes are 0."""
    papers = df.select("snapshot_date", F.explode(F.from_json("payload", SNAPSHOT)).alias("x")).select("snapshot_date", "x.paper.id", F.coalesce("x.paper.upvotes", F.lit(0)).alias("upvotes"))
    return papers.where("id is not null and id != ''")


def read_upvotes(spark: SparkSession, path: str) -> DataFrame:
    """Files named by their date, or in a folder named by it, one JSON array each; the last date in the path counts."""
    files = spark.read.text(path, wholetext=True).select(F.to_date(F.regexp_extract("_metadata.file_path", r".*(\d{4}-\d{2}-\d{2})", 1)).alias("snapshot_date"), F.col("value").alias("payload"))
    return explode_snapshots(files)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, page) of the Markdown files below a folder."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.md")
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("page"))


def published_id(page: Column) -> Column:
    """The value of the first arxiv_id line before the second rule line; null where there is none."""
    lines = F.transform(F.split(page, "\n", -1), strip)
    rules = F.filter(F.transform(lines, lambda x, i: F.when(x == "---", i)), lambda i: i.isNotNull())
    head = F.slice(lines, F.lit(1), F.coalesce(F.get(rules, F.lit(1)), F.size(lines)))
    line = F.get(F.filter(head, lambda x: x.startswith("arxiv_id:")), F.lit(0))
    return strip(F.regexp_replace(line, "^[^:]*:", ""))


def published_ids(pages: DataFrame) -> DataFrame:
    return pages.select(published_id(F.col("page")).alias("arxiv_id")).where("arxiv_id is not null").distinct()


def read_published_ids(spark: SparkSession, path: str) -> DataFrame:
    return published_ids(read_texts(spark, path))


def front_matter(pages: DataFrame) -> DataFrame:
    """(path, page) to the keys of the front matter as columns, quotes taken off, and the body behind it."""
    block = F.regexp_extract("page", r"(?s)\A---\n(.*?)\n---\n", 1)
    value = lambda key: F.nullif(F.regexp_replace(F.regexp_extract("block", rf"(?m)^{key}: (.*)$", 1), '^"|"$', ""), F.lit(""))
    body = F.regexp_replace("page", r"(?s)\A---\n.*?\n---\n\n", "")
    return pages.withColumn("block", block).select("path", *(value(k).alias(k) for k in FRONT_KEYS), body.alias("body"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return front_matter(read_texts(spark, path))


def read_call_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(calls, summaries) of a JSONL log that holds both kinds of record."""
    both = spark.read.schema(f"{CALL}, {SUMMARY}").json(path)
    calls = [c.split()[0] for c in CALL.split(", ")]
    return both.where("call_kind != 'summary'").select(*calls), both.where("call_kind = 'summary'")


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
