"""From cleaned Markdown to batches of paragraphs or table cells, and back to documents."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.parallel import is_table
from paperloom.functions.spans import rewrite
from paperloom.functions.strings import strip
from paperloom.functions.vectorized import batch_places

#: The mark between the items of a batch, and the characters of a batch. Fixed values.
DELIMITER, MOST_CHARS = "<<<P>>>", 4000
#: A cell is translated only if it has a letter. Fixed value.
LETTER = "[a-zA-Z가-힣]"


def paragraphs(c: Column) -> Column:
    """Texts between empty lines, blank ones left out."""
    return F.filter(F.split(c, "\n\n", -1), lambda p: p.rlike(r"(?U)\S"))


#: A fence up to its end or, where it is not closed, to the end of the text; and what joins paragraphs inside it. Fixed values.
OPEN_FENCE = r"(?s)```.*?(?:```|\z)"
#: While a text is split, what joins paragraphs inside a fence, and a NUL of the text's own.
INNER_BREAK, OWN_NUL = "\0b", "\0n"


def fenced_paragraphs(c: Column) -> Column:
    """Paragraphs, those of a code fence that holds empty lines as one; an unclosed fence takes all that follows.

    Breaks inside fences are hidden while the text is split, so the work is linear in the text. The sign that hides them
    may stand in the text too.
    """
    c = F.replace(c, F.lit("\0"), F.lit(OWN_NUL))
    bare = lambda m: F.regexp_replace(F.regexp_replace(m, r"(?U)\n\n\s*\z", ""), r"(?U)\n\n(?:\s*?\n\n)*+", INNER_BREAK)
    shown = lambda p: F.replace(F.replace(p, F.lit(INNER_BREAK), F.lit("\n\n")), F.lit(OWN_NUL), F.lit("\0"))
    return F.transform(paragraphs(rewrite(c, OPEN_FENCE, lambda gap: gap, bare)), shown)


@F.pandas_udf(T.ArrayType(T.LongType()))
def _batches(lengths: pd.Series, alone: pd.Series, most: pd.Series) -> pd.Series:
    """Batch and place in the batch of each paragraph, as one number."""
    return pd.Series([batch_places(n, a, m) for n, a, m in zip(lengths, alone, most, strict=True)])


def chunk(df: DataFrame, most: int = MOST_CHARS) -> DataFrame:
    """(doc_id, md) to (doc_id, batch_index, item_index, text, is_table).

    Only lengths and flags cross to Python; the texts stay where they are. A paragraph is never cut, a table is a batch
    of its own.
    """
    parts = df.select("doc_id", fenced_paragraphs(F.col("md")).alias("parts")).withColumn("alone", F.transform("parts", is_table))
    lengths = F.transform("parts", lambda p: F.length(p) + len(DELIMITER))
    numbered = parts.withColumn("batch", _batches(lengths, "alone", F.lit(most)))
    items = numbered.select("doc_id", F.explode(F.arrays_zip("parts", "alone", "batch")).alias("x"))
    batch, place = F.shiftright("x.batch", 32).cast("int"), F.col("x.batch").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    return items.select("doc_id", batch.alias("batch_index"), place.alias("item_index"), F.col("x.parts").alias("text"), F.col("x.alone").alias("is_table"))


def batch_stats(items: DataFrame) -> DataFrame:
    return items.groupBy("doc_id", "batch_index").agg(F.count(F.lit(1)).alias("items"), F.sum(F.length("text")).cast("long").alias("chars"))


def batch_input(items: Column) -> Column:
    """What is sent for the items of a batch."""
    return F.array_join(items, f"\n\n{DELIMITER}\n\n")


def split_row(row: Column) -> Column:
    """Cells of a table row: one outer bar less on each side, cells trimmed."""
    bare = F.regexp_replace(F.regexp_replace(strip(row), r"^\|", ""), r"\|$", "")
    return F.transform(F.split(bare, r"\|", -1), strip)


def _table_lines(c: Column) -> Column:
    return F.filter(F.split(c, "\n", -1), lambda x: x.rlike(r"(?U)\S"))


def explode_cells(tables: DataFrame) -> DataFrame:
    """(doc_id, batch_index, md) to (…, row, col, cell, is_work). Row 0 is the header; the rule line is no row."""
    lines = _table_lines(F.col("md"))
    rows = F.concat(F.slice(lines, 1, 1), F.slice(lines, F.lit(3), F.greatest(F.size(lines) - 2, F.lit(0))))
    exploded = tables.select("doc_id", "batch_index", F.posexplode(F.transform(rows, split_row)).alias("row", "cells"))
    return exploded.select("doc_id", "batch_index", "row", F.posexplode("cells").alias("col", "cell")).withColumn("is_work", F.col("cell").rlike(LETTER))


def assemble_tables(tables: DataFrame, cells: DataFrame, translated: DataFrame) -> DataFrame:
    """Put translated cells (doc_id, batch_index, row, col, text) back; row widths and the rule line stay as they were."""
    key = ["doc_id", "batch_index"]
    filled = cells.join(translated, [*key, "row", "col"], "left").select(*key, "row", "col", F.coalesce("text", "cell").alias("cell"))
    rows = filled.groupBy(*key, "row").agg(F.array_sort(F.collect_list(F.struct("col", "cell"))).alias("cells"))
    line = F.concat(F.lit("| "), F.array_join(F.col("cells.cell"), " | "), F.lit(" |"))
    bodies = rows.select(*key, "row", line.alias("line")).groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("row", "line"))).alias("lines"))
    rule = F.get(_table_lines(F.col("md")), F.lit(1))
    out = F.array_join(F.concat(F.slice(F.col("lines.line"), 1, 1), F.array("rule"), F.slice(F.col("lines.line"), F.lit(2), F.size("lines"))), "\n")
    return tables.select(*key, rule.alias("rule")).join(bodies, key).select(*key, out.alias("md"))


def answer_parts(response: Column) -> Column:
    """Parts of a batch's answer: trimmed, empty ones left out."""
    return F.filter(F.transform(F.split(response, DELIMITER, -1), strip), lambda p: p != "")


def count_parts(response: Column) -> Column:
    """How many parts an answer has, without trimming them: those with a sign that is not white space."""
    return F.size(F.filter(F.split(response, DELIMITER, -1), lambda p: p.rlike(r"(?U)\S")))


def align_response(df: DataFrame) -> DataFrame:
    """(doc_id, items, response, finish_reason) to (…, parts, fail_reason).

    A response that was cut off or does not have as many parts as items is refused; a single item is not split.
    """
    parts = F.when(F.size("items") == 1, F.array("response")).otherwise(answer_parts(F.col("response")))
    reason = F.when(F.col("finish_reason") == "length", "length_truncated").when(F.size("parts") != F.size("items"), "item_count_mismatch")
    return df.withColumn("parts", parts).withColumn("fail_reason", reason)


def aligned_items(aligned: DataFrame) -> DataFrame:
    """One row (doc_id, item_index, item, part) per item of the responses that fit."""
    rows = aligned.where("fail_reason is null").select("doc_id", F.posexplode(F.arrays_zip("items", "parts")).alias("item_index", "x"))
    return rows.select("doc_id", "item_index", F.col("x.items").alias("item"), F.col("x.parts").alias("part"))


def bisect(failed: DataFrame) -> DataFrame:
    """(doc_id, path, items, more) of refused batches to their halves, with ``error``; a single item cannot be halved and is
    an error row. A column ``start``, the place of the first item in the whole batch, moves along; others stay."""
    n = F.size("items")
    half = F.floor(n / 2).cast("int")
    start = F.col("start") if "start" in failed.columns else F.lit(0)
    side = lambda name, at, items: F.struct(F.concat("path", F.lit(name)).alias("path"), at.alias("start"), items.alias("items"), F.lit(None).cast("string").alias("error"))
    whole = F.struct(F.col("path"), start.alias("start"), F.col("items"), F.lit("single_item_truncated").alias("error"))
    halves = F.array(side(".L", start, F.slice("items", F.lit(1), half)), side(".R", start + half, F.slice("items", half + 1, n)))
    kept = [c for c in failed.columns if c not in ("path", "start", "items", "error")]
    return failed.select(*kept, F.explode(F.when(n > 1, halves).otherwise(F.array(whole))).alias("_x")).select(*kept, "_x.path", "_x.start", "_x.items", "_x.error")


def assemble_docs(batches: DataFrame) -> DataFrame:
    """(doc_id, batch_index, text) to (doc_id, md): batches in order, trimmed, an empty line behind each."""
    ordered = F.array_sort(F.collect_list(F.struct("batch_index", "text")))
    return batches.groupBy("doc_id").agg(ordered.alias("x")).select("doc_id", F.array_join(F.transform("x", lambda b: F.concat(strip(b["text"]), F.lit("\n\n"))), "").alias("md"))
