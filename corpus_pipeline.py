"""The corpus pipeline: quality rules, exact dedup, near-duplicate join, passage removal, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's result to the shared folder
and reads it again for the next one. All but the last return the columns of ``documents``. The packed sequences are
written there too; what ``run`` returns is their list of pieces, without the ids.

In every stage null texts count as empty (such documents fail the base rules, so the first stage drops them), null ids
are ids like others, texts may be of any length, rows that repeat in full are judged alike and one of them is left after
the second stage, extra columns of any name travel along up to the last stage, and an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import exact_dedup, jaccard_join, packing, quality_rules, suffix_dedup
from paperloom.llm.common import discard, read, temporary_tables, written
from paperloom.llm.queries import tokenizer

#: Bytes of a passage that may not stand twice: ninety-nine in a hundred runs of 51 words are longer. Operator 8's own
#: query has 400, which most passages of some fifty words do not reach.
PASSAGE_BYTES = 250


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the trees reject go; without labels the base rules alone judge."""
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays; of rows that repeat it, one."""
    return exact_dedup.drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id."""
    return jaccard_join.drop_near_duplicates(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of PASSAGE_BYTES bytes and more that stand anywhere else too are cut out, every copy of them; n_chars follows the text."""
    cut = suffix_dedup.remove_repeats(docs, PASSAGE_BYTES)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else cut


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, with their ids and places in sequences of 2048 tokens; an empty text is one end id."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("suffix-array dedup", passages), ("best-fit packing", pack)]

#: Neither the trees nor the token ids can be said in SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order. A stage's result is written in full, then the tables that its operator left go, and the stage
    before it too."""
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        with temporary_tables() as keep:
            docs = keep(written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-")))
        if last is not None:
            discard(last)
        last = docs
    written(packing.sequences(docs), "sequences")
    return docs.drop("ids")
