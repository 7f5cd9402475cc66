"""Quality rules: fixed base rules, then gradient-boosted trees over document statistics.

The trees are fitted on the driver on a bounded sample of labelled rows and score batches in numpy inside the tasks;
the constrained features can only lower a document's score as they grow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.llm.boosted_trees import Forest, fit
from paperloom.llm.common import small_batches, text_or_empty
from paperloom.llm.text_stats import STATS, batch_stats

#: The fit uses at most so many labelled rows: those whose id has the smallest hash.
MOST_LABELS = 8_000
#: A document goes if the trees' probability of good quality is below this.
THRESHOLD = 0.5
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "marks", "digits", "distinct", "punct", "wordless", "same_next", "wide", "line_words")
#: Features that may only lower the score.
FALLING = ("symbols", "dup_lines", "repeats", "marks", "wordless", "same_next")


def features(s: dict[str, np.ndarray]) -> np.ndarray:
    words, chars, lines = np.maximum(1, s["n_words"]), np.maximum(1, s["word_chars"]), np.maximum(1, s["n_lines"])
    letters = np.maximum(1, s["n_upper"] + s["n_lower"])
    columns = (
        np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / words, s["n_dup_lines"] / lines, s["n_repeat_words"] / words, s["n_upper"] / letters, s["n_marks"] / words,
        s["n_digits"] / chars, s["n_distinct"] / words, s["n_punct"] / words, s["n_wordless"] / words, s["n_same_next"] / words, s["n_wide"] / chars, words / lines,
    )
    return np.stack(columns, 1).astype(float)


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELS, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id") -> Forest:
    """Fit on ``labels`` (label_id, quality 0/1): one row per id, null labels left out, at most ``most`` of them.

    Of several texts under one id one is taken, the one with the least statistics, so at most ``most`` rows come to the driver.
    """
    few = (
        labels.where("quality is not null").groupBy(F.col(label_id).alias("_id")).agg(F.max("quality").cast("double").alias("_y"))
        .orderBy(F.xxhash64("_id"), "_id").limit(most)
    )
    small_batches(docs.sparkSession)

    def stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch_stats(_bytes(batch.column(2))))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["_id", "_y", "_x"])

    joined = docs.select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text")).join(F.broadcast(few), "_id").select("_id", "_y", "_text")
    found = joined.mapInArrow(stats, "_id " + dict(joined.dtypes)["_id"] + ", _y double, _x array<double>")
    rows = found.groupBy("_id", "_y").agg(F.min("_x").alias("_x")).toPandas().sort_values("_id", kind="stable")
    if rows.empty:
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0), {})
    return fit(np.stack(rows["_x"].to_list()), rows["_y"].to_numpy(), {FEATURES.index(f): -1 for f in FALLING})


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = MOST_LABELS, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, ``carry`` columns, the statistics STATS, p_good, base_failed, kept.

    kept is false for documents that fail a base rule, else true where p_good reaches the threshold. Null texts count as
    empty (and fail the base rule), rows that repeat are judged alike, null ids are kept as they are, texts are worked on
    whole; without usable labels every document gets the base rate. An empty table gives an empty result.
    """
    forest = train(docs, labels, most, id_col, text_col)  # some thousand numbers
    small_batches(docs.sparkSession)
    names = [id_col, *carry, *STATS, "p_good", "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch_stats(_bytes(batch.column(batch.num_columns - 1)))
            good, failed = forest.probability(features(s)), base_failed(s)
            mine = [pa.array(s[k]) for k in STATS] + [pa.array(good), pa.array(failed), pa.array(~failed & (good >= threshold))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *mine], names=names)

    source = docs.select(id_col, *carry, text_or_empty(F.col(text_col)).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    return source.mapInArrow(run, schema + "".join(f", {k} long" for k in STATS) + ", p_good double, base_failed boolean, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, most: int = MOST_LABELS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that ``judge`` keeps, with all their columns, whatever their names.

    Null and empty texts fail the base rules and go, null ids are ids like others, rows that repeat are judged alike, texts
    may have any length, an empty table gives an empty result.
    """
    columns = docs.columns
    plain = docs.toDF(*(f"c{k}" for k in range(len(columns))))
    name = {c: f"c{k}" for k, c in enumerate(columns)}
    judged = judge(plain, labels, threshold, most, name[id_col], name[text_col], tuple(c for c in plain.columns if c != name[id_col]))
    return judged.where("kept").select(*plain.columns).toDF(*columns)
