"""Exact deduplication by progressive refinement, with DataFrame functions only.

Texts are equal when they are identical after lower-casing A-Z. Candidates are narrowed by byte length, then by a hash
of the first bytes, and only the rows of groups that still hold two or more have their full content read and hashed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import hot_join, lower_ascii, text_or_empty, written

#: Characters of the normalised text in the second key.
PREFIX_CHARS = 64
#: Up to so many keys (8 bytes each) are broadcast to pick out the rows that share them; more are joined by a shuffle.
BROADCAST_KEYS = 250_000


def _key(text: Column) -> tuple[Column, Column]:
    """Byte length, which lower-casing A-Z does not change, and a hash of the first characters."""
    return F.octet_length(text).alias("_len"), F.xxhash64(lower_ascii(F.substring(text, 1, PREFIX_CHARS))).alias("_prefix")


def _candidates(docs: DataFrame, text_col: str) -> DataFrame:
    """(_key, _n) of the lengths and prefixes that two or more rows share, with how many: partial counts leave one row
    for each length and prefix, so a hot one is no burden. Prefixes are grouped only for lengths that two rows share."""
    counts = written(docs.select(*_key(text_or_empty(F.col(text_col)))).groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n")), "keys")
    lengths = counts.groupBy("_len").agg(F.sum("_n").alias("_rows")).where("_rows > 1").select("_len")
    groups = counts.join(lengths, "_len", "left_semi").where("_n > 1").select(F.xxhash64("_len", "_prefix").alias("_key"), "_n")
    return written(groups.groupBy("_key").agg(F.sum("_n").alias("_n")), "candidates")


def _digests(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, _sha, _rows) of the rows that share length and prefix with others; only these are read in full."""
    groups = _candidates(docs, text_col)
    text = text_or_empty(F.col(text_col))
    keyed = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(*_key(text)).alias("_key"))
    if groups.count() <= BROADCAST_KEYS:
        alive = keyed.join(F.broadcast(groups.select("_key")), "_key", "left_semi")
    else:
        alive = hot_join(keyed, groups, "_key", "_n", "_id")
    digests = alive.select("_id", F.xxhash64("_text").alias("_h"), F.sha2(lower_ascii(F.col("_text")), 256).alias("_sha"))
    return written(digests.groupBy("_id", "_h", "_sha").agg(F.count(F.lit(1)).alias("_rows")), "digests")


def equal_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_sha, _keep, _size) of every text that two or more rows share: ``_keep`` is the row that stays, as its id and the
    hash of its text before lower-casing. It has the largest id; null ids count as the smallest."""
    found = _digests(docs, id_col, text_col).groupBy("_sha").agg(F.max(F.struct("_id", "_h")).alias("_keep"), F.sum("_rows").alias("_size"))
    return found.where("_size > 1")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Null text counts as empty; null ids count as the smallest; texts may have any length. Rows that repeat both id and
    text are told apart by a count only: exactly one of them is kept. Two texts under one id are two documents. An empty
    table gives an empty result; other columns are ignored.
    """
    sha = F.sha2(lower_ascii(text_or_empty(F.col(text_col))), 256)
    rows = docs.select(F.col(id_col).alias("_i"), sha.alias("_sha")).groupBy("_i", "_sha").agg(F.count(F.lit(1)).alias("_n"))
    joined = hot_join(rows, equal_groups(docs, id_col, text_col), "_sha", "_size", "_i", "left")
    alone = F.col("_size").isNull()
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(
        F.col("_i").alias(id_col),
        F.when(alone, F.col("_i")).otherwise(F.col("_keep._id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        ((F.col("_copy") == 1) & (alone | F.col("_i").eqNullSafe(F.col("_keep._id")))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the rows that ``exact_dedup`` drops, with all their columns, whatever their names.

    The keys of the rows to drop are found first, so the texts are read in place, or dealt once where the keys are many.
    Nulls, repeated rows, long texts and empty tables are as in ``exact_dedup``.
    """
    columns = docs.columns
    plain = docs.toDF(*(f"c{k}" for k in range(len(columns))))
    id_, text = (f"c{columns.index(c)}" for c in (id_col, text_col))
    digests = _digests(plain, id_, text)
    groups = digests.groupBy("_sha").agg(F.max(F.struct("_id", "_h")).alias("_keep"), F.sum("_rows").alias("_size")).where("_size > 1")
    told = hot_join(digests, groups, "_sha", "_size", "_id").withColumn("_stays", F.struct("_id", "_h").eqNullSafe(F.col("_keep")))
    marked = written(told.where("not _stays or _rows > 1").select("_id", "_h", "_stays"), "marked")
    many, again = marked.agg(F.count(F.lit(1)), F.count_if("_stays")).first()
    hashed = plain.withColumn("_row", F.xxhash64(text_or_empty(F.col(text))))
    keys = F.broadcast(marked) if many <= BROADCAST_KEYS else marked
    same = hashed[id_].eqNullSafe(keys["_id"]) & (hashed["_row"] == keys["_h"])
    kept = hashed.join(keys, same, "left_anti").drop("_row")
    if again:
        kept = kept.unionByName(hashed.join(keys.where("_stays"), same, "left_semi").dropDuplicates([id_, "_row"]).drop("_row"))
    return kept.toDF(*columns)


ORACLE = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
 doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""
