"""Sharding by extendible hashing, with DataFrame functions only.

A directory maps the leading bits of a hash of the id to shards. A bucket splits on one more bit only while it holds
more than the byte limit, so shards of unequal depth stand side by side, as in a local-depth directory.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.common import hot_join, text_or_empty, written

#: Bits of the hash: 12 hexadecimal digits of the id's MD5.
BITS = 48
#: Bytes a shard may hold; a record counts its UTF-8 text and one byte for its end.
SHARD_BYTES = 64 << 20
#: Bits looked at beyond those that even splitting would need; what is still too large then is split bit by bit to BITS.
SPARE_BITS = 6
#: Depths up to which oversized buckets are broadcast: there are at most 2 to the SHALLOW + 1 of them.
SHALLOW = 12
#: Up to so many rows of the directory are broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 250_000
#: Rows of one hash that alone exceed the limit are numbered in so many parts.
PARTS = 1024


def id_bits(c: Column) -> Column:
    return F.conv(F.substring(F.md5(F.coalesce(c.cast("string"), F.lit(""))), 1, BITS // 4), 16, 10).cast("long")


def _bits(depth: str, of: str = "_hash") -> Column:
    return F.expr(f"shiftright({of}, {BITS} - {depth})")


def _too_large(leaves: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """The deepest oversized bucket over each (_key, _deep): its depth, from ``low`` to ``high`` bits.

    leaves: _hash (any hash in the bucket) and _bytes.
    """
    levels = leaves.withColumn("_depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn("_bucket", _bits("_depth"))
    return levels.groupBy("_depth", "_bucket").agg(F.sum("_bytes").alias("_sum")).where(F.col("_sum") > limit).select("_depth", "_bucket")


def _leaf_depth(leaves: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """leaves with _leaf: one bit more than the deepest oversized bucket, ``low`` where none is, at most ``high``.

    All leaves share the few buckets of the shallow depths, so these are looked up in a broadcast list (at most 2 to the
    SHALLOW + 1 rows); a deeper bucket holds a small share of the leaves only and they are joined to it.
    """
    big = written(_too_large(leaves, low, high, limit), "oversized")
    levels = leaves.withColumn("_depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn("_bucket", _bits("_depth"))
    key = ["_depth", "_bucket"]
    shallow = levels.where(F.col("_depth") <= SHALLOW).join(F.broadcast(big.where(F.col("_depth") <= SHALLOW)), key, "left_semi")
    deep = levels.where(F.col("_depth") > SHALLOW).join(big.where(F.col("_depth") > SHALLOW), key, "left_semi")
    deepest = shallow.unionByName(deep).groupBy("_hash").agg(F.max("_depth").alias("_max"))
    return leaves.join(deepest, "_hash", "left").withColumn("_leaf", F.coalesce(F.col("_max") + 1, F.lit(low))).drop("_max")


def directory(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """(first, second, deep): the depth ``_first`` of every bucket ``_hash`` of ``deep`` leading bits, with its ``_rows``;
    and of the few buckets that are still too large there, the depth ``_second`` of each full hash ``_h``. The documents
    are read once; all else works on their sizes."""
    text = text_or_empty(F.col(text_col))
    sized = written(
        docs.select(id_bits(F.col(id_col)).alias("_h"), (F.octet_length(text) + 1).cast("long").alias("_bytes")).groupBy("_h").agg(F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_rows")), "sizes"
    )
    total = sized.agg(F.sum("_bytes")).first()[0] or 0
    deep = min(BITS, max(1, math.ceil(math.log2(max(1, total) / limit)) + SPARE_BITS))
    buckets = sized.groupBy(_bucket(deep)).agg(F.sum("_bytes").alias("_bytes"), F.sum("_rows").alias("_rows"))
    first = written(_leaf_depth(buckets, 0, deep, limit).select("_hash", "_rows", F.col("_leaf").alias("_first")), "directory")
    # Buckets that are too large even at that depth, few as they are, go on to the last bit with their own hashes.
    rest = sized.withColumn("_hash", _bucket(deep)).join(first.where(F.col("_first") > deep).select("_hash"), "_hash", "left_semi").select(F.col("_h").alias("_hash"), "_bytes", "_rows")
    second = _leaf_depth(rest, deep, BITS, limit).select(F.col("_hash").alias("_h"), "_rows", F.col("_leaf").alias("_second"))
    return first, written(second, "deeper"), deep


def _bucket(deep: int) -> Column:
    return F.expr(f"shiftleft(shiftright(_h, {BITS - deep}), {BITS - deep})").alias("_hash")


def _looked_up(rows: DataFrame, table: DataFrame, key: str, size: str, spread: str) -> DataFrame:
    """Rows with the columns of their key's row in ``table``: broadcast up to BROADCAST_ROWS of them, else dealt."""
    if table.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(table.drop(size)), key)
    return hot_join(rows, table, key, size, spread).drop(size)


def with_shards(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_bytes, depth, prefix, page and shard.

    shard is ``<bits>`` of the directory entry (``-`` for the undivided one), with ``.<page>`` where rows of one hash
    alone exceed the limit: those cannot be split by bits, so rows of one length fill pages of as many as fit. A single
    text above the limit has a page of its own, the only kind above the limit. Null ids hash as the empty string, null
    texts count as empty, rows that repeat are rows, an empty table gives an empty result; columns of the input that
    clash with the new ones are replaced.
    """
    first, second, deep = directory(docs, limit, id_col, text_col)
    new = ("n_bytes", "depth", "prefix", "page", "shard")
    names = docs.columns
    docs = docs.toDF(*(f"c{k}" for k in range(len(names))))
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    text = text_or_empty(F.col(text_col))
    rows = docs.withColumns({"_h": id_bits(F.col(id_col)), "_size": (F.octet_length(text) + 1).cast("long"), "_text": F.xxhash64(text)}).withColumn("_part", F.pmod("_text", F.lit(PARTS)).cast("int")).withColumn("_hash", _bucket(deep))
    placed = _looked_up(rows, first, "_hash", "_rows", "_h")
    deeper, paged = second.agg(F.count(F.lit(1)), F.count_if(F.col("_second") > BITS)).first()
    if deeper:
        split = _looked_up(placed.where(F.col("_first") > deep), second, "_h", "_rows", "_part")
        placed = placed.where(F.col("_first") <= deep).withColumn("_second", F.lit(None).cast("int")).unionByName(split)
    else:
        placed = placed.withColumn("_second", F.lit(None).cast("int"))
    placed = placed.withColumn("_leaf", F.coalesce("_second", "_first"))
    page = F.lit(None).cast("string")
    if paged:
        alone = placed.where(F.col("_leaf") > BITS)
        # a row's rank is its rank in its part of the rows of its length plus the sizes of the parts before
        before = Window.partitionBy("_h", "_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        sums = alone.groupBy("_h", "_size", "_part").count().withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
        within = Window.partitionBy("_h", "_size", "_part").orderBy("_text")
        ranked = alone.withColumn("_row", F.row_number().over(within) - 1).join(sums, ["_h", "_size", "_part"])
        fits = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.col("_size")))
        page = F.concat_ws("-", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.col("_size").cast("string"), F.floor((F.col("_before") + F.col("_row")) / fits).cast("string"))
        ranked = ranked.withColumn("page", page).drop("_before", "_row")
        placed = placed.where(F.col("_leaf") <= BITS).withColumn("page", F.lit(None).cast("string")).unionByName(ranked)
    else:
        placed = placed.withColumn("page", page)
    bits = F.when(F.col("depth") == 0, F.lit("-")).otherwise(F.lpad(F.conv(F.col("prefix").cast("string"), 10, 2), F.col("depth"), F.lit("0")))
    return (
        placed.withColumn("depth", F.least("_leaf", F.lit(BITS)).cast("int"))
        .withColumns({"n_bytes": F.col("_size"), "prefix": _bits("depth", "_h")})
        .withColumn("shard", F.concat_ws(".", bits, "page"))
        .select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names) if c not in new), *new)
    )


def shard(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_bytes, depth, prefix, page, shard (as in ``with_shards``), shard_bytes, shard_docs."""
    rows = written(with_shards(docs.select(id_col, text_col), limit, id_col, text_col).drop(text_col), "shards")
    sizes = rows.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_docs"))
    return rows.join(sizes, "shard").select(id_col, "n_bytes", "depth", "prefix", "page", "shard", "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the documents as Parquet, one folder ``shard=<shard>`` and one file per shard. Nulls, long texts, repeated rows
    and clashing columns are as in ``with_shards``; an empty table writes no shard."""
    with_shards(docs, limit, id_col, text_col).repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int = SHARD_BYTES) -> str:
    """The same by summing the buckets of all depths, for tables in which no text alone exceeds the limit."""
    return f"""
with d as (select doc_id, strlen(coalesce(text, '')) + 1 as n_bytes, ('0x' || substr(md5(cast(doc_id as varchar)), 1, 12))::bigint as h from documents),
levels as (select depth, h >> cast({BITS} - depth as integer) as bucket, sum(n_bytes) as bytes
 from d, (select unnest(generate_series(0, {BITS})) as depth) group by 1, 2 having sum(n_bytes) > {limit}),
leaf as (select d.doc_id, d.n_bytes, d.h, coalesce(max(l.depth) + 1, 0) as depth
 from d left join levels l on l.bucket = d.h >> cast({BITS} - l.depth as integer) group by 1, 2, 3),
named as (select doc_id, n_bytes, cast(depth as integer) as depth, h >> cast({BITS} - depth as integer) as prefix, cast(null as varchar) as page,
 case when depth = 0 then '-' else lpad(bin(h >> cast({BITS} - depth as integer)), cast(depth as integer), '0') end as shard from leaf)
select doc_id, n_bytes, depth, prefix, page, shard, cast(sum(n_bytes) over (partition by shard) as bigint) as shard_bytes,
 count(*) over (partition by shard) as shard_docs from named
"""
