"""Anti-joins that shuffle only what a Bloom sketch of the right side cannot rule out."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one bitmap of the sketch (what ``bitmap_construct_agg`` makes), bits for each key, and hashes of a key.
BITMAP, BITS_PER_KEY, HASHES = 32_768, 16, 3
#: Bytes that a sketch may have; beyond that the join is a plain one.
MOST_BYTES = 64 << 20


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(k)), F.lit(bits).cast("long")) for k in range(HASHES)]


def sketch(right: DataFrame, key: str, bits: int) -> DataFrame:
    """(bitmap_no, bitmap): a Bloom filter of ``bits`` bits in bitmaps of 4096 bytes, built by partial aggregation. Null keys
    leave no bits; bitmaps without bits have no row."""
    places = right.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("_place"))
    number = F.floor(F.col("_place") / BITMAP).cast("int")
    return places.groupBy(number.alias("bitmap_no")).agg(F.bitmap_construct_agg(F.pmod("_place", F.lit(BITMAP))).alias("bitmap"))


def _maybe(left: DataFrame, found: DataFrame, key: str, bits: int) -> DataFrame:
    """``left`` with _maybe: may the key be on the other side? Each hash looks its bitmap up in the broadcast sketch."""
    rows = left.withColumn("_maybe", F.col(key).isNotNull())
    for k, place in enumerate(_places(F.col(key), bits)):
        one = found.select(F.col("bitmap_no").alias("_no"), F.col("bitmap").alias("_bitmap"))
        at = F.pmod(place, F.lit(BITMAP)).cast("int")
        byte = F.conv(F.hex(F.substring(F.col("_bitmap"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        bit = F.expr("shiftright(_byte, _bit) & 1") == 1
        rows = rows.withColumn("_at", F.floor(place / BITMAP).cast("int")).join(F.broadcast(one), F.col("_at") == F.col("_no"), "left")
        rows = rows.withColumns({"_byte": byte, "_bit": F.pmod(at, F.lit(8))}).withColumn("_maybe", F.col("_maybe") & F.coalesce(bit, F.lit(False)))
        rows = rows.drop("_at", "_no", "_bitmap", "_byte", "_bit")
    return rows


def anti_join(left: DataFrame, right: DataFrame, key: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``left`` without the rows whose key is in ``right``; the same rows as a left anti join, in any order.

    The right side is counted and sketched first (it should be cheap to read twice). Rows that the sketch rules out, about
    998 of 1000 of those without a partner, go straight to the result; the others are joined. A sketch of more than
    ``most_bytes`` bytes is not made: then all rows are joined. Null keys have no partner; an empty side is no exception.
    """
    keys = right.select(key)
    count = keys.count()
    bits = BITMAP * max(1, math.ceil(count * BITS_PER_KEY / BITMAP))
    if bits // 8 > most_bytes:
        return left.join(keys, key, "left_anti")
    told = _maybe(left, sketch(keys, key, bits), key, bits)
    absent = told.where(~F.col("_maybe")).drop("_maybe")
    return absent.unionByName(told.where("_maybe").drop("_maybe").join(keys, key, "left_anti").select(*left.columns))
