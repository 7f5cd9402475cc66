"""The last written row of each key, without dragging wide rows through an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that comes last by ``order``; nulls come first, rows that repeat in full are one.

    The last value of the first order column is found on keys and that column alone, in a hash aggregate with partial
    results; only rows that have it go on to the window, usually one for each key.
    """
    first, *rest = order
    newest = df.groupBy(*keys).agg(F.max(first).alias("_newest")).withColumnsRenamed({k: f"_{k}" for k in keys})
    same = F.col(first).eqNullSafe(F.col("_newest"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    last = Window.partitionBy(*keys).orderBy(*(F.desc_nulls_last(c) for c in rest or keys))
    return df.join(newest, same, "left_semi").withColumn("_no", F.row_number().over(last)).where("_no = 1").drop("_no")
