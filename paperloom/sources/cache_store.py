"""The response cache as a bucketed table: look-ups without moving the cache, upserts that rewrite only what they touch.

Rows lie in folders by a hash of the key (``part``) and, inside each, in buckets by another, sorted by key. Joins on the key
read the buckets as they lie; an upsert rewrites the folders that its keys fall into. A manifest beside the table holds the
numbers of both, so any session can open it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators.runlog import CONTENT, upsert
from paperloom.sources.tables import exists

#: Folders of a cache, and buckets inside each.
PARTS, BUCKETS = 64, 200
COLUMNS = ("key", *CONTENT)


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")


def open_cache(spark: SparkSession, name: str, path: str, parts: int = PARTS, buckets: int = BUCKETS) -> DataFrame:
    """The cache under ``path`` as table ``name`` of this session: (key, content, finish_reason, written_at).

    A new one is made empty with the given numbers; for one that is there its own count. The table's files stay where they
    are when the session ends.
    """
    manifest = f"{path}-manifest"
    if not exists(spark, manifest):
        spark.createDataFrame([(parts, buckets)], "parts int, buckets int").coalesce(1).write.parquet(manifest)
    parts, buckets = spark.read.parquet(manifest).first()
    spark.sql(
        f"create table if not exists {name} (key string, content string, finish_reason string, written_at timestamp_ntz, part int) using parquet "
        f"partitioned by (part) clustered by (key) sorted by (key) into {buckets} buckets location '{path}'"
    )
    if exists(spark, path):  # folders that other sessions wrote
        spark.catalog.recoverPartitions(name)
    return spark.table(name).select(*COLUMNS)


def upsert_cache(spark: SparkSession, name: str, path: str, new: DataFrame) -> list[int]:
    """Bring new rows into the cache; the last write of a key wins, as in ``upsert``. Returns the folders rewritten.

    Only the folders of the new keys are read and written (at most as many numbers as there are folders reach the driver);
    each is staged and put in place when the job commits, so a failed upsert leaves the cache as it was.
    """
    parts, buckets = spark.read.parquet(f"{path}-manifest").first()
    touched = sorted(r[0] for r in new.select(_part(parts)).distinct().collect())
    if not touched:
        return []
    old = spark.table(name).where(F.col("part").isin(touched)).select(*COLUMNS)
    merged = upsert(old, new.select(*COLUMNS)).withColumn("part", _part(parts))
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        merged.repartition(buckets, "key").select(*COLUMNS, "part").write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(key, before)
    spark.catalog.refreshTable(name)
    return touched
