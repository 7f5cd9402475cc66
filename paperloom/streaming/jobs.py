"""The streaming jobs: live and daily counters over growing call logs, and incremental upkeep of the archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions.strings import category_dir
from paperloom.operators.archive import upsert_archive
from paperloom.sources.tables import delete, exists


def live_counters(calls: DataFrame) -> DataFrame:
    """Calls, cache hits and failures per run and reason; drained, the same numbers as the batch summary."""
    rows = calls.where(F.col("call_kind") != "summary")
    return rows.groupBy("run_id", "validation_fail_reason").agg(F.count(F.lit(1)).alias("calls"), F.count_if("cache_hit").alias("hits"))


#: Key of the daily counters; batches after which a ledger's entries are folded into one table.
DAILY, FOLD = ["day", "run_id", "validation_fail_reason"], 64


def daily_counters(calls: DataFrame, root: str, checkpoint: str, fold: int = FOLD):
    """Start a query that enters each micro-batch's calls and hits per day, run and reason into a ledger under ``root``.

    An entry says what a batch adds, so the order in which files come does not matter and a row is never too late: one
    for a day long past is a correction (see ``corrections``). No state is kept in memory; a batch that runs again
    overwrites its own entry. After every ``fold`` batches the entries are added up, and those added up the time before,
    which no rerun can need, are deleted. Null times are a day of their own.
    """

    def enter(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(F.col("call_kind") != "summary").withColumn("day", F.to_date("ts"))
        rows.groupBy(*DAILY).agg(F.count(F.lit(1)).alias("calls"), F.count_if("cache_hit").alias("hits")).write.mode("overwrite").parquet(f"{root}/entries/{epoch}")
        if epoch % fold == fold - 1:
            _ledger(spark, root, epoch, fold).groupBy(*DAILY).agg(F.sum("calls").alias("calls"), F.sum("hits").alias("hits")).write.mode("overwrite").parquet(f"{root}/folded/{epoch}")
            old = epoch - fold
            delete(spark, f"{root}/folded/{old - fold}", *(f"{root}/entries/{e}" for e in range(max(old - fold + 1, 0), old + 1)))

    return calls.writeStream.foreachBatch(enter).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _ledger(spark: SparkSession, root: str, epoch: int, fold: int) -> DataFrame:
    """What the last fold before an epoch and the entries since then add up to."""
    last = (epoch // fold) * fold - 1
    paths = [f"{root}/entries/{e}" for e in range(last + 1, epoch + 1)] + [f"{root}/folded/{last}"] * (last >= 0)
    return spark.read.parquet(*paths)


def read_daily(spark: SparkSession, root: str, epoch: int, fold: int = FOLD) -> DataFrame:
    """(day, run_id, validation_fail_reason, calls, hits) as of a batch."""
    return _ledger(spark, root, epoch, fold).groupBy(*DAILY).agg(F.sum("calls").alias("calls"), F.sum("hits").alias("hits"))


def corrections(spark: SparkSession, root: str, epoch: int, days: int = 1, fold: int = FOLD) -> DataFrame:
    """Entries since the last fold for days that were closed when they came: a batch before had a row ``days`` later."""
    entries = None
    for e in range((epoch // fold) * fold, epoch + 1):
        one = spark.read.parquet(f"{root}/entries/{e}").withColumn("epoch", F.lit(e).cast("long"))
        entries = one if entries is None else entries.unionByName(one)
    newest = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)  # one row for each batch
    ends = entries.groupBy("epoch").agg(F.max("day").alias("last")).withColumn("before", F.max("last").over(newest)).drop("last")
    return entries.join(F.broadcast(ends), "epoch").where(F.date_add("day", days) <= F.col("before")).drop("before")


#: Parts of a folder of the archive; a batch rewrites only the parts that its ids fall into.
PARTS = 32
NO_FOLDER = "none"


def _folder_key(folder: Column) -> Column:
    """Name of a category folder's own folder: a digest, as the name may hold any sign, or be null."""
    return F.coalesce(F.md5(folder), F.lit(NO_FOLDER))


def _manifest(spark: SparkSession, root: str, epoch: int) -> dict[tuple[str, int], int]:
    """(folder key, part) -> the epoch that wrote it last, as of an epoch: at most folders times PARTS rows."""
    path = f"{root}/manifest/{epoch}"
    if epoch < 0 or not exists(spark, path):
        return {}
    return {(r.folder, r.part): r.epoch for r in spark.read.parquet(path).collect()}


def _place(root: str, key: tuple[str, int], epoch: int) -> str:
    return f"{root}/pages/epoch={epoch}/folder={key[0]}/part={key[1]}"


def read_archive(spark: SparkSession, root: str, epoch: int) -> DataFrame:
    """The archive as of an epoch: the latest version of every part of every folder; empty before the first batch."""
    return _read_parts(spark, root, _manifest(spark, root, epoch))


def _read_parts(spark: SparkSession, root: str, parts: dict[tuple[str, int], int]) -> DataFrame:
    schema = spark.read.parquet(f"{root}/schema").schema
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*(_place(root, key, epoch) for key, epoch in parts.items()))


def upkeep(pages: DataFrame, root: str, checkpoint: str, parts: int = PARTS):
    """Start a query that applies each micro-batch of new pages to the archive under ``root`` (see ``read_archive``).

    The archive lies in parts by folder and id; a batch reads and rewrites the parts that it touches and no others, and a
    manifest says which epoch wrote each part last. A batch that is run again starts from the manifest before it and
    writes the same again. A part that a later epoch has replaced goes one epoch after that, when no rerun can ask for it.
    Categories may be null or hold any signs, ids may be null; pages without a category share a folder of their own.
    """
    none = pages.sparkSession.createDataFrame([], pages.schema)
    upsert_archive(none, none).coalesce(1).write.mode("overwrite").parquet(f"{root}/schema")

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        known, older = _manifest(spark, root, epoch - 1), _manifest(spark, root, epoch - 2)
        delete(spark, *(_place(root, key, at) for key, at in older.items() if known.get(key) != at), *[f"{root}/manifest/{epoch - 2}"] * bool(older))
        place = {"folder": _folder_key(F.col("category_dir")), "part": F.pmod(F.xxhash64("arxiv_id"), F.lit(parts)).cast("int")}
        new = batch.withColumn("category_dir", category_dir(F.col("category"))).withColumns(place)
        touched = [(r.folder, r.part) for r in new.select("folder", "part").distinct().collect()]  # at most folders times parts
        before = {key: known[key] for key in touched if key in known}
        old = _read_parts(spark, root, before).select(*batch.columns)
        kept = upsert_archive(old, batch).withColumns(place)
        kept.repartition("folder", "part").write.mode("overwrite").partitionBy("folder", "part").parquet(f"{root}/pages/epoch={epoch}")
        rows = [(*key, at) for key, at in (known | dict.fromkeys(touched, epoch)).items()]
        spark.createDataFrame(rows, "folder string, part int, epoch long").coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/{epoch}")

    return pages.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_stream(spark: SparkSession, schema, path: str, files: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
