"""Response cache and call logs: keys, lookups, upserts, seeding and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paperloom.functions.parallel import fail_code
from paperloom.functions.strings import cache_key
from paperloom.operators.absence import anti_join
from paperloom.operators.chunking import align_response, aligned_items
from paperloom.operators.latest import last_rows
from paperloom.operators.pair_quality import BAD_ATTEMPTS, MOST_ATTEMPTS

#: Kinds of calls that can seed the cache. Fixed values.
SEEDABLE_KINDS = ("batch", "single")
#: Columns of a cache row besides its key.
CONTENT = ("content", "finish_reason", "written_at")


def with_key(df: DataFrame) -> DataFrame:
    return df.withColumn("key", cache_key(F.col("input"), F.col("prompt_hash"), F.col("model"), F.col("temperature")))


def other_prompts(log: DataFrame, expected: str) -> DataFrame:
    """How many logged calls used another prompt than the expected one."""
    return log.agg(F.count_if(~F.col("prompt_hash").eqNullSafe(expected)).alias("others"), F.count(F.lit(1)).alias("calls"))


def lookup(work: DataFrame, cache: DataFrame) -> DataFrame:
    """Hits: the distinct keys of the work that the cache has, with its content."""
    return cache.join(work.select("key").distinct(), "key", "left_semi")


def _one_of_each(rows: DataFrame, key: str) -> DataFrame:
    """One row of each key, the first by a hash of all its columns: no aggregate over long ones."""
    first = Window.partitionBy(key).orderBy("_tie")
    return rows.withColumn("_tie", F.xxhash64(*rows.columns)).withColumn("_no", F.row_number().over(first)).where("_no = 1").drop("_no", "_tie")


def misses(work: DataFrame, cache: DataFrame, sketch: bool = False) -> DataFrame:
    """The model work-list: one row per key that the cache lacks. With ``sketch`` rows whose keys a Bloom sketch of the cache
    rules out do not meet the cache (see ``absence.anti_join``): for caches too large to broadcast that answer little."""
    keys = cache.select("key")
    lacking = anti_join(work, keys, "key") if sketch else work.join(keys, "key", "left_anti")
    return _one_of_each(lacking, "key")


def upsert(cache: DataFrame, new: DataFrame) -> DataFrame:
    """The last write of a key wins; of equal times the larger content."""
    return last_rows(cache.unionByName(new), ["key"], ["written_at", "content"]).select("key", *CONTENT)


def is_seedable(reason: Column) -> Column:
    """No failure, or only some items of a batch failed."""
    return reason.isNull() | F.coalesce(reason.startswith("partial_bad:"), F.lit(False))


def seedable_calls(log: DataFrame) -> DataFrame:
    return log.where(F.col("call_kind").isin(*SEEDABLE_KINDS))


def seed_from_log(log: DataFrame) -> DataFrame:
    """Cache rows from a log; a later line (ts, then seq) overwrites an earlier one."""
    passed = seedable_calls(log).where(is_seedable(F.col("validation_fail_reason")))
    rows = with_key(passed).select("key", F.col("raw_response").alias("content"), "finish_reason", F.col("ts").alias("written_at"), "seq")
    return last_rows(rows, ["key"], ["written_at", "seq"]).select("key", *CONTENT)


def seed_counts(log: DataFrame) -> DataFrame:
    """Records, not keys: how many seed the cache and how many are passed over."""
    ok = is_seedable(F.col("validation_fail_reason"))
    return seedable_calls(log).agg(F.count_if(ok).alias("seeded"), F.count_if(~ok).alias("skipped"))


def unseedable(log: DataFrame) -> DataFrame:
    """Inputs of which no attempt passed, whatever the prompt. Grouped by a digest alone; the inputs are fetched once it is
    known which."""
    ok = is_seedable(F.col("validation_fail_reason"))
    calls = seedable_calls(log).select("input", F.sha2("input", 256).alias("_digest"), ok.alias("_ok"))
    bad = calls.groupBy("_digest").agg(F.bool_or("_ok").alias("_ok")).where("not _ok").select("_digest")
    same = F.col("_digest").eqNullSafe(F.col("_bad"))
    rows = calls.select("input", "_digest").join(bad.withColumnRenamed("_digest", "_bad"), same, "left_semi")
    return _one_of_each(rows, "_digest").select("input")


def miss_report(inputs: DataFrame, most: int = 70) -> DataFrame:
    return inputs.select(F.length("input").alias("chars"), F.replace(F.substring("input", 1, most), F.lit("\n"), F.lit(" ")).alias("preview"))


def run_summary(log: DataFrame) -> DataFrame:
    """Per run: model calls (hits included), cache hits, and failures by reason as a map; success is no reason."""
    calls = log.where(F.col("call_kind") != "summary")
    by_reason = calls.groupBy("run_id", "validation_fail_reason").agg(F.count(F.lit(1)).alias("n"), F.count_if("cache_hit").alias("hits"))
    entry = F.when(F.col("validation_fail_reason").isNotNull(), F.struct("validation_fail_reason", "n"))
    return by_reason.groupBy("run_id").agg(
        F.sum("n").alias("model_calls"), F.sum("hits").alias("cache_hits"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("validation_failures")
    )


def revalidate(hits: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, items, response, finish_reason) of cached answers that would be refused today, with the reason.

    Structural faults refuse a batch; a batch with some bad items stays; a single item is tested like a fresh answer.
    """
    aligned = align_response(hits.select(F.col(key).alias("doc_id"), "items", "response", "finish_reason"))
    broken = aligned.where("fail_reason is not null").select("doc_id", "fail_reason")
    single = aligned_items(aligned.where(F.size("items") == 1)).select("doc_id", fail_code(F.col("item"), F.col("part")).alias("fail_reason"))
    return broken.unionByName(single.where("fail_reason is not null")).withColumnRenamed("doc_id", key)


def enter_attempts(attempts: DataFrame, root: str, run: str) -> None:
    """Append a run's attempts (key, fail_code, cache_hit) to the ledger under ``root``, added up by key. A run that is
    entered again replaces its own entry. A refused cache hit costs nothing: it is no entry."""
    spent(attempts).write.mode("overwrite").parquet(f"{root}/run={run}")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """(key, tries, bad) over all runs of a ledger."""
    return fold(spark.read.option("basePath", root).parquet(f"{root}/run=*"))


def spent(attempts: DataFrame) -> DataFrame:
    """(key, tries, bad): attempts that called the model, and those of them whose answer was refused. Exceptions
    (``exception:…``) are tries only."""
    called = ~F.coalesce("cache_hit", F.lit(False))
    bad = F.col("fail_code").isNotNull() & ~F.col("fail_code").startswith("exception:")
    return attempts.groupBy("key").agg(F.count_if(called).alias("tries"), F.count_if(called & bad).alias("bad"))


def fold(entries: DataFrame) -> DataFrame:
    """Entries (key, tries, bad) of any number of runs, added up by key."""
    return entries.groupBy("key").agg(F.sum("tries").alias("tries"), F.sum("bad").alias("bad"))


def requeue(work: DataFrame, cache: DataFrame, ledger: DataFrame) -> DataFrame:
    """The work-list with what the cache answers badly: (the columns of ``work``, reason, attempts_left).

    work: (key, items, more); cache: (key, content, finish_reason); ledger: (key, tries, bad). A key is asked for when the
    cache lacks it (reason ``miss``) or when its cached answer is refused today (``refused:<code>``). What earlier runs
    spent on it counts, the refused hit does not; keys without attempts left are given up. One row a key.
    """
    distinct = _one_of_each(work, "key")
    hits = distinct.select("key", "items").join(cache.select("key", F.col("content").alias("response"), "finish_reason"), "key")
    refused = revalidate(hits, "key").select("key", F.concat(F.lit("refused:"), "fail_reason").alias("reason"))
    known = cache.select("key", F.lit(True).alias("_hit"))
    asked = distinct.join(known, "key", "left").join(refused, "key", "left").where("_hit is null or reason is not null")
    tries, bad = F.coalesce("tries", F.lit(0)), F.coalesce("bad", F.lit(0))
    left = F.least(BAD_ATTEMPTS - bad, MOST_ATTEMPTS - tries).cast("long")
    out = asked.join(ledger.select("key", "tries", "bad"), "key", "left").withColumn("attempts_left", left).where("attempts_left > 0")
    return out.select(*work.columns, F.coalesce("reason", F.lit("miss")).alias("reason"), "attempts_left")


def replay_lineage(summaries: DataFrame) -> DataFrame:
    """(run_id, seeded_from, ts) with the start of the run that seeded it."""
    earlier = summaries.select(F.col("run_id").alias("seeded_from"), F.col("ts").alias("seeded_ts"))
    return summaries.join(earlier, "seeded_from", "left").select("run_id", "seeded_from", "ts", "seeded_ts")
