"""Queries of the response cache and the call logs."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from paperloom.functions.strings import prompt_hash
from paperloom.operators import runlog as r
from paperloom.operators.latest import last_rows
from paperloom.plans import q_chunking, q_quality
from paperloom.plans.views import spark_view, sql, table
from paperloom.sources import cache_store
from paperloom.sources.tables import scratch


def _calls(spark, d):
    return spark_view(spark, d, "calls")


def _work(spark, d):
    return r.with_key(r.seedable_calls(_calls(spark, d))).select("key", "input")


def _cache(spark, d):
    """The cache with one row per key."""
    rows = r.with_key(spark_view(spark, d, "cache"))
    return last_rows(rows, ["key"], ["written_at", "content"]).select("key", *r.CONTENT)


def keys(spark, d):
    return r.with_key(_calls(spark, d)).select("seq", "key")


def prompts(spark, d):
    return table(spark, d, "documents").select("doc_id", prompt_hash(F.col("text")).alias("prompt_hash"))


def guard(spark, d):
    return r.other_prompts(_calls(spark, d), "abcdef012345")


def hits(spark, d):
    return r.lookup(_work(spark, d), _cache(spark, d))


def missing(spark, d):
    return r.misses(_work(spark, d), _cache(spark, d)).select("key", "input")


def merged(spark, d):
    return r.upsert(_cache(spark, d), r.seed_from_log(_calls(spark, d)))


def seedable(spark, d):
    return _calls(spark, d).select("seq", r.is_seedable(F.col("validation_fail_reason")).alias("seedable"))


def seeded(spark, d):
    return r.seed_from_log(_calls(spark, d))


def counts(spark, d):
    return r.seed_counts(_calls(spark, d))


def never(spark, d):
    return r.unseedable(_calls(spark, d))


def report(spark, d):
    return r.miss_report(r.unseedable(_calls(spark, d))).select(F.col("chars").cast("long").alias("chars"), "preview")


def summary(spark, d):
    s = r.run_summary(_calls(spark, d))
    return s.select("run_id", "model_calls", "cache_hits", F.explode_outer("validation_failures").alias("reason", "failures"))


def stale(spark, d):
    return r.revalidate(spark_view(spark, d, "responses"))


def stored(spark, d):
    """The cache in buckets, and the log's answers brought into it."""
    name, path = f"cache_{uuid.uuid4().hex}", scratch(spark, "cache-table")
    cache_store.open_cache(spark, name, path, parts=8, buckets=8)
    cache_store.upsert_cache(spark, name, path, _cache(spark, d))
    cache_store.upsert_cache(spark, name, path, r.seed_from_log(_calls(spark, d)))
    return cache_store.open_cache(spark, name, path)


def stored_hits(spark, d):
    """Look-ups in the cache in buckets: the cache is read as it lies."""
    name, path = f"cache_{uuid.uuid4().hex}", scratch(spark, "cache-table")
    cache_store.open_cache(spark, name, path, parts=8, buckets=8)
    cache_store.upsert_cache(spark, name, path, _cache(spark, d))
    return r.lookup(_work(spark, d), cache_store.open_cache(spark, name, path))


def sketched(spark, d):
    """Misses, with a sketch of the cache's keys that most of them need not pass."""
    return r.misses(_work(spark, d), _cache(spark, d), sketch=True).select("key", "input")


def requeued(spark, d):
    """Batches of lines: every fourth is not cached, the others' cached answers are judged again; attempts of earlier runs
    come from the conversations."""
    x = spark_view(spark, d, "responses").withColumn("key", F.col("doc_id").cast("string"))
    cache = x.where("doc_id % 4 != 1").select("key", F.col("response").alias("content"), "finish_reason")
    tried = spark_view(spark, d, "attempts").select(F.col("doc_id").cast("string").alias("key"), "fail_code", (F.col("attempt") % 5 == 4).alias("cache_hit"))
    return r.requeue(x.select("key", "items"), cache, r.fold(r.spent(tried))).select("key", "reason", "attempts_left")


def lineage(spark, d):
    """Runs of the log, every third seeded from the run whose number is half of its own."""
    runs = _calls(spark, d).groupBy("run_id").agg(F.min("ts").alias("ts")).withColumn("n", F.substring("run_id", 2, 9).cast("long"))
    return r.replay_lineage(runs.select("run_id", "ts", F.when(F.col("n") % 3 == 0, F.concat(F.lit("r"), F.expr("n div 2"))).alias("seeded_from")))


QUERIES = {
    "l1_cache_key": keys, "l2_prompt_hash": prompts, "l2_other_prompts": guard, "l3_lookup": hits, "l4_misses": missing, "l5_upsert": merged, "l6_is_seedable": seedable, "l7_seed_from_log": seeded, "l7_seed_counts": counts,
    "l8_unseedable": never, "l9_miss_report": report, "l10_run_summary": summary, "l11_revalidate": stale, "l12_replay_lineage": lineage, "l11_requeue": requeued,
    "io8_bucketed_cache": stored, "l3_bucketed_lookup": stored_hits, "l4_sketched_misses": sketched,
}

_KEY = "sha256(concat(input, chr(0), prompt_hash, chr(0), model, chr(0), temperature))"
_OK = "(validation_fail_reason is null or validation_fail_reason like 'partial_bad:%')"
_BASE = f"""with w as (select {_KEY} as key, input from f_calls where call_kind in ('batch', 'single')),
c as (select {_KEY} as key, arg_max(content, (written_at, content)) as content, arg_max(finish_reason, (written_at, content)) as finish_reason, max(written_at) as written_at from f_cache group by 1),
s as (select {_KEY} as key, arg_max(raw_response, (ts, seq)) as content, arg_max(finish_reason, (ts, seq)) as finish_reason, max(ts) as written_at from f_calls where call_kind in ('batch', 'single') and {_OK} group by 1),
n as (select input from f_calls where call_kind in ('batch', 'single') group by 1 having not bool_or({_OK}))
"""
_REFUSED = (
    q_chunking.ALIGN.rstrip() + ", f_pairs as (select doc_id as conv_id, 0 as turn, items[1] as source, parts[1] as response from b where len(items) = 1 and fail_reason is null), " + q_quality.TESTS.removeprefix("with ").rstrip()
    + f""", rv as (select doc_id, fail_reason from b where fail_reason is not null
 union all select conv_id, fail_reason from (select conv_id, {q_quality.CODE} as fail_reason from vt where kind = 'plain') where fail_reason is not null)
"""
)
ORACLES = {
    "l11_requeue": sql(
        _REFUSED.rstrip() + """, sp as (select doc_id, count(*) filter (attempt % 5 <> 4) as tries, count(*) filter (attempt % 5 <> 4 and fail_code is not null) as bad from f_attempts group by 1),
q as (select b.doc_id, case when b.doc_id % 4 = 1 then 'miss' else 'refused:' || rv.fail_reason end as reason, least(5 - coalesce(bad, 0), 12 - coalesce(tries, 0)) as attempts_left
 from b left join rv on rv.doc_id = b.doc_id left join sp on sp.doc_id = b.doc_id)
select cast(doc_id as varchar) as key, reason, attempts_left from q where reason is not null and attempts_left > 0""",
        "responses", "attempts",
    ),
    "l1_cache_key": sql(f"select seq, {_KEY} as key from f_calls", "calls"),
    "l2_prompt_hash": "select doc_id, substring(sha256(text), 1, 12) as prompt_hash from documents",
    "l2_other_prompts": sql("select count(*) filter (prompt_hash is distinct from 'abcdef012345') as others, count(*) as calls from f_calls", "calls"),
    "l3_lookup": sql(_BASE + "select * from c where key in (select key from w)", "calls", "cache"),
    "l4_misses": sql(_BASE + "select distinct key, input from w where key not in (select key from c)", "calls", "cache"),
    "l5_upsert": sql(
        _BASE + ", b as (select * from c union all select * from s) select key, arg_max(content, (written_at, content)) as content, arg_max(finish_reason, (written_at, content)) as finish_reason, max(written_at) as written_at from b group by 1",
        "calls", "cache",
    ),
    "l6_is_seedable": sql(f"select seq, {_OK} as seedable from f_calls", "calls"),
    "l7_seed_from_log": sql(_BASE + "select * from s", "calls", "cache"),
    "l7_seed_counts": sql(f"select count(*) filter ({_OK}) as seeded, count(*) filter (not {_OK}) as skipped from f_calls where call_kind in ('batch', 'single')", "calls"),
    "l8_unseedable": sql(_BASE + "select input from n", "calls", "cache"),
    "l9_miss_report": sql(_BASE + "select length(input) as chars, replace(substring(input, 1, 70), chr(10), ' ') as preview from n", "calls", "cache"),
    "l10_run_summary": sql(
        """with c as (select * from f_calls where call_kind <> 'summary'), t as (select run_id, count(*) as model_calls, count(*) filter (cache_hit) as cache_hits from c group by 1),
f as (select run_id, validation_fail_reason as reason, count(*) as failures from c where validation_fail_reason is not null group by 1, 2)
select t.run_id, cast(model_calls as bigint) as model_calls, cast(cache_hits as bigint) as cache_hits, reason, failures from t left join f on f.run_id = t.run_id""",
        "calls",
    ),
    "l11_revalidate": sql(
        q_chunking.ALIGN.rstrip() + ", f_pairs as (select doc_id as conv_id, 0 as turn, items[1] as source, parts[1] as response from b where len(items) = 1 and fail_reason is null), " + q_quality.TESTS.removeprefix("with ")
        + f"""select doc_id, fail_reason from b where fail_reason is not null
union all select conv_id, fail_reason from (select conv_id, {q_quality.CODE} as fail_reason from vt where kind = 'plain') where fail_reason is not null""",
        "responses",
    ),
    "l12_replay_lineage": sql(
        """with r as (select run_id, min(ts) as ts, cast(substring(run_id, 2) as bigint) as n from f_calls group by 1), s as (select run_id, ts, case when n % 3 = 0 then concat('r', n // 2) end as seeded_from from r)
select a.run_id, a.seeded_from, a.ts, b.ts as seeded_ts from s a left join s b on b.run_id = a.seeded_from""",
        "calls",
    ),
}
ORACLES |= {"io8_bucketed_cache": ORACLES["l5_upsert"], "l3_bucketed_lookup": ORACLES["l3_lookup"], "l4_sketched_misses": ORACLES["l4_misses"]}
