"""Queries of the selection operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.strings import canonical_id, collapse_ws
from paperloom.operators import selection as s
from paperloom.plans.views import spark_view, sql

CATEGORIES = [f"c{k}" for k in range(5)]


def _inputs(spark, d):
    return tuple(spark_view(spark, d, v) for v in ("runs", "candidates", "upvotes", "published"))


def canonical(spark, d):
    x = spark_view(spark, d, "feed").select("doc_id", F.regexp_extract("entry_xml", "<id>(.*?)</id>", 1).alias("raw"))
    return x.select("doc_id", canonical_id(F.col("raw")).alias("id"))


def whitespace(spark, d):
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", collapse_ws(F.col("text")).alias("text"))


def urls(spark, d):
    x = spark_view(spark, d, "feed").select(
        "doc_id",
        F.regexp_extract("entry_xml", "<id>(.*?)</id>", 1).alias("id"),
        F.regexp_extract("entry_xml", "<published>(.*?)</published>", 1).alias("published"),
        F.regexp_extract("entry_xml", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("entry_xml", "(?s)<summary>(.*?)</summary>", 1).alias("summary"),
        F.nullif(F.regexp_extract("entry_xml", 'title="pdf" href="(.*?)"', 1), F.lit("")).alias("pdf_url"),
    )
    return s.candidate_urls(x).select("doc_id", "id", F.col("published").cast("timestamp_ntz").alias("published"), "title", "abs_url", "pdf_url")


def window(spark, d):
    ref = s.as_of_instant(F.lit("1998-01-04"))
    return s.in_window(spark_view(spark, d, "candidates"), ref)


def instant(spark, d):
    return spark_view(spark, d, "runs").select("as_of", s.as_of_instant(F.col("as_of")).alias("instant"))


def replay(spark, d):
    runs, candidates, _, _ = _inputs(spark, d)
    return s.replay_window(runs, candidates).select("as_of", "category", "id", "published")


def votes(spark, d):
    runs, _, snaps, _ = _inputs(spark, d)
    return s.upvotes_asof(snaps, runs)


def unpublished(spark, d):
    _, candidates, _, published = _inputs(spark, d)
    return s.exclude_published(candidates, published)


def sketched(spark, d):
    _, candidates, _, published = _inputs(spark, d)
    return s.exclude_published(candidates, published, sketch=True)


def attached(spark, d):
    runs, candidates, snaps, _ = _inputs(spark, d)
    return s.attach_upvotes(s.replay_window(runs, candidates), s.upvotes_asof(snaps, runs)).select("as_of", "category", "id", "upvotes", "matched")


def capped(spark, d):
    return s.within_page_cap(spark_view(spark, d, "candidates"))


def ranked(spark, d):
    return s.top_candidates(*_inputs(spark, d), most=5).select("as_of", "category", "id", "upvotes", "matched", F.col("rank").cast("long").alias("rank"))


def top1(spark, d):
    return s.select_top1(*_inputs(spark, d)).select("as_of", "category", "id", "title", "published", "num_pages", "selection_reason")


def all_categories(spark, d):
    return s.select_all(s.top_candidates(*_inputs(spark, d), most=5), CATEGORIES)


def successive(spark, d):
    return s.backfill(*_inputs(spark, d), CATEGORIES)


_REPLAY = """with w as (select r.as_of, c.* from f_runs r join f_candidates c
 on c.published between cast(r.as_of as timestamp) + interval '23 hours 59 minutes 59 seconds' - interval 7 day and cast(r.as_of as timestamp) + interval '23 hours 59 minutes 59 seconds'),
u as (select r.as_of, id, max(coalesce(upvotes, 0)) as upvotes from f_runs r join f_upvotes v on v.snapshot_date between r.as_of - 7 and r.as_of group by 1, 2),
pool as (select w.* from w where num_pages <= 60 and id not in (select arxiv_id from f_published)),
a as (select p.*, u.upvotes, u.id is not null as matched from pool p left join u on u.as_of = p.as_of and u.id = p.id),
r as (select *, row_number() over (partition by as_of, category order by matched desc, upvotes desc nulls last, published desc, id) as rank,
 case when matched then concat('hf_daily_papers_upvotes=', upvotes) else 'fallback_most_recent' end as selection_reason from a)
"""
_VIEWS = ("runs", "candidates", "upvotes", "published")
_PICKS = "".join(
    f", p{k} as (select * from (select r.*, row_number() over (partition by as_of order by rank) as best from r where category = 'c{k}'"
    + "".join(f" and not exists (select 1 from p{j} where p{j}.as_of = r.as_of and p{j}.id = r.id)" for j in range(k))
    + ") where best = 1)"
    for k in range(5)
)

QUERIES = {
    "s1_canonical_id": canonical, "s2_collapse_ws": whitespace, "s3_candidate_urls": urls, "s4_in_window": window, "s5_as_of_instant": instant, "s6_replay_window": replay, "s7_upvotes_asof": votes,
    "s8_exclude_published": unpublished, "s8_sketched_exclude": sketched, "s9_attach_upvotes": attached, "s10_within_page_cap": capped, "c10_page_cap_gate": capped, "s11_rank_candidates": ranked, "s12_select_top1": top1, "s13_select_all": all_categories, "s14_backfill": successive,
}
ORACLES = {
    "s1_canonical_id": sql("select doc_id, regexp_replace(regexp_extract(regexp_extract(entry_xml, '<id>(.*?)</id>', 1), '[^/]*$'), 'v[0-9]+$', '') as id from f_feed", "feed"),
    "s2_collapse_ws": "select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as text from documents",
    "s3_candidate_urls": sql(
        """with x as (select doc_id, regexp_replace(regexp_extract(regexp_extract(entry_xml, '<id>(.*?)</id>', 1), '[^/]*$'), 'v[0-9]+$', '') as id, entry_xml from f_feed)
select doc_id, id, cast(replace(replace(regexp_extract(entry_xml, '<published>(.*?)</published>', 1), 'T', ' '), 'Z', '') as timestamp) as published, trim(regexp_replace(regexp_extract(entry_xml, '(?s)<title>(.*?)</title>', 1), '\\s+', ' ', 'g')) as title, concat('https://arxiv.org/abs/', id) as abs_url,
 coalesce(nullif(regexp_extract(entry_xml, 'title="pdf" href="(.*?)"', 1), ''), concat('https://arxiv.org/pdf/', id)) as pdf_url from x""",
        "feed",
    ),
    "s4_in_window": sql("select * from f_candidates where published between timestamp '1998-01-04 23:59:59' - interval 7 day and timestamp '1998-01-04 23:59:59'", "candidates"),
    "s5_as_of_instant": sql("select as_of, cast(as_of as timestamp) + interval '23 hours 59 minutes 59 seconds' as instant from f_runs", "runs"),
    "s6_replay_window": sql(_REPLAY + "select as_of, category, id, published from w", *_VIEWS),
    "s7_upvotes_asof": sql(_REPLAY + "select as_of, id, upvotes from u", *_VIEWS),
    "s8_exclude_published": sql("select * from f_candidates where id not in (select arxiv_id from f_published)", "candidates", "published"),
    "s9_attach_upvotes": sql(_REPLAY + "select w.as_of, w.category, w.id, u.upvotes, u.id is not null as matched from w left join u on u.as_of = w.as_of and u.id = w.id", *_VIEWS),
    "s10_within_page_cap": sql("select * from f_candidates where num_pages <= 60", "candidates"),
    "c10_page_cap_gate": sql("select * from f_candidates where num_pages <= 60", "candidates"),
    "s11_rank_candidates": sql(_REPLAY + "select as_of, category, id, upvotes, matched, rank from r where rank <= 5", *_VIEWS),
    "s12_select_top1": sql(_REPLAY + "select as_of, category, id, title, published, num_pages, selection_reason from r where rank = 1", *_VIEWS),
    "s14_backfill": sql(
        _REPLAY.rstrip() + """, w14 as (select as_of, row_number() over (order by as_of) - 1 as k from f_runs),
t14 as materialized (select w14.k * 5 + cast(substring(category, 2) as bigint) as step, r.* from r join w14 on w14.as_of = r.as_of where rank <= 10),
g14 as (select cast(-1 as bigint) as step, cast([] as varchar[]) as barred, cast(null as varchar) as pick
 union all select g.step + 1, any_value(case when t.id is null then g.barred else list_append(g.barred, t.id) end order by t.rank), any_value(t.id order by t.rank)
 from (select * from g14 where step < (select 5 * count(*) - 1 from f_runs)) g left join t14 t on t.step = g.step + 1 and not list_contains(g.barred, t.id) group by g.step)
select t.as_of, t.category, t.id, t.published, t.selection_reason from g14 g join t14 t on t.step = g.step and t.id = g.pick""",
        *_VIEWS, recursive=True,
    ),
    "s13_select_all": sql(_REPLAY.rstrip() + _PICKS + " select as_of, category, id, published, selection_reason from (" + " union all ".join(f"select * from p{k}" for k in range(5)) + ")", *_VIEWS),
}
ORACLES["s8_sketched_exclude"] = ORACLES["s8_exclude_published"]
