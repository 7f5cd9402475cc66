"""Queries of pages, editions, messages, readers, writers and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import strings as t
from paperloom.operators import archive as a
from paperloom.operators import runlog
from paperloom.plans.views import spark_view, sql, table
from paperloom.sources import page_files, readers, writers
from paperloom.sources.tables import scratch
from paperloom.streaming import jobs

SITE = "https://example.org/site/"


def day():
    return F.date_add(F.col("base_date"), F.col("edition").cast("int") % 20)


def _archive(spark, d) -> DataFrame:
    return spark_view(spark, d, "archive").withColumn("translated", day())


def _papers(spark, d) -> DataFrame:
    """Archive rows with the columns that a page is built from."""
    x = spark_view(spark, d, "archive")
    return x.select(
        F.col("arxiv_id").alias("id"), "category", "title", F.concat(F.lit("https://example.org/abs/"), F.col("arxiv_id")).alias("abs_url"), F.concat(F.lit("https://example.org/pdf/"), F.col("arxiv_id")).alias("pdf_url"),
        F.concat(F.col("base_date").cast("string"), F.lit("T00:00:00+00:00")).alias("published"), day().alias("translated"), F.concat(F.lit("hf_daily_papers_upvotes="), F.col("edition").cast("string")).alias("selection_reason"),
        F.when(F.col("edition") % 2 == 0, F.concat(F.lit("# **T** "), F.col("title"), F.lit(" ## Abstract\n"), F.col("body"))).otherwise(F.col("body")).alias("body"), "edition",
    )


def slugs(spark, d):
    return spark_view(spark, d, "archive").select("edition", t.slugify(F.col("title")).alias("slug"))


def nav_titles(spark, d):
    return spark_view(spark, d, "archive").select("edition", t.truncate_title(F.col("title")).alias("nav_title"))


def titles(spark, d):
    both = spark_view(spark, d, "images").select("doc_id", "md").unionByName(_papers(spark, d).select(F.col("edition").alias("doc_id"), F.col("body").alias("md")))
    return both.select("doc_id", a.translated_title(F.col("md"), F.lit("fallback")).alias("title"))


def _images(spark, d):
    stem = F.concat(F.lit("page-"), F.col("doc_id").cast("string"))
    return spark_view(spark, d, "images").withColumn("stem", stem), spark_view(spark, d, "image_inventory")


def image_refs(spark, d):
    return a.image_refs(_images(spark, d)[0])


def image_texts(spark, d):
    return a.rewrite_images(*_images(spark, d))


def images(spark, d):
    return a.image_manifest(*_images(spark, d))


def folders(spark, d):
    codes = spark_view(spark, d, "archive").select("category").unionByName(spark_view(spark, d, "archive").select(F.when(F.col("edition") % 2 == 0, "cs.CL").otherwise("cs.RO").alias("category")))
    return codes.distinct().select("category", t.category_dir(F.col("category")).alias("dir"))


def pages(spark, d):
    return a.build_page(_papers(spark, d)).select("edition", "page")


def paths(spark, d):
    return _papers(spark, d).select("edition", a.page_path(F.col("translated"), F.col("category"), F.col("id"), F.col("title")).alias("page_path"))


def _halves(spark, d):
    x = _archive(spark, d).select("arxiv_id", "category", "title", "translated", "edition")
    return x.where("edition % 3 = 0"), x.where("edition % 3 <> 0")


def editions(spark, d):
    return a.upsert_archive(*_halves(spark, d))


def stamped(spark, d):
    return a.stamp(spark_view(spark, d, "archive").select("arxiv_id", "edition", "base_date"), day()).drop("base_date")


def urls(spark, d):
    x = _papers(spark, d)
    dated = F.when(F.col("edition") % 5 > 0, F.col("translated"))
    return x.select("edition", t.page_url(SITE, dated, F.col("category"), F.col("id"), F.col("title")).alias("url"))


def digests(spark, d):
    x = _papers(spark, d)
    warned = F.when(F.col("translated") >= F.lit("2026-01-10").cast("date"), F.lit("late"))
    return a.digest(x.select(F.col("translated").alias("week"), "category", "id", "title", F.col("translated").alias("published_date"), warned.alias("warning")), SITE)


def stale(spark, d):
    """Markers from the event times, some missing, at a fixed time of asking."""
    x = table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 > 0, F.col("ts").cast("timestamp")).alias("generated_at"))
    return a.staleness(x, F.lit("2024-01-20 12:30:00").cast("timestamp")).select("event_id", "warning")


def atom(spark, d):
    x = readers.parse_atom(spark_view(spark, d, "feed"), "entry_xml", ("doc_id",))
    return x.select("doc_id", "id", "title", F.col("published").cast("timestamp_ntz").alias("published"), "abs_url", "pdf_url")


def snapshots(spark, d):
    return readers.explode_snapshots(spark_view(spark, d, "snapshots"))


def _page_files(spark, d) -> DataFrame:
    """The archive's pages, written as Parquet and read again."""
    out = scratch(spark, "pages")
    x = a.build_page(_papers(spark, d)).withColumn("page_path", a.page_path(F.col("translated"), F.col("category"), F.col("id"), F.col("title")))
    writers.write_pages(x.select("category", "page_path", "page"), out)
    return spark.read.parquet(out)


def published(spark, d):
    return readers.published_ids(_page_files(spark, d))


def front(spark, d):
    return readers.front_matter(_page_files(spark, d).select(F.col("page_path").alias("path"), "page")).select(*readers.FRONT_KEYS, F.length("body").cast("long").alias("body_chars"))


def _log_file(spark, d) -> str:
    out = scratch(spark, "log")
    x = spark_view(spark, d, "calls")
    x.select(F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("ts"), "run_id", "call_kind", "input", "raw_response", "finish_reason", "model", "prompt_hash", "temperature", "cache_hit", "validation_fail_reason").write.json(out)
    return out


def logged(spark, d):
    calls, summaries = readers.read_call_log(spark, _log_file(spark, d))
    keep = ["run_id", "call_kind", "input", "validation_fail_reason"]
    both = calls.select(*keep).unionByName(summaries.select(*keep[:2], F.lit(None).cast("string").alias("input"), F.lit(None).cast("string").alias("validation_fail_reason")))
    return both.groupBy(*keep).agg(F.count(F.lit(1)).alias("n"))


def selections(spark, d):
    from paperloom.plans.q_selection import top1

    out = scratch(spark, "selection")
    writers.write_selection(top1(spark, d), out)
    return spark.read.json(out).groupBy("category_name").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))


def stored_pages(spark, d):
    return _page_files(spark, d).groupBy("category_dir").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("page")).cast("long").alias("chars"))


def stored_cache(spark, d):
    out = scratch(spark, "cache")
    writers.write_cache(runlog.seed_from_log(spark_view(spark, d, "calls")), out)
    return readers.read_cache(spark, out)


def _drained(query) -> None:
    query.awaitTermination()
    if query.exception():
        raise query.exception()


def counters(spark, d):
    """Counters over the log as a stream of files, drained; the sink keeps each key's last count."""
    source, out, name = scratch(spark, "calls"), scratch(spark, "counts"), f"counters_{uuid.uuid4().hex}"
    spark_view(spark, d, "calls").select("run_id", "call_kind", "cache_hit", "validation_fail_reason").repartition(3).write.parquet(source)
    stream = jobs.live_counters(jobs.read_stream(spark, spark.read.parquet(source).schema, source))

    def keep(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(f"{out}/epoch={epoch}")

    _drained(stream.writeStream.outputMode("update").foreachBatch(keep).queryName(name).option("checkpointLocation", scratch(spark, "state")).trigger(availableNow=True).start())
    rows = spark.read.parquet(f"{out}/*")
    return rows.groupBy("run_id", "validation_fail_reason").agg(F.max_by(F.struct("calls", "hits"), "epoch").alias("x")).select("run_id", "validation_fail_reason", "x.calls", "x.hits")


def daily_counters(spark, d):
    """Counters per day over the log as files in no order of time, drained: each file has rows of all days."""
    source, root = scratch(spark, "calls"), scratch(spark, "days")
    calls = spark_view(spark, d, "calls").select(F.col("ts").cast("timestamp").alias("ts"), "run_id", "call_kind", "cache_hit", "validation_fail_reason")
    calls.repartition(3).write.parquet(source)
    query = jobs.daily_counters(jobs.read_stream(spark, spark.read.parquet(source).schema, source), root, scratch(spark, "state"), fold=2)
    _drained(query)
    return jobs.read_daily(spark, root, query.lastProgress["batchId"], fold=2)


def feed_files(spark, d):
    """The feed's entries as XML files of some 200 entries, as the feed comes in pages; read again."""
    out = scratch(spark, "feed")
    pages = spark_view(spark, d, "feed").groupBy(F.expr("doc_id div 200").alias("page")).agg(F.concat_ws("", F.collect_list("entry_xml")).alias("entries"))
    pages.select("page", F.concat(F.lit("<feed>"), "entries", F.lit("</feed>")).alias("value")).write.partitionBy("page").text(out)
    return readers.read_atom(spark, out).select("id", "title", F.col("published").cast("timestamp_ntz").alias("published"), "abs_url", "pdf_url")


def snapshot_files(spark, d):
    """Snapshots in one JSON file for each date, told by the folder and file names that Spark gives them."""
    out = scratch(spark, "snapshots")
    spark_view(spark, d, "snapshots").withColumn("day", F.col("snapshot_date").cast("string")).select("day", F.col("payload").alias("value")).write.partitionBy("day").text(out)
    return readers.read_upvotes(spark, out)


def exact_page_files(spark, d):
    """Pages under their exact names: what was written, and the ids that a scan of the folder finds."""
    root = scratch(spark, "site")
    x = a.build_page(_papers(spark, d)).withColumn("page_path", a.page_path(F.col("translated"), F.col("category"), F.col("id"), F.col("title")))
    last = x.groupBy("page_path").agg(F.max("edition").alias("edition"))  # one page for each name
    sizes = writers.write_page_files(x.join(last, ["page_path", "edition"], "left_semi"), root.removeprefix("file:"))
    sizes.write.parquet(f"{root}-sizes")
    read = page_files.scan_pages(spark, root.removeprefix("file:")).select("page_path", readers.published_id(F.col("page")).alias("arxiv_id"))
    return spark.read.parquet(f"{root}-sizes").join(read, "page_path")


def committed_page_files(spark, d):
    """Pages under their exact names through the committing sink, as a scan of the folder finds them."""
    root = scratch(spark, "site")
    x = a.build_page(_papers(spark, d)).withColumn("page_path", a.page_path(F.col("translated"), F.col("category"), F.col("id"), F.col("title")))
    last = x.groupBy("page_path").agg(F.max("edition").alias("edition"))
    page_files.write_committed(x.join(last, ["page_path", "edition"], "left_semi"), root.removeprefix("file:"))
    read = page_files.scan_pages(spark, root.removeprefix("file:"))
    return read.select("page_path", readers.published_id(F.col("page")).alias("arxiv_id"), F.octet_length("page").cast("long").alias("bytes"))


def upkeep(spark, d):
    """The archive kept up from a stream of page files; the last version."""
    source, out = scratch(spark, "new-pages"), scratch(spark, "versions")
    existing, new = _halves(spark, d)
    existing.unionByName(new).repartition(3).write.parquet(source)
    stream = jobs.read_stream(spark, spark.read.parquet(source).schema, source)
    query = jobs.upkeep(stream, out, scratch(spark, "state"), parts=4)
    _drained(query)
    return jobs.read_archive(spark, out, query.lastProgress["batchId"])


QUERIES = {
    "p1_slugify": slugs, "p2_truncate_title": nav_titles, "p3_translated_title": titles, "p4_image_refs": image_refs, "p4_rewrite_images": image_texts, "p5_image_manifest": images, "p6_category_dir": folders, "p7_build_page": pages,
    "p8_page_path": paths, "p9_upsert_archive": editions, "p10_stamp": stamped, "n1_page_url": urls, "n2_digest": digests, "n3_staleness": stale, "io1_atom": atom, "io2_upvotes": snapshots, "io3_published_ids": published,
    "io4_front_matter": front, "io5_call_log": logged, "io6_selection": selections, "io7_pages": stored_pages, "io8_cache": stored_cache, "t1_live_counters": counters, "t2_archive_upkeep": upkeep, "t1_daily_counters": daily_counters,
    "io1_atom_files": feed_files, "io2_upvote_files": snapshot_files, "io7_page_files": exact_page_files,
    "io7_committed_pages": committed_page_files,
}

_SLUG = "rtrim(substring(lower(trim(regexp_replace(title, '[^a-zA-Z0-9]+', '-', 'g'), '-')), 1, 60), '-')"
_DIR = "case category when 'cs.CL' then 'nlp' when 'cs.CV' then 'vision' when 'cs.LG' then 'ml' when 'cs.AI' then 'ai' when 'cs.RO' then 'robotics' else replace(category, '.', '_') end"
_NAV = "case when length({0}) > 40 then rtrim(substring({0}, 1, 40)) || '…' else {0} end"
_HEAD = r"regexp_extract(split_part({0}, chr(10), 1), '^\s*#\s+(?:<span[^>]*></span>\s*)?(.*)$', 1)"
_TITLE = r"coalesce(nullif(trim(replace(regexp_replace(trim(" + _HEAD + r"), '\s#{{2,6}}\s.*$', ''), '**', '')), ''), {1})"
_PAPERS = f"""with pa as (select arxiv_id as id, category, title, concat('https://example.org/abs/', arxiv_id) as abs_url, concat('https://example.org/pdf/', arxiv_id) as pdf_url, concat(base_date, 'T00:00:00+00:00') as published,
 base_date + cast(edition % 20 as integer) as translated, concat('hf_daily_papers_upvotes=', edition) as selection_reason, case when edition % 2 = 0 then concat('# **T** ', title, ' ## Abstract', chr(10), body) else body end as body, edition from f_archive),
pt as (select *, {_SLUG} as slug, {_DIR} as dir, {_TITLE.format('body', 'title')} as t from pa),
pg as (select *, concat('---', chr(10), 'title: "', {_NAV.format('t')}, '"', chr(10), 'arxiv_id: ', id, chr(10), 'category: ', category, chr(10), 'published: ', published, chr(10), 'translated: ', translated, chr(10), 'selection_reason: "', selection_reason, '"', chr(10),
 '---', chr(10), chr(10), '# ', t, chr(10), chr(10), '- 원제: ', title, chr(10), '- 원문: [', abs_url, '](', abs_url, ')', chr(10), '- PDF: [', pdf_url, '](', pdf_url, ')', chr(10), '- arXiv ID: `', id, '`', chr(10), chr(10), '---', chr(10), chr(10), body) as page from pt)
"""
_IMG = r"!\[([^\]]*)\]\(([^)\s]+)\)"
_REFS = f"""with re as (select distinct doc_id, unnest(regexp_extract_all(md, '{_IMG}', 2)) as file from f_images),
ok as (select * from re where not contains(file, '/') and regexp_matches(lower(file), '[^.]\\.(jpeg|jpg|png|gif|webp|svg)$')),
mf as (select ok.* from ok join f_image_inventory i on i.doc_id = ok.doc_id and i.file = ok.file)
"""
_EDITIONS = f"""with e as (select arxiv_id, category, title, base_date + cast(edition % 20 as integer) as translated, edition, {_DIR} as category_dir from f_archive),
b as (select *, row_number() over (partition by category_dir, arxiv_id order by translated desc, edition desc) as n from e) select category_dir, arxiv_id, category, title, translated, edition from b where n = 1"""
_URL = "case when day is null then 'https://example.org/site' else concat('https://example.org/site/', dir, '/', day, '-', id, '-', slug, '/') end"
ORACLES = {
    "p1_slugify": sql(f"select edition, {_SLUG} as slug from f_archive", "archive"),
    "p2_truncate_title": sql(f"select edition, {_NAV.format('title')} as nav_title from f_archive", "archive"),
    "p3_translated_title": sql(_PAPERS + f"select doc_id, {_TITLE.format('md', chr(39) + 'fallback' + chr(39))} as title from (select doc_id, md from f_images union all select edition, body from pa)", "archive", "images"),
    "p4_image_refs": sql(_REFS + "select * from ok", "images", "image_inventory"),
    "p4_rewrite_images": sql(
        _REFS + f""", fl as (select doc_id, list(file) as files from mf group by 1), sp as (select m.doc_id, string_split_regex(md, '{_IMG}') as g, regexp_extract_all(md, '{_IMG}', 1) as al, regexp_extract_all(md, '{_IMG}', 2) as fi, coalesce(files, []) as files from f_images m left join fl on fl.doc_id = m.doc_id)
select doc_id, concat('page-', doc_id) as stem, array_to_string(list_transform(g, lambda x, i: x || case when i > len(fi) then '' else '![' || al[i] || '](' || case when list_contains(files, fi[i]) then concat('page-', doc_id, '/') else '' end || fi[i] || ')' end), '') as md from sp""",
        "images", "image_inventory",
    ),
    "p5_image_manifest": sql(_REFS + "select * from mf", "images", "image_inventory"),
    "p6_category_dir": sql(f"select category, {_DIR} as dir from (select category from f_archive union select case when edition % 2 = 0 then 'cs.CL' else 'cs.RO' end from f_archive)", "archive"),
    "p7_build_page": sql(_PAPERS + "select edition, page from pg", "archive"),
    "p8_page_path": sql(_PAPERS + "select edition, concat(dir, '/', translated, '-', id, '-', slug, '.md') as page_path from pt", "archive"),
    "p9_upsert_archive": sql(_EDITIONS, "archive"),
    "p10_stamp": sql("select arxiv_id, edition, base_date + cast(edition % 20 as integer) as published_date from f_archive", "archive"),
    "n1_page_url": sql(_PAPERS + f"select edition, {_URL} as url from (select *, case when edition % 5 > 0 then translated end as day from pt)", "archive"),
    "n2_digest": sql(
        _PAPERS + f""", li as (select translated as week, case category when 'cs.CL' then 1 when 'cs.CV' then 2 when 'cs.LG' then 3 when 'cs.AI' then 4 when 'cs.RO' then 5 else 6 end as rank, category, id, title,
 concat('- [', category, '] ', title, ' — ', {_URL}, ' (arXiv: ', id, ')') as line from (select *, translated as day from pt)),
co as (select week, concat('@everyone', case when week >= date '2026-01-10' then chr(10) || 'late' else '' end, chr(10), '**이번 주 번역된 논문 ', count(*), '편**', chr(10), string_agg(line, chr(10) order by rank, category, id, line)) as content from li group by 1)
select week, content, concat('{{"content":', to_json(content), ',"allowed_mentions":{{"parse":["everyone"]}},"flags":4}}') as payload from co""",
        "archive",
    ),
    "n3_staleness": f"""with s as (select event_id, case when event_id % 7 > 0 then ts end as g from events), a as (select *, epoch(timestamp '2024-01-20 12:30:00') - floor(epoch(g)) as sec from s)
select event_id, case when g is null then '{a.NO_MARKER}' when sec > 48 * 3600 then concat('{a.OLD_MARKER[0]}', cast(floor(sec / 86400) as bigint), '{a.OLD_MARKER[1]}', cast(floor((sec % 86400) / 3600) as bigint), '{a.OLD_MARKER[2]}') end as warning from a""",
    "io1_atom": """with x as (select doc_id, concat('2608.', lpad(cast(doc_id as varchar), 5, '0')) as id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as title, timestamp '2026-08-01 06:24:36' + to_days(cast(doc_id % 7 as integer)) as published from documents)
select doc_id, id, title, published, concat('https://arxiv.org/abs/', id) as abs_url, case when doc_id % 4 = 0 then concat('https://arxiv.org/pdf/', id) else 'http://example.org/pdf/x' end as pdf_url from x""",
    "io1_atom_files": """with x as (select doc_id, concat('2608.', lpad(cast(doc_id as varchar), 5, '0')) as id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as title, timestamp '2026-08-01 06:24:36' + to_days(cast(doc_id % 7 as integer)) as published from documents)
select id, title, published, concat('https://arxiv.org/abs/', id) as abs_url, case when doc_id % 4 = 0 then concat('https://arxiv.org/pdf/', id) else 'http://example.org/pdf/x' end as pdf_url from x""",
    "io2_upvote_files": "select cast(ts as date) as snapshot_date, concat('p', user_id) as id, case when event_type = 'error' then 0 else cast(floor(value) as bigint) end as upvotes from events",
    "io7_page_files": sql(_PAPERS + ", pf as (select concat(dir, '/', translated, '-', id, '-', slug, '.md') as page_path, id as arxiv_id, page, edition from pg) select page_path, arxiv_id, cast(octet_length(encode(arg_max(page, edition))) as bigint) as bytes from pf group by 1, 2", "archive"),
    "t1_daily_counters": sql("select cast(ts as date) as day, run_id, validation_fail_reason, count(*) as calls, count(*) filter (cache_hit) as hits from f_calls where call_kind <> 'summary' group by 1, 2, 3", "calls"),
    "io2_upvotes": "select cast(ts as date) as snapshot_date, concat('p', user_id) as id, case when event_type = 'error' then 0 else cast(floor(value) as bigint) end as upvotes from events",
    "io3_published_ids": sql("select distinct arxiv_id from f_archive", "archive"),
    "io4_front_matter": sql(
        _PAPERS + f"select {_NAV.format('t')} as title, id as arxiv_id, category, published, cast(translated as varchar) as translated, selection_reason, length(page) - strpos(page, chr(10) || '---' || chr(10) || chr(10)) - 5 as body_chars from pg", "archive"
    ),
    "io5_call_log": sql(
        "select run_id, call_kind, case when call_kind <> 'summary' then input end as input, case when call_kind <> 'summary' then validation_fail_reason end as validation_fail_reason, count(*) as n from f_calls group by 1, 2, 3, 4", "calls"
    ),
    "io7_pages": sql(_PAPERS + "select dir as category_dir, count(*) as pages, cast(sum(length(page)) as bigint) as chars from pg group by 1", "archive"),
    "t1_live_counters": sql("select run_id, validation_fail_reason, count(*) as calls, count(*) filter (cache_hit) as hits from f_calls where call_kind <> 'summary' group by 1, 2", "calls"),
    "t2_archive_upkeep": sql(_EDITIONS, "archive"),
}


def _late_oracles() -> None:
    from paperloom.plans import q_runlog, q_selection

    ORACLES["io8_cache"] = q_runlog.ORACLES["l7_seed_from_log"]
    ORACLES["io6_selection"] = q_selection.ORACLES["s12_select_top1"].replace(
        "select as_of, category, id, title, published, num_pages, selection_reason from r where rank = 1", "select category as category_name, count(*) as n, count(distinct id) as ids from r where rank = 1 group by 1"
    )


_late_oracles()
ORACLES["io7_committed_pages"] = ORACLES["io7_page_files"]
