"""Queries of chunking and re-assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions.parallel import is_table
from paperloom.functions.strings import strip
from paperloom.operators import cascade
from paperloom.operators import chunking as k
from paperloom.plans.views import spark_view, sql, table

#: Small batches, so that the short test documents fill several.
MOST = 1000


def _texts(name, column):
    return lambda spark, d: spark_view(spark, d, "papers_md").select("doc_id", F.posexplode(column(F.col("md"))).alias("pos", "text")).select("doc_id", F.col("pos").cast("long").alias("pos"), "text")


def tables(spark, d):
    both = spark_view(spark, d, "tables").unionByName(spark_view(spark, d, "papers_md"))
    return both.select("doc_id", F.length("md").alias("chars"), is_table(F.col("md")).alias("is_table"))


def _with_table(spark, d):
    """Documents with a real table paragraph in front of and behind them."""
    md = F.concat(F.lit("| a | b |\n|---|---|\n| 1 | x |\n\n"), F.col("md"), F.lit("\n\n| a |\n|:-:|\n| 2 |"))
    return spark_view(spark, d, "papers_md").select("doc_id", md.alias("md"))


def chunked(spark, d):
    return k.chunk(_with_table(spark, d), MOST).select("doc_id", F.col("batch_index").cast("long").alias("batch_index"), F.col("item_index").cast("long").alias("item_index"), "text", "is_table")


def stats(spark, d):
    return k.batch_stats(k.chunk(_with_table(spark, d), MOST)).select("doc_id", F.col("batch_index").cast("long").alias("batch_index"), "items", "chars")


def _cells(spark, d):
    t = spark_view(spark, d, "tables").select("doc_id", F.lit(0).cast("long").alias("batch_index"), "md")
    return t, k.explode_cells(t)


def cells(spark, d):
    return _cells(spark, d)[1].select("doc_id", "batch_index", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), "cell", "is_work")


def assembled_tables(spark, d):
    t, c = _cells(spark, d)
    done = c.where("is_work").select("doc_id", "batch_index", "row", "col", F.lower("cell").alias("text"))
    return k.assemble_tables(t, c, done).select("doc_id", "md")


def inputs(spark, d):
    return spark_view(spark, d, "responses").select("doc_id", k.batch_input(F.col("items")).alias("input"))


def aligned(spark, d):
    a = k.align_response(spark_view(spark, d, "responses"))
    return a.select("doc_id", F.size("items").cast("long").alias("items_in"), F.size("parts").cast("long").alias("items_out"), "fail_reason")


def aligned_rows(spark, d):
    return k.aligned_items(k.align_response(spark_view(spark, d, "responses"))).select("doc_id", F.col("item_index").cast("long").alias("item_index"), "item", "part")


def halves(spark, d):
    failed = k.align_response(spark_view(spark, d, "responses")).where("fail_reason is not null").select("doc_id", F.lit("0").alias("path"), "items")
    return k.bisect(failed).select("doc_id", "path", F.size("items").cast("long").alias("n"), F.array_join("items", "\n").alias("text"), "error")


def documents(spark, d):
    batches = k.chunk(_with_table(spark, d), MOST).groupBy("doc_id", "batch_index").agg(F.array_sort(F.collect_list(F.struct("item_index", "text"))).alias("x"))
    return k.assemble_docs(batches.select("doc_id", "batch_index", F.array_join("x.text", "\n\n").alias("text"))).select("doc_id", strip(F.col("md")).alias("md"))


def node_answers(spark, d):
    """The rows of the view ``node_answers`` from one reading of the table: the view has a branch for each of fifteen nodes, and
    each branch reads and splits every text again."""
    level = F.array(F.struct(F.lit("0").alias("path"), F.lit(0).alias("start"), F.size("said").alias("n")))
    levels = [level]
    half = lambda x: F.floor(x["n"] / 2).cast("int")
    node = lambda x, side, start, n: F.struct(F.concat(x["path"], F.lit(side)).alias("path"), start.alias("start"), n.alias("n"))
    for _ in range(3):
        level = F.flatten(F.transform(F.filter(level, lambda x: x["n"] > 1), lambda x: F.array(node(x, ".L", x["start"], half(x)), node(x, ".R", x["start"] + half(x), x["n"] - half(x)))))
        levels.append(level)
    said = table(spark, d, "documents").select("doc_id", F.transform(F.split("text", "\n", -1), lambda x: F.concat(F.lit("t:"), x)).alias("said"))
    nodes = said.select("doc_id", "said", F.explode(F.concat(*levels)).alias("x")).select("doc_id", "said", "x.path", "x.start", "x.n").where("(doc_id * 7 + start + n) % 23 > 0")
    lost = F.when((F.col("n") > 1) & ((F.col("doc_id") + F.col("n")) % 3 < 2) & (F.length("path") < 6), 1).otherwise(0)
    response = F.array_join(F.slice("said", F.col("start") + 1 + lost, F.col("n") - lost), f"\n\n{k.DELIMITER}\n\n")
    reason = F.when((F.col("doc_id") + F.col("start")) % 19 == 0, "length").otherwise("stop")
    return nodes.select("doc_id", F.lit(0).alias("batch_index"), "path", F.lit(1).alias("attempt"), response.alias("response"), reason.alias("finish_reason"))


def _tree(spark, d):
    batches, answers = spark_view(spark, d, "item_batches"), node_answers(spark, d)
    return batches, answers, cascade.cascade(batches, answers)


def nodes(spark, d):
    return _tree(spark, d)[2].select("doc_id", "path", F.col("start").cast("long").alias("start"), F.col("n").cast("long").alias("n"), "state")


def waiting(spark, d):
    batches, _, reached = _tree(spark, d)
    return cascade.cascade_work(batches, reached).select("doc_id", "path", "input")


def documents_of_halves(spark, d):
    """Documents that the cascade brings back whole, in order, from answers at up to four depths."""
    batches, answers, reached = _tree(spark, d)
    items = cascade.cascade_items(batches, answers, reached)
    return cascade.reassemble(batches, items.select("doc_id", "batch_index", "item_index", F.col("response").alias("text")))


QUERIES = {
    "k10_cascade": nodes, "k10_cascade_work": waiting, "k11_cascade_docs": documents_of_halves,
    "k1_paragraphs": _texts("k1", k.paragraphs), "k2_merge_fences": _texts("k2", k.fenced_paragraphs), "k3_is_table": tables, "k4_chunk": chunked, "k5_batch_stats": stats, "k6_explode_cells": cells,
    "k7_assemble_tables": assembled_tables, "k8_batch_input": inputs, "k9_align_response": aligned, "k9_aligned_items": aligned_rows, "k10_bisect": halves, "k11_assemble_docs": documents,
}

_PARAS = r"""p as (select doc_id, unnest(ps) as text, generate_subscripts(ps, 1) as n from (select doc_id, list_filter(string_split(md, chr(10)||chr(10)), lambda x: regexp_matches(x, '\S')) as ps from {0})),
par as (select *, sum((length(text) - length(replace(text, '```', ''))) // 3 % 2) over (partition by doc_id order by n) as odd from p),
isl as (select *, coalesce(sum(case when odd % 2 = 0 then 1 else 0 end) over (partition by doc_id order by n rows between unbounded preceding and 1 preceding), 0) as island from par),
mer as (select doc_id, cast(island as bigint) as pos, string_agg(text, chr(10) || chr(10) order by n) as text from isl group by 1, 2)"""
_TABLE = r"""(len(list_filter(string_split({0}, chr(10)), lambda x: regexp_matches(x, '\S'))) >= 2 and len(list_filter(string_split({0}, chr(10)), lambda x: regexp_matches(x, '\S') and not regexp_matches(x, '(?s)^\s*\|.*\|\s*$'))) = 0
 and regexp_matches(list_filter(string_split({0}, chr(10)), lambda x: regexp_matches(x, '\S'))[2], '^\s*\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?\s*$'))"""
_WITH = "t as (select doc_id, '| a | b |'||chr(10)||'|---|---|'||chr(10)||'| 1 | x |'||chr(10)||chr(10)||md||chr(10)||chr(10)||'| a |'||chr(10)||'|:-:|'||chr(10)||'| 2 |' as md from f_papers_md)"
_CHUNK = f"""with {_WITH}, {_PARAS.format('t')},
m as (select *, {_TABLE.format('text')} as alone, length(text) + 7 as cost from mer),
walk as (select doc_id, pos, cast(0 as bigint) as batch_index, case when alone then -1 else cost end as used from m where pos = 0
 union all select m.doc_id, m.pos, case when m.alone or w.used < 0 or w.used + m.cost > {MOST} then w.batch_index + 1 else w.batch_index end, case when m.alone then -1 when w.used < 0 or w.used + m.cost > {MOST} then m.cost else w.used + m.cost end
 from walk w join m on m.doc_id = w.doc_id and m.pos = w.pos + 1),
items as (select w.doc_id, batch_index, row_number() over (partition by w.doc_id, batch_index order by w.pos) - 1 as item_index, m.text, m.alone as is_table from walk w join m on m.doc_id = w.doc_id and m.pos = w.pos)
"""
_CELLS = r"""with li as (select doc_id, list_filter(string_split(md, chr(10)), lambda x: regexp_matches(x, '\S')) as ls from f_tables),
ro as (select doc_id, unnest(list_concat(ls[1:1], ls[3:])) as line, generate_subscripts(list_concat(ls[1:1], ls[3:]), 1) - 1 as row from li),
ce as (select doc_id, row, list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(line, '^\s+|\s+$', '', 'g'), '^\|', ''), '\|$', ''), '|'), lambda x: trim(x)) as cs from ro),
cl as (select doc_id, cast(0 as bigint) as batch_index, row, unnest(cs) as cell, generate_subscripts(cs, 1) - 1 as col from ce)
"""
ALIGN = """with a as (select doc_id, items, finish_reason, case when len(items) = 1 then [response] else list_filter(list_transform(string_split(response, '<<<P>>>'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') end as parts from f_responses),
b as (select *, case when finish_reason = 'length' then 'length_truncated' when len(parts) <> len(items) then 'item_count_mismatch' end as fail_reason from a)
"""
_TREE = """with a as (select doc_id, path, response, finish_reason, list_filter(list_transform(string_split(response, '<<<P>>>'), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') as parts from f_node_answers),
tree as (select b.doc_id, '0' as path, 0 as start, len(items) as n from f_item_batches b
 union all select t.doc_id, concat(t.path, s.side), case when s.side = '.L' then t.start else t.start + t.n // 2 end, case when s.side = '.L' then t.n // 2 else t.n - t.n // 2 end
 from tree t join a on a.doc_id = t.doc_id and a.path = t.path, (values ('.L'), ('.R')) s(side) where t.n > 1 and (a.finish_reason = 'length' or len(a.parts) <> t.n)),
st as (select t.doc_id, t.path, t.start, t.n, a.response, a.parts, case when a.path is null then 'asked' when t.n = 1 and a.finish_reason = 'length' then 'error' when t.n > 1 and (a.finish_reason = 'length' or len(a.parts) <> t.n) then 'split' else 'fits' end as state
 from tree t left join a on a.doc_id = t.doc_id and a.path = t.path)
"""
ORACLES = {
    "k10_cascade": sql(_TREE + "select doc_id, path, cast(start as bigint) as start, cast(n as bigint) as n, state from st", "node_answers", "item_batches", recursive=True),
    "k10_cascade_work": sql(_TREE + "select st.doc_id, path, array_to_string(items[start + 1:start + n], chr(10)||chr(10)||'<<<P>>>'||chr(10)||chr(10)) as input from st join f_item_batches b on b.doc_id = st.doc_id where state = 'asked'", "node_answers", "item_batches", recursive=True),
    "k11_cascade_docs": sql(
        _TREE + """, it as (select doc_id, start + generate_subscripts(ps, 1) as k, unnest(ps) as text from (select doc_id, start, case when n = 1 then [response] else parts end as ps from st where state = 'fits')),
ok as (select b.doc_id from f_item_batches b join it on it.doc_id = b.doc_id group by b.doc_id, len(b.items) having count(*) = len(b.items))
select doc_id, string_agg(text, chr(10)||chr(10) order by k) as md from it where doc_id in (select doc_id from ok) group by 1""",
        "node_answers", "item_batches", recursive=True,
    ),
    "k1_paragraphs": sql(f"with {_PARAS.format('f_papers_md')} select doc_id, n - 1 as pos, text from p", "papers_md"),
    "k2_merge_fences": sql(f"with {_PARAS.format('f_papers_md')} select doc_id, pos, text from mer", "papers_md"),
    "k3_is_table": sql(f"select doc_id, length(md) as chars, {_TABLE.format('md')} as is_table from (select doc_id, md from f_tables union all select doc_id, md from f_papers_md)", "tables", "papers_md"),
    "k4_chunk": sql(_CHUNK + "select * from items", "papers_md", recursive=True),
    "k5_batch_stats": sql(_CHUNK + "select doc_id, batch_index, count(*) as items, cast(sum(length(text)) as bigint) as chars from items group by 1, 2", "papers_md", recursive=True),
    "k6_explode_cells": sql(_CELLS + "select doc_id, batch_index, row, col, cell, regexp_matches(cell, '[a-zA-Z가-힣]') as is_work from cl", "tables"),
    "k7_assemble_tables": sql(
        _CELLS + """, ln as (select doc_id, row, '| '||string_agg(case when regexp_matches(cell, '[a-zA-Z가-힣]') then lower(cell) else cell end, ' | ' order by col)||' |' as line from cl group by 1, 2)
select ln.doc_id, string_agg(case when row = 0 then line||chr(10)||ls[2] else line end, chr(10) order by row) as md from ln join li on li.doc_id = ln.doc_id group by 1""",
        "tables",
    ),
    "k8_batch_input": sql("select doc_id, array_to_string(items, chr(10)||chr(10)||'<<<P>>>'||chr(10)||chr(10)) as input from f_responses", "responses"),
    "k9_align_response": sql(ALIGN + "select doc_id, len(items) as items_in, len(parts) as items_out, fail_reason from b", "responses"),
    "k9_aligned_items": sql(ALIGN + "select doc_id, generate_subscripts(items, 1) - 1 as item_index, unnest(items) as item, unnest(parts) as part from b where fail_reason is null", "responses"),
    "k10_bisect": sql(
        ALIGN + """, h as (select doc_id, items, len(items) as n from b where fail_reason is not null)
select doc_id, '0.L' as path, n // 2 as n, array_to_string(items[1:n // 2], chr(10)) as text, cast(null as varchar) as error from h where n > 1
union all select doc_id, '0.R', n - n // 2, array_to_string(items[n // 2 + 1:], chr(10)), null from h where n > 1
union all select doc_id, '0', n, array_to_string(items, chr(10)), 'single_item_truncated' from h where n = 1""",
        "responses",
    ),
    "k11_assemble_docs": sql(
        f"""with {_WITH}, {_PARAS.format('t')} select doc_id, regexp_replace(string_agg(case when b then regexp_replace(text, '^\\s+|\\s+$', '', 'g') else text end, chr(10)||chr(10) order by pos), '^\\s+|\\s+$', '', 'g') as md
 from (select *, false as b from mer) group by 1""",
        "papers_md",
    ),
}
