"""Inputs of the registered queries: views over the given tables, once for Spark and once for DuckDB.

``:name`` stands for a table. ``spark_view`` reads it by the folder's path, ``sql`` puts the views in front of a query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_TABLE = re.compile(r":(region|nation|customer|supplier|part|orders|lineitem|events|documents|embeddings|pages|benchmark|labels|conversations)\b")

#: Answers logged for the nodes of each document's tree of lines, three halvings deep; some nodes have none. ``{cut}`` takes
#: ``{count}`` items from a place counted from 1.
_TREE = """with t0 as (select doc_id, '0' as path, 0 as start, {size} as n, {lines} as items from :documents),
t1 as (select doc_id, concat(path, '.L') as path, start, n {div} 2 as n, items from t0 where n > 1 union all select doc_id, concat(path, '.R'), start + n {div} 2, n - n {div} 2, items from t0 where n > 1),
t2 as (select doc_id, concat(path, '.L') as path, start, n {div} 2 as n, items from t1 where n > 1 union all select doc_id, concat(path, '.R'), start + n {div} 2, n - n {div} 2, items from t1 where n > 1),
t3 as (select doc_id, concat(path, '.L') as path, start, n {div} 2 as n, items from t2 where n > 1 union all select doc_id, concat(path, '.R'), start + n {div} 2, n - n {div} 2, items from t2 where n > 1)
select doc_id, 0 as batch_index, path, 1 as attempt, {join} as response, case when (doc_id + start) % 19 = 0 then 'length' else 'stop' end as finish_reason
 from (select * from t0 union all select * from t1 union all select * from t2 union all select * from t3) t where (doc_id * 7 + start + n) % 23 > 0"""
#: A part of the items is missing in some answers: the first one, where there are several.
_LOST = "case when n > 1 and (doc_id + n) % 3 < 2 and length(path) < 6 then 1 else 0 end"

BOTH = {
    "candidates": """select distinct concat('c', cast(l_suppkey % 5 as varchar(9))) as category, cast(o_orderkey as varchar(19)) as id,
 concat('Paper ', cast(o_orderkey as varchar(19)), ' on ', o_orderpriority) as title, o_orderdate as published,
 cast((o_orderkey * 37) % 83 + 1 as int) as num_pages from :lineitem join :orders on l_orderkey = o_orderkey""",
    "published": "select cast(o_orderkey as varchar(19)) as arxiv_id from :orders where o_orderkey % 11 = 0",
    "pairs": """select conv_id, turn, source, case when (conv_id+turn)%3=0 then source when (conv_id+turn)%7=0 then concat('I''m sorry, but I can’t do that. ', source)
 when (conv_id+turn)%5=0 then concat(translate(source,'aeiou','가나다라마'),' $x$') else translate(source,'aeiou','가나다라마') end as response
 from (select conv_id, turn, role, text as source, lead(text) over (partition by conv_id order by turn) as nxt from :conversations) t where role='user' and nxt is not null""",
    "calls": """select event_id as seq, ts, concat('r', cast(user_id as varchar(9))) as run_id,
 case when event_type='signup' then 'summary' when event_type in ('click','view') then 'single' else 'batch' end as call_kind,
 concat('in', cast(user_id % 50 as varchar(9)), props) as input, concat('out', cast(event_id as varchar(9))) as raw_response, 'stop' as finish_reason,
 'm1' as model, 'abcdef012345' as prompt_hash, '0.1' as temperature, event_id % 4 = 0 as cache_hit,
 case when event_type='error' then 'untranslated' when event_type='purchase' and value > 20 then concat('partial_bad:', cast(cast(floor(value) as int) % 3 + 1 as varchar(9))) else null end as validation_fail_reason
 from :events""",
    "attempts": """select conv_id as doc_id, turn % 3 as item_index, turn as attempt, text as response,
 case when (conv_id*5+turn*3)%7 in (0,1) then null when (conv_id+turn)%4=0 then 'dollar_mismatch' else 'untranslated' end as fail_code, concat('src', cast(conv_id as varchar(9))) as source from :conversations""",
    "archive": """select concat('2608.', lpad(cast(doc_id % 700 as varchar(9)),5,'0')) as arxiv_id, concat('cs.', upper(lang)) as category, split_part(text, chr(10), 1) as title, text as body,
 cast(timestamp '2026-01-01 00:00:00' as date) as base_date, doc_id as edition from :documents""",
    "feed": """select doc_id, concat('<entry><id>http://example.org/abs/2608.',lpad(cast(doc_id as varchar(9)),5,'0'),'v',cast(doc_id%3+1 as varchar(9)),'</id><published>2026-08-0',cast(doc_id%7+1 as varchar(9)),'T06:24:36Z</published><title>',replace(replace(replace(text,'&','&amp;'),'<','&lt;'),'>','&gt;'),'</title><summary>s</summary><link href="h" rel="alternate"/>',case when doc_id%4=0 then '' else '<link title="pdf" href="http://example.org/pdf/x"/>' end,'</entry>') as entry_xml from :documents""",
    "image_inventory": "select doc_id, concat('_page_', cast(doc_id%4 as varchar(9)), '.JPEG') as file from :documents where doc_id % 6 <> 0",
    "cache": """select concat('in', cast(user_id % 50 as varchar(9)), props) as input, 'm1' as model, 'abcdef012345' as prompt_hash, '0.1' as temperature,
 concat('cached', cast(event_id as varchar(9))) as content, 'stop' as finish_reason, ts as written_at from :events where event_id % 3 = 0""",
}

_MD = r"""case when i%13=0 then concat('#### ',cast(i as varchar(9)),'.2 ',x) when i%13=3 then concat('| ',x,' | ',cast(i as varchar(9)),' |')
 when i%13=5 or i%13=6 then concat(cast(i as varchar(9)),': ',x) when i%13=8 then concat(x,' $k_{',cast(i as varchar(9)),'}$ cost $',cast(i as varchar(9)))
 when i%13=9 then concat('<span id="p',cast(i as varchar(9)),'"></span>') when i%13=10 then concat('$$z_',cast(i as varchar(9)),'$$ (',cast(i as varchar(9)),')') when i%13=11 then '```' else x end"""

SPARK = BOTH | {
    "node_answers": _TREE.format(size="size(split(text,'\\n',-1))", lines="split(text,'\\n',-1)", div="div", join=f"array_join(transform(slice(items, start + 1 + {_LOST}, n - {_LOST}), x -> concat('t:', x)), '\\n\\n<<<P>>>\\n\\n')"),
    "item_batches": r"select doc_id, 0 as batch_index, split(text,'\n',-1) as items from :documents",
    "upvotes": """select cast(l_orderkey as varchar(19)) as id, date_add(cast(o_orderdate as date), l_linenumber) as snapshot_date,
 case when l_linestatus='O' and l_returnflag='A' then null else cast(floor(l_quantity) as bigint) end as upvotes from :lineitem join :orders on l_orderkey=o_orderkey where l_returnflag <> 'N'""",
    "runs": "select explode(sequence(date'1995-01-15', date'2001-07-29', interval 7 day)) as as_of",
    "papers_md": rf"select doc_id, array_join(transform(split(text,'\n',-1), (x,i) -> {_MD}), case when doc_id%2=0 then '\n' else '\n\n' end) as md from :documents",
    "responses": r"""select doc_id, split(text,'\n',-1) as items, array_join(case when doc_id%5=0 then slice(split(text,'\n',-1),2,100000) else split(text,'\n',-1) end, '\n\n<<<P>>>\n\n') as response,
 case when doc_id%17=0 then 'length' else 'stop' end as finish_reason from :documents""",
    "gloss": r"select doc_id, array_join(transform(split(text,'\n',-1), x -> concat('용어 (', lower(split(x,' ',-1)[0]), ') ', x)), '\n') as md from :documents",
    "snapshots": """select cast(ts as date) as snapshot_date, concat('[',array_join(transform(array_sort(collect_list(struct(event_id, concat('{"paper":{"id":"p',cast(user_id as varchar(9)),'","upvotes":',case when event_type='error' then 'null' else cast(cast(floor(value) as int) as varchar(9)) end,'}}') as j))), z -> z.j), ','),']') as payload from :events group by 1""",
    "tables": r"""select o_custkey as doc_id, concat('| key | priority | status |\n|---|---|---|\n',array_join(transform(array_sort(collect_list(struct(o_orderkey, concat('| ',cast(o_orderkey as varchar(19)),' | ',o_orderpriority,' | ',o_orderstatus,' |') as j))), z -> z.j),'\n')) as md from :orders group by 1""",
    "images": r"""select doc_id, concat('# ', replace(text,'\n',' '), case when doc_id%3=0 then ' ## Abstract' else '' end, '\n', '![fig (', cast(doc_id%5 as varchar(9)), ')](_page_', cast(doc_id%4 as varchar(9)), '.JPEG)', '\n', '![](', case when doc_id%2=0 then 'sub/x.png' else 'missing.png' end, ')') as md from :documents""",
    "escaped": """select doc_id, concat(replace(text, chr(10), concat(chr(92),'n')), chr(10),'```',chr(10),'print(1',chr(92),'n)',chr(10),'```',chr(10), case when doc_id%4=0 then concat('(blank line)',chr(10)) else '' end, '$a ',chr(92),'neq b$') as md from :documents""",
}

DUCK = BOTH | {
    "node_answers": _TREE.format(size="len(string_split(text, chr(10)))", lines="string_split(text, chr(10))", div="//", join=f"array_to_string(list_transform(items[start + 1 + {_LOST}:start + n], lambda x: concat('t:', x)), chr(10)||chr(10)||'<<<P>>>'||chr(10)||chr(10))"),
    "item_batches": "select doc_id, 0 as batch_index, string_split(text, chr(10)) as items from :documents",
    "upvotes": """select cast(l_orderkey as varchar(19)) as id, cast(o_orderdate as date) + l_linenumber as snapshot_date,
 case when l_linestatus='O' and l_returnflag='A' then null else cast(floor(l_quantity) as bigint) end as upvotes from :lineitem join :orders on l_orderkey=o_orderkey where l_returnflag <> 'N'""",
    "runs": "select cast(d as date) as as_of from (select unnest(generate_series(date '1995-01-15', date '2001-07-29', interval 7 day)) as d)",
    "papers_md": f"select doc_id, case when doc_id%2=0 then md else replace(md, chr(10), chr(10)||chr(10)) end as md from (select doc_id, array_to_string(list_transform(string_split(text,chr(10)), lambda x, i: {re.sub(r'(?<![a-z_])i(?![a-z_])', '(i-1)', _MD)}), chr(10)) as md from :documents)",
    "responses": """select doc_id, string_split(text,chr(10)) as items, array_to_string(case when doc_id%5=0 then list_slice(string_split(text,chr(10)),2,100000) else string_split(text,chr(10)) end, chr(10)||chr(10)||'<<<P>>>'||chr(10)||chr(10)) as response,
 case when doc_id%17=0 then 'length' else 'stop' end as finish_reason from :documents""",
    "gloss": "select doc_id, array_to_string(list_transform(string_split(text,chr(10)), lambda x: concat('용어 (', lower(string_split(x,' ')[1]), ') ', x)), chr(10)) as md from :documents",
    "snapshots": """select cast(ts as date) as snapshot_date, '['||string_agg(concat('{"paper":{"id":"p',cast(user_id as varchar(9)),'","upvotes":',case when event_type='error' then 'null' else cast(cast(floor(value) as int) as varchar(9)) end,'}}'), ',' order by event_id)||']' as payload from :events group by 1""",
    "tables": "select o_custkey as doc_id, '| key | priority | status |'||chr(10)||'|---|---|---|'||chr(10)||string_agg(concat('| ',cast(o_orderkey as varchar(19)),' | ',o_orderpriority,' | ',o_orderstatus,' |'),chr(10) order by o_orderkey) as md from :orders group by 1",
    "images": "select doc_id, concat('# ', replace(text,chr(10),' '), case when doc_id%3=0 then ' ## Abstract' else '' end, chr(10), '![fig (', cast(doc_id%5 as varchar(9)), ')](_page_', cast(doc_id%4 as varchar(9)), '.JPEG)', chr(10), '![](', case when doc_id%2=0 then 'sub/x.png' else 'missing.png' end, ')') as md from :documents",
    "escaped": "select doc_id, concat(replace(text, chr(10), chr(92)||'n'), chr(10)||'```'||chr(10)||'print(1'||chr(92)||'n)'||chr(10)||'```'||chr(10), case when doc_id%4=0 then '(blank line)'||chr(10) else '' end, '$a '||chr(92)||'neq b$') as md from :documents",
}


#: Documents in which nothing runs away: plain words carry their place, so no run of them repeats; every fourth document has
#: an environment that is not closed.
_TAME_WORD = r"^[^\s|$`#<>\\0-9]+$"
SPARK["tame"] = rf"""select doc_id, concat(case when doc_id % 4 = 0 then '$\\begin{{a}}$ $$\\begin{{b}}x\\end{{b}}$$ ' else '' end,
 array_join(transform(split(md, ' ', -1), (w, k) -> case when w rlike '{_TAME_WORD.replace(chr(92), chr(92) * 2)}' then concat(w, cast(k as varchar(9))) else w end), ' ')) as md from ({SPARK["papers_md"]})"""
DUCK["tame"] = rf"""select doc_id, concat(case when doc_id % 4 = 0 then '$\begin{{a}}$ $$\begin{{b}}x\end{{b}}$$ ' else '' end,
 array_to_string(list_transform(string_split(md, ' '), lambda w, k: case when regexp_matches(w, '{_TAME_WORD}') then w || cast(k - 1 as varchar) else w end), ' ')) as md from ({DUCK["papers_md"]})"""


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(_TABLE.sub(lambda m: f"parquet.`{sf_dir}/{m[1]}.parquet` as {m[1]}", SPARK[name]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql(query: str, *names: str, recursive: bool = False) -> str:
    """``query`` for DuckDB behind the views ``f_<name>`` that it uses."""
    views = ",\n".join(f"f_{n} as ({_TABLE.sub(lambda m: m[1], DUCK[n])})" for n in names)
    query = query.strip()
    if query.startswith("with "):
        return f"with {'recursive ' if recursive else ''}{views},\n{query[5:]}"
    return f"with {views}\n{query}"
