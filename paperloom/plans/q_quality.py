"""Queries of the pair tests, verdicts, attempts and glosses."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions import parallel as v
from paperloom.functions.glosses import dedup_glosses
from paperloom.functions.vectorized import runaway
from paperloom.operators import pair_quality as q
from paperloom.plans.views import spark_view, sql, table

def _pairs(spark, d):
    """Every pair and, for the brace test, one more whose math differs by a brace: (conv_id, turn, kind, source, response)."""
    p = spark_view(spark, d, "pairs").withColumn("kind", F.lit("plain"))
    math = lambda c, tail: F.concat(c, F.lit(f" $k_{{1}}$ and $$x{tail}$$"))
    one = p.withColumns({"kind": F.lit("brace"), "source": math(F.col("source"), "{a}"), "response": math(F.col("response"), "{a")})
    return p.unionByName(one).select("conv_id", "turn", "kind", "source", "response")


def _flag(name, test):
    return lambda spark, d: _pairs(spark, d).select("conv_id", "turn", "kind", test(F.col("source"), F.col("response")).alias(name))


def runaways(spark, d):
    return table(spark, d, "documents").select("doc_id", runaway("text").alias("runaway"))


def blank_markers(spark, d):
    return spark_view(spark, d, "escaped").select("doc_id", v.blank_marker(F.col("md")).alias("blank_marker"))


def references(spark, d):
    """Raw texts, and entries made of them in the forms that count and that do not."""
    t = table(spark, d, "documents")
    year = F.when(F.col("doc_id") % 2 == 0, " (2024a) x [A 1999](u) ").otherwise(" see doi: ")
    form = F.when(F.col("doc_id") % 3 == 0, "- [12] ").when(F.col("doc_id") % 3 == 1, "* ").otherwise("[3] ")
    made = F.concat(form, F.substring("text", 1, 50), year, year, year)
    both = t.select("doc_id", F.lit("raw").alias("kind"), F.col("text").alias("t")).unionByName(t.select("doc_id", F.lit("made").alias("kind"), made.alias("t")))
    return both.select("doc_id", "kind", v.is_reference(F.col("t")).alias("is_reference"))


def codes(spark, d):
    return _pairs(spark, d).select("conv_id", "turn", "kind", v.fail_code(F.col("source"), F.col("response")).alias("fail_code"))


def _items(spark, d):
    return spark_view(spark, d, "attempts").select("doc_id", (F.col("attempt") % 2).alias("batch_index"), F.lit("0").alias("path"), "item_index", "attempt", "fail_code")


def verdicts(spark, d):
    return q.batch_verdict(_items(spark, d)).select("doc_id", "batch_index", "path", "bad", "verdict")


def retries(spark, d):
    return q.retry_items(_items(spark, d))


def resolved(spark, d):
    return q.resolve_attempts(spark_view(spark, d, "attempts"))


def glosses(spark, d):
    return spark_view(spark, d, "gloss").select("doc_id", dedup_glosses(F.col("md")).alias("md"))


def gloss_numbers(spark, d):
    return q.gloss_stats(spark_view(spark, d, "gloss"))


QUERIES = {
    "v1_is_refusal": _flag("refusal", lambda s, r: v.is_refusal(r)),
    "v2_dollar_mismatch": _flag("dollars", v.dollar_mismatch),
    "v3_brace_mismatch": _flag("braces", v.brace_mismatch),
    "v4_runaway": runaways,
    "v5_is_untranslated": _flag("untranslated", v.is_untranslated),
    "v6_untranslated_run": _flag("run", v.has_untranslated_run),
    "v7_blank_marker": blank_markers,
    "v8_is_reference": references,
    "v9_fail_code": codes,
    "v10_batch_verdict": verdicts,
    "v10_retry_items": retries,
    "v11_resolve_attempts": resolved,
    "v13_dedup_glosses": glosses,
    "v14_gloss_stats": gloss_numbers,
}

_MATH = r"(?s)\$\$.*?\$\$|\$[^$\n]+\$"
_PAIRS = f"""with pp as (select conv_id, turn, 'plain' as kind, source, response from f_pairs union all select conv_id, turn, 'brace', source || ' $k_{{1}}$ and $$x{{a}}$$', response || ' $k_{{1}}$ and $$x{{a$$' from f_pairs),
pm as (select *, regexp_replace(source, '{_MATH}', ' ', 'g') as ps, regexp_replace(response, '{_MATH}', ' ', 'g') as pr, array_to_string(regexp_extract_all(source, '{_MATH}'), '') as ms, array_to_string(regexp_extract_all(response, '{_MATH}'), '') as mr from pp),
"""
_REFUSES = "(" + " or ".join("contains(replace(lower(response), '’', ''''), '" + p.replace("'", "''") + "')" for p in v.REFUSALS) + ")"
_REFERENCE = r"""((regexp_matches(split_part(ltrim({0}, ' ' || chr(9) || chr(10) || chr(13)), chr(10), 1), '^[-*]?\s*\[[0-9]+\]') and (regexp_matches({0}, '\((?:19|20)\d{{2}}[a-z]?\)') or regexp_matches({0}, '\[[^\]]*(?:19|20)\d{{2}}[^\]]*\]\([^)]+\)') or regexp_matches({0}, '(?i)https?://|doi:|arxiv:')))
 or (regexp_matches(split_part(ltrim({0}, ' ' || chr(9) || chr(10) || chr(13)), chr(10), 1), '^[-*]\s') and (len(regexp_extract_all({0}, '\[[^\]]*(?:19|20)\d{{2}}[^\]]*\]\([^)]+\)')) >= 3 or len(regexp_extract_all({0}, '\((?:19|20)\d{{2}}[a-z]?\)')) >= 3)))"""
_COUNT = lambda c, s: f"(length({c}) - length(replace({c}, '{s}', '')))"
_WORDS = ", ".join(f"'{w}'" for w in v.FUNCTION_WORDS)
TESTS = (
    _PAIRS
    + f"""vt as (select *, {_REFUSES} as refusal, {_COUNT('source', '$')} <> {_COUNT('response', '$')} as dollars,
 {_COUNT('ms', '{')} <> {_COUNT('mr', '{')} or {_COUNT('ms', '}')} <> {_COUNT('mr', '}')} as braces,
 case when {_REFUSES} then true when length(ps) < 100 then false when {_REFERENCE.format('source')} then false when len(regexp_extract_all(pr, '[a-zA-Z]{{3,}}')) < 5 then false else len(regexp_extract_all(pr, '[가-힣]')) < 5 end as untranslated,
 not {_REFERENCE.format('source')} and len(list_filter(string_split_regex(pr, '[가-힣]+'), lambda x: length(x) >= 100 and not regexp_matches(x, '(?i)https?://|doi:|arxiv:') and len(regexp_extract_all(x, '[a-zA-Z]{{3,}}')) >= 10
 and len(list_filter(string_split_regex(x, '[^\\p{{L}}\\p{{M}}\\p{{Nd}}_]+'), lambda w: lower(w) in ({_WORDS}))) >= 3)) > 0 as run from pm)
"""
)
CODE = "case when untranslated then 'untranslated' when run then 'untranslated_run' when dollars then 'dollar_mismatch' when braces then 'brace_mismatch' end"
ORACLES = {
    "v1_is_refusal": sql(TESTS + "select conv_id, turn, kind, refusal from vt", "pairs"),
    "v2_dollar_mismatch": sql(TESTS + "select conv_id, turn, kind, dollars from vt", "pairs"),
    "v3_brace_mismatch": sql(TESTS + "select conv_id, turn, kind, braces from vt", "pairs"),
    "v5_is_untranslated": sql(TESTS + "select conv_id, turn, kind, untranslated from vt", "pairs"),
    "v6_untranslated_run": sql(TESTS + "select conv_id, turn, kind, run from vt", "pairs"),
    "v7_blank_marker": sql(r"select doc_id, regexp_matches(md, '(?im)^\s*[\(\[]\s*blank\s*line\s*[\)\]]\s*$') as blank_marker from f_escaped", "escaped"),
    "v8_is_reference": f"""with t as (select doc_id, 'raw' as kind, text as t from documents union all select doc_id, 'made', case doc_id % 3 when 0 then '- [12] ' when 1 then '* ' else '[3] ' end || substring(text, 1, 50) || repeat(case when doc_id % 2 = 0 then ' (2024a) x [A 1999](u) ' else ' see doi: ' end, 3) from documents)
select doc_id, kind, {_REFERENCE.format('t')} as is_reference from t""",
    "v9_fail_code": sql(
        TESTS + f"select conv_id, turn, kind, {CODE} as fail_code from vt", "pairs"
    ),
    "v10_batch_verdict": sql(
        """select doc_id, attempt % 2 as batch_index, '0' as path, count(fail_code) as bad, case when count(fail_code) > 0 then 'partial_bad:' || count(fail_code) end as verdict from f_attempts group by 1, 2""", "attempts"
    ),
    "v10_retry_items": sql("select doc_id, attempt % 2 as batch_index, '0' as path, item_index, attempt, fail_code from f_attempts where fail_code is not null", "attempts"),
    "v11_resolve_attempts": sql(
        """with n as (select *, coalesce(sum(case when fail_code is null then 0 else 1 end) over (partition by doc_id, item_index order by attempt rows between unbounded preceding and 1 preceding), 0) as before from f_attempts),
g as (select doc_id, item_index, arg_min(response, attempt) filter (fail_code is null) as passed, bool_or(fail_code in ('dollar_mismatch', 'brace_mismatch', 'runaway_repetition', 'blank_line_marker')) as never,
 arg_max(response, attempt) filter (fail_code is not null) as last, min(source) as source, count(*) filter (fail_code is null) as ok from n where before < 5 group by 1, 2)
select doc_id, item_index, case when ok > 0 then passed when never then source else last end as text, case when ok > 0 then 'passed' when never then 'source_kept' else 'last_bad' end as outcome from g""",
        "attempts",
    ),
    "v13_dedup_glosses": sql(
        r"""with l as (select doc_id, unnest(string_split(md, chr(10))) as line, generate_subscripts(string_split(md, chr(10)), 1) as n from f_gloss),
f as (select *, sum(case when regexp_matches(line, '^\s*```') then 1 else 0 end) over (partition by doc_id order by n) as fences from l),
s as (select doc_id, n, string_split_regex(line, '[가-힣] ?\([^()\n]{1,80}\)') as gs, regexp_extract_all(line, '[가-힣] ?\([^()\n]{1,80}\)') as ms, fences % 2 = 0 and not regexp_matches(line, '^\s*#') and not regexp_matches(line, '^\s*```') as free from f),
e as (select doc_id, n, free, unnest(ms) as m, generate_subscripts(ms, 1) as k from s),
t as (select *, trim(regexp_extract(m, '\((.*)\)$', 1)) as term from e),
u as (select *, free and length(term) >= 2 and regexp_matches(term, '[a-zA-Z]') and not regexp_matches(term, '(?i)(?:19|20)\d{2}[a-z]?|et al') and not regexp_matches(term, '[$\\`]') as used from t),
r as (select doc_id, n, k, case when used and row_number() over (partition by doc_id, lower(term), used order by n, k) > 1 then substring(m, 1, 1) else m end as m from u),
a as (select doc_id, n, list(m order by k) as ms from r group by 1, 2),
j as (select s.doc_id, s.n, array_to_string(list_transform(s.gs, lambda x, i: x || coalesce(a.ms[i], '')), '') as line from s left join a on a.doc_id = s.doc_id and a.n = s.n)
select doc_id, string_agg(line, chr(10) order by n) as md from j group by 1""",
        "gloss",
    ),
    "v14_gloss_stats": sql(
        r"""with l as (select doc_id, unnest(string_split(md, chr(10))) as line, generate_subscripts(string_split(md, chr(10)), 1) as n from f_gloss),
f as (select *, sum(case when regexp_matches(line, '^\s*```') then 1 else 0 end) over (partition by doc_id order by n) as fences from l),
t as (select doc_id, n, unnest(regexp_extract_all(line, '[가-힣] ?\(([^()\n]{1,80})\)', 1)) as raw from f where fences % 2 = 0 and not regexp_matches(line, '^\s*#') and not regexp_matches(line, '^\s*```')),
s as (select doc_id, row_number() over () as pos, n, trim(raw) as term from t),
k as (select * from s where length(term) >= 2 and regexp_matches(term, '[a-zA-Z]') and not regexp_matches(term, '(?i)(?:19|20)\d{2}[a-z]?|et al') and not regexp_matches(term, '[$\\`]'))
select doc_id, arg_min(term, n * 1000000 + pos) as term, count(*) as occurrences, count(*) - 1 as removed from k group by doc_id, lower(term) having count(*) > 1""",
        "gloss",
    ),
}
