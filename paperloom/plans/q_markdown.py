"""Queries of the cleanup rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.functions import markdown as m
from paperloom.functions.vectorized import PLACEHOLDER, sanitize_math
from paperloom.plans.views import spark_view, sql, table


def rule(function, view="papers_md"):
    return lambda spark, d: spark_view(spark, d, view).select("doc_id", function(F.col("md")).alias("md"))


def bracketed(spark, d):
    md = F.replace(F.replace("text", F.lit(". "), F.lit(".\\(x\\) ")), F.lit(", "), F.lit(", \\\\[1\\\\] "))
    return table(spark, d, "documents").select("doc_id", m.unescape_brackets(md).alias("md"))


def broken_math(spark, d):
    md = F.concat(F.lit("$"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("$ $$\\begin{a} x$$ $$\\begin{b}\\end{b}$$"))
    return table(spark, d, "documents").select("doc_id", sanitize_math(md).alias("md"))


def unclosed(spark, d):
    """Documents with an environment behind every third line's first word, closed or not."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.concat(F.when(i % 3 == 0, "$$\\begin{a} ").otherwise("$x \\end{b} "), x, F.when(i % 6 == 0, " \\end{a}$$").otherwise("$ $$")))
    return table(spark, d, "documents").select("doc_id", m.unclosed_math(F.array_join(lines, "\n")).cast("long").alias("unclosed"))


def newlines(spark, d):
    return spark_view(spark, d, "escaped").select("doc_id", m.fix_newlines(F.col("md")).alias("x")).select("doc_id", "x.text", F.col("x.count").cast("long").alias("count"))


def guarded_newlines(spark, d):
    return spark_view(spark, d, "escaped").select("doc_id", m.fix_newlines(F.col("md"), protect_math=True).alias("x")).select("doc_id", "x.text", F.col("x.count").cast("long").alias("count"))


QUERIES = {
    "c1_unescape_brackets": bracketed,
    "c2_escape_orphan_dollars": rule(m.escape_orphan_dollars),
    "c3_sanitize_math": broken_math,
    "c3_unclosed_math": unclosed,
    "c4_fix_heading_levels": rule(m.fix_heading_levels),
    "c5_merge_pseudocode": rule(m.merge_pseudocode),
    "c6_space_tables": rule(m.space_tables),
    "c7_space_anchors": rule(m.space_anchors),
    "c8_space_equations": rule(m.space_equations),
    "c9_clean_markdown": lambda spark, d: m.clean_markdown(spark_view(spark, d, "papers_md")),
    "c3_sanitize_tame": lambda spark, d: spark_view(spark, d, "tame").withColumn("md", sanitize_math("md")),
    "c9_clean_tame": lambda spark, d: m.clean_markdown(spark_view(spark, d, "tame")),
    "v12_fix_newlines": newlines,
    "v12_fix_newlines_guarded": guarded_newlines,
}

_MATH = r"(?s)\$\$.*?\$\$|\$[^$\n]+\$"
_SHOW = r"(?s)\$\$.*?\$\$"
_LINES = "string_split(md, chr(10))"
_join = lambda body, over=_LINES, by="chr(10)": f"array_to_string(list_transform({over}, lambda x, i: {body}), {by})"
_STRIP = r"regexp_replace(x, '^\s+|\s+$', '', 'g')"
_FENCE = "(starts_with(s, '```') and ends_with(s, '```') and length(s) >= 6)"
_ROW = r"regexp_matches({}, '(?s)^\s*\|.*\|\s*$')"
_FULL = r"regexp_matches({}, '\S')"
_LABEL = r"'^[ \t]*(\([^()\n]{1,10}\))'"

ORACLES = {
    "c1_unescape_brackets": r"""with b as (select doc_id, replace(replace(text, '. ', '.\(x\) '), ', ', ', \\[1\\] ') as md from documents)
select doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(md, '\\{1,2}\(', '(', 'g'), '\\{1,2}\)', ')', 'g'), '\\{1,2}\[', '&#91;', 'g'), '\\{1,2}\]', '&#93;', 'g') as md from b""",
    "c2_escape_orphan_dollars": sql(
        f"""with x as (select doc_id, string_split_regex(md, '{_MATH}') as g, regexp_extract_all(md, '{_MATH}') as s from f_papers_md)
select doc_id, array_to_string(list_transform(g, lambda x, i: replace(x, '$', chr(92) || '$') || coalesce(s[i], '')), '') as md from x""",
        "papers_md",
    ),
    "c3_unclosed_math": r"""with l as (select doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda x, i: case when (i - 1) % 3 = 0 then '$$\begin{a} ' else '$x \end{b} ' end || x || case when (i - 1) % 6 = 0 then ' \end{a}$$' else '$ $$' end), chr(10)) as md from documents)
select doc_id, len(list_filter(regexp_extract_all(md, '(?s)\$\$.*?\$\$|\$[^$\n]+\$'), lambda x: len(string_split(x, '\begin{')) <> len(string_split(x, '\end{')))) as unclosed from l""",
    "c4_fix_heading_levels": sql(
        r"""with p as (select '^#{1,6}[ \t]+((?:<span[^>]*>\s*</span>\s*)*(?:\*{1,2}|_{1,2})?([0-9]+(?:\.[0-9]+)*)\.?(?:\*{1,2}|_{1,2})?\s.*)$' as p)
select doc_id, """
        + _join(
            "case when regexp_matches(x, p) then repeat('#', least(length(regexp_extract(x, p, 2)) - length(replace(regexp_extract(x, p, 2), '.', '')) + 2, 6)) || ' ' || regexp_extract(x, p, 1) else x end"
        )
        + " as md from f_papers_md, p",
        "papers_md",
    ),
    "c5_merge_pseudocode": sql(
        rf"""with a as (select doc_id, list_transform(string_split(md, chr(10)||chr(10)), lambda x: struct_pack(p := x, s := {_STRIP})) as ps from f_papers_md),
f as (select doc_id, list_transform(ps, lambda z: struct_pack(p := z.p, s := z.s, f := starts_with(z.s, '```') and ends_with(z.s, '```') and length(z.s) >= 6)) as ps from a),
c as (select doc_id, list_transform(ps, lambda z: struct_pack(p := z.p, b := case when z.f then regexp_replace(substr(z.s, 4, length(z.s) - 6), '^\n+|\n+$', '', 'g') else z.s end,
 code := case when z.f then len(list_filter(string_split(substr(z.s, 4, length(z.s) - 6), chr(10)), lambda l: regexp_matches(l, '^\s*[0-9]+:\s'))) > 0 else regexp_matches(string_split(z.s, chr(10))[1], '^\s*[0-9]+:\s') end)) as ps from f)
select doc_id, array_to_string(list_transform(ps, lambda z, i: case when z.code then (case when i > 1 and ps[i - 1].code then '' else '```' || chr(10) end) || z.b || (case when i < len(ps) and ps[i + 1].code then '' else chr(10) || '```' end) else z.p end
 || case when i = len(ps) then '' when z.code and ps[i + 1].code then chr(10) else chr(10) || chr(10) end), '') as md from c""",
        "papers_md",
    ),
    "c6_space_tables": sql(
        f"""with l as (select doc_id, {_LINES} as a from f_papers_md)
select doc_id, array_to_string(list_transform(a, lambda x, i: case when {_ROW.format('x')} then
 case when i > 1 and {_FULL.format('a[i - 1]')} and not {_ROW.format('a[i - 1]')} then chr(10) else '' end || x || case when i < len(a) and {_FULL.format('a[i + 1]')} and not {_ROW.format('a[i + 1]')} then chr(10) else '' end
 else x end), chr(10)) as md from l""",
        "papers_md",
    ),
    "c7_space_anchors": sql(
        rf"""with l as (select doc_id, {_LINES} as a from f_papers_md)
select doc_id, array_to_string(list_transform(a, lambda x, i: case when regexp_matches(x, '^\s*<span id="[^"]*"></span>\s*$') and i < len(a) and {_FULL.format('a[i + 1]')} then x || chr(10) else x end), chr(10)) as md from l""",
        "papers_md",
    ),
    "c8_space_equations": sql(
        rf"""with e as (select doc_id, string_split_regex(md, '{_SHOW}') as g, regexp_extract_all(md, '{_SHOW}') as s from f_papers_md),
b as (select doc_id, s, list_transform(g, lambda x, i: struct_pack(l := case when i > 1 then regexp_extract(x, {_LABEL}, 1) else '' end, r := case when i > 1 then regexp_replace(x, {_LABEL}, '') else x end)) as g from e),
t as (select doc_id, s, list_transform(g, lambda z, i: case when z.l <> '' then chr(10)||chr(10)||z.l else '' end || case when i = 1 or not regexp_matches(z.r, '\S') then z.r else chr(10)||chr(10)||ltrim(z.r, chr(10)) end) as g from b)
select doc_id, array_to_string(list_transform(g, lambda x, i: case when i = len(g) then x else case when regexp_matches(x, '\S') then rtrim(x, chr(10))||chr(10)||chr(10) else x end || s[i] end), '') as md from t""",
        "papers_md",
    ),
    "v12_fix_newlines": sql(
        """with x as (select doc_id, string_split_regex(md, '(?s)```.*?```') as g, regexp_extract_all(md, '(?s)```.*?```') as s from f_escaped)
select doc_id, array_to_string(list_transform(g, lambda x, i: replace(x, chr(92)||'n', chr(10)) || coalesce(s[i], '')), '') as text,
 cast(list_sum(list_transform(g, lambda x: (length(x) - length(replace(x, chr(92)||'n', ''))) // 2)) as bigint) as count from x""",
        "escaped",
    ),
    "v12_fix_newlines_guarded": sql(
        r"""with p as (select '(?s)```.*?```|\$\$.*?\$\$|\$[^$\n]+\$' as p), x as (select doc_id, string_split_regex(md, p) as g, regexp_extract_all(md, p) as s from f_escaped, p)
select doc_id, array_to_string(list_transform(g, lambda x, i: replace(x, chr(92)||'n', chr(10)) || coalesce(s[i], '')), '') as text,
 cast(list_sum(list_transform(g, lambda x: (length(x) - length(replace(x, chr(92)||'n', ''))) // 2)) as bigint) as count from x""",
        "escaped",
    ),
}


def _over(name: str, source: str) -> str:
    """An oracle's query over another source of (doc_id, md)."""
    rest = ORACLES[name].removeprefix(sql("", "papers_md").rstrip())
    return (f"with {rest.removeprefix(',').strip()}" if rest.startswith(",") else rest.strip()).replace("f_papers_md", source)


def _sanitized(source: str) -> str:
    """The broken-math rule where nothing runs away: environments that are not closed."""
    spans = f"select doc_id, string_split_regex(md, '{_MATH}') as g, regexp_extract_all(md, '{_MATH}') as s from {source}"
    broken = r"len(string_split(s[i], '\begin{')) <> len(string_split(s[i], '\end{'))"
    return f"select doc_id, array_to_string(list_transform(g, lambda x, i: x || coalesce(case when {broken} then '{PLACEHOLDER}' else s[i] end, '')), '') as md from ({spans})"


_BRACKETS = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(md, '\\{1,2}\(', '(', 'g'), '\\{1,2}\)', ')', 'g'), '\\{1,2}\[', '&#91;', 'g'), '\\{1,2}\]', '&#93;', 'g')"
_CHAIN = ["c2_escape_orphan_dollars", "c5_merge_pseudocode", "c4_fix_heading_levels", "c6_space_tables", "c7_space_anchors", "c8_space_equations"]
ORACLES["c3_sanitize_tame"] = sql(_sanitized("f_tame"), "tame")
ORACLES["c9_clean_tame"] = sql(
    f"with s0 as (select doc_id, {_BRACKETS} as md from f_tame), " + ", ".join(f"s{k + 1} as ({_over(name, f's{k}')})" for k, name in enumerate(_CHAIN)) + f" {_sanitized(f's{len(_CHAIN)}')}", "tame"
)
