"""Cleanup of extracted Markdown: one Column function per rule, text in, text out.

Lines are those between ``\\n``; blank means white space of any kind. The rules act inside code fences too, but for
those that say otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.spans import DISPLAY, FENCED, MATH, count_of, gaps, let, matches, rewrite
from paperloom.functions.strings import strip
from paperloom.functions.vectorized import sanitize_math

#: Patterns of lines. Fixed values.
NUMBERED_HEADING = r"(?d)^#{1,6}[ \t]+((?:<span[^>]*>\s*</span>\s*)*(?:\*{1,2}|_{1,2})?(\d+(?:\.\d+)*)\.?(?:\*{1,2}|_{1,2})?\s.*)$"
STEP = r"(?U)^\s*\d+:\s"
TABLE_ROW = r"(?Us)^\s*\|.*\|\s*$"
ANCHOR = r'(?U)^\s*<span id="[^"]*"></span>\s*$'
LABEL = r"^[ \t]*(\([^()\n]{1,10}\))"


def _lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def _blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def unescape_brackets(c: Column) -> Column:
    """One or two backslashes before a round bracket go; square ones become entities."""
    for sign, to in (("(", "("), (")", ")"), ("[", "&#91;"), ("]", "&#93;")):
        c = F.regexp_replace(c, r"\\{1,2}\%s" % sign, to)
    return c


def escape_orphan_dollars(c: Column) -> Column:
    """Dollar signs outside well-paired math get a backslash."""
    return rewrite(c, MATH, lambda gap: F.replace(gap, F.lit("$"), F.lit("\\$")))


def fix_heading_levels(c: Column) -> Column:
    """The level of a numbered heading follows from the depth of its number."""
    return F.array_join(F.transform(_lines(c), _heading), "\n")


def _heading(x: Column) -> Column:
    """A line with its level set; lines without a number sign are left alone at once."""

    def levelled(number: Column) -> Column:
        depth = F.length(number) - F.length(F.replace(number, F.lit("."), F.lit("")))
        marks = F.repeat(F.lit("#"), F.least(depth + 2, F.lit(6)))
        return F.when(number != "", F.concat(marks, F.lit(" "), F.regexp_extract(x, NUMBERED_HEADING, 1))).otherwise(x)

    return F.when(x.contains("#"), let(F.regexp_extract(x, NUMBERED_HEADING, 2), levelled)).otherwise(x)


def _fenced(stripped: Column) -> Column:
    return stripped.startswith("```") & stripped.endswith("```") & (F.length(stripped) >= 6)


def _inner(stripped: Column) -> Column:
    return F.substring(stripped, F.lit(4), F.length(stripped) - 6)


def is_pseudocode(paragraph: Column) -> Column:
    """Its first line is a numbered step, or it is a fence that holds such a line."""
    s = strip(paragraph)
    return F.when(_fenced(s), F.exists(_lines(_inner(s)), lambda x: x.rlike(STEP))).otherwise(F.substring_index(s, "\n", 1).rlike(STEP))


def merge_pseudocode(c: Column) -> Column:
    """Neighbouring pseudo-code paragraphs become one fenced block without inner fences.

    Whether a paragraph opens, goes on or closes a block depends on its neighbours alone, so no state is carried.
    """
    marked = F.transform(F.split(c, "\n\n", -1), lambda p: F.struct(p.alias("p"), is_pseudocode(p).alias("code")))

    def piece(x: Column, i: Column, all_: Column) -> Column:
        s = strip(x["p"])
        before = F.coalesce(F.get(all_, i - 1)["code"], F.lit(False))
        after = F.coalesce(F.get(all_, i + 1)["code"], F.lit(False))
        body = F.when(_fenced(s), F.regexp_replace(_inner(s), "^\n+|\n+$", "")).otherwise(s)
        code = F.concat(F.when(before, "").otherwise("```\n"), body, F.when(after, "").otherwise("\n```"))
        ends = F.when(i == F.size(all_) - 1, "").when(x["code"] & after, "\n").otherwise("\n\n")
        return F.concat(F.when(x["code"], code).otherwise(x["p"]), ends)

    # a one-element array binds the marked paragraphs, so they are worked out once
    return F.element_at(F.transform(F.array(marked), lambda all_: F.array_join(F.transform(all_, lambda x, i: piece(x, i, all_)), "")), 1)


def _spaced(c: Column, before, after) -> Column:
    """Put an empty line before or after lines; both tests see (lines, index)."""
    def line(x: Column, i: Column, all_: Column) -> Column:
        empty, none = F.array(F.lit("")), F.array().cast("array<string>")
        return F.concat(F.when(before(x, i, all_), empty).otherwise(none), F.array(x), F.when(after(x, i, all_), empty).otherwise(none))

    return F.element_at(F.transform(F.array(_lines(c)), lambda all_: F.array_join(F.flatten(F.transform(all_, lambda x, i: line(x, i, all_))), "\n")), 1)


def space_tables(c: Column) -> Column:
    """An empty line between a table and a neighbouring line that is neither blank nor a row."""
    row = lambda x: x.rlike(TABLE_ROW)
    other = lambda x: x.isNotNull() & ~_blank(x) & ~row(x)
    return _spaced(c, lambda x, i, a: row(x) & F.coalesce(other(F.get(a, i - 1)), F.lit(False)), lambda x, i, a: row(x) & F.coalesce(other(F.get(a, i + 1)), F.lit(False)))


def space_anchors(c: Column) -> Column:
    """An empty line behind a line that is only an empty anchor, if the next one is not blank."""
    following = lambda i, a: F.coalesce(~_blank(F.get(a, i + 1)), F.lit(False))
    return _spaced(c, lambda x, i, a: F.lit(False), lambda x, i, a: x.rlike(ANCHOR) & following(i, a))


def fix_lines(c: Column) -> Column:
    """Heading levels, spaced tables and spaced anchors at once: the same as the three rules one after the other.

    Each line is classed once; what stands between two lines, one line end or an empty line, follows from their classes.
    A levelled heading stays what it was to the other two rules.
    """
    has = lambda x, sign, pattern: x.contains(sign) & x.rlike(pattern)
    classed = F.transform(_lines(c), lambda x: F.struct(_heading(x).alias("line"), has(x, "|", TABLE_ROW).alias("row"), _blank(x).alias("blank"), has(x, "<span", ANCHOR).alias("anchor")))

    def ended(x: Column, y: Column) -> Column:
        apart = (x["row"] & ~y["row"] & ~y["blank"]) | (y["row"] & ~x["row"] & ~x["blank"]) | (x["anchor"] & ~y["blank"])
        return F.concat(x["line"], F.when(y.isNull(), "").when(apart, "\n\n").otherwise("\n"))

    return let(classed, lambda all_: F.array_join(F.transform(all_, lambda x, i: let(F.get(all_, i + 1), lambda y: ended(x, y))), ""))


def space_equations(c: Column) -> Column:
    """Display equations stand alone; a short label behind one becomes a paragraph of its own."""

    def gap(x: Column, i: Column, last: Column) -> Column:
        label = F.when(i > 0, F.regexp_extract(x, LABEL, 1)).otherwise("")
        rest = F.when(label != "", F.regexp_replace(x, LABEL, "")).otherwise(x)
        led = F.when((i == 0) | _blank(rest), rest).otherwise(F.concat(F.lit("\n\n"), F.regexp_replace(rest, "^\n+", "")))
        text = F.concat(F.when(label != "", F.concat(F.lit("\n\n"), label)).otherwise(""), led)
        return F.when((i == last) | _blank(text), text).otherwise(F.concat(F.regexp_replace(text, "\n+$", ""), F.lit("\n\n")))

    def woven(equations: Column) -> Column:
        texts = F.transform(gaps(c, DISPLAY), lambda x, i: gap(x, i, F.size(equations)))
        return F.array_join(F.zip_with(texts, equations, lambda g, e: F.concat(g, F.coalesce(e, F.lit("")))), "")

    return let(matches(c, DISPLAY), lambda equations: F.when(F.size(equations) > 0, woven(equations)).otherwise(c))


def unclosed_math(c: Column) -> Column:
    """How many math spans open and close a different number of environments."""
    return F.size(F.filter(matches(c, MATH), lambda m: count_of(m, "\\begin{") != count_of(m, "\\end{")))


#: ``fix_lines`` stands for the rules of headings, tables and anchors, which come in this place.
RULES = (unescape_brackets, escape_orphan_dollars, merge_pseudocode, fix_lines, space_equations)


def clean_markdown(df: DataFrame, column: str = "md") -> DataFrame:
    """The whole chain in its fixed order, a projection per rule; the broken-math rule runs last and in Arrow batches.

    The last step names the column more than once, so the optimizer keeps the rules before it out of the Python call.
    """
    for rule in RULES:
        df = df.withColumn(column, rule(F.col(column)))
    return df.withColumn(column, F.when(F.col(column).contains("$"), sanitize_math(column)).otherwise(F.col(column)))


def fix_newlines(c: Column, protect_math: bool = False) -> Column:
    """struct<text, count>: literal backslash-n outside fences becomes a line end. With ``protect_math`` math keeps its
    commands that begin with n."""
    pattern = f"{FENCED}|{MATH.removeprefix('(?s)')}" if protect_math else FENCED
    outside = F.array_join(gaps(c, pattern), "\0")
    count = ((F.length(outside) - F.length(F.replace(outside, F.lit("\\n"), F.lit("")))) / 2).cast("int")
    return F.struct(rewrite(c, pattern, lambda g: F.replace(g, F.lit("\\n"), F.lit("\n"))).alias("text"), count.alias("count"))
