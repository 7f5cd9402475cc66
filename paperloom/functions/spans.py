"""Rewrite a text around the matches of a pattern: the text between matches and the matches are handled apart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Math: a display span over any lines, or a non-empty inline span on one line. Fixed value.
MATH = r"(?s)\$\$.*?\$\$|\$[^$\n]+\$"
DISPLAY = r"(?s)\$\$.*?\$\$"
FENCED = r"(?s)```.*?```"


def gaps(c: Column, pattern: str) -> Column:
    """The texts before, between and behind the matches; one more than there are matches."""
    return F.split(c, pattern, -1)


def matches(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), 0)


def rewrite(c: Column, pattern: str, gap: Callable[[Column], Column], match: Callable[[Column], Column] = lambda m: m) -> Column:
    woven = F.zip_with(gaps(c, pattern), matches(c, pattern), lambda g, m: F.concat(gap(g), F.coalesce(match(m), F.lit(""))))
    return F.array_join(woven, "")


def count_of(c: Column, text: str) -> Column:
    """How often a fixed text occurs."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(text), F.lit("")))) / len(text)).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
