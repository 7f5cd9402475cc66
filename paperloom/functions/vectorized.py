"""The text helpers that built-in functions cannot say well: Arrow batches in, Arrow batches out."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions.spans import MATH, count_of, gaps, let, matches

#: A unit of 3 to 80 characters, 15 times or more in a row. Fixed values.
LEAST_UNIT, MOST_UNIT, REPEATS = 3, 80, 15
RUNAWAY = re.compile(r"(.{3,80}?)(?:\1){14,}")
LETTER = re.compile("[A-Za-z가-힣]")
#: What a broken equation is replaced with. Fixed value.
PLACEHOLDER = "`[수식 추출 실패 - 원본 PDF 참조]`"

#: Characters that are compared at a place of the grid before a period is tried in full, and of the strings that are met again.
PROBE, GRAM = 16, 8


def _meets_itself(codes: np.ndarray) -> bool:
    """Do as many strings of GRAM characters come again within MOST_UNIT as the shortest runaway holds? Most texts stop here."""
    h = np.zeros(codes.size - GRAM + 1, np.uint64)
    for k in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + h.size]
    order = np.argsort(h, kind="stable")
    again = (h[order][1:] == h[order][:-1]) & (np.diff(order) <= MOST_UNIT)
    return int(np.count_nonzero(again)) >= LEAST_UNIT * (REPEATS - 1) - GRAM


def _holds(codes: np.ndarray, newline: np.ndarray, period: int, need: int) -> bool:
    """Does the text equal itself, moved by the period, over ``need`` characters in a row?"""
    broken = np.flatnonzero((codes[period:] != codes[:-period]) | newline[period:])
    if not broken.size:
        return True
    return bool(broken[0] >= need or codes.size - period - broken[-1] - 1 >= need or (np.diff(broken) > need).any())


def may_run_away(text: str) -> bool:
    """Is there a period of LEAST_UNIT to MOST_UNIT that holds over REPEATS units, in a newline-free stretch?

    A stretch of that length covers half of it from some place of a grid of half its length on, so a few characters
    behind each place of the grid tell whether the period is worth a comparison of the whole text with itself.
    """
    if len(text) < LEAST_UNIT * REPEATS:
        return False
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    if not _meets_itself(codes):
        return False
    newline = codes == 10
    for period in range(LEAST_UNIT, MOST_UNIT + 1):
        need = period * (REPEATS - 1)
        if codes.size < need + period:
            break
        step = need // 2
        at = np.arange(0, codes.size - period - min(PROBE, step) + 1, step)
        for k in range(min(PROBE, step)):
            at = at[codes[at + k] == codes[at + k + period]]
            if not at.size:
                break
        if at.size and _holds(codes, newline, period, need):
            return True
    return False


def has_runaway(text: str | None) -> bool:
    """A unit with a letter in it that runs away; the exact pattern is tried only where a period was found."""
    return text is not None and may_run_away(text) and any(LETTER.search(m[1]) for m in RUNAWAY.finditer(text))


def _tested(texts: pa.Array) -> pa.Array:
    """``has_runaway`` of each text. One text at a time leaves Arrow's buffers, so memory does not grow with the batch."""
    return pa.array((has_runaway(t.as_py()) for t in texts), pa.bool_())


@F.arrow_udf(T.BooleanType())
def _runaway(texts: pa.Array) -> pa.Array:
    return _tested(texts)


@F.arrow_udf(T.ArrayType(T.BooleanType()))
def _runaways(lists: pa.Array) -> pa.Array:
    """The test of each text of a list; null lists stay null."""
    return pa.ListArray.from_arrays(_offsets(lists), _tested(lists.flatten()))


def _offsets(lists: pa.Array) -> pa.Array:
    """Where lists end when they are put together, null where a list is null: what ``ListArray.from_arrays`` wants."""
    ends = np.cumsum([0, *(0 if n is None else n for n in lists.value_lengths().to_pylist())])
    return pa.array(ends, pa.int32(), mask=np.append(lists.is_null().to_numpy(zero_copy_only=False), False))


def _long_enough(c: Column) -> Column:
    return F.length(c) >= LEAST_UNIT * REPEATS


def runaway(texts: Column | str) -> Column:
    """Does something run away in the text? False for null. Texts that are too short for it do not go to Python."""
    c = F.col(texts) if isinstance(texts, str) else texts
    return _runaway(F.when(_long_enough(c), c))


def sanitize_math(texts: Column | str) -> Column:
    """Math spans that run away or do not close their environments become the placeholder; null stays null.

    Only spans that are long enough to run away go to Python, and only a list of answers comes back: the text is cut and
    put together by built-in functions.
    """
    c = F.col(texts) if isinstance(texts, str) else texts
    spans = matches(c, MATH)
    long_ones = lambda a: F.when(F.exists(a, _long_enough), F.transform(a, lambda m: F.when(_long_enough(m), m)))
    bad = F.coalesce(_runaways(let(spans, long_ones)), F.array().cast("array<boolean>"))
    unclosed = lambda m: count_of(m, "\\begin{") != count_of(m, "\\end{")
    sound = F.zip_with(spans, bad, lambda m, b: F.when(unclosed(m) | F.coalesce(b, F.lit(False)), PLACEHOLDER).otherwise(m))
    return F.array_join(F.zip_with(gaps(c, MATH), sound, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")


def batch_places(lengths: list[int], alone: list[bool], most: int) -> list[int]:
    """Batch of each paragraph times 2**32 plus its place there: batches are filled in order while the sum of lengths
    allows; a paragraph that stands alone closes the batch."""
    out, batch, used, place = [], -1, None, 0
    for length, single in zip(lengths, alone, strict=True):
        if single or used is None or used + length > most:
            batch, used, place = batch + 1, None if single else length, 0
        else:
            used, place = used + length, place + 1
        out.append((batch << 32) | place)
    return out
