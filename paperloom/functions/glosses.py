"""Repeated glosses cut out of a document by built-in functions alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.spans import gaps, let, matches
from paperloom.functions.strings import strip

#: Blank signs at a line's beginning, a fence from the line that opens it to the line that closes it or the end, a heading,
#: and a gloss in brackets behind a Hangul character. Fixed values.
_INDENT = r"^[\s&&[^\n]]*"
FENCE = _INDENT + r"```(?:.*?\n[\s&&[^\n]]*```[^\n]*$|.*\z)"
HEADING = _INDENT + r"#[^\n]*"
GLOSS = r"(?<=[가-힣]) ?\([^()\n]{1,80}\)"
#: One pass meets all three in order; a gloss inside a fence or heading is part of it.
ANY = f"(?Umsd){FENCE}|{HEADING}|{GLOSS}"


def is_term(term: Column) -> Column:
    """Two characters and more, with a Latin letter, no citation, no math and no code."""
    citation = term.rlike(r"(?i)(?:19|20)\d{2}[a-z]?|et al")
    return (F.length(term) >= 2) & term.rlike("[a-zA-Z]") & ~citation & ~term.rlike(r"[$\\`]")


def _repeats(found: Column) -> Column:
    """For each match, in order: is it a gloss whose term an earlier one has? Matches are sorted by term and place, so a
    repeat stands behind its like; the work is that of two sorts."""
    term = lambda m: strip(F.regexp_extract(m, r"^ ?\((.*)\)$", 1))
    key = lambda m, k: F.when(m.rlike(r"^ ?\(") & is_term(term(m)), F.lower(term(m))).otherwise(F.concat(F.lit("\n"), k.cast("string")))
    places = F.array_sort(F.transform(found, lambda m, k: F.struct(key(m, k).alias("key"), k.alias("place"))))
    told = let(places, lambda rows: F.transform(rows, lambda x, k: F.struct(x["place"].alias("place"), F.coalesce((k > 0) & (F.get(rows, k - 1)["key"] == x["key"]), F.lit(False)).alias("again"))))
    return F.transform(F.array_sort(told), lambda x: x["again"])


def dedup_glosses(c: Column) -> Column:
    """Only the first gloss of a term stays, with its spelling; later ones go with the blank before them. Fences, headings,
    citations, math and code are left alone. Null stays null."""

    def woven(found: Column) -> Column:
        kept = F.zip_with(found, _repeats(found), lambda m, again: F.when(again, F.lit("")).otherwise(m))
        return F.array_join(F.zip_with(gaps(c, ANY), kept, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")

    return let(matches(c, ANY), lambda found: F.when(F.size(found) > 1, woven(found)).otherwise(c))
