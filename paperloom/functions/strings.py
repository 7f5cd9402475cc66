"""Column functions on ids, names and short texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SLUG_CHARS, NAV_CHARS = 60, 40
#: Category code, name and folder, in the order of the weekly run. Fixed values.
CATEGORIES = (("cs.CL", "nlp"), ("cs.CV", "vision"), ("cs.LG", "ml"), ("cs.AI", "ai"), ("cs.RO", "robotics"))


def strip(c: Column) -> Column:
    """Trim white space of any kind, not blanks alone."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def canonical_id(c: Column) -> Column:
    """The part behind the last slash without a version at its end."""
    return F.regexp_replace(F.substring_index(strip(c), "/", -1), r"v\d+$", "")


def collapse_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def slugify(c: Column, most: int = SLUG_CHARS) -> Column:
    dashed = F.lower(F.regexp_replace(F.regexp_replace(c, "[^a-zA-Z0-9]+", "-"), "^-+|-+$", ""))
    return F.regexp_replace(F.substring(dashed, 1, most), "-+$", "")


def truncate_title(c: Column, most: int = NAV_CHARS) -> Column:
    return F.when(F.length(c) > most, F.concat(F.regexp_replace(F.substring(c, 1, most), r"(?U)\s+$", ""), F.lit("…"))).otherwise(c)


def category_dir(c: Column) -> Column:
    """Folder of a category; an unknown code with its dots replaced."""
    known = F.create_map(*(F.lit(x) for pair in CATEGORIES for x in pair))
    return F.coalesce(F.try_element_at(known, c), F.replace(c, F.lit("."), F.lit("_")))


def page_stem(day: Column, id_: Column, title: Column) -> Column:
    return F.concat_ws("-", day.cast("string"), id_, slugify(title))


def page_url(base: str, day: Column, category: Column, id_: Column, title: Column) -> Column:
    """Address of a published page; the site's own where the page has no date."""
    site = base.rstrip("/")
    return F.when(day.isNull(), F.lit(site)).otherwise(F.concat(F.lit(f"{site}/"), category_dir(category), F.lit("/"), page_stem(day, id_, title), F.lit("/")))


def prompt_hash(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 12)


def cache_key(text: Column, prompt: Column, model: Column, temperature: Column) -> Column:
    """Content key; null where a part is null. Carry the temperature as the string that was logged."""
    nul = F.lit("\0")
    return F.sha2(F.concat(text, nul, prompt, nul, model, nul, temperature), 256)
