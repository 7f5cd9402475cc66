"""Quality tests on (source, translation) pairs: true means bad unless the name says otherwise.

The target script and the function words are parameters, so another language pair needs no other code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperloom.functions.markdown import TABLE_ROW
from paperloom.functions.spans import MATH, count_of, matches
from paperloom.functions.vectorized import runaway

SCRIPT = "[가-힣]"
#: Phrases of a refusal. Fixed values.
REFUSALS = (
    "i'm sorry, but i can't",
    "i'm sorry, but i cannot",
    "i am sorry, but i can't",
    "i am sorry, but i cannot",
    "i can't help with that",
    "i cannot help with that",
    "i can't help with this",
    "i cannot assist with",
    "as an ai language model",
    "i'm not able to help",
    "i am not able to help",
)
#: English function words. Fixed values.
FUNCTION_WORDS = ("the", "and", "of", "is", "are", "in", "to", "with", "for", "on", "that", "this", "from", "by", "as", "we", "our", "which", "its", "be", "can", "not")
#: Thresholds. Fixed values.
LEAST_SOURCE, LEAST_WORDS, LEAST_SCRIPT = 100, 5, 5
RUN_CHARS, RUN_WORDS, RUN_FUNCTION_WORDS = 100, 10, 3
#: Patterns. Fixed values.
WORD = "[a-zA-Z]{3,}"
ADDRESS = "(?i)https?://|doi:|arxiv:"
BLANK_MARKER = r"(?imUd)^\s*[\(\[]\s*blank\s*line\s*[\)\]]\s*$"
TABLE_RULE = r"(?U)^\s*\|?\s*:?-+:?\s*(\|\s*:?-+:?\s*)*\|?\s*$"
ENTRY_START = r"(?U)^[-*]?\s*\[\d+\]"
ITEM_START = r"(?U)^[-*]\s"
YEAR = r"\((?:19|20)\d{2}[a-z]?\)"
DATED_LINK = r"\[[^\]]*(?:19|20)\d{2}[^\]]*\]\([^)]+\)"
#: Codes of the tests in their order, and those after which a response is never used. Fixed values.
CODES = ("untranslated", "untranslated_run", "dollar_mismatch", "brace_mismatch", "runaway_repetition", "blank_line_marker")
NEVER_ADOPT = CODES[2:]


def without_math(c: Column) -> Column:
    return F.regexp_replace(c, MATH, " ")


def is_refusal(response: Column) -> Column:
    text = F.replace(F.lower(response), F.lit("’"), F.lit("'"))
    found = F.lit(False)
    for phrase in REFUSALS:
        found = found | text.contains(phrase)
    return found


def dollar_mismatch(source: Column, response: Column) -> Column:
    return count_of(source, "$") != count_of(response, "$")


def brace_mismatch(source: Column, response: Column) -> Column:
    """Braces inside math spans, opening and closing ones each for itself."""
    a, b = (F.array_join(matches(c, MATH), "") for c in (source, response))
    return (count_of(a, "{") != count_of(b, "{")) | (count_of(a, "}") != count_of(b, "}"))


def is_table(c: Column) -> Column:
    """True for two lines or more that are all rows, the second one a rule."""
    lines = F.filter(F.split(c, "\n", -1), lambda x: x.rlike(r"(?U)\S"))
    return (F.size(lines) >= 2) & F.forall(lines, lambda x: x.rlike(TABLE_ROW)) & F.coalesce(F.get(lines, F.lit(1)).rlike(TABLE_RULE), F.lit(False))


def is_reference(source: Column) -> Column:
    """True for entries of a reference list, which may stay as they are."""
    first = F.substring_index(F.regexp_replace(source, r"(?U)^\s+", ""), "\n", 1)
    numbered = first.rlike(ENTRY_START) & (source.rlike(YEAR) | source.rlike(DATED_LINK) | source.rlike(ADDRESS))
    many = (F.regexp_count(source, F.lit(DATED_LINK)) >= 3) | (F.regexp_count(source, F.lit(YEAR)) >= 3)
    return numbered | (first.rlike(ITEM_START) & many)


def is_untranslated(source: Column, response: Column, script: str = SCRIPT) -> Column:
    plain = without_math(response)
    return (
        F.when(is_refusal(response), True)
        .when(F.length(without_math(source)) < LEAST_SOURCE, False)
        .when(is_reference(source), False)
        .when(F.regexp_count(plain, F.lit(WORD)) < LEAST_WORDS, False)
        .otherwise(F.regexp_count(plain, F.lit(script)) < LEAST_SCRIPT)
    )


def has_untranslated_run(source: Column, response: Column, script: str = SCRIPT, words: tuple[str, ...] = FUNCTION_WORDS) -> Column:
    """A long stretch without target script that reads like sentences."""
    function_word = rf"(?iU)\b(?:{'|'.join(words)})\b"

    def bad(run: Column) -> Column:
        long = (F.length(run) >= RUN_CHARS) & (F.regexp_count(run, F.lit(WORD)) >= RUN_WORDS)
        return long & ~run.rlike(ADDRESS) & (F.regexp_count(run, F.lit(function_word)) >= RUN_FUNCTION_WORDS)

    return F.when(is_table(source) | is_reference(source), False).otherwise(F.exists(F.split(without_math(response), f"{script}+", -1), bad))


def blank_marker(response: Column) -> Column:
    return response.rlike(BLANK_MARKER)


def fail_code(source: Column, response: Column) -> Column:
    """The first test that a response fails, null where it passes."""
    return (
        F.when(is_untranslated(source, response), CODES[0])
        .when(has_untranslated_run(source, response), CODES[1])
        .when(dollar_mismatch(source, response), CODES[2])
        .when(brace_mismatch(source, response), CODES[3])
        .when(runaway(response), CODES[4])
        .when(blank_marker(response), CODES[5])
    )
