"""Verdicts over batches and attempts, and gloss statistics of whole documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.glosses import is_term
from paperloom.functions.parallel import NEVER_ADOPT
from paperloom.functions.strings import strip

#: Bad responses after which an item is given up, and attempts in all. Fixed values.
BAD_ATTEMPTS, MOST_ATTEMPTS = 5, 12
#: A line that opens a fence, up to the line that closes it or the end. Fixed value.
FENCE_LINES = r"(?Umsd)^[\s&&[^\n]]*```(?:.*?\n[\s&&[^\n]]*```[^\n]*$|.*\z)"


def batch_verdict(items: DataFrame) -> DataFrame:
    """(doc_id, batch_index, path, fail_code) to one row per batch: bad items and ``partial_bad:<n>`` or null."""
    bad = F.count_if(F.col("fail_code").isNotNull())
    return items.groupBy("doc_id", "batch_index", "path").agg(bad.alias("bad")).withColumn("verdict", F.when(F.col("bad") > 0, F.concat(F.lit("partial_bad:"), F.col("bad").cast("string"))))


def retry_items(items: DataFrame) -> DataFrame:
    return items.where("fail_code is not null")


def resolve_attempts(attempts: DataFrame, key: tuple[str, ...] = ("doc_id", "item_index")) -> DataFrame:
    """(key, attempt, response, fail_code, source) to (key, text, outcome).

    In order of attempts, as long as fewer than BAD_ATTEMPTS were bad: the first response that passed; else the source
    if any bad one had a never-adopt code; else the last bad response; only exceptions (``exception:…``): an error.
    Attempts are chosen by number on rows without texts; only the chosen attempt's texts are joined. Attempts that share a
    number come in order of a hash of their texts.
    """
    tie = F.xxhash64("response", "fail_code", "source")
    narrow = attempts.select(*key, "attempt", "fail_code", tie.alias("_tie"))
    order = Window.partitionBy(*key).orderBy("attempt", "_tie")
    failed = F.col("fail_code").isNotNull()
    exception = F.coalesce(F.col("fail_code").startswith("exception:"), F.lit(False))
    bad = failed & ~exception
    counted = narrow.withColumns(
        {
            "_bad": bad,
            "_before": F.coalesce(F.sum(bad.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_no": F.row_number().over(order),
        }
    ).where((F.col("_before") < BAD_ATTEMPTS) & (F.col("_no") <= MOST_ATTEMPTS))
    here = F.struct("attempt", "_tie")
    chosen = counted.groupBy(*key).agg(
        F.min(F.when(~failed, here)).alias("_passed"),
        F.bool_or(F.col("_bad") & F.col("fail_code").isin(*NEVER_ADOPT)).alias("_never"),
        F.max(F.when(F.col("_bad"), here)).alias("_last"),
        F.min(here).alias("_first"),
    )
    outcome = F.when(F.col("_passed").isNotNull(), "passed").when(F.col("_never"), "source_kept").when(F.col("_last").isNotNull(), "last_bad").otherwise("error")
    pick = F.when(F.col("outcome") == "source_kept", F.col("_first")).otherwise(F.coalesce("_passed", "_last", "_first"))
    picked = chosen.withColumn("outcome", outcome).select(*(F.col(k).alias(f"_{k}") for k in key), "outcome", pick.alias("_pick"))
    same = (F.col("attempt") == F.col("_pick.attempt")) & (tie == F.col("_pick._tie"))
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    text = F.when(F.col("outcome") == "source_kept", F.col("source")).when(F.col("outcome") != "error", F.col("response"))
    repeats = Window.partitionBy(*key).orderBy("attempt")  # rows that repeat in full
    out = attempts.select(*key, "attempt", "response", "fail_code", "source").join(picked, same).withColumn("_no", F.row_number().over(repeats)).where("_no = 1")
    return out.select(*key, text.alias("text"), "outcome")


def gloss_stats(df: DataFrame) -> DataFrame:
    """(doc_id, md) to (doc_id, term, occurrences, removed) of the terms whose gloss repeats.

    Fences, from a line that opens one to the line that closes it or the end of the text, are cut out first.
    """
    lines = F.split(F.regexp_replace("md", FENCE_LINES, ""), "\n", -1)
    kept = F.filter(lines, lambda x: x.contains("(") & ~x.rlike(r"(?U)^\s*#"))
    found = F.flatten(F.transform(kept, lambda x: F.regexp_extract_all(x, F.lit(r"(?<=[가-힣]) ?\(([^()\n]{1,80})\)"), 1)))
    terms = df.select("doc_id", F.posexplode(found).alias("pos", "raw")).select("doc_id", "pos", strip(F.col("raw")).alias("term")).where(is_term(F.col("term")))
    return (
        terms.groupBy("doc_id", F.lower("term").alias("_key"))
        .agg(F.min_by("term", "pos").alias("term"), F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
        .select("doc_id", "term", "occurrences", (F.col("occurrences") - 1).alias("removed"))
    )
