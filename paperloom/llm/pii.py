"""Personal data in texts: sure patterns, and a bootstrapped search for identifiers that these do not know.

The matches of four sure patterns are seeds. The words around them are lexical patterns; other strings that look like
identifiers are unseen instances. Patterns and instances form a graph: a pattern's score for a kind is the share of its
instances that are of the kind, an instance's score the mean of its patterns' scores, and both are worked out in turns.
Instances that a high-confidence pattern holds are added. Everything is a DataFrame function; the texts are read once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.common import discard, hot_join, lower_ascii, text_or_empty, written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: The sure patterns, said so that each is linear in the text: a match can begin only where a run of its signs begins, and
#: runs are never given back. Counts of digits are in the pattern where a match is a whole run.
SURE = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
    r"\+[0-9](?:[ ().-]*+[0-9]){8,14}+(?![ ().-]*+[0-9])",
)
#: Four numbers of at most 255.
BYTES = r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})){3}$"
#: Strings that look like identifiers: addresses with odd parts or spelled-out signs, groups of hexadecimals, and 7 to 19
#: digits in groups.
LOOKS_LIKE = (
    r"(?<![^\s@<>()\[\]\"',;:])[^\s@<>()\[\]\"',;:]{1,64}+@[^\s@<>()\[\]\"',;:]{1,255}+",
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?:(?: ?[\[(] ?dot ?[\])] ?|\.)[A-Za-z0-9-]++)++",
    r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[ ().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])",
)
#: Everything that takes part in the graph, sure matches first. A match before it cannot be the anchor here.
ANY = "|".join((SURE[EMAIL].replace(r"\G|", ""), SURE[PHONE], SURE[IP], SURE[CARD], *LOOKS_LIKE))

#: Characters of context on either side of a match.
LEFT, RIGHT = 48, 32
#: Instances that a pattern needs besides its own to count half; rounds of scoring; scores of a pattern, and of an
#: instance over all its patterns, from which on an instance is added.
PRIOR, ROUNDS, SURE_PATTERN, SURE_INSTANCE = 2.0, 3, 0.8, 0.5

SCORES = ["s0", "s1", "s2", "s3"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def sums_before(numbers: Column) -> Column:
    """For each of an array's numbers the sum of those before it. Sums of stretches of about the root of the length come
    first, so an entry adds up two short lists."""
    n = F.size(numbers)
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
    total = lambda part: F.aggregate(part, F.lit(0), lambda acc, x: acc + x)

    def entries(w: Column) -> Column:
        stretches = F.sequence(F.lit(0), F.floor((n - 1) / w).cast("int"))
        sums = F.transform(stretches, lambda b: total(F.slice(numbers, b * w + 1, w)))
        return let(sums, lambda s: F.transform(F.sequence(F.lit(0), n - 1), lambda k: total(F.slice(s, F.lit(1), F.floor(k / w).cast("int"))) + total(F.slice(numbers, F.floor(k / w).cast("int") * w + 1, k % w))))

    return let(width, entries)


def located(text: Column, pattern: str, fields: Callable[[Column, Column, Column, Column], Column], empty: str) -> Column:
    """Array of ``fields(value, start, gap before, gap behind)`` of a pattern's matches; ``start`` counts code points."""

    def placed(found: Column, gaps: Column) -> Column:
        lengths = F.transform(found, lambda m, k: F.length(m) + F.length(F.get(gaps, k)))
        return let(sums_before_once(lengths), lambda before: F.transform(found, lambda m, k: fields(m, F.get(before, k) + F.length(F.get(gaps, k)), F.get(gaps, k), F.get(gaps, k + 1))))

    def sums_before_once(lengths: Column) -> Column:
        return let(lengths, sums_before)

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return let(matches, lambda found: F.when(F.size(found) > 0, let(F.split(text, pattern, -1), lambda gaps: placed(found, gaps))).otherwise(F.array().cast(empty)))


def luhn(digits: Column) -> Column:
    """Does the check digit of a string of digits fit?"""

    def add(acc: Column, k: Column) -> Column:
        d = F.substring(digits, -k, F.lit(1)).cast("int") * F.when(k % 2 == 0, 2).otherwise(1)
        return acc + d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def holds(kind: int, value: Column) -> Column:
    """What a match of a sure pattern must hold besides."""
    if kind == IP:
        return value.rlike(BYTES)
    return luhn(digits_of(value)) if kind == CARD else F.lit(True)


SPAN = "struct<kind:int,start:int,end:int>"


def sure_spans(text: Column) -> Column:
    """array<struct<kind,start,end>> of the sure matches, by kind, then by place."""
    hints = ("@", ".", None, "+")

    def one(kind: int) -> Column:
        found = located(text, SURE[kind], lambda m, start, _a, _b: F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value")), "array<struct<kind:int,start:int,end:int,value:string>>")
        good = F.transform(F.filter(found, lambda x: holds(kind, x["value"])), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
        return good if hints[kind] is None else F.when(F.contains(text, F.lit(hints[kind])), good).otherwise(F.array().cast(f"array<{SPAN}>"))

    return F.concat(*map(one, range(len(KINDS))))


FOUND = "array<struct<start:int,end:int,value:string,left:string,right:string>>"


def surrounded(text: Column) -> Column:
    """array<struct<start,end,value,left,right>> of all that looks like an identifier, with some text around it. The
    match before counts as the word `#`."""

    def fields(m: Column, start: Column, before: Column, behind: Column) -> Column:
        left = F.concat(F.when(F.length(before) < LEFT, F.lit("# ")).otherwise(F.lit("")), F.substring(before, -LEFT, LEFT))
        return F.struct(start.alias("start"), (start + F.length(m)).alias("end"), m.alias("value"), left.alias("left"), F.substring(behind, 1, RIGHT).alias("right"))

    return located(text, ANY, fields, FOUND)


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, base, found) of every document; all that comes later reads this table instead of the texts."""
    plain = docs.select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("_text"))
    return plain.select("_id", F.xxhash64("_text").alias("_h"), sure_spans(F.col("_text")).alias("base"), surrounded(F.col("_text")).alias("found"))


def _kind(value: Column) -> Column:
    """Kind of a sure match, null for what only looks like one."""
    whole = lambda k: value.rlike("^(?:" + SURE[k].replace(r"\G|", "") + ")$")
    return F.when(whole(EMAIL), EMAIL).when(whole(PHONE), PHONE).when(whole(IP) & holds(IP, value), IP).when(whole(CARD) & holds(CARD, value), CARD)


def occurrences(scanned: DataFrame) -> DataFrame:
    """(_id, _h, start, end, instance, seed, may, patterns): instances are compared by their digits, or lower-cased; ``may``
    has the kinds that an unseen one's form allows."""
    rows = scanned.select("_id", "_h", F.explode("found").alias("f")).select("_id", "_h", "f.*")
    digits = digits_of(F.col("value"))
    n = F.length(digits)
    named = F.col("value").rlike(r"[@\[A-Za-z]") | F.lower("value").rlike(r"\( ?at ?\)")
    colons = F.col("value").contains(":")
    kinds = F.when(colons, F.array(F.lit(IP))).when(named, F.array(F.lit(EMAIL))).otherwise(
        F.array_compact(F.array(F.when(n.between(12, 19) & luhn(digits), CARD), F.when(n.between(7, 15), PHONE)))
    )
    instance = F.when(colons | named, lower_ascii(F.col("value"))).otherwise(digits)
    word = lambda c: F.regexp_replace(lower_ascii(c), "[0-9]", "0")
    words = F.split(F.trim(F.regexp_replace(word(F.col("left")), r"\s+", " ")), " ")
    behind = F.get(F.split(F.trim(F.regexp_replace(word(F.col("right")), r"\s+", " ")), " "), F.lit(0))
    last, before = F.try_element_at(words, F.lit(-1)), F.coalesce(F.try_element_at(words, F.lit(-2)), F.lit(""))
    patterns = F.array(F.concat(last, F.lit(" _")), F.concat(before, F.lit(" "), last, F.lit(" _")), F.concat(last, F.lit(" _ "), behind))
    return rows.select("_id", "_h", "start", "end", instance.alias("instance"), _kind(F.col("value")).alias("seed"), kinds.alias("may"), patterns.alias("patterns"))


def _evidence(degree: Column) -> Column:
    """Weight of a pattern: what it holds besides one instance, against the prior."""
    return (degree - 1) / (degree - 1 + PRIOR)


def score_graph(seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(patterns with their scores, accepted instances with their kind), from ``occurrences``.

    Seeds keep their kind, so their part of a pattern's score is counted once; only the edges of unseen instances go
    through the rounds. Patterns and instances with very many edges are dealt over tasks.
    """
    edges = written(seen.select("instance", "seed", "may", F.explode("patterns").alias("pattern")).distinct(), "edges")
    known = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("degree"), *(F.count_if(F.col("seed") == k).cast("double").alias(f"k{k}") for k in range(len(KINDS))))
    open_edges = edges.where("seed is null and size(may) > 0").select("instance", "may", "pattern")
    degrees = open_edges.groupBy("instance", "may").agg(F.count(F.lit(1)).alias("patterns"))
    known = written(known, "patterns")
    linked = written(hot_join(open_edges, known.where("degree > 1"), "pattern", "degree", "instance"), "graph")
    scores = None
    for _ in range(ROUNDS):
        table = linked
        extra = [F.lit(0.0)] * len(KINDS)
        if scores is not None:
            table = hot_join(linked, scores.select("instance", "patterns", *SCORES), "instance", "patterns", "pattern").drop("patterns")
            sums = table.groupBy("pattern").agg(*(F.sum(s).alias(f"x{s}") for s in SCORES), F.first("degree").alias("many")).withColumnRenamed("pattern", "_p")
            table = hot_join(linked, sums.withColumnRenamed("_p", "pattern"), "pattern", "many", "instance").drop("many")
            extra = [F.col(f"x{s}") for s in SCORES]
        confidence = [(F.col(f"k{k}") + extra[k]) / (F.col("degree") + PRIOR) for k in range(len(KINDS))]
        weight = _evidence(F.col("degree"))
        allowed = [F.array_contains("may", k) for k in range(len(KINDS))]
        means = [F.when(allowed[k], F.sum(confidence[k] * weight) / F.sum(weight)).otherwise(0.0).alias(f"s{k}") for k in range(len(KINDS))]
        tops = [F.when(allowed[k], F.max(confidence[k])).otherwise(0.0).alias(f"t{k}") for k in range(len(KINDS))]
        fresh = written(table.groupBy("instance", "may").agg(F.count(F.lit(1)).alias("patterns"), *means, *tops), "scores")
        if scores is not None:
            discard(scores)
        scores = fresh
    sure = [(F.col(f"t{k}") >= SURE_PATTERN) & (F.col(f"s{k}") >= SURE_INSTANCE) for k in range(len(KINDS))]
    best = F.greatest(*(F.when(sure[k], F.struct(F.col(f"s{k}").alias("s"), F.lit(-k).alias("k"))) for k in range(len(KINDS))))
    accepted = scores.select("instance", (-best["k"]).alias("kind")).where("kind is not null")
    return known, accepted


def named_spans(spans: Column) -> Column:
    """`kind:start:end` of sorted spans, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone, base_sha256 (of the sure spans) and spans (all spans).

    Added spans never overlap sure ones. Null and empty texts have no spans, null ids stay, texts may have any length,
    rows that repeat give equal rows (an instance counts once for a pattern, however often it stands there), kinds that tie
    go to the first in order, other columns are ignored, an empty table gives an empty result. Of the texts only what
    looks like an identifier is written to the shared folder, with some characters around it.
    """
    scanned = written(scan(docs, id_col, text_col), "scanned")
    seen = written(occurrences(scanned), "seen")
    patterns, accepted = score_graph(seen)
    times = seen.where("seed is null").groupBy("instance").agg(F.count(F.lit(1)).alias("times"))
    table = written(accepted.join(times, "instance"), "accepted")
    where = hot_join(seen.where("seed is null").select("_id", "_h", "start", "end", "instance"), table, "instance", "times", "start")
    span = F.struct("kind", "start", "end")
    added = where.select(F.col("_id").alias("_i"), F.col("_h").alias("_t"), span.alias("span")).distinct().groupBy("_i", "_t").agg(F.collect_list("span").alias("added"))
    rows = scanned.groupBy("_id", "_h", "base").agg(F.count(F.lit(1)).alias("_n"))
    both = rows.join(added, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_t")), "left")
    base = F.col("base")
    free = F.filter("added", lambda a: ~F.exists(base, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
    spans = F.when(F.col("added").isNull(), base).otherwise(F.array_sort(F.concat(base, free)))
    of_kind = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return both.select(F.col("_id").alias(id_col), *counts, F.sha2(named_spans(base), 256).alias("base_sha256"), named_spans(spans).alias("spans"), F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_copy")).drop("_copy")


def learned_patterns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """pattern, degree (distinct instances) and email, ip, card, phone: the seeds' share of them against the prior."""
    patterns = score_graph(occurrences(scan(docs, id_col, text_col)))[0]
    return patterns.select("pattern", "degree", *((F.col(f"k{k}") / (F.col("degree") + PRIOR)).alias(name) for k, name in enumerate(KINDS)))
