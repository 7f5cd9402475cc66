"""The re-split cascade: refused batches are halved until every part has a usable answer, and documents come back in order.

A batch is the root of a binary tree. A node is a run of the batch's items, told by its path (`0`, `0.L`, `0.L.R` …), the
place of its first item in the batch and their number. Only these narrow rows go through the rounds; items and answers
are joined to the nodes at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.operators.chunking import answer_parts, batch_input, count_parts
from paperloom.operators.latest import last_rows
from paperloom.sources.tables import discard, written

BATCH = ["doc_id", "batch_index"]
NODE = [*BATCH, "path"]


def verdicts(answers: DataFrame) -> DataFrame:
    """(node, attempt, tie, finish_reason, parts): of each node's answers the last one, by a hash in place of its text.
    ``answers`` has (doc_id, batch_index, path, attempt, response, finish_reason) and is read once; null responses
    (exceptions) are no answers."""
    parts = count_parts(F.col("response")).alias("parts")
    told = written(answers.where("response is not null").select(*NODE, "attempt", _tie().alias("tie"), "finish_reason", parts), "told")
    return last_rows(told, NODE, ["attempt", "tie"])


def _tie() -> Column:
    return F.xxhash64("response", "finish_reason")


def cascade(batches: DataFrame, answers: DataFrame) -> DataFrame:
    """(doc_id, batch_index, path, start, n, attempt, tie, state) of every node that the cascade reaches; attempt and tie tell
    the answer that was judged.

    States: ``asked`` (no answer yet), ``fits``, ``split`` (cut off, or another number of parts than items) and ``error`` (a
    single item that was cut off: there is nothing left to halve). A single item's answer is never split into parts. The
    frontier of unsettled nodes meets the answers once a round and its lineage is cut by writing it; a batch of n items
    takes at most ceil(log2 n) + 1 rounds. Answers of nodes that are not reached are ignored, batches without items
    have no nodes. Parts are halved as n div 2 and the rest.
    """
    known = written(verdicts(answers).withColumn("depth", F.regexp_count("path", F.lit(r"\."))), "verdicts")
    cut, wrong = F.col("finish_reason") == "length", F.col("parts") != F.col("n")
    state = (
        F.when(F.col("attempt").isNull(), "asked")
        .when((F.col("n") == 1) & F.coalesce(cut, F.lit(False)), "error")
        .when((F.col("n") > 1) & (F.coalesce(cut, F.lit(False)) | wrong), "split")
        .otherwise("fits")
    )
    half = F.floor(F.col("n") / 2).cast("int")
    side = lambda name, start, n: F.struct(F.concat("path", F.lit(name)).alias("path"), start.alias("start"), n.cast("int").alias("n"))
    halves = F.array(side(".L", F.col("start"), half), side(".R", F.col("start") + half, F.col("n") - half))
    frontier = batches.where(F.size("items") > 0).select(*BATCH, F.col("batch_index").cast("string").alias("path"), F.lit(0).alias("start"), F.size("items").alias("n"))
    done = []
    while True:
        told = known.where(F.col("depth") == len(done)).drop("depth")  # a round's nodes lie at one depth
        settled = written(frontier.join(told, NODE, "left").select(*NODE, "start", "n", "attempt", "tie", state.alias("state")), "frontier")
        done.append(settled)
        split = settled.where("state = 'split'")
        if split.isEmpty():
            break
        frontier = split.select(*BATCH, F.explode(halves).alias("x")).select(*BATCH, "x.path", "x.start", "x.n")
    discard(known)
    out = done[0]
    for some in done[1:]:
        out = out.unionByName(some)
    return out


def cascade_work(batches: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, batch_index, path, start, items, input) of the nodes that wait for an answer."""
    asked = nodes.where("state = 'asked'").select(*NODE, "start", "n")
    items = asked.join(batches.select(*BATCH, "items"), BATCH)
    return items.select(*NODE, "start", F.slice("items", F.col("start") + 1, F.col("n")).alias("items")).withColumn("input", batch_input(F.col("items")))


def cascade_items(batches: DataFrame, answers: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, batch_index, item_index, path, source, response) of the nodes that fit.

    ``item_index`` is the item's place in its whole batch, so items of different halves never meet under one number and
    order alone puts a batch together again. A single item's response stays as it is, parts of others are trimmed.
    """
    fits = nodes.where("state = 'fits'").select(*NODE, "start", "n", "attempt", "tie")
    parts = F.when(F.col("n") == 1, F.array("response")).otherwise(answer_parts(F.col("response")))
    same = [*NODE, "attempt", "tie"]
    chosen = answers.where("response is not null").select(*NODE, "attempt", _tie().alias("tie"), "response").join(fits, same)
    first = F.row_number().over(Window.partitionBy(*same).orderBy("start"))  # answers that repeat in full are one
    told = chosen.withColumn("_no", first).where("_no = 1").select(*NODE, "start", "n", parts.alias("parts"))
    both = told.join(batches.select(*BATCH, "items"), BATCH)
    pairs = F.arrays_zip(F.slice("items", F.col("start") + 1, F.col("n")).alias("source"), F.col("parts").alias("response"))
    rows = both.select(*NODE, "start", F.posexplode(pairs).alias("k", "x"))
    return rows.select(*BATCH, (F.col("start") + F.col("k")).alias("item_index"), "path", F.col("x.source").alias("source"), F.col("x.response").alias("response"))


def reassemble(batches: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, md) of the documents of whose batches every item is there, in order of batch and item.

    ``items`` has (doc_id, batch_index, item_index, text) and is read once. Documents with a gap are left out.
    """
    wanted = batches.groupBy("doc_id").agg(F.sum(F.size("items")).alias("wanted"))
    ordered = F.array_sort(F.collect_list(F.struct("item_index", "text")))
    texts = items.groupBy(*BATCH).agg(F.array_join(ordered["text"], "\n\n").alias("text"), F.count(F.lit(1)).alias("there"))
    in_order = F.array_sort(F.collect_list(F.struct("batch_index", "text")))
    documents = texts.groupBy("doc_id").agg(F.array_join(in_order["text"], "\n\n").alias("md"), F.sum("there").alias("there"))
    return documents.join(wanted, "doc_id").where("wanted = there").select("doc_id", "md")
