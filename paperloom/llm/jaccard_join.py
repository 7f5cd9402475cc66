"""Near-duplicate join on word shingles by Bayesian candidate pruning.

MinHash bands propose pairs; their MinHash values are compared a few at a time and a pair is dropped as soon as the
posterior probability that its Jaccard similarity reaches the threshold is below the tolerance; what is left is
verified exactly on the shingle sets. Documents with equal sets are one class throughout. No step emits the pairs of a
group: candidates leave as a spanning forest, verified links as counts and a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm.arrow_groups import group_edges, text_runs, whole_groups
from paperloom.llm.common import hot_join, small_batches, text_or_empty, written
from paperloom.llm.components import components
from paperloom.llm.shingles import Forest, Intersections, least_matches, minhashes, set_keys, shingle_sets, surviving_groups, survivors
from paperloom.llm.text_stats import mixed

THRESHOLD, TOLERANCE = 0.8, 1e-6
#: MinHash values of a document, bands and values in a band: a pair at the threshold shares no band once in 3e7.
HASHES, BANDS, ROWS = 128, 24, 3
STEPS = range(16, HASHES + 1, 16)
#: Rows of a bucket, and shingles and rows of a family of candidates, that one task compares; larger ones are dealt in pairs of blocks.
BUCKET_ROWS, FAMILY_SHINGLES, FAMILY_ROWS = 4096, 1 << 20, 4096
#: A family of more than LEAST_ROWS rows is dealt in BLOCKS blocks, as long as these have between LEAST_ROWS and FAMILY_ROWS rows.
LEAST_ROWS, BLOCKS = 128, 16
#: Rows of a bucket of several blocks that all its rows are compared with before any blocks are dealt.
PIVOTS = 32
CHUNK_BYTES = 1 << 20
#: Surviving pairs of a block that are verified at once.
PAIRS = 1 << 17


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for texts in text_runs(batch.column(1).cast(pa.binary()).to_pylist(), CHUNK_BYTES):
            values, sizes = shingle_sets(texts)
            low = minhashes(values, sizes, HASHES)
            bands = np.zeros((len(texts), BANDS), np.uint64)
            for k in range(ROWS):
                bands = mixed(bands + low[:, k : BANDS * ROWS : ROWS] + np.arange(BANDS, dtype=np.uint64))
            small = ((low >> np.uint64(13)) & np.uint64(255)).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(done, len(texts)),
                    pa.array(set_keys(values, sizes)),
                    pa.array(sizes, pa.int64()),
                    pa.array(list(bands.astype(np.int64)), pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in small], pa.binary()),
                ],
                names=["_id", "key", "n", "bands", "sig"],
            )
            done += len(texts)


def _dealt(df: DataFrame, key: str, blocks: Column) -> DataFrame:
    """Rows of a group in so many blocks by hash, each row once for every pair of blocks (a, b) that has its block."""
    return (
        df.withColumn("_blocks", blocks.cast("int"))
        .withColumn("_mine", F.pmod(F.xxhash64("key"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumns({"a": F.least("_mine", "_other"), "b": F.greatest("_mine", "_other")})
        .drop("_blocks", "_other")
        .repartition(key, "a", "b")
        .sortWithinPartitions(key, "a", "b")
    )


def _crowded(buckets: DataFrame) -> DataFrame:
    """(band, key, rows): the rows (key, band) of buckets with two or more of them."""
    crowded = written(buckets.groupBy("band").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "buckets")
    return hot_join(buckets, crowded, "band", "rows", "key").select("band", "key", "rows")


def _compared_with_pivots(large: DataFrame, table: list[tuple[int, int]]) -> DataFrame:
    """(band, key, sig, mask): of the bucket's PIVOTS rows with the smallest hashes those that a row survives with, as bits.

    A bucket is read in shares of BUCKET_ROWS rows; its pivots are copied to each.
    """
    order = Window.partitionBy("band").orderBy(F.xxhash64("key"), "key")
    shares = F.ceil(F.col("rows") / BUCKET_ROWS).cast("int")
    pivots = large.withColumn("pivot", F.row_number().over(order) - 1).where(F.col("pivot") < PIVOTS)
    copies = pivots.select("band", F.explode(F.sequence(F.lit(0), shares - 1)).alias("share"), "pivot", "key", "sig")
    rows = large.select("band", F.pmod(F.xxhash64("key"), shares).cast("int").alias("share"), F.lit(PIVOTS).alias("pivot"), "key", "sig")
    together = copies.unionByName(rows).repartition("band", "share").sortWithinPartitions("band", "share", "pivot")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in whole_groups(batches, 2):
            firsts = group_edges(found, 2)
            sigs = np.frombuffer(b"".join(found.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
            pivot = found.column("pivot").to_numpy()
            masks = np.zeros(len(sigs), np.int64)
            for start, end in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
                first = start + int((pivot[start:end] < PIVOTS).sum())
                for k in range(start, first):
                    hit = first + survivors(np.broadcast_to(sigs[k], (end - first, HASHES)), sigs[first:end], table)
                    masks[hit] |= 1 << int(pivot[k])
            rows = pa.array(np.flatnonzero(pivot == PIVOTS))
            yield pa.RecordBatch.from_arrays([found.column(c).combine_chunks().take(rows) for c in ("band", "key", "sig")] + [pa.array(masks).take(rows)], names=["band", "key", "sig", "mask"])

    return together.select("band", "share", "pivot", "key", "sig").mapInArrow(run, "band long, key long, sig binary, mask long")


def _divided(large: DataFrame, table: list[tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """(edges, rows dealt in pairs of blocks) for buckets of several blocks.

    The rows that survive with the bucket's most popular pivot hang together through it: these edges are given out and the
    pairs among them need no look. All other pairs are dealt: the rest with itself and with what hangs together. So no
    surviving pair between two groups is missed, and a family of near copies costs one comparison with each pivot a row.
    """
    masked = written(_compared_with_pivots(large, table), "masks")
    bit = lambda k: F.expr(f"shiftright(mask, {k}) & 1")
    counts = masked.groupBy("band").agg(F.count(F.lit(1)).alias("all"), *(F.sum(bit(k)).alias(f"p{k}") for k in range(PIVOTS)))
    best = F.greatest(*(F.struct(F.col(f"p{k}").alias("n"), F.lit(-k).alias("k")) for k in range(PIVOTS)))
    counts = written(counts.select("band", "all", best.alias("best")).select("band", "all", F.col("best.n").alias("hung"), (-F.col("best.k")).alias("pivot")), "hubs")
    flagged = written(hot_join(masked, counts, "band", "all", "key").withColumn("hangs", F.expr("shiftright(mask, pivot) & 1") == 1).drop("mask"), "flagged")
    number = F.row_number().over(Window.partitionBy("band").orderBy(F.xxhash64("key"), "key")) - 1
    pivots = masked.select("band", "key", number.alias("no")).where(F.col("no") < PIVOTS)
    hubs = counts.join(pivots, "band").where("no = pivot").select("band", F.col("key").alias("hub"), "all")
    edges = hot_join(flagged.where("hangs").select("band", "key"), hubs, "band", "all", "key").select(F.col("key").alias("u"), F.col("hub").alias("v"))
    blocks = lambda n: F.ceil(n / BUCKET_ROWS).cast("int")
    rest, held = blocks(F.col("all") - F.col("hung")), blocks(F.col("hung"))
    mine = F.when(F.col("hangs"), rest + F.pmod(F.xxhash64("key"), F.greatest(held, F.lit(1)))).otherwise(F.pmod(F.xxhash64("key"), F.greatest(rest, F.lit(1)))).cast("int")
    others = F.when(F.col("hangs") & (rest == 0), F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.when(F.col("hangs"), rest).otherwise(rest + held) - 1))
    pairs = flagged.select("band", "key", "sig", mine.alias("_mine"), F.explode(others).alias("_other"))
    return edges, pairs.select("band", F.least("_mine", "_other").alias("a"), F.greatest("_mine", "_other").alias("b"), "key", "sig")


def candidate_edges(classes: DataFrame, table: list[tuple[int, int]]) -> DataFrame:
    """(u, v): a spanning forest, bucket by bucket, of the pairs that share a band and survive the pruning."""
    crowded = written(_crowded(classes.select("key", F.explode("bands").alias("band"))), "crowded")
    rows = crowded.join(classes.select("key", "sig"), "key")
    dealt, hung = rows.where(F.col("rows") <= BUCKET_ROWS).select("band", F.lit(0).alias("a"), F.lit(0).alias("b"), "key", "sig"), None
    if crowded.where(F.col("rows") > BUCKET_ROWS).limit(1).count():
        hung, more = _divided(written(rows.where(F.col("rows") > BUCKET_ROWS), "large"), table)
        dealt = dealt.unionByName(more)
    small = 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in whole_groups(batches, 3):
            firsts = group_edges(found, 3)
            keys = found.column("key").to_numpy()
            sigs = np.frombuffer(b"".join(found.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
            counts = np.diff(firsts)
            group = np.repeat(np.arange(counts.size), counts)
            little = np.repeat(counts <= small, counts)
            u, v = [], []
            for step in range(1, small):
                at = np.flatnonzero((group[step:] == group[:-step]) & little[step:])
                if not at.size:
                    break
                at = at[survivors(sigs[at], sigs[at + step], table)]
                u.append(keys[at])
                v.append(keys[at + step])
            for g in np.flatnonzero(counts > small).tolist():
                a, b = firsts[g], firsts[g + 1]
                root = surviving_groups(sigs[a:b], table)
                moved = np.flatnonzero(root != np.arange(b - a))
                u.append(keys[a:b][moved])
                v.append(keys[a:b][root[moved]])
            u, v = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (u, v))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    found = dealt.repartition("band", "a", "b").sortWithinPartitions("band", "a", "b").mapInArrow(run, "u long, v long")
    return found if hung is None else found.unionByName(hung)


def _surviving_pairs(mine: np.ndarray, a: int, b: int, sizes: np.ndarray, sigs: np.ndarray, table: list[tuple[int, int]], threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of a block (or of its two blocks) whose sizes and MinHash values allow the threshold, PAIRS and less than a block's rows more at a time."""
    lefts, rights, held = [], [], 0
    second = np.flatnonzero(mine == b)
    for k in range(len(mine)):
        others = second if a != b and mine[k] == a else np.arange(k + 1, len(mine)) if a == b else second[:0]
        # similarity cannot exceed the ratio of the sizes
        others = others[np.minimum(sizes[others], sizes[k]) >= threshold * np.maximum(sizes[others], sizes[k])]
        if others.size:
            others = others[survivors(np.broadcast_to(sigs[k], (others.size, HASHES)), sigs[others], table)]
            lefts.append(np.full(others.size, k))
            rights.append(others)
            held += others.size
        if held >= PAIRS:
            yield np.concatenate(lefts), np.concatenate(rights)
            lefts, rights, held = [], [], 0
    if held:
        yield np.concatenate(lefts), np.concatenate(rights)


def verified_links(members: DataFrame, table: list[tuple[int, int]], threshold: float) -> DataFrame:
    """(u, v, links): for each class u with links in a block pair of its family, how many documents it is linked to there
    and v, the root of its tree in a spanning forest of the links.

    members: family, family_shingles, family_rows, key, copies, sig, text. A block's surviving pairs are verified PAIRS at
    a time, so memory is linear in the block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in whole_groups(batches, 3):
            firsts = group_edges(found, 3)
            for g in range(firsts.size - 1):
                part = found.slice(firsts[g], firsts[g + 1] - firsts[g])
                keys = part.column("key").to_numpy()
                held = [shingle_sets(t) for t in text_runs(part.column("text").cast(pa.binary()).to_pylist(), CHUNK_BYTES)]
                values, sizes = (np.concatenate(x) for x in zip(*held, strict=True))
                own = set_keys(values, sizes)
                # an id that stands for several texts brought them all: keep the class's own, once
                first = np.zeros(len(keys), bool)
                first[np.unique(keys, return_index=True)[1]] = True
                if not ((own == keys) & first).all():
                    good = np.flatnonzero(own == keys)
                    good = good[np.unique(keys[good], return_index=True)[1]]
                    chosen = np.zeros(len(keys), bool)
                    chosen[good] = True
                    values, sizes, keys = values[np.repeat(chosen, sizes)], sizes[chosen], keys[chosen]
                    part = part.take(pa.array(np.flatnonzero(chosen)))
                n = len(keys)
                mine, copies = part.column("_mine").to_numpy(), part.column("copies").to_numpy()
                a, b = part.column("a")[0].as_py() if n else 0, part.column("b")[0].as_py() if n else 0
                sigs = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint8).reshape(-1, HASHES)
                links, forest, shared = np.zeros(n, np.int64), Forest(n), Intersections(values, sizes)
                for left, right in _surviving_pairs(mine, a, b, sizes, sigs, table, threshold):
                    both = shared.of(left, right)
                    near = both >= threshold * (sizes[left] + sizes[right] - both) - 1e-9
                    left, right = left[near], right[near]
                    np.add.at(links, left, copies[right])
                    np.add.at(links, right, copies[left])
                    forest.join_all(left, right)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(keys[forest.roots()[some]] if n else keys[some]), pa.array(links[some])], names=["u", "v", "links"])

    block = F.least(F.lit(FAMILY_ROWS), F.greatest(F.lit(LEAST_ROWS), F.ceil(F.col("family_rows") / BLOCKS)))
    dealt = _dealt(members, "family", F.greatest(F.ceil(F.col("family_rows") / block), F.ceil(F.col("family_shingles") / FAMILY_SHINGLES)))
    return dealt.select("family", "a", "b", "key", "_mine", "copies", "sig", "text").mapInArrow(run, "u long, v long, links long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, class_id, n_links, n_shingles.

    class_id is the smallest id of the documents that are connected by links of Jaccard similarity >= threshold on
    five-word shingles (A-Z lower-cased), n_links the number of other rows a document is linked to, copies included.
    Null, empty and blank texts have no shingles: they are linked to nothing and are classes of their own (class_id is
    their id). Null ids are ids like others and count as the largest. Texts are worked on whole, one of the longest at a
    time. Rows that repeat are copies of each other; other columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    table = least_matches(threshold, tolerance, STEPS)
    source = docs.select(F.col(id_col).alias("_id"), text_or_empty(F.col(text_col)).alias("text"))
    kind = source.schema["_id"].dataType.simpleString()
    signed = written(source.mapInArrow(_signatures, f"_id {kind}, key long, n long, bands array<long>, sig binary"), "signatures")
    classes = written(
        signed.where("n > 0").groupBy("key").agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig")),
        "classes",
    )
    families = components(candidate_edges(classes, table)).select(F.col("node").alias("key"), F.col("component").alias("family"))
    members = families.join(classes.select("key", "rep", "copies", "n", "sig"), "key")
    sizes = members.groupBy("family").agg(F.sum("n").alias("family_shingles"), F.count(F.lit(1)).alias("family_rows"))
    # one text for each class; where an id stands for several texts, the wrong ones go when the sets are built
    texts = hot_join(members, sizes, "family", "family_rows", "key").join(source.withColumnRenamed("_id", "_doc"), F.col("rep").eqNullSafe(F.col("_doc")))
    links = written(verified_links(texts, table, threshold), "links")
    grouped = components(links.select("u", "v")).select(F.col("node").alias("key"), "component")
    named = grouped.join(classes.select("key", "rep"), "key")
    names = named.groupBy("component").agg(F.min("rep").alias("class_id"))
    linked = named.join(names, "component").select("key", "class_id").join(links.groupBy(F.col("u").alias("key")).agg(F.sum("links").alias("links")), "key")
    known = classes.select("key", "rep", "copies").join(linked, "key", "left").select(
        "key", "copies", F.coalesce("class_id", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    rows = signed.select("_id", "key", "n")
    with_words = hot_join(rows.where("n > 0"), known, "key", "copies", "_id").select("_id", "class_id", "n_links", "n")
    without = rows.where("n = 0").select("_id", F.col("_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), "n")
    return with_words.unionByName(without).select(F.col("_id").alias(id_col), "class_id", "n_links", F.col("n").alias("n_shingles"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of which one of each class stays, the one with the smallest id (and hash of its text).

    A row is told by its id and its text, so other texts under the same id are judged for themselves; rows that repeat
    both are one. Null, empty and blank texts all stay, null ids are ids like others, other columns travel along whatever
    their names, an empty table gives an empty result.
    """
    columns = docs.columns
    plain = docs.toDF(*(f"c{k}" for k in range(len(columns))))
    id_, text = (f"c{columns.index(c)}" for c in (id_col, text_col))
    hashed = F.xxhash64(text_or_empty(F.col(text)))
    found = near_duplicates(plain.select(F.struct(F.col(id_).alias("id"), hashed.alias("h")).alias("_row"), F.col(text).alias("_text")), threshold, tolerance, "_row", "_text")
    gone = found.where(~F.col("_row").eqNullSafe(F.col("class_id"))).select(F.col("_row.id").alias("_gone"), F.col("_row.h").alias("_of")).distinct()
    known = plain.withColumn("_h", hashed)
    kept = known.join(gone, F.col(id_).eqNullSafe(F.col("_gone")) & (F.col("_h") == F.col("_of")), "left_anti")
    return kept.dropDuplicates([id_, "_h"]).drop("_h").toDF(*columns)


#: The same by comparing all shingles; for small tables.
ORACLE = r"""
with recursive w as (select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then cast([] as varchar[]) when len(ws) < 5 then [array_to_string(ws, ' ')]
 else list_transform(range(1, len(ws) - 3), lambda i: concat_ws(' ', ws[i], ws[i + 1], ws[i + 2], ws[i + 3], ws[i + 4])) end) as sh from w),
n as (select w.doc_id, count(sh) as n from w left join s on s.doc_id = w.doc_id group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as both_ from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by 1, 2),
l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where both_ >= 0.8 * (nx.n + ny.n - both_) - 1e-9),
r as (select doc_id as x, doc_id as y from documents union select r.x, l.y from r join l on l.x = r.y)
select n.doc_id, (select min(y) from r where r.x = n.doc_id) as class_id, (select count(*) from l where l.x = n.doc_id) as n_links, n.n as n_shingles from n
"""
