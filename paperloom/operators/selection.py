"""Which paper each category gets: windows, votes, exclusions, ranking and the greedy pick across categories."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions.strings import canonical_id, collapse_ws
from paperloom.operators.absence import anti_join
from paperloom.sources.tables import discard, written

WINDOW_DAYS, MOST_PAGES = 7, 60


def as_of_instant(day: Column) -> Column:
    """The last second of a day."""
    return F.to_timestamp_ntz(F.concat(day.cast("string"), F.lit(" 23:59:59")), F.lit("yyyy-MM-dd HH:mm:ss"))


def candidate_urls(df: DataFrame, site: str = "https://arxiv.org") -> DataFrame:
    """Raw feed rows (id, published, title, summary, pdf_url) to candidates with canonical id and addresses."""
    id_ = canonical_id(F.col("id"))
    return df.withColumns(
        {
            "id": id_,
            "published": F.to_timestamp("published"),
            "title": collapse_ws(F.col("title")),
            "summary": collapse_ws(F.col("summary")),
            "abs_url": F.concat(F.lit(f"{site}/abs/"), id_),
            "pdf_url": F.coalesce("pdf_url", F.concat(F.lit(f"{site}/pdf/"), id_)),
        }
    )


def in_window(df: DataFrame, ref: Column, days: int = WINDOW_DAYS) -> DataFrame:
    """Candidates published from ``days`` times 24 hours before ``ref`` up to it, both ends included."""
    return df.where(F.col("published").between(ref - F.make_dt_interval(F.lit(days)), ref))


def _served(runs: DataFrame, days: int, name: str) -> DataFrame:
    """(as_of, name): each run with the days that it looks at. A few rows a run, so the other side is copied only to runs that there are."""
    return runs.select("as_of").distinct().withColumn(name, F.explode(F.sequence(F.date_sub("as_of", days), F.col("as_of"))))


def replay_window(runs: DataFrame, candidates: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Candidates of every as-of date: an equi-join on the day of publication, then the exact window."""
    published, ref = F.col("published"), as_of_instant(F.col("as_of"))
    joined = candidates.withColumn("_day", F.to_date(published)).join(_served(runs, days, "_day"), "_day").drop("_day")
    return joined.where(published.between(ref - F.make_dt_interval(F.lit(days)), ref))


def upvotes_asof(snapshots: DataFrame, runs: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """(as_of, id, upvotes): the most votes in the ``days`` + 1 snapshots up to each date, nulls as 0.

    Days lie in blocks as long as the window, so a window is the end of one block and the beginning of the next. A vote is
    copied to the two blocks whose runs may see it, however many runs these have; the maximum of each day is found before
    the shuffle, and a run looks up the maximum from its first day to the end of the block before and that from its own
    block's beginning to its date.
    """
    size = days + 1
    number = lambda day: F.datediff(day, F.lit("1970-01-01").cast("date"))
    dates = runs.select("as_of").distinct().select(F.floor(number(F.col("as_of")) / size).alias("_block"), F.struct(F.pmod(number(F.col("as_of")), F.lit(size)).alias("day"), "as_of").alias("x"))
    blocks = dates.groupBy("_block").agg(F.collect_list("x").alias("runs"))  # at most ``size`` dates in each
    votes = F.greatest(F.coalesce("upvotes", F.lit(0)), F.lit(0)).cast("long")
    day = number(F.col("snapshot_date"))
    rows = snapshots.where("id is not null and id != ''").select("id", votes.alias("v"), F.floor(day / size).alias("_own"), F.pmod(day, F.lit(size)).alias("_day"))
    copies = rows.select("id", "v", "_day", F.explode(F.array(F.struct(F.col("_own").alias("b"), F.lit(True).alias("own")), F.struct((F.col("_own") + 1).alias("b"), F.lit(False).alias("own")))).alias("x"))
    wanted = copies.select("id", "v", "_day", F.col("x.b").alias("_block"), "x.own").join(blocks.select("_block"), "_block", "left_semi")
    most = [F.max(F.when(F.col("own") == own, F.when(F.col("_day") == k, F.col("v")))) for own in (False, True) for k in range(size)]
    days_ = wanted.groupBy("id", "_block").agg(*(m.alias(f"_{k}") for k, m in enumerate(most)))
    before, own = [f"_{k}" for k in range(size)], [f"_{k}" for k in range(size, 2 * size)]
    largest = lambda names: F.greatest(*names) if len(names) > 1 else F.col(names[0])
    ends = F.array(*(largest(before[k:]) for k in range(size)), F.lit(None).cast("long"))  # from day k of the block before on
    starts = F.array(*(largest(own[: k + 1]) for k in range(size)))  # up to day k of the run's own block
    seen = days_.select("id", "_block", ends.alias("_ends"), starts.alias("_starts")).join(blocks, "_block")
    told = seen.select("id", "_ends", "_starts", F.explode("runs").alias("r"))
    return told.select("r.as_of", "id", F.greatest(F.get("_ends", F.col("r.day") + 1), F.get("_starts", F.col("r.day"))).alias("upvotes")).where("upvotes is not null")


def exclude_published(candidates: DataFrame, published: DataFrame, sketch: bool = False) -> DataFrame:
    """Candidates whose id is not published. With ``sketch`` those that a Bloom sketch of the archive's ids rules out, nearly
    all, skip the shuffle (see ``absence.anti_join``): for archives too large to broadcast."""
    ids = published.select(F.col("arxiv_id").alias("id"))
    return anti_join(candidates, ids, "id") if sketch else candidates.join(ids, "id", "left_anti")


def attach_upvotes(candidates: DataFrame, votes: DataFrame, on: tuple[str, ...] = ("as_of", "id")) -> DataFrame:
    """matched is true for listed ids, those with no votes included."""
    listed = votes.select(*on, "upvotes", F.lit(True).alias("matched"))
    return candidates.join(listed, list(on), "left").withColumn("matched", F.coalesce("matched", F.lit(False)))


def within_page_cap(df: DataFrame, most: int = MOST_PAGES) -> DataFrame:
    """Unknown page counts are left out, the cap itself is allowed."""
    return df.where(F.col("num_pages") <= most)


def rank_candidates(df: DataFrame) -> DataFrame:
    """Listed papers first, by votes; equal votes and unlisted papers by recency, then by id."""
    order = Window.partitionBy("as_of", "category").orderBy(F.desc("matched"), F.desc_nulls_last("upvotes"), F.desc("published"), "id")
    return df.withColumn("rank", F.row_number().over(order))


def reason(matched: Column, upvotes: Column) -> Column:
    return F.when(matched, F.concat(F.lit("hf_daily_papers_upvotes="), upvotes.cast("string"))).otherwise(F.lit("fallback_most_recent"))


def top_candidates(runs: DataFrame, candidates: DataFrame, snapshots: DataFrame, published: DataFrame, most: int, days: int = WINDOW_DAYS, pages: int = MOST_PAGES) -> DataFrame:
    """The ``most`` best candidates of each (as_of, category), with selection_reason."""
    pool = within_page_cap(exclude_published(replay_window(runs, candidates, days), published), pages)
    ranked = rank_candidates(attach_upvotes(pool, upvotes_asof(snapshots, runs, days)))
    return ranked.where(F.col("rank") <= most).withColumn("selection_reason", reason(F.col("matched"), F.col("upvotes")))


def select_top1(runs: DataFrame, candidates: DataFrame, snapshots: DataFrame, published: DataFrame) -> DataFrame:
    return top_candidates(runs, candidates, snapshots, published, 1).drop("rank", "matched", "upvotes")


def _greedy(rows: pd.DataFrame, categories: list[str]) -> list[int]:
    """Places of the picked rows: per category, in the given order, the best row whose id is not picked yet."""
    picks: list[int] = []
    for category in categories:
        mine = rows[(rows["category"] == category) & ~rows["id"].isin(rows.loc[picks, "id"])]
        if len(mine):
            picks.append(mine["rank"].idxmin())
    return picks


def select_all(top: DataFrame, categories: list[str]) -> DataFrame:
    """One paper per category and date; a paper picked for an earlier category is barred from later ones.

    ``top`` needs the best len(categories) candidates of each (as_of, category) only: earlier categories bar at most one
    id each. So a date has at most len(categories)**2 rows here.
    """

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.loc[_greedy(rows, categories)]

    columns = ["as_of", "category", "id", "published", "selection_reason", "rank"]
    return top.select(columns).groupBy("as_of").applyInPandas(pick, top.select(columns).schema).drop("rank")


def backfill_depth(runs: DataFrame, categories: int, days: int = WINDOW_DAYS) -> int:
    """How many candidates of each (as_of, category) a backfill may have to look at: those that the run's own categories and
    the earlier runs with overlapping windows can take, and one more. The window goes over the run dates alone."""
    day = F.datediff("as_of", F.lit("1970-01-01").cast("date"))
    overlapping = F.count(F.lit(1)).over(Window.orderBy(day).rangeBetween(-days, 0))  # the run itself counts
    return categories * (runs.select("as_of").distinct().select(overlapping.alias("n")).agg(F.max("n")).first()[0] or 1)


def backfill(runs: DataFrame, candidates: DataFrame, snapshots: DataFrame, published: DataFrame, categories: list[str], days: int = WINDOW_DAYS, pages: int = MOST_PAGES) -> DataFrame:
    """Successive runs: what an earlier date, or an earlier category of the date, picked is out for all later ones.

    All (date, category) places claim at once. In each round every place asks for its best claim left; an id falls to the
    earliest place that asks for it, and all later places lose their claims on it, as nobody but a still earlier place
    can take it away. A round without a loss is the sequential walk's result: each place has its best id that no earlier
    place wants more. Places have at most ``backfill_depth`` claims, which is as deep as any pick can reach.
    """
    most = backfill_depth(runs, len(categories), days)
    columns = ["as_of", "category", "id", "published", "selection_reason", "rank"]
    top = written(top_candidates(runs, candidates, snapshots, published, most, days, pages).where(F.col("category").isin(*categories)).select(columns), "top")
    ordinal = F.array_position(F.array(*map(F.lit, categories)), F.col("category"))
    claims = written(top.select(F.struct("as_of", ordinal.alias("ordinal")).alias("place"), "rank", "id"), "claims")
    left = claims.count()
    while True:
        asked = claims.groupBy("place").agg(F.min(F.struct("rank", "id")).alias("best"))
        holders = asked.groupBy(F.col("best.id").alias("id")).agg(F.min("place").alias("holder"))
        kept = written(claims.join(holders, "id", "left").where("holder is null or place <= holder").drop("holder"), "claims")
        discard(claims)
        claims, before, left = kept, left, kept.count()
        if left == before:
            break
    picks = claims.groupBy("place").agg(F.min(F.struct("rank", "id")).alias("best")).select("place.as_of", F.element_at(F.array(*map(F.lit, categories)), F.col("place.ordinal").cast("int")).alias("category"), "best.id")
    return top.join(picks, ["as_of", "category", "id"], "left_semi").select(columns[:-1])
