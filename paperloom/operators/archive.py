"""Published pages: titles, images, page text, editions, digests and freshness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.spans import gaps
from paperloom.functions.strings import CATEGORIES, category_dir, page_stem, page_url, strip, truncate_title
from paperloom.operators.latest import last_rows

#: Image endings and the form of a reference. Fixed values.
IMAGE_ENDINGS = (".jpeg", ".jpg", ".png", ".gif", ".webp", ".svg")
IMAGE = r"!\[([^\]]*)\]\(([^)\s]+)\)"
TITLE_LINE = r"(?Ud)^\s*#\s+(?:<span[^>]*></span>\s*)?(.*)$"
#: Hours after which a marker is stale. Fixed value.
STALE_HOURS = 48
#: Texts of pages and messages. Fixed values.
ORIGINAL, SOURCE = "원제", "원문"
COUNT_LINE = ("**이번 주 번역된 논문 ", "편**")
NO_MARKER = "⚠️ 이번 주 처리 결과를 찾지 못했습니다 (처리 워크플로가 아직 안 끝났을 수 있습니다)."
OLD_MARKER = ("⚠️ 마지막 처리가 ", "일 ", "시간 전이라 오래됐습니다. 이번 주 처리가 지연되었을 수 있습니다.")


def translated_title(body: Column, fallback: Column) -> Column:
    """The first line's level-1 heading up to a deeper heading mark in it, without bold marks; else the fallback."""
    text = strip(F.regexp_extract(F.substring_index(body, "\n", 1), TITLE_LINE, 1))
    cut = F.regexp_replace(text, r"(?Us)\s#{2,6}\s.*$", "")
    return F.coalesce(F.nullif(strip(F.replace(cut, F.lit("**"), F.lit(""))), F.lit("")), fallback)


def image_refs(df: DataFrame) -> DataFrame:
    """(doc_id, file) of the references that may be rewritten: bare file names with an image ending."""
    refs = df.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all("md", F.lit(IMAGE), 2))).alias("file"))
    ending = F.lower(F.regexp_extract("file", r"[^.](\.[^.]+)$", 1))
    return refs.where(~F.col("file").contains("/") & ending.isin(*IMAGE_ENDINGS))


def image_manifest(df: DataFrame, inventory: DataFrame) -> DataFrame:
    """The files to copy: distinct, referenced and there."""
    return image_refs(df).join(inventory, ["doc_id", "file"], "left_semi").distinct()


def rewrite_images(df: DataFrame, inventory: DataFrame) -> DataFrame:
    """(doc_id, stem, md): references to files of the inventory point into the page's folder."""
    there = image_manifest(df, inventory).groupBy("doc_id").agg(F.collect_set("file").alias("files"))
    alts, files = (F.regexp_extract_all("md", F.lit(IMAGE), k) for k in (1, 2))
    refs = F.transform(F.arrays_zip(alts.alias("alt"), files.alias("file")), lambda r: F.concat(
        F.lit("!["), r["alt"], F.lit("]("), F.when(F.array_contains("files", r["file"]), F.concat("stem", F.lit("/"))).otherwise(""), r["file"], F.lit(")")))
    woven = F.zip_with(gaps(F.col("md"), IMAGE), refs, lambda g, r: F.concat(g, F.coalesce(r, F.lit(""))))
    joined = df.join(there, "doc_id", "left").withColumn("files", F.coalesce("files", F.array().cast("array<string>")))
    return joined.select("doc_id", "stem", F.array_join(woven, "").alias("md"))


def build_page(df: DataFrame) -> DataFrame:
    """(id, category, title, abs_url, pdf_url, published, translated, selection_reason, body) with ``page``."""
    title = translated_title(F.col("body"), F.col("title"))
    parts = (
        '---\ntitle: "', truncate_title(title), '"\narxiv_id: ', F.col("id"), "\ncategory: ", F.col("category"), "\npublished: ", F.col("published"),
        "\ntranslated: ", F.col("translated").cast("string"), '\nselection_reason: "', F.col("selection_reason"), '"\n---\n\n# ', title,
        f"\n\n- {ORIGINAL}: ", F.col("title"), f"\n- {SOURCE}: [", F.col("abs_url"), "](", F.col("abs_url"), ")\n- PDF: [", F.col("pdf_url"), "](", F.col("pdf_url"),
        ")\n- arXiv ID: `", F.col("id"), "`\n\n---\n\n", F.col("body"),
    )
    return df.withColumn("page", F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts)))


def page_path(day: Column, category: Column, id_: Column, title: Column) -> Column:
    return F.concat(category_dir(category), F.lit("/"), page_stem(day, id_, title), F.lit(".md"))


def upsert_archive(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Inside a category's folder only the newest edition of an id stays (translated, then edition)."""
    both = existing.unionByName(new)
    placed = both.withColumn("category_dir", category_dir(F.col("category")))
    return last_rows(placed, ["category_dir", "arxiv_id"], ["translated", "edition"]).select("category_dir", *(c for c in both.columns if c != "category_dir"))


def stamp(df: DataFrame, day: Column) -> DataFrame:
    return df.withColumn("published_date", day)


def digest(papers: DataFrame, site: str) -> DataFrame:
    """(week, category, id, title, published_date, warning) to one message per week as JSON, papers in category order."""
    rank = F.coalesce(F.array_position(F.lit([code for code, _ in CATEGORIES]), F.col("category")).cast("int"), F.lit(0))
    rank = F.when(rank == 0, len(CATEGORIES) + 1).otherwise(rank)
    line = F.concat(F.lit("- ["), F.col("category"), F.lit("] "), F.col("title"), F.lit(" — "), page_url(site, F.col("published_date"), F.col("category"), F.col("id"), F.col("title")), F.lit(" (arXiv: "), F.col("id"), F.lit(")"))
    rows = papers.groupBy("week").agg(F.max("warning").alias("warning"), F.array_sort(F.collect_list(F.struct(rank.alias("rank"), F.col("category"), F.col("id"), line.alias("line")))).alias("x"))
    count = F.concat(F.lit(COUNT_LINE[0]), F.size("x").cast("string"), F.lit(COUNT_LINE[1]))
    head = F.concat_ws("\n", F.lit("@everyone"), F.col("warning"), count)
    content = F.concat_ws("\n", head, F.array_join(F.col("x.line"), "\n"))
    payload = F.to_json(F.struct(content.alias("content"), F.struct(F.array(F.lit("everyone")).alias("parse")).alias("allowed_mentions"), F.lit(4).alias("flags")))
    return rows.select("week", content.alias("content"), payload.alias("payload"))


def staleness(markers: DataFrame, now: Column, hours: int = STALE_HOURS) -> DataFrame:
    """``warning`` where the marker is missing or strictly older than ``hours``, else null."""
    seconds = F.unix_timestamp(now) - F.unix_timestamp("generated_at")
    days, rest = F.floor(seconds / 86400), F.floor((seconds % 86400) / 3600)
    old = F.concat(F.lit(OLD_MARKER[0]), days.cast("string"), F.lit(OLD_MARKER[1]), rest.cast("string"), F.lit(OLD_MARKER[2]))
    return markers.withColumn("warning", F.when(F.col("generated_at").isNull(), NO_MARKER).when(seconds > hours * 3600, old))
