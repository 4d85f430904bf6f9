"""Reports and counters over pages, books and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Shares of red ink below and above which a page is worth a look (fixed values).
NO_RED, TOO_MUCH_RED = 0.005, 0.70


def _no(c: str) -> Column:
    return ~F.coalesce(F.col(c), F.lit(False))


def content_pages(stats: DataFrame) -> DataFrame:
    """Pages that are neither blank nor an illustration; a page without a mark has text."""
    return stats.where(_no("is_blank") & _no("is_illustration"))


def pages_with_text(pages: DataFrame, stats: DataFrame, page: str = "page") -> DataFrame:
    """The asked pages without the blank and illustrated ones; pages that nobody analysed stay."""
    skip = stats.where(~(_no("is_blank") & _no("is_illustration"))).select(page)
    return pages.join(skip, page, "left_anti")


def audit_lists(stats: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """keys, no_red, too_much_red, ornaments: sorted pages with text whose red ink is worth a look; the third list stands by itself."""
    c, share = content_pages(stats), F.col("red_ink_ratio")
    listed = lambda cond, name: F.sort_array(F.collect_list(F.when(cond, F.col(page)))).alias(name)
    return c.groupBy(*keys).agg(listed(share < NO_RED, "no_red"), listed((share >= NO_RED) & (share > TOO_MUCH_RED), "too_much_red"), listed(F.col("red_components_dropped_ornament") > 0, "ornaments"))


def book_summary(stats: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """keys, total_pages, text_pages, max_page."""
    return stats.groupBy(*keys).agg(F.count("*").alias("total_pages"), F.count_if(_no("is_blank") & _no("is_illustration")).alias("text_pages"), F.max(page).alias("max_page"))


def published(books: DataFrame, stats: DataFrame, key: str = "book_id", page: str = "page") -> DataFrame:
    """The registry: published books with a proper id, their titles, page counts and last page."""
    own = books.where(F.coalesce("publish", F.lit(False)) & F.col(key).rlike(r"^[a-z0-9_]+\z"))
    none = [F.coalesce(c, F.lit(d)).alias(c) for c, d in (("title_am", ""), ("title_en", ""))]
    return own.select(key, *none).join(book_summary(stats, [key], page), key)


def library(books: DataFrame, rules: DataFrame, images: DataFrame, texts: DataFrame, key: str = "book_id") -> DataFrame:
    """key, title_am, title_en, sections, rendered, transcribed of every book."""
    n = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    out = books.select(key, "title_am", "title_en").join(n(rules, "sections"), key, "left").join(n(images, "rendered"), key, "left").join(n(texts, "transcribed"), key, "left")
    return out.fillna(0, ["sections", "rendered", "transcribed"])


def inventory(books: DataFrame, stats: DataFrame, texts: DataFrame, images: DataFrame, key: str = "book_id", page: str = "page") -> DataFrame:
    """key, analysed_pages, content_pages, transcripts, draft_pages (sorted), original_page_images, source_available, source_manifest_available.

    books: key, source_sha256 and manifest, each null where it is gone.
    """
    s = stats.groupBy(key).agg(F.count("*").alias("analysed_pages"), F.count_if(_no("is_blank") & _no("is_illustration")).alias("content_pages"))
    t = texts.groupBy(key).agg(F.count("*").alias("transcripts"), F.sort_array(F.collect_list(F.when(F.lower(F.coalesce("source", F.lit(""))).contains("draft"), F.col(page)))).alias("draft_pages"))
    i = images.groupBy(key).agg(F.count("*").alias("original_page_images"))
    out = books.select(key, F.col("source_sha256").isNotNull().alias("source_available"), F.col("manifest").isNotNull().alias("source_manifest_available")).join(s, key, "left").join(t, key, "left").join(i, key, "left")
    out = out.fillna(0, ["analysed_pages", "content_pages", "transcripts", "original_page_images"])
    return out.withColumn("draft_pages", F.coalesce("draft_pages", F.expr("array()").cast(dict(t.dtypes)["draft_pages"])))


def mean_confidence(words: DataFrame, keys: list[str], conf: Column) -> DataFrame:
    """keys, mean_conf: over confidences above 0; 0 where there is none."""
    return words.groupBy(*keys).agg(F.coalesce(F.avg(F.when(conf > 0, conf)), F.lit(0.0)).alias("mean_conf"))


def token_confidence(tokens: DataFrame, keys: list[str], text: Column, conf: Column) -> DataFrame:
    """keys, confidence (null without any), word_count: over tokens that are not blank, with a numeric confidence of 0 or more."""
    c = F.when((F.trim(F.coalesce(text, F.lit(""))) != "") & (conf >= 0), conf)
    return tokens.groupBy(*keys).agg(F.avg(c).alias("confidence"), F.count(c).alias("word_count"))


def confidence_summary(pages: DataFrame, keys: list[str], conf: Column, places: int = 2) -> DataFrame:
    """keys, min, median, mean, max of the confidences there are; all null without any."""
    r = lambda x, name: F.round(x, places).alias(name)
    return pages.groupBy(*keys).agg(r(F.min(conf), "min"), r(F.median(conf), "median"), r(F.avg(conf), "mean"), r(F.max(conf), "max"))


def red_ink_share(layers: DataFrame, keys: list[str]) -> DataFrame:
    """keys, mask_red: dark pixels of the red layer over those of both (red_px, black_px); null where a layer or all ink is missing."""
    total = F.col("red_px") + F.col("black_px")
    return layers.select(*keys, (F.col("red_px") / F.nullif(total, F.lit(0))).alias("mask_red"))


def export_stamp(at: Column) -> Column:
    """The part of an ISO time that goes into a file name: to the second, without colons."""
    return F.replace(F.substring(at, 1, 19), F.lit(":"), F.lit(""))


def utc_stamp(at: Column) -> Column:
    """An ISO 8601 time in UTC with its offset."""
    return F.concat(F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
