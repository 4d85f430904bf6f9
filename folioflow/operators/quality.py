"""Checks, flags, counters and release status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

#: Statuses in order of precedence (fixed values).
STATUSES = ("source_incomplete", "not_analyzed", "incomplete", "needs_review", "awaiting_approval", "sectioning_incomplete", "ready")


def status(counts: DataFrame) -> DataFrame:
    """Adds status and production_ready to rows of counts: the first status that applies; ready needs a content page.

    Columns: source_problems, analysed (pages with an analysis), content,
    missing_pages, missing_analysis, unexpected_analysis, flagged, unverified,
    unapproved, missing_sections.
    """
    c = F.col
    s = (
        F.when(c("source_problems") > 0, STATUSES[0])
        .when(c("analysed") == 0, STATUSES[1])
        .when((c("missing_pages") > 0) | (c("missing_analysis") > 0) | (c("unexpected_analysis") > 0) | (c("content") == 0), STATUSES[2])
        .when((c("flagged") > 0) | (c("unverified") > 0), STATUSES[3])
        .when(c("unapproved") > 0, STATUSES[4])
        .when(c("missing_sections") > 0, STATUSES[5])
        .otherwise(STATUSES[6])
    )
    return counts.withColumn("status", s).withColumn("production_ready", s == STATUSES[6])


def flags(*pairs: tuple[Column, Column]) -> Column:
    """The messages of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(cond, message) for cond, message in pairs]))


def page_report(pages: DataFrame, key: str, latin=tx.ALPHABETS["latin"], digit=tx.ALPHABETS["digit"]) -> DataFrame:
    """Per page: lines, paragraphs, character counts per script, and flags."""
    t = F.coalesce("text", F.lit(""))
    lines = F.split(t, "\n")
    blank = F.filter(lines, lambda x: x.rlike(r"^\s*$"))
    starts = F.expr("size(filter(sequence(0, size(l) - 1), i -> not (l[i] rlike '^\\\\s*$') and (i = 0 or l[i - 1] rlike '^\\\\s*$')))")
    p = pages.select(key, t.alias("t"), lines.alias("l"), F.size(blank).alias("blank_lines"))
    p = p.withColumn("latin_chars", tx.count_in(F.col("t"), latin)).withColumn("ascii_digits", tx.count_in(F.col("t"), digit)).withColumn("paragraphs", starts.cast("long"))
    other = F.length(F.regexp_replace("t", r"[\x00-\x7F]", "")).cast("long")
    f = flags((F.col("t") == "", F.lit("empty")), (F.col("latin_chars") == 0, F.lit("no latin letters")), (F.col("ascii_digits") > 0, F.concat(F.col("ascii_digits").cast("string"), F.lit(" digits"))), (F.size("l") == 1, F.lit("one line")))
    return p.select(key, F.size("l").cast("long").alias("lines"), "paragraphs", F.length("t").cast("long").alias("chars"), "latin_chars", "ascii_digits", other.alias("other_chars"), F.array_join(f, "; ").alias("flags"))
