"""Assembly of a book: blocks into sections, numbers, page spans, nested payload."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from . import core, quality, revisions, transcripts


def assemble(blocks: DataFrame, keys: list[str], page: str = "page", order: str = "block_ord", opens: str = "opens", kind: str = "type") -> DataFrame:
    """Adds section, first_section, moved and block_id to blocks in reading order.

    `opens` names the section a block would open; only a section's first opening
    counts.  Ornaments directly above an opening block on its page go to the new
    section and keep the number they had; blocks before any opening are front matter.
    """
    t = core.first_openings(blocks, keys, [page, order], opens, "first_section")
    w = Window.partitionBy(*keys).orderBy(page, order)
    before = F.lag("first_section").over(w)
    t = t.withColumn("_starts", F.col("first_section").isNotNull() & ~F.col("first_section").eqNullSafe(before))
    ahead = Window.partitionBy(*keys, page).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    other = F.when(F.col(kind) != "ornament", F.struct("_starts", "first_section"))
    t = t.withColumn("_next", F.first(other, ignorenulls=True).over(ahead))
    moved = (F.col(kind) == "ornament") & F.coalesce(F.col("_next._starts"), F.lit(False)) & ~F.col("_starts")
    t = t.withColumn("moved", moved).withColumn("section", F.when(moved, F.col("_next.first_section")).otherwise(F.col("first_section")))
    n = lambda c: F.row_number().over(Window.partitionBy(*keys, c).orderBy(page, order))
    t = t.withColumn("_old", n("first_section")).withColumn("_new", n("section"))
    named = lambda c, k: F.format_string("%s_%03d", F.coalesce(c, F.lit("front_matter")), F.col(k))
    return t.withColumn("block_id", F.when(F.col("moved"), named("first_section", "_old")).otherwise(named("section", "_new"))).drop("_starts", "_next", "_old", "_new")


def section_spans(assembled: DataFrame, keys: list[str], page: str = "page") -> DataFrame:
    """First and last page of each section, as blocks came in: a moved ornament does not shorten the section it left."""
    own = assembled.where("first_section IS NOT NULL").groupBy(*keys, F.col("first_section").alias("section")).agg(F.min(page).alias("start_page"), F.max(page).alias("end_page"))
    held = assembled.where("section IS NOT NULL").groupBy(*keys, "section").agg(F.count("*").alias("blocks"))
    return own.join(held, [*keys, "section"], "left").fillna(0, ["blocks"])


def payload(assembled: DataFrame, rules: DataFrame, keys: list[str], fields: list[str], page: str = "page", order: str = "block_ord") -> DataFrame:
    """One row per book for the JSON sink: front matter and sections in rule order, each with its blocks in reading order.

    rules: section, ord, and any further columns of a section.  A book's blocks come together in one row, as its file does.
    """
    item = F.struct(F.col(page).alias("_p"), F.col(order).alias("_o"), F.struct("block_id", page, *fields).alias("b"))
    lists = assembled.groupBy(*keys, "section").agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: x["b"]).alias("blocks"))
    spans = section_spans(assembled, keys, page).drop("blocks")
    more = [c for c in rules.columns if c not in ("section", "ord")]
    full = lists.where("section IS NOT NULL").join(spans, [*keys, "section"]).join(rules, "section", "left")
    one = F.struct(F.coalesce("ord", F.lit(0)).alias("ord"), "start_page", F.col("section").alias("section_id"), "end_page", *more, "blocks")
    sections = full.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("sections"))
    front = lists.where("section IS NULL").select(*keys, F.col("blocks").alias("front_matter"))
    return assembled.select(*keys).distinct().join(front, keys, "left").join(sections, keys, "left").withColumn("sections_count", F.coalesce(F.size("sections"), F.lit(0)))


# ---- a whole book ---------------------------------------------------------------

#: What a section table may say of a section, and what a section has where it says nothing (fixed values).
SECTION_FIELDS = {"title_am": "", "title_en": "", "category": None, "weekday_am": None, "weekday_en": None}


def opened(blocks: DataFrame, books: DataFrame, rules: DataFrame, keys: list[str], page: str = "page", order: str = "block_ord", alphabet: str = "build") -> DataFrame:
    """blocks with opens: the section that a block would open.

    rules: keys, section_id, pos (place in the table), required_any, first_page,
    last_page.  Where every section of a book gives pages, a block opens the first
    section whose range holds its page; else a title block opens the first section
    not opened yet whose keyword groups its normalised text holds.  A book without
    sections (books: keys, book_id) is one section from its first block on.
    """
    # Alternatives are normalised one by one; an empty one never fits, one that normalises to nothing always does.
    alt = rules.select(*keys, "section_id", F.posexplode("required_any").alias("_g", "_alts")).select(*keys, "section_id", "_g", F.explode_outer("_alts").alias("_a"))
    alt = alt.withColumn("_n", F.when(F.col("_a") != "", tx.normalize(F.col("_a"), alphabet)))
    groups = alt.groupBy(*keys, "section_id", "_g").agg(F.collect_list("_n").alias("_n")).groupBy(*keys, "section_id").agg(F.collect_list("_n").alias("_groups"))
    table = rules.join(groups, [*keys, "section_id"], "left")
    table = table.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("pos", "section_id", "first_page", "last_page", "_groups"))).alias("_rules"), F.bool_and(F.col("first_page").isNotNull()).alias("_by_pages"))
    b = blocks.join(table, keys, "left")
    held = F.filter("_rules", lambda r: F.col(page).between(r["first_page"], r["last_page"]))
    fits = F.filter("_rules", lambda r: r["_groups"].isNotNull() & F.forall(r["_groups"], lambda g: F.exists(g, lambda a: F.contains(F.col("_text"), a))))
    by_page = F.when(F.col("_by_pages"), F.try_element_at(held, F.lit(1))["section_id"])
    title = (F.col("type") == "title") & ~F.coalesce("_by_pages", F.lit(True))
    b = b.withColumn("_text", F.when(title, tx.normalize(transcripts.block_text(F.struct("spans")), alphabet)))
    none = F.expr("cast(array() as array<string>)")
    b = b.withColumn("_fits", F.when(F.col("_text") != "", F.transform(fits, lambda r: r["section_id"])).otherwise(none))
    titles = core.openings(b, keys, [page, order], "_fits")
    first = Window.partitionBy(*keys).orderBy(page, order)
    names = books.select(*keys, F.col("book_id").alias("_book"))
    b = b.join(titles, [*keys, page, order], "left").join(names, keys, "left")
    whole = F.when(F.col("_rules").isNull() & (F.row_number().over(first) == 1), F.col("_book"))
    return b.withColumn("opens", F.coalesce("opens", by_page, whole)).drop("_rules", "_by_pages", "_text", "_fits", "_book")


def page_facts(books: DataFrame, stats: DataFrame, texts: DataFrame, reports: DataFrame, reviews: DataFrame, keys: list[str]) -> DataFrame:
    """One row per page that anything is known of: what is known, as booleans.

    books: keys, total_pages; stats: keys, page, is_blank, is_illustration;
    texts: keys, page and both hashes of its present revision; reports: keys,
    page, review_flags, both hashes; reviews: keys, page, status, both hashes.
    """
    own = [*keys, "page"]
    verified = revisions.matching(reports, texts, *own)
    approved = revisions.matching(reviews.where("status = 'approved'"), texts, *own)
    yes, bare = F.lit(True), F.lit(None).cast("boolean")
    names = ("inventory", "analysed", "blank", "illustration", "transcribed", "verified", "flagged", "approved")

    def facts(df, **have):
        return df.select(*own, *[have.get(n, bare).alias(n) for n in names])

    flag = lambda c: F.coalesce(c, F.lit(False))
    inventory = books.where("total_pages >= 1").select(*keys, F.explode(F.sequence(F.lit(1), F.col("total_pages").cast("int"))).alias("page"))
    every = (
        facts(inventory, inventory=yes)
        .unionByName(facts(stats, analysed=yes, blank=flag(F.col("is_blank")), illustration=flag(F.col("is_illustration"))))
        .unionByName(facts(texts, transcribed=yes))
        .unionByName(facts(verified, verified=F.col("matches"), flagged=F.size("review_flags") > 0))
        .unionByName(facts(approved, approved=F.col("matches")))
    )
    p = every.groupBy(*own).agg(*[F.coalesce(F.max(n), F.lit(False)).alias(n) for n in names])
    return p.withColumn("content", F.col("analysed") & ~F.col("blank") & ~F.col("illustration"))


def book_quality(books: DataFrame, facts: DataFrame, rules: DataFrame, sections: DataFrame, issues: DataFrame, keys: list[str]) -> DataFrame:
    """keys, extraction, quality: a book's counters, its page lists in ascending order, status and readiness.

    sections: keys, section of the built book; issues: keys, issues (of the source).
    """
    c = F.col
    gone = rules.select(*keys, F.col("section_id").alias("section")).join(sections.select(*keys, "section").distinct(), [*keys, "section"], "left_anti")
    gone = gone.groupBy(*keys).agg(F.array_sort(F.collect_set("section")).alias("missing_sections"))
    lists = {
        "missing_transcript_pages": c("content") & ~c("transcribed"),
        "unverified_transcript_pages": c("transcribed") & ~c("verified"),
        "flagged_transcript_pages": c("transcribed") & c("flagged"),
        "unapproved_content_pages": c("content") & ~c("approved"),
        "missing_analysis_pages": c("inventory") & ~c("analysed"),
        "unexpected_analysis_pages": c("analysed") & ~c("inventory"),
    }
    counts = {
        "pages_transcribed": c("transcribed"),
        "pages_expected": c("content"),
        "pages_blank": c("blank"),
        "pages_illustration": c("illustration"),
        "pages_approved": c("content") & c("approved"),
        "pages_flagged": c("transcribed") & c("flagged"),
        "analysed": c("analysed"),
    }
    g = facts.groupBy(*keys).agg(*[F.sort_array(F.collect_list(F.when(x, c("page")))).alias(n) for n, x in lists.items()], *[F.count_if(x).alias(n) for n, x in counts.items()])
    g = books.select(*keys).distinct().join(g, keys, "left").join(gone, keys, "left").join(issues.select(*keys, c("issues").alias("source_issues")), keys, "left")
    pages = F.expr("array()").cast(facts.select(F.array("page").alias("x")).schema["x"].dataType)
    texts = F.expr("cast(array() as array<string>)")
    g = g.withColumns({n: F.coalesce(n, pages) for n in lists} | {n: F.coalesce(n, texts) for n in ("missing_sections", "source_issues")}).fillna(0, list(counts))
    size = lambda n: F.size(n)
    g = g.withColumns({"source_problems": size("source_issues"), "content": c("pages_expected"), "missing_pages": size("missing_transcript_pages"), "missing_analysis": size("missing_analysis_pages"), "unexpected_analysis": size("unexpected_analysis_pages"), "flagged": size("flagged_transcript_pages"), "unverified": size("unverified_transcript_pages"), "unapproved": size("unapproved_content_pages"), "_sections": c("missing_sections")})
    g = quality.status(g.withColumn("missing_sections", size("missing_sections")))
    said = F.struct(c("status"), c("production_ready"), (c("analysed") > 0).alias("page_stats_available"), *lists, c("_sections").alias("missing_sections"), "source_issues")
    return g.select(*keys, F.struct(*[n for n in counts if n != "analysed"]).alias("extraction"), said.alias("quality"))


def build(books: DataFrame, blocks: DataFrame, rules: DataFrame, stats: DataFrame, texts: DataFrame, reports: DataFrame, reviews: DataFrame, issues: DataFrame, keys: list[str]) -> DataFrame:
    """One row per book: its fields, extraction, quality, front_matter, sections_count, sections.

    blocks: keys, page, block_ord, type, verse_num_am, spans of the asked pages;
    books: keys, book_id, title_am, title_en, total_pages and any further fields.
    Sections come by their order, equal ones as they opened.
    """
    a = assemble(opened(blocks, books, rules, keys), keys)
    own = [*keys, "page"]
    flags = reports.select(*own, F.col("review_flags").alias("_flags")).dropDuplicates(own)
    status = reviews.select(*own, F.col("status").alias("review_status")).dropDuplicates(own)
    a = a.join(flags, own, "left").join(status, own, "left")
    a = a.withColumn("review_flags", F.coalesce("_flags", F.expr("cast(array() as array<string>)"))).withColumn("text", transcripts.block_text(F.struct("spans"))).withColumn("verse_num_am", F.nullif("verse_num_am", F.lit(""))).withColumn("type", F.coalesce("type", F.lit("prayer")))
    q = book_quality(books, page_facts(books, stats, texts, reports, reviews, keys), rules, a.select(*keys, F.col("first_section").alias("section")).where("section IS NOT NULL"), issues, keys)

    block = F.struct("block_id", "type", "verse_num_am", "page", "spans", "text", "review_flags", "review_status")
    lists = a.groupBy(*keys, "section").agg(F.transform(F.sort_array(F.collect_list(F.struct("page", "block_ord", block.alias("b")))), lambda x: x["b"]).alias("blocks"))
    spans = section_spans(a, keys).drop("blocks")
    began = a.where("first_section IS NOT NULL").groupBy(*keys, F.col("first_section").alias("section")).agg(F.min(F.struct("page", "block_ord")).alias("_began"))
    more = [F.coalesce(c, F.lit(d)).alias(c) if d is not None else F.col(c) for c, d in SECTION_FIELDS.items()]
    table = rules.select(*keys, F.col("section_id").alias("section"), "ord", *SECTION_FIELDS).unionByName(
        books.join(rules.select(*keys).distinct(), keys, "left_anti").select(*keys, F.col("book_id").alias("section"), F.lit(1).alias("ord"), "title_am", "title_en", *[F.lit(None).cast("string").alias(c) for c in list(SECTION_FIELDS)[2:]])
    )
    full = spans.join(began, [*keys, "section"]).join(lists, [*keys, "section"], "left").join(table, [*keys, "section"], "left")
    one = F.struct(F.coalesce("ord", F.lit(0)).alias("order"), "_began", F.struct(F.col("section").alias("section_id"), F.coalesce("ord", F.lit(0)).alias("order"), *more, "start_page", "end_page", "blocks").alias("s"))
    sections = full.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["s"]).alias("sections"))
    front = lists.where("section IS NULL").select(*keys, F.col("blocks").alias("front_matter"))
    out = books.drop("sections").join(q, keys, "left").join(front, keys, "left").join(sections, keys, "left")
    return out.withColumn("sections_count", F.coalesce(F.size("sections"), F.lit(0)))


def transcript_blocks(transcripts_: DataFrame, keys: list[str]) -> DataFrame:
    """keys, page, block_ord, type, verse_num_am, spans of every block, in order from 1."""
    rows = transcripts_.select(*keys, "page", F.posexplode("blocks").alias("_i", "_b"))
    return rows.select(*keys, "page", (F.col("_i") + 1).alias("block_ord"), F.col("_b.type").alias("type"), F.col("_b.verse_num_am").alias("verse_num_am"), F.col("_b.spans").alias("spans"))


def block_spans(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """keys, page, block_ord, span_ord, t, c of every span, in order from 1."""
    rows = blocks.select(*keys, "page", "block_ord", F.posexplode("spans").alias("_i", "_s"))
    return rows.select(*keys, "page", "block_ord", (F.col("_i") + 1).alias("span_ord"), F.col("_s.t").alias("t"), F.col("_s.c").alias("c"))
