"""Transcripts from recognised regions and words, and the ordered flags of a page."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import matching
from ..functions import text as tx
from ..functions.sqlparts import rounded
from . import core

#: Break types after which a space follows (fixed values).
BREAKS = ("SPACE", "EOL_SURE_SPACE", "LINE_BREAK", "HYPHEN")
#: Limits of the checks (fixed values).
RED_TOLERANCE, LEAST_AGREEMENT, REJECT_AGREEMENT, REJECT_UNCERTAIN = 0.18, 0.25, 0.35, 4


def body_regions(regions: DataFrame, patterns: Iterable[str], category: str = "category", text: str = "text") -> DataFrame:
    """Drops pictures, empty regions and those in which any pattern is found."""
    t = F.coalesce(F.col(text), F.lit(""))
    found = reduce(lambda a, p: a | t.rlike(p), patterns, F.lit(False))
    return regions.where(~F.col(category).eqNullSafe("Picture") & (t != "") & ~found)


def page_headers(regions: DataFrame, keys: list[str], order: str, is_header: Column, text: str = "text") -> DataFrame:
    """Per page: running headers joined by a space, and how many regions are body."""
    parts = F.sort_array(F.collect_list(F.when(is_header, F.struct(F.col(order).alias("o"), F.col(text).alias("t")))))
    return regions.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p["t"]), " ").alias("page_header"), F.count_if(~is_header).alias("body"))


def coloured_regions(tokens: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """tokens (keys, tokens), words (keys, words, colours): a colour per token where both agree token by token, else all black and unaligned."""
    j = tokens.join(words, keys, "left")
    ok = F.coalesce(core.aligned(F.col("tokens"), F.col("words")), F.lit(False))
    return j.select(*keys, "tokens", F.when(ok, F.col("colours")).otherwise(F.transform("tokens", lambda _: F.lit("black"))).alias("colours"), (~ok).alias("unaligned"))


def broken_runs(words: DataFrame, keys: list[str], order: list[str], colour: str, text: str, after: str) -> DataFrame:
    """Neighbours of one colour with the spaces their breaks ask for; two spaces become one, blank runs go."""
    piece = F.concat(text, F.when(F.col(after).isin(*BREAKS), " ").otherwise(""))
    r = core.runs(words.withColumn("_piece", piece), keys, order, colour, "_piece", "")
    return r.withColumn("text", F.replace("text", F.lit("  "), F.lit(" "))).where(~F.col("text").rlike(r"^\s*$"))


def parent_blocks(words: DataFrame, keys: list[str], order: list[str], parent: str, text: str) -> DataFrame:
    """A new block wherever the parent differs from the word before."""
    return core.runs(words, keys, order, parent, text)


def line_blocks(lines: DataFrame, keys: list[str], order: list[str], title: Column, numeral: Column) -> DataFrame:
    """Numbers blocks: a title stands alone, a numeral opens a verse unless it lies on a title; other lines go on."""
    w = Window.partitionBy(*keys).orderBy(*order)
    t = lines.withColumn("_title", F.coalesce(title, F.lit(False))).withColumn("_num", ~F.col("_title") & F.coalesce(numeral, F.lit(False)))
    starts = F.col("_title") | F.col("_num") | F.coalesce(F.lag("_title").over(w), F.lit(True))
    return core.islands(t.withColumn("_start", starts), keys, order, F.col("_start"), "block").withColumn("kind", F.when(F.col("_title"), "title").when(F.col("_num"), "verse")).drop("_title", "_num", "_start")


def clipped_edges(lines: DataFrame, keys: list[str], order: str, top: str, bottom: str, height: Column) -> DataFrame:
    """Edges at which a page's first or last line touches the outer 3 % of the page."""
    g = lines.groupBy(*keys).agg(F.min_by(top, order).alias("_t"), F.max_by(bottom, order).alias("_b"), F.max(height).alias("_h"))
    edge = F.array_compact(F.array(F.when(F.col("_t") <= 0.03 * F.col("_h"), "top"), F.when(F.col("_b") >= F.col("_h") - 0.03 * F.col("_h"), "bottom")))
    return g.select(*keys, edge.alias("edges"))


def undecided(corrections: Column) -> Column:
    """Suggestions neither applied nor dismissed; a missing mark is no."""
    return F.filter(corrections, lambda c: ~F.coalesce(c["applied"], F.lit(False)) & ~F.coalesce(c["dismissed"], F.lit(False)))


def block_text(block: Column) -> Column:
    """A block's span texts, one after the other."""
    return F.array_join(F.transform(block["spans"], lambda s: s["t"]), "")


def page_text(blocks: Column) -> Column:
    """A page's block texts, a line each."""
    return F.array_join(F.transform(blocks, block_text), "\n")


def red_text(blocks: Column) -> Column:
    """A page's red spans, one after the other."""
    spans = F.flatten(F.transform(blocks, lambda b: b["spans"]))
    return F.array_join(F.transform(F.filter(spans, lambda s: s["c"] == "red"), lambda s: s["t"]), "")


#: How far line counts may differ before a page without text is suspicious (fixed value).
LINE_TOLERANCE = 0.5


def page_checks(pages: DataFrame, key: str = "page", alphabet: str = "verify", latin=tx.ALPHABETS["latin"], digit=tx.ALPHABETS["digit"], ranges=None) -> DataFrame:
    """Adds what the checks of a page need and find.

    Columns of pages: has_transcript, blocks, source, uncertain, clipped,
    corrections (null where the file lacks them), mask_red (null without
    evidence), ocr_text (recognised words without separators, null or empty
    without layout), ocr_lines.  Added: latin, latin_shown, digits, script_chars,
    model_red (share of red characters, 0 for an empty page), agreement (ratio of
    recognised to transcribed text, null without either), model_lines,
    empty_type, draft.
    """
    form = (lambda c: tx.normalize(c, alphabet)) if ranges is None else (lambda c: tx.keep_alphabet(tx.composed(c), ranges))
    b = F.coalesce("blocks", F.array().cast(dict(pages.dtypes)["blocks"]))
    p = pages.withColumn("_full", page_text(b)).withColumn("_norm", form(F.col("_full"))).withColumn("_red", form(red_text(b))).withColumn("_ocr", form(F.coalesce("ocr_text", F.lit(""))))
    empty = F.filter(b, lambda x: (x["type"] != "ornament") & (tx.strip(block_text(x)) == ""))
    both = (F.col("_ocr") != "") & (F.col("_norm") != "")
    lines = F.aggregate(b, F.lit(0), lambda n, x: n + F.greatest(F.lit(1), F.size(x["spans"])))
    p = p.withColumns(
        {
            "latin": tx.count_in(F.col("_full"), latin),
            "latin_shown": tx.first_in(F.col("_full"), latin),
            "digits": tx.count_in(F.col("_full"), digit),
            "script_chars": F.length("_norm").cast("long"),
            "model_red": F.coalesce(F.length("_red") / F.nullif(F.length("_norm"), F.lit(0)), F.lit(0.0)),
            "agreement": F.when(both, matching.ratio("_ocr", "_norm")),
            "model_lines": lines,
            "empty_type": F.try_element_at(empty, F.lit(1))["type"],
            "draft": tx.is_draft(F.col("source")),
        }
    )
    return p.drop("_full", "_norm", "_red", "_ocr")


def page_flags(p: DataFrame, key: str = "page") -> DataFrame:
    """key, flags: the sentences of a page's report in their fixed order.

    Columns of p: has_transcript, uncertain (text), clipped (edge), corrections
    (printed, suggested, applied, dismissed; each list null where the file lacks
    it), latin, digits (counts), latin_shown, model_red, mask_red (shares; mask
    null without evidence), has_layout, colour_from_mask, has_image, agreement
    (null without text on both sides), script_chars, ocr_lines, model_lines,
    empty_type (of the first empty block that is no ornament), unresolved.
    """
    c, text = F.col, F.lit
    say = lambda cond, *parts: F.when(cond, F.concat(*[x if isinstance(x, Column) else text(x) for x in parts]))
    count = lambda name: F.coalesce(F.size(F.when(c(name).isNotNull(), c(name))), text(0))
    shown = lambda items: core.preview(items, 4)
    two = lambda x: F.format_string("%.2f", F.expr(rounded(x, 2)))
    lacking = F.array_compact(F.array(F.when(c("uncertain").isNull(), "uncertain"), F.when(c("clipped").isNull(), "clipped")))
    p = p.withColumn("_agreed", two("agreement")).withColumn("_model", two("model_red")).withColumn("_mask", two("mask_red")).withColumn("_agreement", F.expr(rounded("agreement", 3)))
    p = p.withColumn("_agreement2", two("_agreement"))
    many, gap = count("uncertain"), c("model_red") - c("mask_red")
    open_ = undecided(F.coalesce(c("corrections"), F.expr("array()").cast(p.schema["corrections"].dataType)))
    off = (c("ocr_lines") > 0) & (F.abs(c("model_lines") - c("ocr_lines")) / c("ocr_lines").cast("double") > LINE_TOLERANCE)
    n = lambda x: x.cast("string")
    flags = F.array_compact(
        F.array(
            say((c("_agreement") < REJECT_AGREEMENT) & (many >= REJECT_UNCERTAIN), "REJECT — likely not a real transcription (agreement ", c("_agreement2"), ", ", n(many), " uncertain). Check this page against its scan before reviewing it."),
            say(F.size(lacking) > 0, "legacy transcript missing review field(s): ", F.array_join(lacking, ", ")),
            say(c("latin") > 0, n(c("latin")), " Latin characters in Ethiopic text: '", c("latin_shown"), "'"),
            say(c("digits") > 0, n(c("digits")), " ASCII digits (Ethiopic numerals expected)"),
            say(c("mask_red").isNull(), "missing colour-mask evidence; run split before verification"),
            say(~c("colour_from_mask") & ~c("has_layout"), "missing word-layout evidence; run layout before verification"),
            say(~c("has_image"), "missing original page image"),
            say(F.abs(gap) > RED_TOLERANCE, "red coverage ", F.when(gap > 0, "over").otherwise("under"), "-marked: model ", c("_model"), " vs mask ", c("_mask")),
            say(off & (c("script_chars") == 0), "model produced no text but Tesseract found lines"),
            say(c("agreement") < LEAST_AGREEMENT, "text agreement with Tesseract only ", c("_agreed")),
            say(c("agreement").isNull() & (c("script_chars") == 0), "transcript contains no Ethiopic text"),
            say(c("empty_type").isNotNull(), "empty ", c("empty_type"), " block"),
            say(many > 0, n(many), " uncertain word(s) to check: ", shown(F.transform("uncertain", lambda u: F.coalesce(u["text"], text("?"))))),
            say(count("clipped") > 0, "TEXT CUT OFF at ", F.array_join(F.transform("clipped", lambda u: F.coalesce(u["edge"], text("?"))), ", "), " of page — ", n(count("clipped")), " line(s) missing"),
            say(F.size(open_) > 0, n(F.size(open_)), " spelling suggestion(s) to review: ", shown(F.transform(open_, lambda u: F.concat_ws("→", u["printed"], u["suggested"])))),
            say(c("unresolved"), "OCR candidate has unresolved colour alignment"),
        )
    )
    return p.select(key, F.when(F.coalesce(c("has_transcript"), text(False)), flags).otherwise(F.array(text("no transcript"))).alias("flags"))


def report_totals(reports: DataFrame, page: str = "page", flags: str = "flags", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per book (keys): pages_checked, pages_flagged, flagged_pages (ascending)."""
    hit = F.size(flags) > 0
    return reports.groupBy(*keys).agg(F.count("*").alias("pages_checked"), F.count_if(hit).alias("pages_flagged"), F.sort_array(F.collect_list(F.when(hit, F.col(page)))).alias("flagged_pages"))


def layout_hint(lines: DataFrame, words: DataFrame, page: str = "page") -> DataFrame:
    """page, hint: counts, then each layout line with the colour of its words. lines: page, line, looks_like_title; words: page, line, word, text, is_red."""
    tagged = F.concat("text", F.lit("["), F.when(F.col("is_red"), "RED").otherwise("BLACK"), F.lit("]"))
    per = words.groupBy(page, "line").agg(F.transform(F.sort_array(F.collect_list(F.struct("word", tagged.alias("t")))), lambda x: x["t"]).alias("_w"), F.count("*").alias("_n"), F.count_if("is_red").alias("_red"))
    j = lines.join(per, [page, "line"], "left")
    title = F.when(F.col("looks_like_title"), " (looks like a centred title)").otherwise("")
    line = F.concat(F.lit("  line "), F.col("line").cast("string"), title, F.lit(": "), F.coalesce(F.array_join("_w", " "), F.lit("")))
    g = j.groupBy(page).agg(F.transform(F.sort_array(F.collect_list(F.struct("line", line.alias("t")))), lambda x: x["t"]).alias("_l"), F.count("*").alias("_lines"), F.coalesce(F.sum("_n"), F.lit(0)).alias("_words"), F.coalesce(F.sum("_red"), F.lit(0)).alias("_red"))
    head = F.concat(F.lit("Tesseract found "), F.col("_lines").cast("string"), F.lit(" lines, "), F.col("_words").cast("string"), F.lit(" words, "), F.col("_red").cast("string"), F.lit(" of them red."))
    note = F.lit("Per line (Tesseract's text is unreliable; the [RED]/[BLACK] flags are not):")
    return g.select(page, F.array_join(F.concat(F.array(head, note), F.col("_l")), "\n").alias("hint"))


def layout_text(words: DataFrame, page: str = "page") -> DataFrame:
    """page, ocr_text, ocr_lines: a layout's word texts in order without separators, and its number of lines."""
    return words.groupBy(page).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "word", "text"))), lambda x: x["text"]), "").alias("ocr_text"), F.countDistinct("line").alias("ocr_lines"))


#: What an import says of an approval it withdraws (fixed value).
WITHDRAWN = " [approval withdrawn on import: it referred to an older baseline text]"


def imported_reviews(entries: DataFrame, imported: DataFrame, key: str = "page") -> DataFrame:
    """key, status, note, withdrawn: approvals survive only where the same export brought the page's text; others are withdrawn and say so."""
    have = imported.select(F.col(key).alias("_k"), F.lit(True).alias("_have")).distinct()
    gone = (F.col("status") == "approved") & F.col("_have").isNull()
    note = tx.strip(F.coalesce("note", F.lit("")))
    out = entries.join(have, F.col(key) == F.col("_k"), "left").withColumn("withdrawn", F.coalesce(gone, F.lit(False)))
    return out.select(key, F.when(~F.col("withdrawn"), F.col("status")).alias("status"), F.when(F.col("withdrawn"), tx.strip(F.concat(note, F.lit(WITHDRAWN)))).otherwise(note).alias("note"), "withdrawn")
