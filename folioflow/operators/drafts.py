"""Draft transcripts: from layout regions, from red readings, from recognised words.

Everything per block happens inside one row's arrays: where a red reading lies in
its block (fuzzy location), which characters it makes red, and the spans of one
colour.  Pages come together by one grouping, as they are stored page by page.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.sqlparts import let, lit, running
from . import core, transcripts

#: Marks that belong to the word before them, and those that a reading loses at its ends (fixed values).
ATTACHED, LOOSE = "።፡፣፤", "። "
#: How far from a block a reading's centre may lie, and a reading's height in lines (fixed values).
NEAR, PITCH = 40, 1.2
SPANS = "array<struct<t:string,c:string>>"
#: Sentences and names that drafts carry (fixed values).
WHY_RED = "red ink on the scan that was not found in this text; check spelling and colour"
NOTES = {
    "regions": "OCR draft. Check text, verse labels, block roles and colour against the scan.",
    "red": "dots.mocr draft with pixel-based red marking. Check every word and colour against the scan.",
}
SOURCES = {
    "regions": "dots OCR draft",
    "red": "dots.mocr OCR + red-mask crops (draft, needs human review)",
    "words": "tesseract on cleaned layers (draft, needs human correction)",
    "vision": "google-cloud-vision DOCUMENT_TEXT_DETECTION (am)",
}

# ---- inside a block ---------------------------------------------------------


def _nearest(needle: str, expected: str, taken: str) -> str:
    """SQL: struct(s, e) of the stretch of t_ nearest to needle, or null; st_: where stretches of t_ begin.

    Their lengths differ from the needle's by a third of it at most (at least
    one), and so do their edits; none meets a taken stretch (s, e).  Fewest edits
    win, then the place nearest to the expected share of the text, then the
    earliest, then the shortest.

    Each place is compared once, at the needle's own length.  A stretch longer or
    shorter by k differs by k edits at most from that, and by k at least from
    the needle, so the fewest edits found so settle most places and lengths.
    """
    own = "transform(st_, s_ -> named_struct('s', s_, 'l', least(nl_, tl_ - s_), 'd', levenshtein(substring(t_, s_ + 1, nl_), n_, 2 * m_)))"
    free = lambda length: f"not exists(k_, k -> k.s < p_.s + {length} and p_.s < k.e)"
    fewest = f"coalesce(array_min(transform(filter(o_, p_ -> p_.d <= m_ and nl_ - p_.l <= m_ and {free('p_.l')}), p_ -> p_.d)), m_)"
    lengths = f"filter(sequence(greatest(1, nl_ - f_), least(nl_ + f_, tl_ - p_.s)), l_ -> abs(l_ - p_.l) >= p_.d - f_ and {free('l_')})"
    one = "named_struct('d', levenshtein(substring(t_, p_.s + 1, l_), n_, f_), 'far', abs(p_.s / greatest(1, tl_) - e_), 's', p_.s, 'l', l_)"
    near = f"flatten(transform(filter(o_, p_ -> p_.d <= 2 * f_ + nl_ - p_.l and tl_ - p_.s >= greatest(1, nl_ - f_)), p_ -> transform({lengths}, l_ -> {one})))"
    best = let(f"array_min(filter({near}, x -> x.d >= 0))", "b_", "case when b_ is not null then named_struct('s', b_.s, 'e', b_.s + b_.l) end")
    body = let(f"filter({own}, p_ -> p_.d >= 0)", "o_", let(fewest, "f_", best))
    body = let("length(n_)", "nl_", let("length(t_)", "tl_", let("cast(greatest(1, ceil(length(n_) / 3)) as int)", "m_", f"case when n_ <> '' and t_ <> '' then {body} end")))
    for name, value in (("k_", taken), ("e_", f"cast({expected} as double)"), ("n_", f"trim(both {lit(LOOSE)} from {needle})")):
        body = let(value, name, body)
    return body


def _prepared(text: str, letters: str, body: str) -> str:
    """SQL: body with t_ and st_; a stretch begins at a character that is no white space and follows no letter."""
    starts = f"filter(transform(tc_, (c, i) -> case when not c rlike {lit(tx.SPACE)} and (i = 0 or not tc_[i - 1] rlike {lit(letters)}) then i end), i -> i is not null)"
    return let(text, "t_", let("regexp_extract_all(t_, '(?s).', 0)", "tc_", let(starts, "st_", body)))


def all_located(text: str, readings: str, letters: str) -> str:
    """SQL: for an array of struct(reading, expected, ...) in order, each one's stretch or null; a stretch is taken for those after it."""
    step = let(_nearest("r.reading", "r.expected", "a.taken"), "h", "named_struct('taken', case when h is null then a.taken else array_append(a.taken, h) end, 'out', array_append(a.out, h))")
    start = "named_struct('taken', cast(array() as array<struct<s:int,e:int>>), 'out', cast(array() as array<struct<s:int,e:int>>))"
    folded = f"aggregate({readings}, {start}, (a, r) -> {step}, a -> a.out)"
    none = f"transform({readings}, r -> cast(null as struct<s:int,e:int>))"
    return f"case when {text} is not null and size({readings}) > 0 then {_prepared(text, letters, folded)} else {none} end"


def coloured_spans(text: str, runs: str, letters: str, attached: str = ATTACHED) -> str:
    """SQL: spans of a text whose stretches (s, e) are red.

    Red is printed by the word: a stretch grows to the edges of its words and
    over marks attached to them.  White space and marks alone between two red
    characters are red as well.
    """
    gap = f"[{attached}{tx.SPACE[1:]}"
    left = f"length(regexp_extract(substring(t_, 1, v.s), {lit(f'{letters}+' + chr(92) + 'z')}, 0))"
    right = f"length(regexp_extract(substring(t_, v.e + 1), {lit(f'^[{attached}{letters[1:]}*')}, 0))"
    wide = f"transform({runs}, v -> named_struct('s', v.s - {left}, 'e', v.e + {right}))"
    own = let(wide, "w_", "transform(split(t_, ''), (c, i) -> exists(w_, v -> v.s <= i and i < v.e))")
    known = f"transform(split(t_, ''), (c, i) -> case when not c rlike {lit(gap)} then f_[i] end)"
    last = "coalesce({x}, {y})"
    sides = let(running("n_", last), "p_", let(f"reverse({running('reverse(n_)', last)})", "q_", "transform(f_, (x, i) -> x or (n_[i] is null and coalesce(p_[i], false) and coalesce(q_[i], false)))"))
    red = let(own, "f_", let(known, "n_", sides))
    cut = "transform(s_, (p, k) -> named_struct('t', substring(t_, p + 1, coalesce(try_element_at(s_, k + 2), length(t_)) - p), 'c', case when r_[p] then 'red' else 'black' end))"
    spans = let(red, "r_", let("filter(sequence(0, size(r_) - 1), i -> i = 0 or r_[i] <> r_[i - 1])", "s_", cut))
    return let(text, "t_", f"case when t_ = '' then cast(array() as {SPANS}) else {spans} end")


def merged_spans(parts: str) -> str:
    """SQL: an array of struct(t, c), neighbours of one colour made one span."""
    cut = "transform(s_, (p, k) -> named_struct('t', array_join(transform(slice(x_, p + 1, coalesce(try_element_at(s_, k + 2), size(x_)) - p), y -> y.t), ''), 'c', x_[p].c))"
    body = let("filter(sequence(0, size(x_) - 1), i -> i = 0 or x_[i].c <> x_[i - 1].c)", "s_", cut)
    return let(parts, "x_", f"case when size(x_) = 0 then cast(array() as {SPANS}) else {body} end")


def aligned_spans(text: str, words: str) -> str:
    """SQL: spans of a region whose tokens are its words one by one (struct(text, is_red)), each with the white space before it; null where they differ."""
    token, piece = lit(f"{tx.NOT_SPACE}+"), lit(f"{tx.SPACE}*{tx.NOT_SPACE}+")
    same = f"size(w_) > 0 and regexp_extract_all(t_, {token}, 0) = transform(w_, w -> w.text)"
    parts = f"transform(regexp_extract_all(t_, {piece}, 0), (p, i) -> named_struct('t', case when i + 1 = size(w_) then concat(p, regexp_extract(t_, {lit(tx.SPACE + '*' + chr(92) + 'z')}, 0)) else p end, 'c', case when w_[i].is_red then 'red' else 'black' end))"
    return let(text, "t_", let(words, "w_", f"case when {same} then {merged_spans(parts)} end"))


# ---- from layout regions ------------------------------------------------------


def region_drafts(regions: DataFrame, words: DataFrame, page: str = "page") -> DataFrame:
    """One draft per page of layout regions: page, blocks, colour_unresolved, notes, corrections, uncertain, clipped, source, error.

    regions: page, ord, category, text, x1, y1, x2, y2.  words: page, line, word,
    text, is_red, x1, y1, x2, y2.  A region is coloured only where all its tokens
    are the words whose centres it holds, in reading order; else it is black and
    its ord is listed.  Pictures go; a page without text regions gets an error.
    """
    held = core.inside(words.withColumn("_row", F.struct("line", "word")), regions, [page], first=False)
    inner = held.select(page, F.explode("regions").alias("ord"), F.struct("_row", "text", "is_red").alias("_w")).groupBy(page, "ord").agg(F.sort_array(F.collect_list("_w")).alias("_words"))
    body = regions.where(~F.col("category").eqNullSafe("Picture")).join(inner, [page, "ord"], "left")
    body = body.withColumn("_spans", F.expr(aligned_spans("text", "_words")))
    kind = F.when(F.col("category").isin("Title", "Section-header"), "title").otherwise("prayer")
    block = F.struct("ord", F.struct(kind.alias("type"), F.lit("").alias("verse_num_am"), F.coalesce("_spans", F.array(F.struct(F.col("text").alias("t"), F.lit("black").alias("c")))).alias("spans"), F.array("x1", "y1", "x2", "y2").alias("bbox"), F.col("category").alias("layout_category"), F.col("_spans").isNotNull().alias("colour_aligned")).alias("b"))
    drafts = body.groupBy(page).agg(F.sort_array(F.collect_list(block)).alias("_b"), F.sort_array(F.collect_list(F.when(F.col("_spans").isNull(), F.col("ord")))).alias("colour_unresolved"))
    out = regions.select(page).distinct().join(drafts, page, "left")
    error = F.when(F.col("_b").isNull(), "content page produced no text regions")
    return _finished(out.withColumn("blocks", F.transform("_b", lambda x: x["b"])), page, "regions", ["colour_unresolved"], error=error)


def _finished(df: DataFrame, page: str, kind: str, more: list[str], error: Column | None = None, notes: Column | None = None, uncertain: Column | None = None, clipped: Column | None = None) -> DataFrame:
    """The fields that every draft has."""
    none = lambda t: F.expr(f"cast(array() as array<struct<{t}>>)")
    return df.select(
        page,
        "blocks",
        (notes if notes is not None else F.lit(NOTES[kind])).alias("notes"),
        none("printed:string,suggested:string,reason:string").alias("corrections"),
        (uncertain if uncertain is not None else none("text:string,why:string")).alias("uncertain"),
        (clipped if clipped is not None else none("edge:string,note:string")).alias("clipped"),
        F.lit(SOURCES[kind]).alias("source"),
        *more,
        (error if error is not None else F.lit(None).cast("string")).alias("error"),
    )


# ---- from red readings --------------------------------------------------------


def red_drafts(regions: DataFrame, readings: DataFrame, ignore: Iterable[str] = (), page: str = "page", script=tx.ALPHABETS["ethiopic"], letters=tx.ALPHABETS["letter"], numeral=tx.ALPHABETS["numeral"], attached: str = ATTACHED) -> DataFrame:
    """One transcript per page of regions: page, page_header, blocks, uncertain, ..., red_regions, red_located, error.

    regions: page, ord, category, text, box; readings: page, ord, text, box of red
    ink.  Regions are cleaned; pictures, empty ones and watermarks (`ignore`) go,
    running heads are joined.  A reading of two script characters or more belongs
    to the first block near its centre (others are ink in a margin) and is located
    in its text in the order of readings; what is not found, and is no border read
    as text, is listed as uncertain.  Verse numerals leave the text.
    """
    letter, number = tx.char_class(letters), tx.char_class(numeral)
    cells = transcripts.body_regions(regions.withColumn("text", tx.clean_text(F.coalesce("text", F.lit("")))), ignore)
    heading = F.col("category").isin("Page-header", "Page-footer")
    heads = transcripts.page_headers(cells, [page], "ord", F.coalesce(heading, F.lit(False))).select(page, "page_header")
    body = cells.where(~F.coalesce(heading, F.lit(False)))

    red = readings.where(tx.count_in(F.coalesce("text", F.lit("")), script) >= 2)
    own = core.inside(red, body, [page], NEAR).where("region IS NOT NULL")
    found = F.struct("ord", tx.clean_text(F.col("text")).alias("reading"), *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    per = own.groupBy(page, F.col("region").alias("ord")).agg(F.sort_array(F.collect_list(found)).alias("_r"))
    cells = body.join(per, [page, "ord"], "left")
    pitch = "greatest(1.0D, (r.y2 - r.y1) * 1.2D)"
    rows = f"greatest(1, cast(bround((y2 - y1) / {pitch}) as int))"
    row = f"least({rows} - 1, greatest(0, cast(floor(((r.y1 + r.y2) / 2 - y1) / {pitch}) as int)))"
    expected = f"({row} + ((r.x1 + r.x2) / 2 - x1) / greatest(1.0D, x2 - x1)) / {rows}"
    cells = cells.withColumn("_r", F.expr(f"transform(_r, r -> named_struct('ord', r.ord, 'reading', r.reading, 'expected', cast({expected} as double), 'bbox', array(r.x1, r.y1, r.x2, r.y2)))"))
    cells = cells.withColumn("_h", F.expr(all_located("text", "_r", letter)))
    lost = F.filter(F.arrays_zip("_r", "_h"), lambda p: p["_h"].isNull() & ~tx.is_ornament_reading(p["_r"]["reading"], letters))
    doubt = F.transform(lost, lambda p: F.struct(p["_r"]["ord"].alias("ord"), F.struct(F.btrim(p["_r"]["reading"], F.lit(LOOSE)).alias("text"), p["_r"]["bbox"].alias("bbox"), F.lit(WHY_RED).alias("why")).alias("u")))
    cells = cells.withColumn("_lost", doubt).withColumn("_v", tx.verse_split(F.col("text"), F.col("category"), number))
    runs = tx.shift_runs(F.filter(F.coalesce("_h", F.expr("cast(array() as array<struct<s:int,e:int>>)")), lambda h: h.isNotNull()), F.col("_v.cut"))
    cells = cells.withColumn("_runs", runs).withColumn("_spans", F.expr(coloured_spans("_v.text", "_runs", letter, attached)))
    box = F.array(*[F.bround(c).cast("long") for c in ("x1", "y1", "x2", "y2")])
    block = F.struct("ord", F.struct(tx.role_of(F.col("category"), F.col("_v.verse")).alias("type"), F.col("_v.verse").alias("verse_num_am"), F.col("_spans").alias("spans"), box.alias("bbox"), F.col("category").alias("layout_category")).alias("b"))
    located_ = F.coalesce(F.size(F.filter("_h", lambda h: h.isNotNull())), F.lit(0))
    drafts = cells.groupBy(page).agg(F.sort_array(F.collect_list(block)).alias("_b"), F.sort_array(F.flatten(F.collect_list("_lost"))).alias("_u"), F.sum(F.greatest(located_, F.lit(0))).alias("red_located"))
    counted = red.groupBy(page).agg(F.count("*").alias("red_regions"))
    out = regions.select(page).distinct().join(heads, page, "left").join(drafts, page, "left").join(counted, page, "left")
    out = out.withColumn("blocks", F.transform("_b", lambda x: x["b"])).fillna(0, ["red_regions", "red_located"]).fillna("", ["page_header"])
    error = F.when(F.col("_b").isNull(), F.concat(F.lit("page "), F.col(page).cast("string"), F.lit(": no text blocks after cleanup")))
    return _finished(out, page, "red", ["page_header", "red_regions", "red_located"], error=error, uncertain=F.transform("_u", lambda x: x["u"]))


# ---- from recognised words ------------------------------------------------------


def joined_spans() -> Column:
    """The spans of _w, an array of words (t, c) in order."""
    # Each word but a span's first carries its space.
    spaced = "transform(_w, (w, i) -> named_struct('t', case when i > 0 and _w[i - 1].c = w.c then concat(' ', w.t) else w.t end, 'c', w.c))"
    return F.filter(F.expr(merged_spans(spaced)), lambda s: tx.strip(s["t"]) != "")


def word_drafts(pages: DataFrame, lines: DataFrame, words: DataFrame, page: str = "page", numeral=tx.ALPHABETS["numeral"], least: float = 70.0, listed: int = 30) -> DataFrame:
    """One draft per page of layout lines: blocks, uncertain, clipped, notes.

    pages: page, height, word_count; lines: page, line, looks_like_title, top,
    bottom; words: page, line, word, text, conf, is_red.  A title line is a block
    of its own; a line that opens with a numeral opens a verse, whose numeral
    leaves the text (on a title it is lost); other lines go on.  Words under
    `least` confidence are listed, `listed` of them at most.
    """
    # Words travel twice: to their line, and with it to their page; the rest is done where a page lies.
    item = F.struct("word", "text", "is_red", "conf")
    own = words.groupBy(page, "line").agg(F.sort_array(F.collect_list(item)).alias("_w"))
    own = own.join(lines.select(page, "line", F.coalesce("looks_like_title", F.lit(False)).alias("_t")), [page, "line"], "left").repartition(page)
    head = F.col("_w")[0]["text"]
    # Words of lines that are not listed are in no block, but may be uncertain.
    heads = own.withColumn("_own", F.col("_t").isNotNull()).withColumn("_n", F.when(tx.is_numeral(head, numeral), tx.strip(head)))
    heads = transcripts.line_blocks(heads, [page, "_own"], ["line"], F.col("_t"), F.col("_n").isNotNull())
    opened = F.min_by(F.struct(F.when(F.col("kind") == "title", "title").when(F.col("kind") == "verse", "verse").otherwise("prayer").alias("type"), F.when(F.col("kind") == "verse", F.col("_n")).otherwise("").alias("verse_num_am")), "line")
    coloured = F.transform("_w", lambda w: F.struct(w["text"].alias("t"), F.when(w["is_red"], "red").otherwise("black").alias("c")))
    left = F.when(F.col("_n").isNotNull(), F.slice(coloured, 2, F.size("_w"))).otherwise(coloured)
    why = lambda w: F.concat(F.lit("Tesseract confidence "), F.bround(w["conf"]).cast("long").cast("string"), F.lit(" — check against the scan"))
    said = F.transform(F.filter("_w", lambda w: w["conf"] < least), lambda w: F.struct(w["text"].alias("text"), why(w).alias("why")))
    ordered = lambda c: F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("line", c))), lambda x: x["v"]))
    blocks = heads.groupBy(page, "_own", "block").agg(opened.alias("_o"), ordered(left.alias("v")).alias("_w"), F.collect_list(F.struct("line", said.alias("v"))).alias("_u"))
    blocks = blocks.withColumn("spans", joined_spans())
    one = F.struct("block", F.struct("_o.type", "_o.verse_num_am", "spans").alias("b"))
    listed_blocks = F.collect_list(F.when(F.col("_own") & (F.size("spans") > 0), one))
    doubts = F.flatten(F.transform(F.sort_array(F.flatten(F.collect_list("_u"))), lambda x: x["v"]))
    body = blocks.groupBy(page).agg(F.transform(F.sort_array(listed_blocks), lambda x: x["b"]).alias("blocks"), doubts.alias("_u"))
    # The sentences on cut lines and on the draft as a whole.
    note = F.create_map(F.lit("top"), F.lit("First line sits against the top edge of the scan — it is probably sliced and words may be missing."), F.lit("bottom"), F.lit("Last line runs into the bottom edge of the scan — it is probably sliced and words may be missing."))
    cut = transcripts.clipped_edges(lines.join(pages.select(page, "height"), page), [page], "line", "top", "bottom", F.col("height"))
    cut = cut.select(page, F.transform("edges", lambda e: F.struct(e.alias("edge"), note[e].alias("note"))).alias("_c"))
    out = pages.join(body, page, "left").join(cut, page, "left")
    empty = lambda c, like: F.coalesce(c, F.array().cast(dict(out.dtypes)[like]))
    u = empty(F.col("_u"), "_u")
    notes = F.concat(F.lit("DRAFT — Tesseract reading of the cleaned page layers, not a checked transcription. "), F.size(u).cast("string"), F.lit(" of "), F.coalesce("word_count", F.lit(0)).cast("string"), F.lit(f" words scored below {least:.0f} confidence and are listed as uncertain. Expect glyph-level slips throughout; every word needs reading against the scan. Colour and verse numerals are derived from pixels and are more reliable than the text."))
    return _finished(out.withColumn("blocks", empty(F.col("blocks"), "blocks")), page, "words", [], notes=notes, uncertain=F.slice(u, 1, listed), clipped=empty(F.col("_c"), "_c"))


def vision_drafts(pages: DataFrame, words: DataFrame, page: str = "page", least: float = 0.80, listed: int = 40) -> DataFrame:
    """One draft per page of a response's words: blocks, uncertain, mean_confidence, notes.

    words: page, word (their order), text, parent, break_after, conf, is_red.  A
    block ends where the parent changes; breaks become spaces; words with a
    confidence above 0 and below `least` are listed.  A page without words is an
    empty draft that says so.
    """
    spans = transcripts.broken_runs(_parent_blocks(words, page), [page, "block"], ["word"], "colour", "text", "break_after")
    per = spans.groupBy(page, "block").agg(F.transform(F.sort_array(F.collect_list(F.struct("run", F.struct(F.col("text").alias("t"), F.col("colour").alias("c")).alias("s")))), lambda x: x["s"]).alias("spans"))
    one = F.struct("block", F.struct(F.lit("prayer").alias("type"), F.lit("").alias("verse_num_am"), "spans").alias("b"))
    body = per.groupBy(page).agg(F.transform(F.sort_array(F.collect_list(one)), lambda x: x["b"]).alias("blocks"))
    conf = F.col("conf")
    fixed = lambda c: F.format_string("%.2f", F.bround(c, 2))
    say = F.when((conf > 0) & (conf < least), F.struct("word", F.struct("text", F.concat(F.lit("Vision confidence "), fixed(conf)).alias("why")).alias("u")))
    seen = words.groupBy(page).agg(F.count("*").alias("_n"), F.coalesce(F.avg(F.when(conf > 0, conf)), F.lit(0.0)).alias("_mean"), F.slice(F.transform(F.sort_array(F.collect_list(say)), lambda x: x["u"]), 1, listed).alias("_u"))
    out = pages.join(body, page, "left").join(seen, page, "left")
    empty = lambda c: F.coalesce(c, F.array().cast(dict(out.dtypes)[c]))
    # The sentences on an empty response and on a draft from one.
    notes = F.when(F.col("_n").isNull(), "Google Vision returned no text for this page.").otherwise(F.concat(F.lit("Transcribed by Google Cloud Vision (Amharic is an experimental language for Vision). Mean word confidence "), fixed(F.col("_mean")), F.lit(" over "), F.col("_n").cast("string"), F.lit(" words. Block types and verse numerals are not detected by OCR and need setting during review.")))
    out = out.withColumn("mean_confidence", F.bround("_mean", 3)).withColumn("blocks", empty("blocks"))
    return _finished(out, page, "vision", ["mean_confidence"], notes=notes, uncertain=empty("_u"))


def _parent_blocks(words: DataFrame, page: str) -> DataFrame:
    """words with block (a new one wherever the parent changes) and colour."""
    w = Window.partitionBy(page).orderBy("word")
    new = ~F.col("parent").eqNullSafe(F.lag("parent").over(w)) | (F.row_number().over(w) == 1)
    return core.islands(words.withColumn("_new", new), [page], ["word"], F.col("_new"), "block").withColumn("colour", F.when(F.col("is_red"), "red").otherwise("black")).drop("_new")


# ---- candidates -------------------------------------------------------------------


def adopted(pages: DataFrame, candidates: DataFrame, readings: DataFrame, drafts: DataFrame, existing: DataFrame, legacy: DataFrame, page: str = "page") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(outcomes, baseline, legacy) of adopting drafts for the asked pages.

    outcomes: page, outcome (adopted, missing_candidate, missing_red), uncertain.
    baseline: the adopted drafts with the name of the page's legacy copy, if any.
    legacy: name and body of files to keep from `existing` (page, name, body) that
    are not in `legacy` (name) yet; sidecars of adopted pages leave the baseline.
    """
    has = lambda df, name: df.select(page).distinct().withColumn(name, F.lit(True))
    p = pages.select(page).distinct().join(has(candidates, "_c"), page, "left").join(has(readings, "_r"), page, "left")
    outcome = F.when(F.col("_c").isNull(), "missing_candidate").when(F.col("_r").isNull(), "missing_red").otherwise("adopted")
    said = p.select(page, outcome.alias("outcome"))
    done = said.where("outcome = 'adopted'").select(page)
    sizes = drafts.select(page, F.size("uncertain").alias("_n"))
    outcomes = said.join(sizes, page, "left").select(page, "outcome", F.when(F.col("outcome") == "adopted", F.greatest(F.coalesce("_n", F.lit(0)), F.lit(0))).otherwise(0).alias("uncertain"))
    kept = existing.join(done, page, "left_semi").join(legacy.select("name").distinct(), "name", "left_anti").select(page, "name", "body")
    main = tx.page_stem(F.col(page))
    old = kept.select("name").union(legacy.select("name")).distinct().withColumnRenamed("name", "_name")
    base = drafts.join(done, page, "left_semi").join(old, F.concat(main, F.lit(".json")) == F.col("_name"), "left")
    return outcomes, base.withColumn("legacy", F.when(F.col("_name").isNotNull(), F.concat(F.lit("transcripts-legacy/"), "_name"))).drop("_name"), kept


def adopt_summary(outcomes: DataFrame, page: str = "page", keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per book (keys): adopted, missing_candidate, missing_red (sorted pages), uncertain (sum)."""
    listed = lambda k: F.sort_array(F.collect_list(F.when(F.col("outcome") == k, F.col(page)))).alias(k)
    return outcomes.groupBy(*keys).agg(listed("adopted"), listed("missing_candidate"), listed("missing_red"), F.coalesce(F.sum("uncertain"), F.lit(0)).alias("uncertain"))
