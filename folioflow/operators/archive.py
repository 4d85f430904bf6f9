"""The archived form: recognition attempts, sections found by fuzzy titles, books of paragraphs.

Pages, rules and lines meet in one row where they belong together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import matching
from ..functions import text as tx
from ..functions.sqlparts import let, lit

#: A score that ends the search, and the least that counts (fixed values).
SURE, LEAST = 0.72, 0.55
#: Lines of a page's head, lines searched for a start, lines looked at together (fixed values).
HEAD, SEARCHED, TOGETHER = 6, 24, 3
#: Confidence and script characters below which a page is doubtful (fixed values).
DOUBTFUL, FEW = 60, 20
#: Modes tried on processed and on original images, in this order (fixed values).
PROCESSED, ORIGINAL = (6, 4, 3), (4, 6)
LINE_BREAK = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"
#: Artefacts of a page, and of a book, that a report lists; pages that its text lists (fixed values).
PAGE_ARTEFACTS, BOOK_ARTEFACTS, LISTED = 5, 250, 120
UNASSIGNED = "front_matter_or_unassigned"
NO_CONFIDENCE = "Tesseract confidence was unavailable for the selected OCR result."
LOW_CONFIDENCE = "Low Tesseract confidence; manual review recommended."
LITTLE_TEXT = "Very little Ethiopic text detected; page may be cover/artwork/blank or OCR failed."


@dataclass(frozen=True)
class Script:
    """What of a text counts, and the words that tell a paragraph's kind (fixed values)."""

    letters: tuple = tx.ALPHABETS["v1"]
    numerals: tuple = tx.ALPHABETS["numeral"]
    heading: tuple[str, ...] = ("ጸሎት", "ውዳሴ", "ማርያም", "ብርሃን")
    scripture: tuple[str, ...] = ("ወንጌል", "መዝሙር", "ምዕራፍ")
    instruction: tuple[str, ...] = ("በል", "ይበል", "ትበል")
    #: Kinds of short and long paragraphs by how a category ends.
    kinds: tuple[tuple[str, str, str], ...] = (("_weekday", "stanza", "hymn"), ("_hymn", "stanza", "hymn"), ("_prayer", "prayer", "prayer"))

    def norm(self, text: str) -> str:
        """SQL: a text's script characters without numerals."""
        return f"regexp_replace(regexp_replace({text}, {lit(tx.char_class(self.letters, True))}, ''), {lit(tx.char_class(self.numerals))}, '')"


def _lines(text: str) -> str:
    """SQL: the lines of a text; a final line break begins no line."""
    return f"case when {text} = '' then cast(array() as array<string>) else split(regexp_replace({text}, {lit(f'(?:{LINE_BREAK})' + chr(92) + 'z')}, ''), {lit(LINE_BREAK)}) end"


def _strip(text: str) -> str:
    return f"btrim({text}, {lit(tx.SPACES)})"


def held(text: str, groups: str, script: Script) -> str:
    """SQL: every group (of normalised alternatives) has one that is not empty and that the normalised text holds."""
    return let(script.norm(text), "h_", f"forall({groups}, g -> exists(g, a -> a <> '' and contains(h_, a)))")


def start_line(text: str, groups: str, script: Script) -> str:
    """SQL: the first line from which on TOGETHER lines hold all groups (normalised), among the first SEARCHED; null where none does."""
    window = f"array_join(slice(v_, i_ + 1, {TOGETHER}), chr(10))"
    first = f"try_element_at(filter(sequence(0, least(size(v_), {SEARCHED}) - 1), i_ -> {held(window, groups, script)}), 1)"
    return let(_lines(text), "v_", f"case when size(v_) > 0 then {first} end")


def section_scores(pages: DataFrame, rules: DataFrame, keys: list[str], script: Script = Script()) -> DataFrame:
    """keys, page, ord, section_id, score, start_line: each page against each rule of its book. A null text is empty.

    rules: keys, ord, section_id, title_am, keywords, required_any.  The head is
    the first HEAD lines that are not blank.  A page is worth its title's ratio,
    or the keywords' share and a little of it; without all groups it has a cap,
    with them a floor.  start_line is where all groups first stand
    within TOGETHER lines, else 0.
    """
    head = f"array_join(slice(filter(transform({_lines('t')}, x -> {_strip('x')}), x -> x <> ''), 1, {HEAD}), chr(10))"
    p = pages.select(*keys, "page", F.coalesce("text", F.lit("")).alias("t"))
    p = p.select(*keys, "page", "t", F.expr(script.norm(head)).alias("head"))
    r = rules.select(*keys, "ord", "section_id", F.expr(script.norm("title_am")).alias("title"), F.expr(f"transform(keywords, k -> {script.norm('k')})").alias("words"), F.expr(f"transform(coalesce(required_any, cast(array() as array<array<string>>)), g -> transform(g, a -> {script.norm('a')}))").alias("groups"))
    j = p.join(r, keys)
    score = F.expr(matching.section_score("title", "head", "words", "groups"))
    start = F.expr(f"coalesce({start_line('t', 'groups', script)}, 0)")
    return j.select(*keys, "page", "ord", "section_id", score.alias("score"), start.alias("start_line"))


def detected(scores: DataFrame, keys: list[str]) -> DataFrame:
    """keys, ord, section_id, start_page, start_line, score, outcome (found, weak, undetected) of each rule.

    In rule order, each search goes on behind the page found last: the first page
    that is SURE ends it, else the first of the best counts if it is worth LEAST.
    A book's scores are one row, as its rules are searched one after the other.
    """
    cell = F.struct("page", "score", "start_line")
    per = scores.groupBy(*keys, "ord", "section_id").agg(F.sort_array(F.collect_list(cell)).alias("cells"))
    rows = per.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("ord", "section_id", "cells"))).alias("_r"))
    sure = f"try_element_at(filter(o_, c -> c.score >= {SURE}), 1)"
    best = "try_element_at(filter(o_, c -> c.score > 0 and c.score = array_max(transform(o_, x -> x.score))), 1)"
    out = f"named_struct('ord', r.ord, 'section_id', r.section_id, 'start_page', case when b_.score >= {LEAST} then b_.page end, 'start_line', case when b_.score >= {LEAST} then b_.start_line end, 'score', coalesce(b_.score, 0D), 'outcome', case when b_.score >= {SURE} then 'found' when b_.score >= {LEAST} then 'weak' else 'undetected' end)"
    step = let("filter(r.cells, c -> c.page > a.after)", "o_", let(f"coalesce({sure}, {best})", "b_", f"named_struct('after', case when b_.score >= {LEAST} then cast(b_.page as bigint) else a.after end, 'out', array_append(a.out, {out}))"))
    types = dict(scores.dtypes)
    start = f"named_struct('after', -1L, 'out', cast(array() as array<struct<ord:{types['ord']},section_id:string,start_page:{types['page']},start_line:int,score:double,outcome:string>>))"
    found = rows.select(*keys, F.explode(F.expr(f"aggregate(_r, {start}, (a, r) -> {step}, a -> a.out)")).alias("x"))
    return found.select(*keys, "x.*")


def bounded(found: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """found with end_page and end_line: up to the next section found, in rule order, or the book's last page (totals: keys, total_pages)."""
    w = Window.partitionBy(*keys).orderBy("ord")
    known = found.where("start_page IS NOT NULL").withColumn("_np", F.lead("start_page").over(w)).withColumn("_nl", F.lead("start_line").over(w))
    known = known.join(totals.select(*keys, "total_pages"), keys)
    mid = F.col("_nl") > 0
    known = known.withColumn("end_page", F.when(F.col("_np").isNull(), F.col("total_pages")).otherwise(F.col("_np") - F.when(mid, 0).otherwise(1))).withColumn("end_line", F.when(mid, F.col("_nl")))
    none = found.where("start_page IS NULL").withColumn("end_page", F.lit(None).cast(dict(known.dtypes)["end_page"])).withColumn("end_line", F.lit(None).cast("int"))
    return known.drop("_np", "_nl", "total_pages").unionByName(none)


def paragraph_kind(lines: Column, text: Column, category: Column, score: Column, script: Script = Script()) -> Column:
    """heading, scripture_reference, instruction, or by the section's category stanza, hymn, prayer; else unknown."""
    first = tx.strip(F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit("")))
    any_ = lambda c, words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))
    kind = F.when(score >= SURE, "heading").when((F.size(lines) <= 2) & any_(first, script.heading), "heading").when(any_(text, script.scripture), "scripture_reference").when(any_(text, script.instruction), "instruction")
    for end, short, long_ in script.kinds:
        kind = kind.when(category.endswith(end), F.when(F.size(lines) <= 4, short).otherwise(long_))
    return kind.otherwise("unknown")


def section_blocks(sections: DataFrame, pages: DataFrame, rules: DataFrame, keys: list[str], script: Script = Script()) -> DataFrame:
    """keys, ord, section_id, block_id, page, block_type, title_am, title_en, text, lines, confidence, notes: the paragraphs of each bounded section.

    pages: keys, page, text, confidence, notes.  A page shared by sections is cut
    at their lines.  Blocks are numbered through a section.
    """
    own = sections.where("start_page IS NOT NULL AND end_page >= start_page").withColumn("page", F.explode(F.sequence("start_page", "end_page")))
    j = own.join(pages, [*keys, "page"]).withColumn("_v", F.expr(_lines("coalesce(text, '')")))
    first = F.when(F.col("page") == F.col("start_page"), F.col("start_line")).otherwise(0)
    after = F.when((F.col("page") == F.col("end_page")) & F.col("end_line").isNotNull(), F.col("end_line")).otherwise(F.size("_v"))
    j = j.withColumn("_v", F.slice("_v", first + 1, F.greatest(F.lit(0), after - first)))
    starts = "filter(sequence(0, size(_v) - 1), i -> btrim(_v[i], s_) <> '' and (i = 0 or btrim(_v[i - 1], s_) = ''))".replace("s_", lit(tx.SPACES))
    blank = "try_element_at(filter(sequence(p, size(_v) - 1), i -> btrim(_v[i], s_) = ''), 1)".replace("s_", lit(tx.SPACES))
    cut = f"transform({starts}, p -> transform(slice(_v, p + 1, coalesce({blank}, size(_v)) - p), x -> trim(trailing {lit(tx.SPACES)} from x)))"
    j = j.withColumn("_p", F.expr(f"case when size(_v) = 0 then cast(array() as array<array<string>>) else {cut} end"))
    j = j.select(*keys, "ord", "section_id", "page", "confidence", "notes", F.posexplode("_p").alias("_i", "lines")).withColumn("text", F.array_join("lines", "\n"))
    # A paragraph is scored as a page of its own, against its section's rule alone.
    r = rules.select(*keys, "section_id", "category", "title_am", "title_en", "keywords", "required_any")
    j = j.join(r, [*keys, "section_id"])
    own_rule = j.select(*keys, "section_id", "ord", "page", "_i", "text", "title_am", "keywords", "required_any")
    scored = _scored_alone(own_rule, keys, script)
    j = j.join(scored, [*keys, "section_id", "page", "_i"])
    n = F.row_number().over(Window.partitionBy(*keys, "section_id").orderBy("page", "_i"))
    kind = paragraph_kind(F.col("lines"), F.col("text"), F.col("category"), F.col("_score"), script)
    j = j.withColumn("block_type", kind).withColumn("block_id", F.format_string("%s_%03d", "section_id", n))
    title = F.when(F.col("block_type") == "heading", F.try_element_at("lines", F.lit(1)))
    return j.select(*keys, "ord", "section_id", "block_id", "page", "block_type", title.alias("title_am"), F.when(F.coalesce(title, F.lit("")) != "", F.col("title_en")).alias("title_en"), "text", "lines", "confidence", "notes")


def _scored_alone(rows: DataFrame, keys: list[str], script: Script) -> DataFrame:
    """Scores of texts that each carry their one rule, through section_scores with a row's name as its book."""
    name = F.struct(*keys, "section_id", "page", "_i")
    x = rows.select(name.alias("_row"), F.col("page"), F.col("text"), F.col("ord"), F.col("section_id"), "title_am", "keywords", "required_any")
    pages = x.select("_row", "page", "text")
    rules = x.select("_row", "ord", "section_id", "title_am", "keywords", "required_any")
    s = section_scores(pages, rules, ["_row"], script)
    return s.select(*[F.col("_row")[k].alias(k) for k in [*keys, "section_id", "page", "_i"]], F.col("score").alias("_score"))


# ---- recognition attempts ------------------------------------------------------------


def candidate_plan(languages: Column, script: str = "amh", other: str = "eng") -> Column:
    """array<struct(source, language, mode)> of the attempts at a page, from the languages there are.

    Processed images are read in the script's language, then with the other one
    beside it (or in the other one alone), in every mode; originals in the widest
    of these.  Without either language there is no attempt.
    """
    a, b = F.array_contains(languages, script), F.array_contains(languages, other)
    tried = F.array_compact(F.array(F.when(a, script), F.when(a & b, f"{script}+{other}").when(b, other)))
    one = lambda source, language, m: F.struct(F.lit(source).alias("source"), language.alias("language"), F.lit(m).alias("mode"))
    first = F.flatten(F.transform(tried, lambda x: F.array(*[one("processed", x, m) for m in PROCESSED])))
    last = F.array(*[one("original", F.try_element_at(tried, F.lit(-1)), m) for m in ORIGINAL])
    return F.when(F.size(tried) == 0, F.slice(first, 1, 0)).otherwise(F.concat(first, last))


def best_attempts(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """The attempt with the highest score of each page, the first of equal ones; adds variants_tried. attempts: keys, seq, score, ..."""
    rest = [c for c in attempts.columns if c not in keys]
    g = attempts.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("score", -F.col("seq"))).alias("_b"), F.count("*").alias("variants_tried"))
    return g.select(*keys, "_b.*", "variants_tried")


def page_notes(confidence: Column, letters: Column, before: Column) -> Column:
    """What a reader should know of a page: given notes, then those on its confidence and on how little text it has."""
    doubt = F.when(confidence.isNull(), NO_CONFIDENCE).when(confidence < DOUBTFUL, LOW_CONFIDENCE)
    return F.concat(before, F.array_compact(F.array(doubt, F.when(letters < FEW, LITTLE_TEXT))))


def stored_results(texts: DataFrame, previous: DataFrame, keys: list[str], script: Script = Script(), latin=tx.ALPHABETS["latin"], page_number: str = tx.PAGE_NUMBER, watermark: str = tx.WATERMARK) -> DataFrame:
    """Page results from stored raw texts (keys, raw_text) and an earlier map (keys, ocr_source, ocr_language, psm, confidence, variants_tried, notes as text).

    Texts are cleaned and counted again; values of the map that are no numbers
    count as missing.
    """
    j = texts.join(previous, keys, "left").withColumn("_c", tx.clean_lines(F.coalesce("raw_text", F.lit("")), script.letters, latin, page_number, watermark))
    t = F.col("_c.text")
    number = lambda c, kind: F.expr(f"try_cast({c} as {kind})")
    old = F.filter(F.transform(F.split(F.coalesce("notes", F.lit("")), r"\|"), lambda x: tx.strip(x)), lambda x: x != "")
    j = j.withColumn("_n", tx.count_in(t, script.letters)).withColumn("_conf", number("confidence", "double"))
    return j.select(
        *keys, "raw_text", t.alias("text"), F.col("_conf").alias("confidence"),
        F.coalesce("ocr_source", F.lit("reused")).alias("source"), F.coalesce("ocr_language", F.lit("reused")).alias("language"),
        F.coalesce(number("psm", "int"), F.lit(0)).alias("mode"), F.coalesce(number("variants_tried", "int"), F.lit(0)).alias("variants_tried"),
        F.col("_n").alias("letters"), tx.count_in(t, latin).alias("latin"), tx.nonempty_lines(t).alias("lines"),
        F.col("_c.removed").alias("removed"), page_notes(F.col("_conf"), F.col("_n"), old).alias("notes"),
    )


# ---- maps and reports ------------------------------------------------------------------


def doubtful(confidence: Column, letters: Column) -> Column:
    return confidence.isNull() | (confidence < DOUBTFUL) | (letters < FEW)


def page_rows(pages: DataFrame, sections: DataFrame, keys: list[str]) -> DataFrame:
    """The page map: each page with the sections that hold it, in their order, joined by |. pages: keys, page, source, language, mode, confidence, letters, variants_tried, notes; sections: keys, ord, section_id, title_am, start_page, end_page."""
    own = sections.where("start_page IS NOT NULL AND end_page >= start_page").select(*keys, "ord", "section_id", "title_am", F.explode(F.sequence("start_page", "end_page")).alias("page"))
    per = own.groupBy(*keys, "page").agg(F.sort_array(F.collect_list(F.struct("ord", "section_id", "title_am"))).alias("_s"))
    j = pages.join(per, [*keys, "page"], "left")
    joined = lambda f, empty: F.coalesce(F.array_join(F.transform("_s", lambda s: s[f].cast("string")), "|"), F.lit(empty))
    shared = F.when(F.size("_s") > 1, F.concat(F.lit("Transition page split across sections: "), F.array_join(F.transform("_s", lambda s: s["section_id"]), " | ")))
    notes = F.array_join(F.concat("notes", F.array_compact(F.array(shared))), " | ")
    return j.select(
        *keys, "page", joined("section_id", UNASSIGNED).alias("section_id"), joined("ord", "").alias("section_order"), joined("title_am", "").alias("section_title_am"),
        F.col("source").alias("ocr_source"), F.col("language").alias("ocr_language"), F.col("mode").alias("psm"), "confidence",
        F.when(doubtful(F.col("confidence"), F.col("letters")), "yes").otherwise("no").alias("low_confidence"), "variants_tried", notes.alias("notes"),
    )


def quality_report(pages: DataFrame, rows: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pages_with_low_confidence, pages_requiring_manual_review, missing_or_uncertain_sections, removed_artifacts, has_unassigned.

    pages: keys, page, confidence, letters, removed; rows: of page_rows; found:
    of detected.  Of a page's artefacts the first PAGE_ARTEFACTS are listed, of a
    book's the first BOOK_ARTEFACTS.
    """
    low = doubtful(F.col("confidence"), F.col("letters"))
    j = pages.select(*keys, "page", low.alias("_low"), "removed").join(rows.select(*keys, "page", (F.col("section_id") == UNASSIGNED).alias("_free")), [*keys, "page"])
    said = F.transform(F.slice("removed", 1, PAGE_ARTEFACTS), lambda x: F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(": "), x))
    listed = lambda c: F.sort_array(F.collect_list(F.when(c, F.col("page"))))
    g = j.groupBy(*keys).agg(
        listed(F.col("_low")).alias("pages_with_low_confidence"), listed(F.col("_low") | F.col("_free")).alias("pages_requiring_manual_review"),
        F.slice(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("page", said.alias("s")))), lambda x: x["s"])), 1, BOOK_ARTEFACTS).alias("removed_artifacts"),
        F.coalesce(F.bool_or("_free"), F.lit(False)).alias("has_unassigned"),
    )
    warn = F.when(F.col("outcome") == "undetected", F.concat("section_id", F.lit(" was not detected confidently."))).when(F.col("outcome") == "weak", F.concat("section_id", F.lit(" was weakly detected on page "), F.col("start_page").cast("string"), F.lit(" (score "), F.col("score").cast("string"), F.lit(").")))
    w = found.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.when(warn.isNotNull(), F.struct("ord", warn.alias("w"))))), lambda x: x["w"]).alias("missing_or_uncertain_sections"))
    return g.join(w, keys, "left").withColumn("missing_or_uncertain_sections", F.coalesce("missing_or_uncertain_sections", F.expr("cast(array() as array<string>)")))


def validation_summary(sections: DataFrame, rows: DataFrame, totals: DataFrame, keys: list[str], expected: int = 12, weekday: str = "_weekday", weekdays: int = 7) -> DataFrame:
    """keys, sections_count(_ok), weekday_sections(_ok), page_map_rows(_ok), no_page_numbers_missing_from_map. weekday: how the category of a weekday's section ends. sections: keys, category; totals: keys, total_pages."""
    s = sections.groupBy(*keys).agg(F.count("*").alias("sections_count"), F.count_if(F.col("category").endswith(weekday)).alias("weekday_sections"))
    r = rows.groupBy(*keys).agg(F.count("*").alias("page_map_rows"), F.countDistinct("page").alias("_d"), F.min("page").alias("_a"), F.max("page").alias("_b"))
    j = totals.join(s, keys, "left").join(r, keys, "left").fillna(0, ["sections_count", "weekday_sections", "page_map_rows", "_d"])
    n = F.col("total_pages")
    whole = (F.col("page_map_rows") == n) & (F.col("_d") == n) & ((n == 0) | ((F.col("_a") == 1) & (F.col("_b") == n)))
    return j.select(*keys, "sections_count", (F.col("sections_count") == expected).alias("sections_count_ok"), "weekday_sections", (F.col("weekday_sections") == weekdays).alias("weekday_sections_ok"), "page_map_rows", (F.col("page_map_rows") == n).alias("page_map_rows_ok"), F.coalesce(whole, F.lit(False)).alias("no_page_numbers_missing_from_map"))
