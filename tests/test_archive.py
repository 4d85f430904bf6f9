"""The archived form: scores against their definition, the scan, blocks, the page map and its reports."""

import difflib
import random

from pyspark.sql import functions as F

from folioflow.functions import text as tx
from folioflow.functions import matching
from folioflow.operators import archive, reports
from folioflow.sources import exports

LATIN = archive.Script(letters=((0x61, 0x7A),), numerals=((0x30, 0x39),), heading=("hymn",), scripture=("psalm",), instruction=("say",), kinds=(("week", "stanza", "hymn"),))
RULES = [("b", 1, "one", "morning hymn", ["morning"], [["hymn", "song"]], "week"), ("b", 2, "two", "evening psalm", ["dusk"], [], "week"), ("b", 3, "three", "zzz qqq", [], [[""]], "other")]


def rules(spark):
    return spark.createDataFrame(RULES, "book string, ord int, section_id string, title_am string, keywords array<string>, required_any array<array<string>>, category string").withColumn("title_en", F.upper("title_am"))


def norm(t):
    return "".join(c for c in t if "a" <= c <= "z")


def windowed(needle, text):
    ratio = lambda a, b: difflib.SequenceMatcher(None, a, b).ratio()
    if not needle or not text:
        return 0.0
    if needle in text:
        return 1.0
    if len(text) - len(needle) <= 4:
        return ratio(needle, text)
    size = max(8, len(needle))
    return max(ratio(needle, text[i : i + size]) for i in range(0, max(0, min(500, len(text)) - size) + 1, max(1, size // 4)))


def worth(text, rule):
    _, _, _, title, words, groups, _ = rule
    head = norm("\n".join([x.strip() for x in text.splitlines() if x.strip()][:6]))
    share = sum(norm(k) in head for k in words) / max(1, len(words))
    t = windowed(norm(title), head)
    base = max(t, share * 0.82 + t * 0.18)
    if groups:
        whole = all(any(norm(a) and norm(a) in head for a in g) for g in groups)
        base = max(base, 0.78) if whole else min(base, 0.52)
    return round(base, 3)


def test_window_ratio(spark):
    pairs = [("abc", "xxabcx"), ("", "a"), ("a", ""), ("abcd", "abxdyyy"), ("abcdefgh", "q" * 30 + "abxdefgh" + "q" * 30), ("abc", "z" * 600 + "ab"), ("ab", "xbxaxxx" * 90), ("ሀለሐመሠረ" * 3, "ሀለመሠረ " * 40)]
    got = spark.createDataFrame(pairs, "a string, b string").select(F.expr(matching.windowed_ratio("a", "b")).alias("r")).collect()
    assert [r.r for r in got] == [windowed(a, b) for a, b in pairs]


def test_scores_by_definition(spark):
    rng = random.Random(4)
    words = ["morning", "hymn", "evening", "psalm", "song", "Morning", "hxmn", "12", "\n", "\r\n", "\n\n", "light"]
    pages = [("b", i, "".join(rng.choice(words) + rng.choice([" ", "\n", ""]) for _ in range(rng.randrange(0, 14)))) for i in range(60)] + [("b", 98, None), ("b", 99, "")]
    df = spark.createDataFrame(pages, "book string, page int, text string")
    got = {(r.page, r.section_id): r for r in archive.section_scores(df, rules(spark), ["book"], LATIN).collect()}
    assert len(got) == 3 * len(pages)
    for _, p, text in pages:
        for rule in RULES:
            r = got[p, rule[2]]
            assert r.score == worth(text or "", rule), (text, rule)
            lines = (text or "").splitlines()
            fit = lambda part, rule=rule: all(any(norm(a) and norm(a) in norm(part) for a in g) for g in rule[5])
            assert r.start_line == next((i for i in range(min(len(lines), 24)) if fit("\n".join(lines[i : i + 3]))), 0)


def test_scan_bounds_and_blocks(spark):
    pages = spark.createDataFrame(
        [("b", 1, "evening psalm", 90.0, 50, []), ("b", 2, None, None, 0, ["www"]), ("b", 3, "intro\nmorning hymn\n\nfirst line\nnext", 70.0, 50, []), ("b", 4, "tail of it\n\nevening psalm\nsay this\n\na\nb\nc\nd\ne", 80.0, 50, []), ("b", 5, "morning hymn", 50.0, 50, ["a", "b", "c", "d", "e", "f"])],
        "book string, page int, text string, confidence double, letters int, removed array<string>",
    ).withColumn("notes", F.array(F.lit("n")))
    scores = archive.section_scores(pages, rules(spark), ["book"], LATIN)
    found = archive.detected(scores, ["book"])
    got = {r.section_id: (r.start_page, r.start_line, r.outcome) for r in found.collect()}
    assert got == {"one": (3, 0, "found"), "two": (4, 0, "found"), "three": (None, None, "undetected")}
    moved = found.withColumn("start_line", F.when(F.col("section_id") == "two", 2).otherwise(F.col("start_line")))
    ends = archive.bounded(moved, spark.createDataFrame([("b", 5)], "book string, total_pages int"), ["book"])
    assert {r.section_id: (r.end_page, r.end_line) for r in ends.collect()} == {"one": (4, 2), "two": (5, None), "three": (None, None)}
    blocks = archive.section_blocks(ends, pages, rules(spark), ["book"], LATIN).orderBy("ord", "block_id").collect()
    assert [(b.block_id, b.page, b.block_type, b.text) for b in blocks] == [
        ("one_001", 3, "heading", "intro\nmorning hymn"),
        ("one_002", 3, "stanza", "first line\nnext"),
        ("one_003", 4, "stanza", "tail of it"),
        ("two_001", 4, "heading", "evening psalm\nsay this"),
        ("two_002", 4, "hymn", "a\nb\nc\nd\ne"),
        ("two_003", 5, "heading", "morning hymn"),
    ]
    assert (blocks[0].title_am, blocks[0].title_en, blocks[1].title_am) == ("intro", "MORNING HYMN", None)

    table = pages.withColumns({"source": F.lit("processed"), "language": F.lit("amh"), "mode": F.lit(6), "variants_tried": F.lit(8)})
    rows = archive.page_rows(table, ends.join(rules(spark).select("book", "section_id", "title_am"), ["book", "section_id"]), ["book"])
    got = {r.page: r for r in rows.collect()}
    assert [got[p].section_id for p in range(1, 6)] == [archive.UNASSIGNED, archive.UNASSIGNED, "one", "one|two", "two"]
    assert got[4].section_order == "1|2" and got[4].notes == "n | Transition page split across sections: one | two" and got[1].section_order == ""
    assert [got[p].low_confidence for p in (1, 2, 5)] == ["no", "yes", "yes"]
    q = archive.quality_report(pages, rows, found, ["book"]).first()
    assert (q.pages_with_low_confidence, q.pages_requiring_manual_review, q.has_unassigned) == ([2, 5], [1, 2, 5], True)
    assert q.removed_artifacts == ["page 2: www", *[f"page 5: {x}" for x in "abcde"]] and q.missing_or_uncertain_sections == ["three was not detected confidently."]
    v = archive.validation_summary(rules(spark), rows, spark.createDataFrame([("b", 5)], "book string, total_pages int"), ["book"], expected=3, weekday="week", weekdays=2).first()
    assert (v.sections_count_ok, v.weekday_sections_ok, v.page_map_rows_ok, v.no_page_numbers_missing_from_map) == (True, True, True, True)
    conf = reports.confidence_summary(pages, ["book"], F.col("confidence")).first()
    assert (conf.min, conf.median, conf.mean, conf.max) == (50.0, 75.0, 72.5, 90.0)
    md = exports.extraction_markdown("Report", {"Pages": 5}, ends, conf, q, rows)
    assert "- Found: 2 / 3" in md and "| 2 | `two` | 4 | 5 |" in md and "pages: 1, 2\n" in md
    assert archive.detected(scores.where("false"), ["book"]).count() == 0


def test_plan_and_best_attempt(spark):
    df = spark.createDataFrame([(1, ["amh", "eng"]), (2, ["amh"]), (3, ["eng", "x"]), (4, [])], "i int, l array<string>")
    got = {r.i: [tuple(x) for x in r.p] for r in df.select("i", archive.candidate_plan(F.col("l")).alias("p")).collect()}
    assert got[1] == [("processed", "amh", 6), ("processed", "amh", 4), ("processed", "amh", 3), ("processed", "amh+eng", 6), ("processed", "amh+eng", 4), ("processed", "amh+eng", 3), ("original", "amh+eng", 4), ("original", "amh+eng", 6)]
    assert got[2][-1] == ("original", "amh", 6) and got[3][0] == ("processed", "eng", 6) and got[4] == []
    a = spark.createDataFrame([(1, 1, 5.0, "a"), (1, 2, 7.0, "b"), (1, 3, 7.0, "c")], "page int, seq int, score double, text string")
    assert [(r.text, r.variants_tried) for r in archive.best_attempts(a, ["page"]).collect()] == [("b", 3)]


def test_cleaner_and_score(spark):
    text = "  ሰላም \t ለኪ \r\n\r\nvisit www.x.y\n\n\n፩ 12 .\nLatin only\nሁለተኛ a\n\n"
    df = spark.createDataFrame([(text, 61.5, 30), ("", None, 0)], "t string, c double, w int")
    r = df.select(tx.clean_lines(F.col("t")).alias("c"), tx.candidate_score(F.col("t"), F.col("c"), F.col("w")).alias("s")).collect()
    assert r[0].c.text == "ሰላም ለኪ\n\nሁለተኛ a"
    assert r[0].c.removed == ["website/watermark: visit www.x.y", "page number: ፩ 12 .", "latin artifact: Latin only"]
    n, m = 10, 20
    assert abs(r[0].s - (61.5 + n / 35 + 20 * n / (n + m) + 2.0 + 0.5 - 18 * m / (n + m) - 4 - 10)) < 1e-9
    assert r[1].c.text == "" and r[1].s == -10.0


def test_stored_texts(spark, tmp_path):
    from folioflow.sources.books import read_page_map

    (tmp_path / "m.csv").write_text('page,section_id,confidence,notes\n3,a|b,,"x, ""y"""\n')
    assert [tuple(r) for r in read_page_map(spark, str(tmp_path / "m.csv")).select("page", "section_id", "psm", "confidence", "notes").collect()] == [(3, "a|b", None, None, 'x, "y"')]
    assert read_page_map(spark, str(tmp_path / "none.csv")).count() == 0
    t = spark.createDataFrame([("b", 1, "ሰላም " * 10), ("b", 2, "x")], "book string, page int, raw_text string")
    p = spark.createDataFrame([("b", 1, "processed", "amh", "6", "59.5", "bad", " one | | two ")], "book string, page int, ocr_source string, ocr_language string, psm string, confidence string, variants_tried string, notes string")
    got = {r.page: r for r in archive.stored_results(t, p, ["book", "page"]).collect()}
    assert (got[1].mode, got[1].variants_tried, got[1].confidence, got[1].letters) == (6, 0, 59.5, 30)
    assert got[1].notes == ["one", "two", archive.LOW_CONFIDENCE]
    assert (got[2].source, got[2].text, got[2].notes) == ("reused", "", [archive.NO_CONFIDENCE, archive.LITTLE_TEXT])


def test_stored_texts_keep_lines_with_addresses_where_no_rule_drops_them(spark):
    t = spark.createDataFrame([(1, "ሰላም " * 10 + "a@b.com")], "page int, raw_text string")
    p = spark.createDataFrame([], "page int, ocr_source string, ocr_language string, psm string, confidence string, variants_tried string, notes string")
    assert archive.stored_results(t, p, ["page"]).first().letters == 0
    assert archive.stored_results(t, p, ["page"], watermark="^$.").first().letters == 30
