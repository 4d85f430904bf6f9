"""Draft transcripts on hand-made pages, and location and colouring against their definitions on random texts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from folioflow.functions import text as tx
from folioflow.operators import drafts

LETTER = tx.char_class(tx.ALPHABETS["letter"])


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


def nearest(text, needle, expected, taken):
    """All stretches that qualify, the best of them."""
    needle = needle.strip("። ")
    most = max(1, math.ceil(len(needle) / 3))
    fit = []
    for s in range(len(text)) if needle else ():
        if text[s].isspace() or (s and text[s - 1].isalpha()):
            continue
        for n in range(max(1, len(needle) - most), len(needle) + most + 1):
            d = distance(text[s : s + n], needle)
            if s + n <= len(text) and d <= most and all(e <= s or s + n <= b for b, e in taken):
                fit.append((d, abs(s / len(text) - expected), s, n))
    return (min(fit)[2], min(fit)[2] + min(fit)[3]) if fit else None


def red_flags(text, runs, attached):
    letter = str.isalpha
    red = [False] * len(text)
    for s, e in runs:
        while s and letter(text[s - 1]):
            s -= 1
        while e < len(text) and (letter(text[e]) or text[e] in attached):
            e += 1
        red[s:e] = [True] * (e - s)
    out = list(red)
    for i, c in enumerate(text):
        if c.isspace() or c in attached:
            a, b = i, i
            while a >= 0 and (text[a].isspace() or text[a] in attached):
                a -= 1
            while b < len(text) and (text[b].isspace() or text[b] in attached):
                b += 1
            out[i] = red[i] or (a >= 0 and b < len(text) and red[a] and red[b])
    return out


def test_location_and_colour_by_definition(spark):
    rng, rows = random.Random(7), []
    latin = tx.char_class(((0x41, 0x5A), (0x61, 0x7A)))
    for i in range(150):
        text = "".join(rng.choice("abc .!") for _ in range(rng.randrange(0, 30)))
        readings = [(text[k : k + rng.randrange(1, 7)] + rng.choice(["", "a", "c "]), rng.random()) for k in (rng.randrange(len(text) + 1) for _ in range(rng.randrange(4)))]
        rows.append((i, text, readings))
    df = spark.createDataFrame(rows, "i int, t string, r array<struct<reading:string,expected:double>>")
    df = df.withColumn("hits", F.expr(drafts.all_located("t", "r", latin)))
    df = df.withColumn("runs", F.filter("hits", lambda h: h.isNotNull())).withColumn("spans", F.expr(drafts.coloured_spans("t", "runs", latin, ".!")))
    found = 0
    for row in df.collect():
        taken, want = [], []
        for r in rows[row.i][2]:
            hit = nearest(row.t, r[0], r[1], taken)
            want.append(hit)
            taken += [hit] if hit else []
        assert [h and (h.s, h.e) for h in row.hits] == want
        flags = red_flags(row.t, taken, ".!")
        assert "".join(s.t for s in row.spans) == row.t
        assert [s.c == "red" for s in row.spans for _ in s.t] == flags
        assert all(a.c != b.c for a, b in zip(row.spans, row.spans[1:]))
        found += len(taken)
    assert found > 60


def test_red_draft(spark):
    regions = [
        (7, 0, "Page-header", "፫ የረቡዕ ጸሎት", 0.0, 0.0, 900.0, 40.0),
        (7, 1, "Text", "፬. ሰላም ለኪ\nእመ ብርሃን ::", 0.0, 60.0, 1000.0, 300.0),
        (7, 2, "Text", "see example.org", 0.0, 400.0, 1000.0, 440.0),
        (7, 3, "Picture", "ሥዕል", 0.0, 500.0, 1000.0, 900.0),
        (7, 4, "Footnote", "ማስታወሻ", 0.0, 900.0, 1000.0, 950.0),
        (8, 0, "Picture", None, 0.0, 0.0, 10.0, 10.0),
    ]
    readings = [(7, 0, "እመ ብርሃን", 100.0, 180.0, 500.0, 280.0), (7, 1, "ገብርኤል መልአክ", 500.0, 100.0, 800.0, 180.0), (7, 2, "በ በ በ", 10.0, 100.0, 50.0, 150.0), (7, 3, "ሰላም", 2000.0, 2000.0, 2100.0, 2050.0), (7, 4, "x", 10.0, 100.0, 50.0, 150.0)]
    r = spark.createDataFrame(regions, "page int, ord int, category string, text string, x1 double, y1 double, x2 double, y2 double")
    q = spark.createDataFrame(readings, "page int, ord int, text string, x1 double, y1 double, x2 double, y2 double")
    got = {x.page: x for x in drafts.red_drafts(r, q, [r"example\.org"]).collect()}
    page = got[7]
    assert page.page_header == "፫ የረቡዕ ጸሎት" and page.error is None
    assert [(b.type, b.verse_num_am) for b in page.blocks] == [("verse", "፬"), ("instruction", "")]
    assert [(s.t, s.c) for s in page.blocks[0].spans] == [("ሰላም ለኪ ", "black"), ("እመ ብርሃን።", "red")]
    assert [u.text for u in page.uncertain] == ["ገብርኤል መልአክ"]
    assert (page.red_regions, page.red_located) == (4, 1)
    assert got[8].error == "page 8: no text blocks after cleanup"


def test_region_draft(spark):
    regions = [(1, 0, "Title", "ሰላም  ፩ ", 0.0, 0.0, 30.0, 20.0), (1, 1, "Text", "other words", 0.0, 30.0, 30.0, 50.0), (2, 0, "Picture", None, 0.0, 0.0, 9.0, 9.0)]
    words = [(1, 1, 2, "፩", False, 20.0, 0.0, 30.0, 20.0), (1, 1, 1, "ሰላም", True, 0.0, 0.0, 20.0, 20.0), (1, 2, 1, "other", True, 0.0, 30.0, 10.0, 50.0)]
    r = spark.createDataFrame(regions, "page int, ord int, category string, text string, x1 double, y1 double, x2 double, y2 double")
    w = spark.createDataFrame(words, "page int, line long, word long, text string, is_red boolean, x1 double, y1 double, x2 double, y2 double")
    got = {x.page: x for x in drafts.region_drafts(r, w).collect()}
    first, second = got[1].blocks
    assert first.type == "title" and [(s.t, s.c) for s in first.spans] == [("ሰላም", "red"), ("  ፩ ", "black")] and first.colour_aligned
    assert [(s.t, s.c) for s in second.spans] == [("other words", "black")] and got[1].colour_unresolved == [1]
    assert got[2].error and got[2].blocks is None


def test_word_draft(spark):
    words = [(1, 1, 1, "ርእስ", 90.0, True), (1, 2, 1, "፩", 95.0, False), (1, 2, 2, "ቃል", 40.0, False), (1, 2, 3, "ቀይ", 90.0, True), (1, 3, 1, "ቀጣይ", 90.0, True), (1, 4, 1, "፪", 90.0, False), (1, 5, 1, "ሌላ", 90.0, False), (1, 6, 1, "፫", 90.0, False)]
    lines = [(1, 1, True, 10, 40), (1, 2, False, 50, 80), (1, 3, False, 90, 120), (1, 4, False, 130, 150), (1, 5, False, 160, 190), (1, 6, False, 960, 985)]
    pages = spark.createDataFrame([(1, 1000, 8), (2, 1000, 0)], "page int, height int, word_count int")
    got = {x.page: x for x in drafts.word_drafts(pages, spark.createDataFrame(lines, "page int, line int, looks_like_title boolean, top int, bottom int"), spark.createDataFrame(words, "page int, line int, word int, text string, conf double, is_red boolean")).collect()}
    assert [(b.type, b.verse_num_am, [(s.t, s.c) for s in b.spans]) for b in got[1].blocks] == [
        ("title", "", [("ርእስ", "red")]),
        ("verse", "፩", [("ቃል", "black"), ("ቀይ ቀጣይ", "red")]),
        ("verse", "፪", [("ሌላ", "black")]),
    ]
    assert [(u.text, u.why) for u in got[1].uncertain] == [("ቃል", "Tesseract confidence 40 — check against the scan")]
    assert [c.edge for c in got[1].clipped] == ["top", "bottom"] and "1 of 8 words" in got[1].notes
    assert got[2].blocks == [] and got[2].clipped == []


def test_vision_draft(spark):
    words = [(1, 1, "ሀ", 1, "SPACE", 0.9, True), (1, 2, "ለ", 1, "", 0.5, True), (1, 3, "ሐ", 1, "LINE_BREAK", 0.0, False), (1, 4, "መ", 2, "", 0.79, False), (1, 5, "ሠ", 1, "", 0.95, False)]
    pages = spark.createDataFrame([(1,), (2,)], "page int")
    w = spark.createDataFrame(words, "page int, word int, text string, parent int, break_after string, conf double, is_red boolean")
    got = {x.page: x for x in drafts.vision_drafts(pages, w).collect()}
    assert [[(s.t, s.c) for s in b.spans] for b in got[1].blocks] == [[("ሀ ለ", "red"), ("ሐ ", "black")], [("መ", "black")], [("ሠ", "black")]]
    assert [u.text for u in got[1].uncertain] == ["ለ", "መ"] and got[1].mean_confidence == pytest.approx(0.785, abs=1e-9)
    assert got[2].blocks == [] and got[2].notes == "Google Vision returned no text for this page."


def test_adoption(spark):
    pages = spark.createDataFrame([(1,), (2,), (3,)], "page int")
    have = spark.createDataFrame([(1,), (2,)], "page int")
    red = spark.createDataFrame([(1,)], "page int")
    draft = spark.createDataFrame([(1, [("u",)])], "page int, uncertain array<struct<text:string>>")
    existing = spark.createDataFrame([(1, "page_001.json", "old"), (1, "page_001.original.json", "first"), (2, "page_002.json", "b")], "page int, name string, body string")
    legacy = spark.createDataFrame([("page_001.original.json",)], "name string")
    outcomes, base, kept = drafts.adopted(pages, have, red, draft, existing, legacy)
    assert tuple(drafts.adopt_summary(outcomes).first()) == ([1], [3], [2], 1)
    assert [(r.page, r.legacy) for r in base.collect()] == [(1, "transcripts-legacy/page_001.json")]
    assert [(r.name, r.body) for r in kept.collect()] == [("page_001.json", "old")]


def test_word_draft_moves_words_twice(spark):
    """Words go to their line and to their page, no more; those of lines that are not listed are in no block, but may be uncertain."""
    words = [(1, 1, 2, "b", 40.0, False), (1, 1, 1, "a", 90.0, True), (1, 7, 1, "lost", 10.0, False), (1, 2, 1, "c", 90.0, False)]
    lines = spark.createDataFrame([(1, 1, False, 100, 140), (1, 2, None, 150, 180), (1, 3, True, 190, 200)], "page int, line int, looks_like_title boolean, top int, bottom int")
    df = spark.createDataFrame(words, "page int, line int, word int, text string, conf double, is_red boolean")
    out = drafts.word_drafts(spark.createDataFrame([(1, 1000, 4)], "page int, height int, word_count int"), lines, df)
    got = out.collect()[0]
    assert [(b.type, [(s.t, s.c) for s in b.spans]) for b in got.blocks] == [("prayer", [("a", "red"), ("b c", "black")])]
    assert [u.text for u in got.uncertain] == ["b", "lost"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") <= 5, plan
